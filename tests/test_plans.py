"""What the physical plans must and must not contain."""

import pytest

from likeness.operators import analyses as an
from likeness.operators import evaluate as ev
from likeness.operators import export as xp
from likeness.operators import extract as ex
from likeness.operators import merge as mg
from likeness.operators import patterns as pt
from likeness.operators.segments import bronze_segments
from likeness.session import staged
from registry.corpus import SENTENCES


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored_segments(lines_of):
    return staged(bronze_segments(lines_of(*SENTENCES)), "segments")


def test_extraction_is_one_narrow_stage_without_python(stored_segments):
    for df in (
        ex.gold_candidates(stored_segments),
        ex.variant_candidates(stored_segments),
        xp.clean_candidates(ex.gold_candidates(stored_segments)),
    ):
        plan = _plan(df)
        assert "Python" not in plan
        assert "Arrow" not in plan
        assert "Exchange hashpartitioning" not in plan
        assert plan.count("FileScan") == 1


def test_scan_reads_only_needed_columns(stored_segments):
    plan = _plan(ex.gold_candidates(stored_segments).groupBy("ground_lemma").count())
    columns = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert columns == "text_normalized:string,match_text:string"


def test_evaluation_tables_scan_once(stored_segments):
    matches = ex.variant_matches(stored_segments, list(pt.VARIANTS))
    assert _plan(ev.comparison_table(matches)).count("FileScan") == 1
    assert _plan(xp.manifest(xp.clean_candidates(ex.gold_candidates(stored_segments)))).count(
        "FileScan"
    ) == 1


def test_ranked_groups_are_limited_before_the_shuffle(stored_segments):
    gold = ex.gold_candidates(stored_segments)
    for df in (
        xp.ground_vehicle_export(xp.clean_candidates(gold)),
        an.ground_fingerprint(gold),
        an.reject_sample(ex.labelled_candidates(stored_segments)),
    ):
        assert "WindowGroupLimit" in _plan(df)
        assert "Partial" in _plan(df)


def test_fingerprint_reads_the_corpus_once(stored_segments):
    df = an.ground_fingerprint(ex.gold_candidates(stored_segments))
    df.collect()
    final = _plan(df).split("Initial Plan")[0]
    assert "ReusedExchange" in final
    assert final.count("FileScan") == 1


def test_union_keeps_patterns_apart(stored_segments):
    gold = ex.gold_candidates(stored_segments).select("candidate_id", "pattern_type")
    variants = ex.variant_candidates(stored_segments).select("pattern_type", "candidate_id")
    union = mg.union_patterns([gold, variants])
    assert union.count() == gold.count() + variants.count()
    assert union.select("pattern_type").distinct().count() == 5
