"""Lexicons with forms of any shape, and the cost of many connectors in one segment."""

import time

from pyspark.sql import functions as F

from likeness.functions import text as tx
from likeness.operators import evaluate as ev
from likeness.operators import extract as ex
from likeness.operators import patterns as pt
from likeness.operators.segments import bronze_segments, bronze_segments_with


def lexicon(spark, *forms, kind="quality_adjective"):
    rows = [(form, form, kind, "test", f"file{n}") for n, form in enumerate(forms)]
    return spark.createDataFrame(
        rows,
        "form string, lemma string, ground_type string, ground_source string, "
        "ground_reference_path string",
    )


def matched(segments, words):
    rows = pt.find_matches(segments, [pt.ARTICLE], words).collect()
    return sorted((r.ground_text, r.ground_start, r.connector_start, r.nth) for r in rows)


def test_forms_with_hyphens_apostrophes_and_spaces(spark, lines_of):
    segments = bronze_segments(
        lines_of(
            "Era bem-humorado como um palhaço.",
            "Era bem humorado como um palhaço.",
            "Um copo d'água como uma fonte.",
            "Era maubem humorado como um palhaço e triste como uma noite.",
        )
    )
    words = lexicon(spark, "bem-humorado", "bem humorado", "d'água", "triste")
    assert matched(segments, words) == [
        ("bem humorado", 4, 17, 0),
        ("bem-humorado", 4, 17, 0),
        ("d'água", 8, 15, 0),
        ("triste", 38, 45, 0),
    ]


def test_the_longest_form_stays_with_one_reading(spark, lines_of):
    segments = bronze_segments(lines_of("Muito bem humorado como um palhaço, falso como uma moeda."))
    words = lexicon(spark, "humorado", "bem humorado", "bem humorado", "falso")
    assert matched(segments, words) == [("bem humorado", 6, 19, 0), ("falso", 36, 42, 1)]
    gold = ex.gold_candidates(segments, words)
    assert gold.count() == gold.select("candidate_id").distinct().count() == 2


def test_segments_are_counted_after_the_lexicon(spark, lines_of):
    segments = bronze_segments(lines_of("Era torto como um arco e falso como uma moeda."))
    words = lexicon(spark, "falso")
    counts = ev.stage_counts(segments, words).first()
    assert (counts.prefiltered_rows, counts.match_rows) == (1, 1)
    found = ex.variant_matches(segments, [pt.WINDOW.pattern_type], words)
    assert ev.comparison_table(found, [pt.WINDOW.pattern_type]).first().prefiltered_rows == 1


def test_pattern_takes_the_reading_it_allows(spark, lines_of):
    segments = bronze_segments(lines_of("Era cair como pedra."))
    both = lexicon(spark, "cair").unionByName(lexicon(spark, "cair", kind="salient_verb"))
    found = pt.find_matches(segments, [pt.BARE], both).collect()
    assert [r.ground_type for r in found] == ["quality_adjective"]


def test_empty_lexicon_finds_nothing(spark, lines_of):
    segments = bronze_segments(lines_of("Era forte como um touro."))
    assert matched(segments, lexicon(spark, "x").limit(0)) == []


def test_running_sums(spark):
    for n in (1, 2, 127, 128, 129, 1000):
        df = spark.range(1).select(F.sequence(F.lit(1), F.lit(n)).alias("a"))
        got = df.select(tx.running_sums(F.col("a")).alias("s")).first().s
        assert got == [i * (i + 1) // 2 for i in range(1, n + 1)]


def test_many_connectors_cost_in_proportion(spark, lines_of):
    words = lexicon(spark, "falso")
    piece = "falso como uma moeda "

    def seconds(n):
        segments = bronze_segments(lines_of(piece * n))
        begun = time.perf_counter()
        assert pt.find_matches(segments, [pt.ARTICLE], words).count() == n
        return time.perf_counter() - begun

    seconds(100)
    assert seconds(16_000) < 8


def test_whitespace_is_collapsed_once(lines_of):
    segments = bronze_segments_with(lines_of("Era  forte como um touro."), ("como",))
    plan = ex.gold_candidates(segments)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace(piece") == 1
