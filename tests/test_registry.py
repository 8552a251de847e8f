"""Registered queries against their SQL on the smallest driver tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from compare import connect, difference
from registry.oracle import ORACLE
from registry.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
CHECKED = """
bronze_segments prefilter_bare match_offsets labelled_candidates backend_candidates
export_ground_vehicle export_vehicle_counts manifest pattern_candidates
experiment_comparison dataset_strategy nlp_labels merged_dataset vehicle_fingerprint
english_the_counts lexicon_phrase_counts stage_counts_with_lexicon verb_groups
english_backend_candidates english_pattern_candidates english_nlp_labels
""".split()

needs_data = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no driver tables")


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@needs_data
def test_entry_gives_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["ground_lemma", "vehicle_head_lemma", "count"]
    assert df.count() > 0


@needs_data
@pytest.mark.parametrize("name", CHECKED)
def test_query_agrees_with_sql(spark, name):
    con = connect(SF_DIR)
    assert difference(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) == ""
