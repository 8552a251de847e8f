"""A tagger over distinct (head, text) pairs equals tagging row by row."""

import pandas as pd

from likeness.operators import heads as hd
from registry.queries import plain_tagger

def _rows(df):
    return sorted(map(lambda r: tuple(map(str, r)), df.collect()))


def _candidates(spark):
    rows = [(i, "Touro", "forte como um Touro") if i % 3 == 0 else (i, f"head{i % 50}", f"text {i % 70}") for i in range(3000)]
    rows += [(3000, None, "no head"), (3001, None, None), (3002, "x", None), (3003, "x", None)]
    return spark.createDataFrame(rows, "id long, vehicle_head_clean string, candidate_full_text string").repartition(5)


def test_distinct_tagging_equals_row_by_row(spark, monkeypatch):
    candidates = _candidates(spark)
    want = _rows(hd.with_tagger(candidates, plain_tagger))
    for share in (hd.HEAVY_SHARE, 3):  # everything broadcast, then one hot pair of a third
        monkeypatch.setattr(hd, "HEAVY_SHARE", share)
        got = hd.with_tagger_on_distinct(candidates, plain_tagger)
        assert got.columns == candidates.columns + ["head_lemma", "head_pos"]
        assert _rows(got) == want
    assert _rows(hd.with_tagger_on_distinct(candidates, setup=lambda: plain_tagger)) == want


def test_distinct_tagging_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "id long, vehicle_head_clean string, candidate_full_text string")
    assert hd.with_tagger_on_distinct(empty, plain_tagger).count() == 0


def test_plain_tagger():
    tags = plain_tagger(pd.DataFrame({"vehicle_head_clean": ["Touro", "rocha", None, ""], "candidate_full_text": ["a"] * 4}))
    assert list(tags["head_pos"]) == ["PROPN", "NOUN", "X", "NOUN"]
    assert list(tags["head_lemma"]) == ["touro", "rocha", None, ""]


def test_candidates_are_made_and_pairs_tagged_once(spark):
    made, tagged = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)
    schema = "id long, vehicle_head_clean string, candidate_full_text string"

    def make(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch

    def tag(batch):
        tagged.add(len(batch))
        return plain_tagger(batch)

    candidates = _candidates(spark)
    rows = candidates.count()
    pairs = candidates.select("vehicle_head_clean", "candidate_full_text").distinct().count()
    got = hd.with_tagger_on_distinct(candidates.mapInPandas(make, schema), tag)
    assert len(got.collect()) == rows
    assert (made.value, tagged.value) == (rows, pairs)
