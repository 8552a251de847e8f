"""The pipeline stage by stage against plain versions, and the registered queries against SQL."""

import hashlib
from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from cases import awkward, awkward_rows
from compare import connect, difference
from likeness.llm import mixing
from likeness.llm.oracle import ORACLE
from likeness.llm.tables import table
from test_dedup import classes_by_hand, fingerprint_by_hand

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(SF).is_dir(), reason="no driver tables")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@needs_data
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, name):
    assert difference(entry.queries()[name](spark, SF), connect(SF), ORACLE[name]) == ""


@needs_data
def test_stages(spark, tmp_path):
    docs, seen = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen.append(docs)
    clean, exact, near, mixed, pieces = ([tuple(r) for r in df.collect()] for df in seen)
    assert all(df.columns == COLUMNS for df in seen[:4])
    labels = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
    kept = {r[0] for r in clean}
    fine = [i for i, toxic in labels.items() if not toxic]
    assert sum(i in kept for i in fine) >= 0.95 * len(fine)

    largest = {}
    for r in clean:
        if r[1] not in largest or r[0] > largest[r[1]][0]:
            largest[r[1]] = r
    assert Counter(exact) == Counter(largest.values())

    classes = classes_by_hand([(r[0], fingerprint_by_hand(r[1])) for r in exact])
    first = {c for _, _, c in classes}
    assert Counter(near) == Counter(r for r in exact if r[0] in first)

    taken = {r.doc_id: r.taken // r.size for r in mixing.mix(seen[2]).collect() if r.taken}
    assert Counter(r[0] for r in mixed) == Counter(taken)

    digest = {r[0]: hashlib.sha256(r[1].encode()).hexdigest() for r in mixed}
    assert Counter(r[0] for r in pieces) == Counter(r[0] for r in mixed)
    assert all(r[2] == digest[r[0]] and r[1] == len(r[3]) for r in pieces)


@needs_data
def test_stages_take_awkward_rows(spark):
    docs = awkward(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert not Counter(map(tuple, out.distinct().collect())) - Counter(
            map(tuple, awkward_rows())
        ), name
    assert corpus_pipeline.encode(spark, docs, SF).count() == len(awkward_rows())
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
