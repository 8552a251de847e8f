"""Chat formatting round trips and mixing against a plain simulation."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cases import awkward, awkward_rows, docs_of, empty
from likeness.llm import chat_format, mixing

TURNS = "conv_id long, turn long, role string, text string, turns string, formatted int"
ROWS = [
    (1, 1, "assistant", "</s>[INST:user]x</t><s>"),
    (1, 0, "user", "hi \\ <\\s> <\\\\s> [/INST] [\\INST]"),
    (1, 2, "assistant", ""),
    (1, 3, "assistant", None),
    (1, 4, "user", "line\nbreak"),
    (2, 0, "we[ird]%5D</s>", "x"),
    (2, 0, "we[ird]%5D</s>", "x"),
    (2, None, None, "no turn"),
    (None, 0, "user", "no id"),
    (3, 7, "assistant", "long " * 20_000),
    (4, 0, "system", ""),
]


def turns_by_hand():
    sorted_turns = defaultdict(list)
    for conv, turn, role, text in ROWS:
        key = (turn is not None, turn or 0, role or "", text or "")
        sorted_turns[conv].append((key, role or "", text or ""))
    return {c: [(r, t) for _, r, t in sorted(x)] for c, x in sorted_turns.items()}


def test_conversations_read_back(spark):
    rows = [(*r, "clash", 1) for r in ROWS]
    formatted = chat_format.format_conversations(spark.createDataFrame(rows, TURNS))
    back = chat_format.read_back(formatted, keep=("formatted",)).collect()
    want = turns_by_hand()
    assert len(back) == len(want)
    for r in back:
        assert [(t.role, t.text) for t in r.turns] == want[r.conv_id]
        assert r.loss_texts == [t for role, t in want[r.conv_id] if role == "assistant"]
    # Adjacent turns of one role are one run.
    first = next(r.formatted for r in back if r.conv_id == 1)
    assert first.count(chat_format.OPEN + chat_format.ROLE) == 3
    assert first.count(chat_format.CLOSE) == 3


def test_mask_covers_the_output(spark):
    rows = [(*r, "clash", 1) for r in ROWS]
    made = chat_format.format_conversations(spark.createDataFrame(rows, TURNS)).collect()
    for r in made:
        at = 0
        for m in r.loss_mask:
            at += m.skip + m.chars
        assert at + len(chat_format.CLOSE) == len(r.formatted)


def test_no_conversations(spark):
    none = chat_format.format_conversations(spark.createDataFrame([], TURNS))
    assert chat_format.read_back(none).count() == 0


def test_many_turns_stay_linear(spark):
    turns = spark.range(20_000).select(
        F.lit(1).alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("text "), "id").alias("text"),
    )
    row = chat_format.read_back(chat_format.format_conversations(turns)).first()
    assert len(row.turns) == 20_000
    assert row.turns[19_999].text == "text 19999"


def mix_by_hand(rows):
    """Targets by repeated resharing, then the line of turns."""
    size = defaultdict(int)
    for _, text, source in rows:
        size[source] += len((text or "").split())
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    budget, target, open_ = sum(size.values()), {}, set(order)
    while open_:
        left = budget - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 3 * size[s]}
        if not full:
            target |= share
            break
        target |= {s: 3 * size[s] for s in full}
        open_ -= full
    return size, target


@pytest.mark.parametrize("awk", [True, False])
def test_mix(spark, awk):
    if awk:
        docs, rows = awkward(spark), [(r[0], r[1], r[3]) for r in awkward_rows()]
    else:
        texts = [("word " * (i * 7 % 50)).strip() for i in range(600)]
        sources = [["big", "big", "big", "x", "y", None][i % 6] for i in range(600)]
        rows = [(i, t, s) for i, (t, s) in enumerate(zip(texts, sources, strict=True))]
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    size, target = mix_by_hand(rows)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    assert sum(r.size for r in got) == sum(size.values())
    assert all(r.taken % r.size == 0 and r.taken <= 3 * r.size for r in got if r.size)
    assert all(r.taken == 0 for r in got if not r.size)
    assert sum(r.taken for r in got) <= sum(size.values())
    taken, most = defaultdict(int), defaultdict(int)
    for r in mixing._taken(docs).collect():
        s = r.source
        assert r.target == pytest.approx(target[s])
        assert r.source_size == size[s]
        taken[s] += r.taken
        most[s] = max(most[s], r.size)
    assert all(abs(taken[s] - target[s]) <= 2 * most[s] + 1 for s in size)
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mixed_rows_repeat_what_is_taken(spark):
    docs = docs_of(spark, ["a b c", "d e", None, ""]).unionByName(
        docs_of(spark, ["f g h i j k l m"] * 9, "t").withColumn("doc_id", F.col("doc_id") + 10)
    )
    want = {r.doc_id: r.taken // r.size for r in mixing.mix(docs).collect() if r.taken}
    mixed = mixing.mixed_rows(docs)
    assert mixed.columns == docs.columns
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == want


def test_nothing_to_mix(spark):
    assert mixing.mix(empty(spark)).count() == 0
    assert mixing.mixed_rows(empty(spark)).count() == 0
    blank = mixing.mix(docs_of(spark, ["", None, " "])).collect()
    assert [(r.target, r.taken) for r in blank] == [(0.0, 0)] * 3


def test_digest_columns(spark):
    turns = spark.createDataFrame([(*r, "c", 1) for r in ROWS], TURNS)
    back = chat_format.read_back(chat_format.format_conversations(turns))
    joined = back.select("conv_id", F.sha2(F.array_join("loss_texts", ""), 256).alias("h"))
    want = {
        c: hashlib.sha256("".join(t for r, t in x if r == "assistant").encode()).hexdigest()
        for c, x in turns_by_hand().items()
    }
    assert {r.conv_id: r.h for r in joined.collect()} == want
