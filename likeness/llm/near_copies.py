"""Near-copy dedup: wide SimHash candidates, verified by the Jaccard of word shingles.

The fingerprint distance of two texts at Jaccard 0.8 is about 15 % of the bits at
any width, more than one bit a byte, so no number of bytes makes them share one:
the byte index of ``simhash`` cannot be made wide enough.  Lists come from
min-hashes of the same shingles instead, ``BANDS`` of ``ROWS`` values each; a pair
at 0.8 shares no list with a chance of 7e-5, closer pairs with less.  Within a list
SimHash fingerprints of ``width`` bits at most ``distance`` apart are candidates,
and every candidate is verified by the exact Jaccard of the 64-bit shingle hashes.

A list gives at most n - 1 candidates at first, links that keep its candidates
connected.  Where all of them hold, so does the class.  Lists in which one fails
give every candidate between members whose classes still differ.

Texts with equal shingle sets are one entry.

Defined results: null and empty texts are alike; fewer than ``shingle`` words make
one shingle of the whole sequence; ids as in ``simhash``; an empty table gives an
empty result; further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from likeness.llm.components import component_labels
from likeness.llm.tables import filled, held

SHINGLE, SIMILARITY = 5, 0.8
#: Bits of a fingerprint, and how many may differ: pairs at 0.8 differ in 39 +- 6.
WIDTH, DISTANCE = 256, 80
BANDS, ROWS = 24, 5
SEED = 42
#: Shingles that are worked on at a time.
BLOCK = 1020
_DRAWN = np.random.default_rng(SEED)
_ODD = _DRAWN.integers(1 << 63, size=BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDED = _DRAWN.integers(1 << 63, size=BANDS * ROWS, dtype=np.uint64)


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The different shingles' XXH64 values, in order."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    size = min(shingle, len(words))
    starts = (ends - sizes)[: len(words) - size + 1].tolist()
    digest = xxhash.xxh64_intdigest
    spans = zip(starts, ends[size - 1 :].tolist(), strict=True)
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, len(starts)))


def fingerprint(hashes: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Bit by bit, what more than half of the shingles have; 64 bits a word."""
    lanes = np.arange(1, width // 64 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    bits = np.zeros(width, np.int64)
    for i in range(0, len(hashes), 255):
        mixed = (hashes[i : i + 255, None] ^ lanes) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        mixed ^= mixed >> np.uint64(29)
        ones = np.unpackbits(mixed.astype("<u8").view(np.uint8), axis=1, bitorder="little")
        bits += ones.sum(axis=0, dtype=np.uint8)  # 255 rows at most
    return np.packbits(bits * 2 > len(hashes), bitorder="little").view("<u8")


def list_keys(hashes: np.ndarray) -> np.ndarray:
    """One key for each band of min-hashes."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), BLOCK):
        np.minimum(least, (hashes[i : i + BLOCK, None] * _ODD + _ADDED).min(axis=0), out=least)
    bands = least.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(b.tobytes(), i) for i, b in enumerate(bands)], np.uint64)


def _marked(shingle: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, prints, keys = [], [], []
            for text in batch.column("text"):
                hashes = shingles(text.as_py(), shingle)
                nodes.append(xxhash.xxh64_intdigest(hashes.tobytes(), SEED))
                prints.append(fingerprint(hashes, width).tobytes())
                keys.append(list_keys(hashes).view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("digest"),
                    pa.array(np.array(nodes, np.uint64).view(np.int64)),
                    pa.array(prints, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                ["doc_id", "digest", "node", "fp", "keys"],
            )

    return run


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 64):
                made = [shingles(t.as_py(), shingle).tobytes() for t in batch.column("text")[at : at + 64]]
                nodes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in made], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes.view(np.int64)), pa.array(made, pa.binary())], ["node", "hashes"]
                )

    return run


def _forest(fps: np.ndarray, distance: int) -> list[tuple[int, np.ndarray]]:
    """Candidates that connect what candidates connect: a member and others of the list."""
    made, left = [], np.arange(len(fps))
    while len(left) > 1:
        open_, left = [left[0]], left[1:]
        while open_ and len(left):
            one = open_.pop()
            near = np.bitwise_count(fps[left] ^ fps[one]).sum(axis=1) <= distance
            if near.any():
                made.append((one, left[near]))
                open_.extend(left[near].tolist())
                left = left[~near]
    return made


def _across(fps: np.ndarray, labels: np.ndarray, distance: int) -> Iterator[tuple[int, np.ndarray]]:
    """Every candidate between members of different classes."""
    for one in range(len(fps) - 1):
        near = np.bitwise_count(fps[one + 1 :] ^ fps[one]).sum(axis=1) <= distance
        others = one + 1 + np.flatnonzero(near & (labels[one + 1 :] != labels[one]))
        if len(others):
            yield one, others


def _candidates(distance: int, across: bool):
    """Over rows sorted by key: ``key, a, b, more``; ``more`` where the list has other pairs."""

    def found(key, rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(rows)
        nodes = table.column("node").to_numpy()
        raw = b"".join(table.column("fp").to_pylist())
        fps = np.frombuffer(raw, "<u8").reshape(len(nodes), -1)
        if across:
            pairs = _across(fps, table.column("label").to_numpy(), distance)
        else:
            pairs = iter(_forest(fps, distance))
        for one, others in pairs:
            n = len(others)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, key, np.int64)),
                    pa.array(np.minimum(nodes[one], nodes[others])),
                    pa.array(np.maximum(nodes[one], nodes[others])),
                    pa.array(np.full(n, len(nodes) > 2)),
                ],
                ["key", "a", "b", "more"],
            )

    def joined(made: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_, size = [], 0
        for batch in made:
            held_.append(batch)
            size += len(batch)
            if size >= 1 << 16 or len(held_) >= 4096:
                yield from pa.Table.from_batches(held_).combine_chunks().to_batches()
                held_, size = [], 0
        if held_:
            yield from pa.Table.from_batches(held_).combine_chunks().to_batches()

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []  # the list that may go on
        for batch in batches:
            keys = batch.column("key").to_numpy()
            if not len(keys):
                continue
            cuts = np.r_[0, np.flatnonzero(np.diff(keys)) + 1, len(keys)]
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if keys[a] != key:
                    if rows and (len(rows) > 1 or len(rows[0]) > 1):
                        yield from found(key, rows)
                    key, rows = keys[a], []
                rows.append(batch.slice(a, b - a))
        if rows and (len(rows) > 1 or len(rows[0]) > 1):
            yield from found(key, rows)

    return lambda batches: joined(lists(batches))


def _verified(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = []
            for one, other in zip(batch.column("one"), batch.column("other"), strict=True):
                x = np.frombuffer(one.as_buffer(), "<u8")
                y = np.frombuffer(other.as_buffer(), "<u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                same.append(both >= similarity * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(same, pa.bool_())], ["a", "b", "same"]
            )

    return run


def near_links(
    texts: DataFrame,
    marked: DataFrame,
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
    distance: int = DISTANCE,
) -> DataFrame:
    """Pairs ``a, b`` of entries of at least that similarity, which connect each class."""
    entries = marked.dropDuplicates(["node"]).select("node", "fp", F.explode("keys").alias("key"))
    schema = "key long, a long, b long, more boolean"

    def proposed(rows: DataFrame, across: bool) -> DataFrame:
        dealt = rows.repartition("key").sortWithinPartitions("key", "node")
        return held(dealt.mapInArrow(_candidates(distance, across), schema))

    def verified(pairs: DataFrame) -> DataFrame:
        nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        wanted = marked.join(nodes, "node").groupBy("node").agg(F.min("digest").alias("digest"))
        read = texts.join(wanted.select("digest").distinct(), "digest", "left_semi").select("text")
        sets = held(read.mapInArrow(_sets(shingle), "node long, hashes binary").dropDuplicates(["node"]))
        one = sets.select(F.col("node").alias("a"), F.col("hashes").alias("one"))
        other = sets.select(F.col("node").alias("b"), F.col("hashes").alias("other"))
        rows = pairs.join(one, "a").join(other, "b").select("a", "b", "one", "other")
        return held(rows.mapInArrow(_verified(similarity), "a long, b long, same boolean"))

    first = proposed(entries, across=False)
    tested = verified(first.select("a", "b").distinct())
    links = tested.where("same").select("a", "b")
    failed = tested.where("NOT same").select("a", "b")
    open_keys = held(first.where("more").join(failed, ["a", "b"]).select("key").distinct())
    if open_keys.isEmpty():
        return links
    labels = component_labels(links)
    again = entries.join(open_keys, "key", "left_semi").join(labels, "node", "left")
    again = again.select("node", "fp", "key", F.coalesce("label", "node").alias("label"))
    rest = proposed(again, across=True).select("a", "b").distinct().join(failed, ["a", "b"], "left_anti")
    return links.unionByName(verified(rest).where("same").select("a", "b"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
    width: int = WIDTH,
    distance: int = DISTANCE,
) -> DataFrame:
    """``doc_id, component_id`` for every row of ``docs``."""
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("doc_id"), filled(text_col).alias("text"))
    texts = texts.withColumn("digest", F.xxhash64("text"))
    schema = f"doc_id {kind}, digest long, node long, fp binary, keys array<long>"
    marked = held(texts.mapInArrow(_marked(shingle, width), schema))
    links = near_links(texts, marked, shingle, similarity, distance)
    labels = component_labels(links)
    distinct = marked.groupBy("node").agg(F.min("doc_id").alias("first_id"))
    named = held(
        distinct.join(labels, "node", "left").select(
            "node", "first_id", F.coalesce("label", "node").alias("label")
        )
    )
    classes = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    by_node = named.join(classes, "label").select("node", "component_id")
    return marked.select("doc_id", "node").join(by_node, "node").select("doc_id", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that carry the smallest id of their class.

    Rows that share an id stay or go together.
    """
    found = near_duplicates(docs, id_col, text_col)
    kept = found.select(F.col("component_id").alias("kept_id")).distinct()
    return docs.join(kept, docs[id_col].eqNullSafe(kept["kept_id"]), "left_semi")
