"""SimHash near-dedup with a byte-position inverted index and count filtering.

Fingerprints have 64 bits, eight bytes.  Two fingerprints that differ in at most
three bits agree in at least five bytes (position and value).  The index posts
each distinct fingerprint under combinations of four byte positions with their
values.  The fourteen combinations whose positions have an XOR of zero are
enough: every choice of five positions holds one of them.  Within a posting list
the bytes that a pair shares are tallied, pairs with at least five go on, and
their differing bits are counted.

A list never gives out all its pairs: links that keep the list's linked members
connected are enough for classes, so a list of n members gives at most n - 1.
Lists longer than ``MAX_LIST`` are not compared.  Their members are posted again
by 13 of 16 half bytes (the least number that such pairs share), which leaves 12
bits open and no list longer than 4096 fingerprints.  Both steps are exact.

Copies, equal texts or not, share one fingerprint and enter the index once.

Defined results: null and empty texts have fingerprint zero and are linked like
others; fewer than ``shingle`` words make one shingle of the whole sequence;
repeated rows are in one class; rows without id belong to the class of their
fingerprint, whose name is the smallest id that is not null; an empty table gives
an empty result; further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from likeness.llm.components import component_labels
from likeness.llm.tables import held

SHINGLE = 3
SEED = 42
MAX_BITS = 3
#: Bytes of eight, and half bytes of sixteen, that a pair must share.
SHARED_BYTES, SHARED_HALVES = 8 - MAX_BITS, 16 - MAX_BITS
#: Positions of the index keys: each five of eight positions hold one of these.
KEYS = [c for c in combinations(range(8), 4) if c[0] ^ c[1] ^ c[2] ^ c[3] == 0]
MAX_LIST = 4096
#: Shingles whose bits are counted at a time.
BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit by bit, what more than half of the shingles' XXH64 values have."""
    # bytes.lower() changes A-Z only, bytes.split() parts at ASCII white space.
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    size = min(shingle, len(words))
    starts = (ends - sizes)[: len(words) - size + 1].tolist()
    stops = ends[size - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    bits = np.zeros(64, np.int64)
    for i in range(0, len(starts), BLOCK):
        spans = zip(starts[i : i + BLOCK], stops[i : i + BLOCK], strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        rows = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        bits += rows.sum(axis=0, dtype=np.int64)
    major = np.packbits(bits * 2 > len(starts), bitorder="little")
    return int(major.view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            made = np.fromiter((fingerprint(t.as_py(), shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(made.view(np.int64))], ["doc_id", "fp"]
            )

    return run


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """``doc_id, fp`` for every row; ``fp`` holds the 64 bits as a signed number."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_fingerprints(shingle), f"doc_id {kind}, fp long")


def _posting_keys(fp: Column) -> Column:
    """The index keys: number of the combination, then its four bytes."""

    def key(number: int, positions: tuple[int, ...]) -> Column:
        made = F.lit(number).cast("long")
        for p in positions:
            byte = F.shiftrightunsigned(fp, 8 * p).bitwiseAND(F.lit(255))
            made = F.shiftleft(made, 8).bitwiseOR(byte)
        return made

    return F.array(*[key(i, positions) for i, positions in enumerate(KEYS)])


def _half_postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of 13 of the 16 half bytes: number of the combination, then the half bytes."""
    for batch in batches:
        fp = batch.column("fp").to_numpy().view(np.uint64)
        for number, positions in enumerate(combinations(range(16), SHARED_HALVES)):
            key = np.full(len(fp), number, np.uint64)
            for p in positions:
                key = (key << np.uint64(4)) | ((fp >> np.uint64(4 * p)) & np.uint64(15))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), batch.column("fp")], ["key", "fp"]
            )


def _shared_bytes(different: np.ndarray) -> np.ndarray:
    return (different.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)


def _shared_halves(different: np.ndarray) -> np.ndarray:
    halves = different.view(np.uint8).reshape(-1, 8)
    return ((halves & 15) == 0).sum(axis=1) + ((halves >> 4) == 0).sum(axis=1)


def _list_links(members: np.ndarray, tally, least: int) -> tuple[list, list]:
    """Verified pairs that connect what is linked within one posting list."""
    ones, others = [], []
    left = members
    while len(left) > 1:
        open_, left = [left[0]], left[1:]
        while open_ and len(left):
            one = open_.pop()
            different = left ^ one
            near = tally(different) >= least
            near[near] = np.bitwise_count(different[near]) <= MAX_BITS
            if near.any():
                found = left[near]
                ones.append(np.full(len(found), one))
                others.append(found)
                open_.extend(found)
                left = left[~near]
    return ones, others


def _links(tally, least: int, max_list: int):
    """Over rows sorted by key: links ``(a, b)``; ``b`` is null where ``a`` has to be posted again."""

    def out(ones: list, others: list) -> pa.RecordBatch:
        a = np.concatenate([np.zeros(0, np.uint64), *ones]).view(np.int64)
        b = np.concatenate([np.zeros(0, np.uint64), *others]).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    def again(members: np.ndarray) -> pa.RecordBatch:
        a = pa.array(members.view(np.int64))
        return pa.RecordBatch.from_arrays([a, pa.nulls(len(a), pa.int64())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members = None, np.zeros(0, np.uint64)  # the list that may go on
        for batch in batches:
            keys = batch.column("key").to_numpy()
            fps = batch.column("fp").to_numpy().view(np.uint64)
            if not len(keys):
                continue
            cuts = np.r_[0, np.flatnonzero(np.diff(keys)) + 1, len(keys)]
            ones, others = [], []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if keys[a] == key:
                    members = np.concatenate([members, fps[a:b]])
                else:
                    if key is not None and 1 < len(members) <= max_list:
                        found = _list_links(members, tally, least)
                        ones += found[0]
                        others += found[1]
                    elif len(members) > max_list:
                        yield again(members)
                    key, members = keys[a], fps[a:b]
                # Of a list that is too long, no more is held than makes it so.
                if len(members) > 2 * max_list:
                    yield again(members[max_list + 1 :])
                    members = members[: max_list + 1]
            yield out(ones, others)
        if len(members) > max_list:
            yield again(members)
        elif len(members) > 1:
            yield out(*_list_links(members, tally, least))

    return run


def near_links(distinct: DataFrame, max_list: int = MAX_LIST) -> DataFrame:
    """Pairs ``a, b`` of fingerprints at most three bits apart that connect each class.

    ``distinct`` has each fingerprint once, in a column ``fp``.
    """

    def linked(postings: DataFrame, tally, least: int, longest: int) -> DataFrame:
        dealt = postings.repartition("key").sortWithinPartitions("key")
        return dealt.mapInArrow(_links(tally, least, longest), "a long, b long")

    postings = distinct.select("fp", F.explode(_posting_keys(F.col("fp"))).alias("key"))
    first = held(linked(postings.select("key", "fp"), _shared_bytes, SHARED_BYTES, max_list))
    crowded = first.where("b IS NULL").select(F.col("a").alias("fp")).distinct()
    halves = crowded.mapInArrow(_half_postings, "key long, fp long")
    rest = linked(halves, _shared_halves, SHARED_HALVES, 1 << 12)
    return first.where("b IS NOT NULL").unionByName(rest)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    max_list: int = MAX_LIST,
) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs``."""
    marked = held(fingerprints(docs, id_col, text_col, shingle))
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    labels = component_labels(near_links(distinct.select("fp"), max_list))
    named = distinct.join(labels, distinct["fp"] == labels["node"], "left").select(
        "fp", "first_id", F.coalesce("label", "fp").alias("label")
    )
    named = held(named)
    classes = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    by_fp = named.join(classes, "label").select("fp", "component_id")
    return marked.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    """The 16 lower-case hex digits of a fingerprint."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_list: int = MAX_LIST
) -> DataFrame:
    """The rows of ``docs`` that carry the smallest id of their class.

    Rows that share an id stay or go together.
    """
    found = near_duplicates(docs, id_col, text_col, max_list=max_list)
    kept = found.select(F.col("component_id").alias("kept_id")).distinct()
    return docs.join(kept, docs[id_col].eqNullSafe(kept["kept_id"]), "left_semi")
