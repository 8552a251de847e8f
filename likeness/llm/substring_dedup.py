"""Substring dedup: Rabin-Karp hashes of every window of words, counted in Spark.

1. Documents are dealt into chunks by a hash of the row, so a chunk is a bounded
   set of texts that any later stage can bring together again.
2. Each chunk hashes all its windows.  Windows repeated inside the chunk are
   known as repeated already; every different hash leaves the chunk once, packed
   by hash range, so a passage that a third of all documents share costs one
   number for each chunk, not one for each copy.
3. Each hash range counts in how many chunks a hash occurs and answers each
   chunk with those of its hashes that occur elsewhere.
4. Each chunk marks the words under its repeated windows; runs of marked words
   are the maximal removal intervals.

A window is identified by its 61-bit hash; two different windows share one with
a chance of about 35 / 2**61 for each pair.

Defined results: null and empty texts have no words; texts shorter than a window
lose nothing; repeated rows, with equal ids or not, are documents of their own
and repeat each other; null ids are allowed; an empty table gives an empty
result; further columns may have any name.  The ids keep their type.
"""

from __future__ import annotations

from itertools import compress
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from likeness.llm.hashing import text_bytes, window_hashes, word_hashes, word_spans

WINDOW = 35
#: Text bytes of a chunk at least.  A task holds one chunk and some ten times its size in numbers.
CHUNK_BYTES = 16 << 20
#: Text bytes of a chunk per square root of the corpus's bytes: every chunk still has
#: a dozen hashes for every hash range, so rows stay packed (100 MB chunks at 100 TB).
CHUNK_PER_ROOT = 10
#: Words hashed at a time.
BLOCK = 1 << 19


def _hashes(texts: pa.ChunkedArray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and first word of every window inside a row, and the rows' first words."""
    data, rows = text_bytes(texts)
    starts, ends, firsts = word_spans(data, rows)
    words = np.concatenate(
        [np.zeros(0, np.uint64)]
        + [
            word_hashes(data, starts[i : i + BLOCK], ends[i : i + BLOCK])
            for i in range(0, len(starts), BLOCK)
        ]
    )
    hashes = np.concatenate(
        [np.zeros(0, np.uint64)]
        + [
            window_hashes(words[i : i + BLOCK + window - 1], window)
            for i in range(0, len(words), BLOCK)
        ]
    )
    last = np.repeat(firsts[1:], np.diff(firsts))[: len(hashes)]  # the end of a word's row
    inside = np.flatnonzero(np.arange(len(hashes)) + window <= last)
    return hashes[inside], inside, firsts


def _packed(hashes: np.ndarray) -> bytes:
    # Byte planes of sorted numbers: the high planes hardly change and compress away.
    return np.ascontiguousarray(hashes.view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.uint64).ravel()


def _range_bounds(buckets: int) -> np.ndarray:
    return np.array([(i << 61) // buckets for i in range(1, buckets)], np.uint64)


def _count_chunk(window: int, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        hashes, _, _ = _hashes(table.column("text"), window)
        different, counts = np.unique(hashes, return_counts=True)
        cuts = np.r_[0, np.searchsorted(different, _range_bounds(buckets)), len(different)]
        chunk = table.column("chunk")[0].as_py()
        rows = []
        for bucket, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if a < b:
                single = counts[a:b] == 1
                part = different[a:b]
                rows.append((chunk, bucket, _packed(part[single]), _packed(part[~single])))
        columns = list(zip(*rows, strict=True)) or [[], [], [], []]
        types = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        return pa.table(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
            names=["chunk", "bucket", "single", "several"],
        )

    return run


def _answer_bucket(table: pa.Table) -> pa.Table:
    single = [_unpacked(x.as_py()) for x in table.column("single")]
    several = [_unpacked(x.as_py()) for x in table.column("several")]
    seen = np.sort(np.concatenate(single + several))
    repeated = np.unique(seen[1:][seen[1:] == seen[:-1]])
    chunks, answers = [], []
    for chunk, own in zip(table.column("chunk").to_pylist(), single, strict=True):
        found = own[np.isin(own, repeated, assume_unique=True)]
        if len(found):
            chunks.append(chunk)
            answers.append(_packed(found))
    return pa.table([pa.array(chunks, pa.int64()), pa.array(answers, pa.binary())], ["chunk", "repeated"])


def _remove(window: int):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        texts = docs.column("text")
        hashes, at, firsts = _hashes(texts, window)
        different, counts = np.unique(hashes, return_counts=True)
        elsewhere = [_unpacked(x.as_py()) for x in answers.column("repeated")]
        repeated = np.concatenate([different[counts > 1], *elsewhere])
        change = np.zeros(firsts[-1] + 1, np.int32)
        hits = at[np.isin(hashes, repeated)]
        np.add.at(change, hits, 1)
        np.add.at(change, hits + window, -1)
        covered = np.cumsum(change)[:-1] > 0
        kept, spans = [], []
        for i, text in enumerate(texts):
            cut = covered[firsts[i] : firsts[i + 1]]
            # bytes.split() parts at ASCII white space, like the words above.
            words = (text.as_py() or "").encode().split()
            if not cut.any():
                kept.append(b" ".join(words))
                spans.append([])
                continue
            kept.append(b" ".join(compress(words, ~cut)))
            edges = np.flatnonzero(np.diff(np.r_[False, cut, False]))
            spans.append([{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()])
        n_words = np.diff(firsts)
        removed = np.diff(np.r_[0, np.cumsum(covered)][firsts])
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table(
            {
                "doc_id": docs.column("doc_id"),
                "n_words": pa.array(n_words, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "removed": pa.array(spans, span),
                "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
            }
        )

    return run


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """``doc_id, n_words, n_removed, removed, kept_text`` for every row of ``docs``.

    ``removed`` has the removal intervals as ``(start, end)`` in words, the end
    not included; ``kept_text`` is the other words, joined by one space.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    # As many chunks as keep every core busy, and more where they would grow too large.
    largest = max(chunk_bytes, CHUNK_PER_ROOT * isqrt(size))
    parts = max(-(-size // largest), 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    chunked = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)))
    counted = chunked.groupBy("chunk").applyInArrow(
        _count_chunk(window, parts), "chunk long, bucket long, single binary, several binary"
    )
    answers = counted.groupBy("bucket").applyInArrow(_answer_bucket, "chunk long, repeated binary")
    kind = docs.schema[id_col].dataType.simpleString()
    return (
        chunked.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(
            _remove(window),
            f"doc_id {kind}, n_words long, n_removed long, "
            "removed array<struct<start: long, end: long>>, kept_text string",
        )
    )
