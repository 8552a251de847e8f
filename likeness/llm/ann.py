"""Approximate nearest neighbours by cosine: multi-index hashing over learned codes.

Fit, on a bounded sample: principal axes and an iterated rotation (ITQ) that
brings the sign bits close to the rotated vectors, and the Hamming radius within
which ``COVERED`` of the sample's true neighbours lie.  Neighbours in the whole
table are closer than those in the sample, so the radius holds for it as well.

Index: the 64-bit code of every different vector is cut into eight bytes and
posted under each (byte position and value).  A code within radius ``r`` of a
query's code has a byte within ``r // 8`` of the query's byte at that position,
so probing all byte values that close retrieves every code within the radius.
In each list the whole codes are compared, those within the radius are ranked by
the cosine of the original vectors in double precision, and only a list's best
few go on.  Long lists are dealt into blocks.

Equal vectors are one entry with its few smallest ids, and equal queries are one
query, so a vector that a third of all rows hold costs no more than others.
Queries that find fewer than ``k`` rows within the radius are compared with all
vectors, block by block.

Defined results: vectors that are null or zero, of another length than the first
valid one by id, or that hold null or non-finite components take no part; rows that share the
query's id are its own and never found; ties go to the smaller id; with fewer
than ``k`` candidates all are returned; an empty table gives an empty result;
further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from likeness.llm.tables import held

BITS, PARTS = 64, 8
#: Rows of the fitting sample, and those of them that serve as its queries.
SAMPLE, SAMPLE_QUERIES = 4096, 256
#: Share of the sample's true neighbours that the radius has to cover.
COVERED = 0.98
ITERATIONS = 30
#: Vectors of a list or block that one task compares at a time.
LIST_ROWS = 8192
SEED = 11


@dataclass(frozen=True)
class Model:
    """Axes to project on (one column per bit) and the Hamming radius to search."""

    axes: np.ndarray
    radius: int


def _unit(rows: np.ndarray) -> np.ndarray:
    # Scaled first, so that no square of a component overflows or vanishes.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _codes(units: np.ndarray, axes: np.ndarray) -> np.ndarray:
    bits = np.packbits(units @ axes > 0, axis=1, bitorder="little")
    return np.ascontiguousarray(bits).view("<u8").ravel()


def fit_model(sample: np.ndarray, k: int) -> Model:
    """ITQ on the sample's unit vectors; the radius from its own neighbours."""
    units = _unit(sample)
    width = units.shape[1]
    _, _, main = np.linalg.svd(units, full_matrices=False)
    kept = min(BITS, len(main))
    basis = np.zeros((width, BITS))
    basis[:, :kept] = main[:kept].T
    rotation = np.linalg.qr(np.random.default_rng(SEED).normal(size=(BITS, BITS)))[0]
    projected = units @ basis
    for _ in range(ITERATIONS):
        signs = np.where(projected @ rotation > 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(projected.T @ signs)
        rotation = left @ right
    axes = basis @ rotation
    codes = _codes(units, axes)
    asked = min(SAMPLE_QUERIES, len(units))
    near = units[:asked] @ units.T
    near[np.arange(asked), np.arange(asked)] = -np.inf
    best = np.argsort(-near, axis=1, kind="stable")[:, : min(k, len(units) - 1)]
    away = np.bitwise_count(codes[:asked, None] ^ codes[best])
    radius = int(np.quantile(away, COVERED, method="higher")) if away.size else BITS
    return Model(axes, radius)


def valid(vector: Column) -> Column:
    """Whether a vector takes part: some component is not zero, none is null or non-finite."""
    bad = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def _code_of(axes: np.ndarray) -> Callable:
    @F.pandas_udf("long")
    def run(vectors: pd.Series) -> pd.Series:
        return pd.Series(_codes(_unit(np.array(vectors.tolist(), float)), axes).view(np.int64))

    return run


def _byte(code: Column, position: Column) -> Column:
    return F.call_function(
        "shiftrightunsigned", code, (position * 8).cast("int")
    ).bitwiseAND(F.lit(255))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(float).reshape(len(column), -1)


_FOUND = ["q", "vid", "ids", "score"]


def _search(radius: int, best: int):
    """In one list: the ``best`` nearest vectors of every query within the radius."""

    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        kinds = [
            queries.schema.field("q").type,
            vectors.schema.field("vid").type,
            pa.list_(vectors.schema.field("vid").type),
            pa.float64(),
        ]
        none = pa.table([pa.array([], t) for t in kinds], names=_FOUND)
        if not len(vectors) or not len(queries):
            return none
        made = []
        own, asked = _unit(_matrix(vectors.column("v"))), _unit(_matrix(queries.column("v")))
        codes = vectors.column("code").to_numpy().view(np.uint64)
        query_codes = queries.column("code").to_numpy().view(np.uint64)
        smallest = vectors.column("vid").to_numpy()
        step = max(1, (1 << 21) // len(own))
        for a in range(0, len(asked), step):
            part, part_codes = asked[a : a + step], query_codes[a : a + step]
            scores = part @ own.T
            scores[np.bitwise_count(part_codes[:, None] ^ codes[None, :]) > radius] = -np.inf
            # A few more than needed: their scores are computed again, one way for all lists.
            few = min(best + 4, len(own))
            top = np.argpartition(-scores, few - 1, axis=1)[:, :few]
            row = np.repeat(np.arange(len(part)), few)
            at = top.ravel()
            hit = scores[row, at] > -np.inf
            row, at = row[hit], at[hit]
            exact = (part[row] * own[at]).sum(axis=1)
            order = np.lexsort((smallest[at], -exact, row))
            row, at, exact = row[order], at[order], exact[order]
            first = np.searchsorted(row, row)
            keep = np.arange(len(row)) - first < best
            made.append(
                pa.table(
                    [
                        queries.column("q").take(pa.array(a + row[keep])),
                        vectors.column("vid").take(pa.array(at[keep])),
                        vectors.column("ids").take(pa.array(at[keep])).cast(kinds[2]),
                        pa.array(exact[keep]),
                    ],
                    names=_FOUND,
                )
            )
        return pa.concat_tables(made) if made else none

    return run


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    sample: int = SAMPLE,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found of every query row.

    ``is_query`` is a condition on a column ``vec_id``, which holds the id.
    """
    held_k = k + 1  # a query's own row may be among those found
    vector = F.col(vector_col)
    if vectors.schema[vector_col].dataType.simpleString() != "array<float>":
        vector = vector.cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("vec_id"), vector.alias("v")).where(
        valid(F.col("v")) & F.col("vec_id").isNotNull()
    )
    widths = rows.agg(F.min_by(F.size("v"), "vec_id").alias("n")).first()
    rows = rows.where(F.size("v") == F.lit(widths.n or 0))
    by_vector = Window.partitionBy("v").orderBy("vec_id")
    entries = held(
        rows.distinct()
        .withColumn("place", F.row_number().over(by_vector))
        .where(F.col("place") <= held_k)
        .groupBy("v")
        .agg(F.min("vec_id").alias("vid"), F.array_sort(F.collect_list("vec_id")).alias("ids"))
    )
    total = entries.count()
    drawn = entries.orderBy(F.xxhash64("vid"), "vid").limit(sample).select("v").collect()
    if not drawn:
        return rows.select(
            F.col("vec_id").alias("query_id"),
            F.lit(0).alias("rank"),
            "vec_id",
            F.lit(0.0).alias("score"),
        ).limit(0)
    model = fit_model(np.array([r.v for r in drawn], float), k)

    code_of = _code_of(model.axes)
    index = held(entries.withColumn("code", code_of("v")))
    members = rows.where(is_query).distinct()
    queries = (
        members.groupBy("v").agg(F.min("vec_id").alias("q")).withColumn("code", code_of("v"))
    )
    queries = held(queries)

    kind = vectors.schema[id_col].dataType.simpleString()
    found_schema = f"q {kind}, vid {kind}, ids array<{kind}>, score double"

    def compared(left: DataFrame, right: DataFrame, keys: list[str], radius: int) -> DataFrame:
        return (
            left.groupBy(*keys)
            .cogroup(right.groupBy(*keys))
            .applyInArrow(lambda a, b: _search(radius, held_k)(a, b), found_schema)
        )

    def dealt(df: DataFrame, blocks: int) -> DataFrame:
        return df.withColumn("block", F.pmod(F.xxhash64("vid"), F.lit(blocks)).cast("int"))

    def to_all(df: DataFrame, blocks: int) -> DataFrame:
        return df.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    positions = F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))
    reach = model.radius // PARTS
    blocks = -(-total // (256 * LIST_ROWS))
    listed = (
        dealt(index, blocks)
        .withColumn("part", positions)
        .withColumn("byte", _byte(F.col("code"), F.col("part")).cast("int"))
    )
    values = F.filter(
        F.sequence(F.lit(0), F.lit(255)),
        lambda x: F.bit_count(x.bitwiseXOR(F.col("own"))) <= reach,
    )
    probes = (
        to_all(queries, blocks)
        .withColumn("part", positions)
        .withColumn("own", _byte(F.col("code"), F.col("part")).cast("int"))
        .withColumn("byte", F.explode(values))
        .drop("own")
    )
    near = held(
        _best(compared(listed, probes, ["part", "byte", "block"], model.radius), held_k)
    )
    # Queries with too few rows in the radius are compared with every block of vectors.
    enough = near.groupBy("q").agg(F.sum(F.size("ids")).alias("n")).where(F.col("n") >= held_k)
    lonely = queries.join(enough, "q", "left_anti")
    whole = -(-total // LIST_ROWS)
    rest = compared(dealt(index, whole), to_all(lonely, whole), ["block"], BITS)
    top = _best(near.unionByName(rest), held_k)

    expanded = top.select("q", "score", F.explode("ids").alias("vec_id"))
    by_query = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    nearest = (
        expanded.withColumn("place", F.row_number().over(by_query))
        .where(F.col("place") <= held_k)
        .drop("place")
    )
    asking = members.join(queries.select("v", "q"), "v").select("q", F.col("vec_id").alias("query_id"))
    by_row = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        asking.join(nearest, "q")
        .where("vec_id != query_id")
        .withColumn("rank", F.row_number().over(by_row))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _best(found: DataFrame, n: int) -> DataFrame:
    """The ``n`` nearest different vectors of every query."""
    once = found.groupBy("q", "vid").agg(
        F.max("score").alias("score"), F.max("ids").alias("ids")
    )
    by_query = Window.partitionBy("q").orderBy(F.desc("score"), "vid")
    return (
        once.withColumn("place", F.row_number().over(by_query))
        .where(F.col("place") <= n)
        .drop("place")
    )
