"""Exact dedup by skew-safe combining, in DataFrame functions only.

Three combining steps, each of which groups by the whole text next to its
digest, so a digest collision never merges different texts:

1. equal texts of one task meet in the map-side aggregation,
2. what is left merges within ``(digest, salt)`` groups; the salt comes from the
   row id, so a text that holds a third of all rows is spread over ``salts`` groups,
3. the at most ``salts`` winners of a text combine to one global winner.

Texts move twice, and only one copy for each task and salt.  Rows are then
labelled through a join on two hashes of the text (no text moves), guarded by a
check that no two different winners share both.

Defined results: null text counts as empty; empty texts are equal to each other;
the row with the largest id stays and null ids are below all others; rows that
share text and id are one document, so all of them are marked as kept by
:func:`exact_groups` and one of them is returned by :func:`deduplicate`; an empty
table gives an empty result; further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from likeness.llm.tables import filled, free_name

#: Groups that share the copies of one text before the global step.
SALTS = 16


def sha256(text: Column) -> Column:
    """The 32 bytes of SHA-256."""
    return F.unhex(F.sha2(text, 256))


def _combined(rows: DataFrame, best: Column, size: Column, salts: int) -> DataFrame:
    """One row per distinct text; ``rows`` has ``digest``, ``text`` and ``salt``."""
    salted = rows.groupBy("digest", "salt", "text").agg(best.alias("best"), size.alias("size"))
    # All texts of a digest meet in one partition: the global step and the
    # collision guard after it then need no further exchange.
    return (
        salted.repartition("digest")
        .groupBy("digest", "text")
        .agg(F.max("best").alias("best"), F.sum("size").alias("size"))
    )


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), filled(text_col).alias("text"))
    keyed = rows.select(
        "doc_id",
        "text",
        digest(F.col("text")).alias("digest"),
        F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt"),
    )
    winners = (
        _combined(keyed, F.max("doc_id"), F.count(F.lit(1)), salts)
        .select("digest", F.xxhash64("text").alias("tag"), "best", "size")
        .groupBy("digest", "tag")
        .agg(
            F.max("best").alias("keep_id"),
            F.max("size").alias("group_size"),
            F.count(F.lit(1)).alias("texts"),
        )
        .select(
            "digest",
            "tag",
            "keep_id",
            F.when(F.col("texts") == 1, F.col("group_size"))
            .otherwise(F.raise_error(F.lit("Two texts share both hashes")).cast("long"))
            .alias("group_size"),
        )
    )
    labels = rows.select(
        "doc_id",
        digest(F.col("text")).alias("digest"),
        F.xxhash64("text").alias("tag"),
        F.sha2("text", 256).alias("text_sha256"),
    )
    return labels.join(winners, ["digest", "tag"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def deduplicate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    The other columns travel with the id through the same combining steps, so
    the texts need not move a third time.  They have to be orderable.
    """
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    row = free_name(docs, "row")
    held = F.struct(
        F.col(id_col).alias("k"),
        F.col(text_col).isNotNull().alias("had_text"),
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)],
    )
    keyed = docs.select(
        filled(text_col).alias("text"),
        held.alias(row),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(salts)).alias("salt"),
    ).withColumn("digest", sha256(F.col("text")))
    kept = _combined(keyed, F.max(row), F.count(F.lit(1)), salts)
    back = {c: F.col(f"best.c{i}") for i, c in enumerate(others)}
    back[id_col] = F.col("best.k")
    back[text_col] = F.when(F.col("best.had_text"), F.col("text"))
    return kept.select(*[back[c].alias(c) for c in docs.columns])
