"""Connected components of a graph given as pairs, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from likeness.llm.tables import held


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest of node and neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    return (
        both.where("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.least("a", "least").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them; ``b < a`` in all pairs."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    below = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return below.unionByName(least.select("a", F.col("least").alias("b")))


def component_labels(pairs: DataFrame) -> DataFrame:
    """``node, label`` for the nodes of ``pairs`` (columns ``a`` and ``b``).

    The label is the smallest node of the component; the smallest node itself has
    no row.  A round costs two shuffles of the pairs, and the number of rounds
    grows with the logarithm of the longest chain.  Each round is a checkpoint.
    No row holds the neighbours of a node, so large components stay spread.
    """
    edges = held(
        pairs.where("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    seen = None
    while True:
        now = edges.agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")
        ).first()
        if now.n == 0 or now == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
        seen = now
        starred = _large_star(edges).distinct()
        edges = held(_small_star(starred).where("a != b").distinct())
