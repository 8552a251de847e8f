"""A training corpus from raw documents in five stages.

Each stage gets the documents that the one before kept and the folder of the
driver tables.  All stages but the last return the columns of ``documents``.
``STAGES`` is made to be run one stage at a time, each written as Parquet and
read again; :func:`run` does that in the shared checkpoint folder.

``ORACLE_SQL`` is None: neither the trained toxicity model nor sampled pieces can
be said in SQL.  The tests hold every stage against a version of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from likeness.llm import exact_dedup, mixing, pieces, simhash, toxicity
from likeness.llm.queries import MODEL_FILE
from likeness.llm.tables import table
from likeness.session import staged

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the threshold."""
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the largest id."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class, the one with the smallest id.

    The SimHash operator with the parameters of its contract: three-word
    shingles, fingerprints linked at three differing bits or fewer, no other
    similarity test.
    """
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, as often as it takes them."""
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_pieces, decoded_sha256, pieces`` of every row; repeats of a row agree."""
    encoded = pieces.encode(
        docs.select("doc_id", "text"), MODEL_FILE, decoded_digest="decoded_sha256"
    )
    return encoded.select(
        "doc_id",
        F.size("pieces").cast("long").alias("n_pieces"),
        "decoded_sha256",
        "pieces",
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
