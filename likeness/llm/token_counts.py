"""Token counts through a digest cache.

Every text is keyed by the SHA-256 of its normalised content (null is the
empty text; nothing else changes, so the key decides the count) together with
the digest of the tokenizer version: the bytes of the tokenizer file, the
library and its version and the encoding settings.  The keys join stored
counts of the cache table; only distinct keys that miss are encoded, and their
counts are appended to the cache before the answer is read from it, so a
rerun or a grown corpus encodes only what is new.

The cache is a Parquet table partitioned by the tokenizer digest, under the
shared folder that every executor reaches.  Appends commit whole or not at
all; a key stored twice (two runs at once) holds the same count and is taken
once.

Cases: null text counts as empty (0 tokens with the library's default
settings, 0 bytes); very long texts are encoded whole; repeated rows and
repeated texts share one key and one encoding; an empty table gives no rows
and appends nothing; extra input columns are not read, so clashing names do
not matter; a null doc_id stays null.

Skew: the distinct keys come from a partial aggregate, so a text with a third
of all rows is one row per map task before the shuffle.  The counts go back
to the rows by a join on the key; keys held by at least ``1 / HEAVY_SHARE`` of
all rows are at most ``HEAVY_SHARE`` by arithmetic and are broadcast, all
others are light keys of a shuffle join.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from likeness.llm.tables import filled, held
from likeness.session import shared_folder

#: Counts above this many tokens are over the limit.
LIMIT = 1024

#: A key held by at least one in this many rows is joined by broadcast.
HEAVY_SHARE = 4096

#: Texts encoded in one call of the library within a task.
BATCH = 256

#: Raised when the way counts are made changes, so that old entries are not used.
CACHE_FORMAT = "1"

_CACHE_SCHEMA = "content_sha256 string, n_tokens long, tokenizer string"

_loaded: dict[str, object] = {}


def tokenizer_digest(tokenizer_file: str) -> str:
    """Digest of the tokenizer file, its library version and the encoding settings."""
    import tokenizers

    digest = hashlib.sha256()
    with open(tokenizer_file, "rb") as handle:
        for block in iter(lambda: handle.read(1 << 20), b""):
            digest.update(block)
    settings = f"tokenizers {tokenizers.__version__}; add_special_tokens=False; format {CACHE_FORMAT}"
    digest.update(settings.encode())
    return digest.hexdigest()


def _tokenizer(tokenizer_file: str):
    """One tokenizer per Python worker, single-threaded within the task's core."""
    found = _loaded.get(tokenizer_file)
    if found is None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(tokenizer_file)
        _loaded[tokenizer_file] = found
    return found


def _encoder(tokenizer_file: str):
    """Counts of a batch of texts; the fast batch call skips offsets, same ids."""
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = _tokenizer(tokenizer_file)
        for batch in batches:
            texts = batch["text"].tolist()
            counts = []
            for start in range(0, len(texts), BATCH):
                chunk = texts[start : start + BATCH]
                found = tokenizer.encode_batch_fast(chunk, add_special_tokens=False)
                counts.extend(len(e.ids) for e in found)
            yield pd.DataFrame(
                {"content_sha256": batch["content_sha256"], "n_tokens": pd.Series(counts, dtype="int64")}
            )

    return encode


def cache_folder(spark) -> str:
    """The cache table in the shared folder."""
    return f"{shared_folder(spark)}/token_count_cache"


def _stored(spark, cache: str, version: str) -> DataFrame:
    try:
        stored = spark.read.schema(_CACHE_SCHEMA).parquet(cache)
    except Exception as error:  # no table written yet
        if "PATH_NOT_FOUND" not in str(error) and "does not exist" not in str(error):
            raise
        stored = spark.createDataFrame([], _CACHE_SCHEMA)
    return stored.filter(F.col("tokenizer") == version).select("content_sha256", "n_tokens")


def count_tokens(
    docs: DataFrame,
    tokenizer_file: str,
    cache: str | None = None,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` of every row of ``docs``.

    Encodes the distinct texts missing from ``cache`` (default: the shared
    folder's cache) and appends them there first.
    """
    spark = docs.sparkSession
    cache = cache or cache_folder(spark)
    version = tokenizer_digest(tokenizer_file)
    content = filled(text)
    digest = F.sha2(content, 256)

    # Key and size of every row, held so that the texts are read twice only: here
    # and for the texts of the misses.
    rows = held(
        docs.select(
            F.col(key).alias("row_key"),
            digest.alias("content_sha256"),
            F.octet_length(content).cast("long").alias("n_bytes"),
        )
    )
    per_key = rows.groupBy("content_sha256").agg(F.count(F.lit(1)).alias("copies"))

    # Distinct missing keys with one text each; the partial aggregate folds copies map-side.
    stored = _stored(spark, cache, version)
    missing = (
        docs.select(digest.alias("content_sha256"), content.alias("text"))
        .groupBy("content_sha256")
        .agg(F.first("text").alias("text"))
        .join(stored, "content_sha256", "left_anti")
    )
    encoded = missing.mapInPandas(_encoder(tokenizer_file), "content_sha256 string, n_tokens long")
    encoded.withColumn("tokenizer", F.lit(version)).write.mode("append").partitionBy(
        "tokenizer"
    ).parquet(cache)

    stored = _stored(spark, cache, version).groupBy("content_sha256").agg(
        F.max("n_tokens").alias("n_tokens")
    )
    per_key = per_key.join(stored, "content_sha256")
    everything = rows.agg(F.count(F.lit(1)).alias("all_rows"))
    heavy = per_key.crossJoin(everything).filter(
        F.col("copies") * F.lit(HEAVY_SHARE) >= F.col("all_rows")
    ).select("content_sha256", "n_tokens")
    tagged = rows.join(F.broadcast(heavy), "content_sha256", "left")
    light = tagged.filter(F.col("n_tokens").isNull()).drop("n_tokens").join(
        per_key.select("content_sha256", "n_tokens"), "content_sha256"
    )
    counted = tagged.filter(F.col("n_tokens").isNotNull()).unionByName(light)
    return counted.select(
        F.col("row_key").alias(key),
        "n_bytes",
        F.col("n_tokens").cast("long").alias("n_tokens"),
        (F.col("n_tokens") > LIMIT).alias("over_limit"),
    )
