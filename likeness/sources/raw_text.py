"""Raw text lines with file and line provenance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPLITS_PER_CORE = 2
BLOCK_SALTS = 64


def read_lines(
    spark: SparkSession, path: str | list[str], line_ids: str = "per_file", name_only: bool = False
) -> DataFrame:
    """Read text (plain or compressed; a path, glob or list) line by line.

    ``line_ids="per_file"`` numbers the lines of every file from 0, whatever
    else is read along with it, so candidate ids stay the same when the file
    set changes.  It costs one extra narrow pass that reads no text column.
    ``line_ids="scan_order"`` gives ids that are unique and increasing within
    one read only, without the extra pass.

    ``name_only`` keeps the file name without its folder as ``source_file``.
    """
    if line_ids not in ("per_file", "scan_order"):
        raise ValueError(f"Unknown line_ids: {line_ids}")
    scanned = _scan(spark, path)
    file = _file(name_only)
    if line_ids == "scan_order":
        return scanned.select(
            file.alias("source_file"), F.col("scan_id").alias("original_line_id"), "raw_text"
        )
    # A block is a contiguous range of one file read by one task, so ids are
    # consecutive in it.
    return _numbered(_with_blocks(scanned, _first_lines(scanned)), name_only)


def read_lines_once(
    spark: SparkSession, path: str | list[str], folder: str, name_only: bool = False
) -> DataFrame:
    """Lines numbered per file, like ``read_lines``, from one read of the text.

    The scan is written to ``folder`` (Parquet, in a folder every executor
    reaches) with its scan id and block.  The block offsets come from the
    written id columns alone, so that pass reads no text; the lines are
    numbered when the written table is read back.  Compressed text is thus
    decompressed once instead of twice.
    """
    _scan(spark, path).write.mode("overwrite").parquet(folder)
    stored = spark.read.parquet(folder)
    blocks = _first_lines(stored.select("file_path", "block_start", "scan_id"))
    return _numbered(_with_blocks(stored, blocks), name_only)


def _scan(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("scan_id"),
        F.col("value").alias("raw_text"),
    )


def _file(name_only: bool):
    file = F.col("file_path")
    return F.substring_index(file, "/", -1) if name_only else file


def _numbered(lines: DataFrame, name_only: bool) -> DataFrame:
    return lines.select(
        _file(name_only).alias("source_file"),
        (F.col("scan_id") - F.col("first_scan_id") + F.col("lines_before")).alias(
            "original_line_id"
        ),
        "raw_text",
    )


def _with_blocks(scanned: DataFrame, blocks: DataFrame) -> DataFrame:
    """Join every line with its block.

    The join has no hint: Catalyst broadcasts the block table where its measured
    size is below the threshold, and shuffles otherwise.  The keys are salted for
    that case: a compressed file is one block, whose lines would meet in one task.
    """
    salts = F.explode(F.sequence(F.lit(0), F.lit(BLOCK_SALTS - 1)))
    salted = scanned.withColumn("salt", F.pmod("scan_id", F.lit(BLOCK_SALTS)).cast("int"))
    keys = ["file_path", "block_start", "salt"]
    return salted.join(blocks.withColumn("salt", salts), keys).drop("salt")


def _first_lines(scanned: DataFrame) -> DataFrame:
    """Per input block: its first scan id and the file's lines before it."""
    blocks = scanned.groupBy("file_path", "block_start").agg(
        F.min("scan_id").alias("first_scan_id"), F.count(F.lit(1)).alias("lines")
    )
    # Prefix sums over the blocks of a file, not over its lines.
    running = F.expr(
        "coalesce(sum(lines) OVER (PARTITION BY file_path ORDER BY block_start "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    )
    return blocks.withColumn("lines_before", running).drop("lines")


def spread_lines(lines: DataFrame, partitions: int | None = None) -> DataFrame:
    """Spread lines over the cluster before CPU-heavy work.

    Meant for scans with few splits; a large splittable corpus needs no such
    shuffle.  Hash partitioning on the line key is even (the key is unique)
    and gives the same split when a task is run again.  A single-core session
    is left alone.
    """
    cores = lines.sparkSession.sparkContext.defaultParallelism
    if cores <= 1:
        return lines
    count = SPLITS_PER_CORE * cores if partitions is None else partitions
    return lines.repartition(count, "source_file", "original_line_id")
