"""Bronze and candidate tables stored as Parquet."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from likeness import schemas
from likeness.operators.segments import bronze_segments
from likeness.session import shared_folder
from likeness.sources.raw_text import read_lines, read_lines_once, spread_lines


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Read a bronze segment table."""
    return spark.read.schema(schemas.BRONZE).parquet(path)


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """Read a gold candidate table."""
    return spark.read.schema(schemas.GOLD).parquet(path)


def read_variants(spark: SparkSession, path: str) -> DataFrame:
    """Read variant candidates; ``pattern_type`` is the partition column."""
    return spark.read.schema(schemas.VARIANT).parquet(path)


def is_complete(spark: SparkSession, path: str) -> bool:
    """True when a finished write left its ``_SUCCESS`` marker at the path."""
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return bool(marker.getFileSystem(conf).exists(marker))


def build_bronze(
    spark: SparkSession,
    input_path: str | list[str],
    line_ids: str = "per_file",
    spread: bool = False,
) -> DataFrame:
    """Bronze segments straight from raw text files.

    ``spread`` deals the lines out over the cluster first; it is worth its
    shuffle for a few large compressed files, each of which one task reads.
    Lines numbered per file are read once, through a staged copy in the shared
    folder (see ``read_lines_once``).
    """
    if line_ids == "per_file":
        staging = f"{shared_folder(spark)}/lines-{uuid.uuid4().hex}"
        lines = read_lines_once(spark, input_path, staging)
    else:
        lines = read_lines(spark, input_path, line_ids)
    return bronze_segments(spread_lines(lines) if spread else lines)


def load_or_build_bronze(
    spark: SparkSession,
    input_path: str | list[str],
    bronze_path: str,
    line_ids: str = "per_file",
    spread: bool = False,
) -> DataFrame:
    """The bronze table at ``bronze_path``, built first when it is not complete.

    Re-reading the written table cuts the raw-text lineage: later jobs start
    from splittable columnar files.
    """
    if not is_complete(spark, bronze_path):
        bronze = build_bronze(spark, input_path, line_ids, spread)
        bronze.write.mode("overwrite").parquet(bronze_path)
    return read_bronze(spark, bronze_path)


#: Folder names inside a bronze built by file.
LEDGER = "_ledger"
STAGING = "_staging"


def input_files(spark: SparkSession, input_path: str | list[str]) -> DataFrame:
    """``file_path``: the files of an input path or glob, listed without reading them.

    The binary-file source prunes its ``content`` column, so no file is opened.
    """
    listing = spark.read.format("binaryFile").load(input_path)
    return listing.select(F.col("path").alias("file_path"))


def _committed(spark: SparkSession, bronze_path: str) -> DataFrame:
    """``file_path, batch`` of every file whose segments were committed."""
    ledger = f"{bronze_path}/{LEDGER}"
    if not _exists(spark, ledger):
        return spark.createDataFrame([], "file_path string, batch string")
    return spark.read.schema("file_path string, batch string").parquet(ledger)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return bool(target.getFileSystem(conf).exists(target))


def _rename(spark: SparkSession, source: str, target: str) -> None:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    src = jvm.org.apache.hadoop.fs.Path(source)
    fs = src.getFileSystem(conf)
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(target).getParent())
    if not fs.rename(src, jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"Could not move {source} to {target}")


def build_bronze_by_file(
    spark: SparkSession,
    input_path: str | list[str],
    bronze_path: str,
    spread: bool = False,
    commit: bool = True,
) -> DataFrame:
    """The bronze of all input files, building only the files not yet in it.

    A ledger (``file_path, batch``) lists the files whose segments are in the
    table.  The input listing anti-joined with it gives the missing files; they
    are built as one batch under a staged name, moved to ``batch=<id>`` and only
    then written to the ledger, which is the commit.  A build killed before that
    leaves an unlisted folder that is never read, and the next call builds its
    files again.  Line numbers are per file, so the table equals a full build.

    ``commit=False`` stops after the move, as a killed build would (for tests).
    What reaches the driver is the list of missing file names and of batch ids.
    """
    done = _committed(spark, bronze_path)
    missing = [
        r.file_path
        for r in input_files(spark, input_path).join(done, "file_path", "left_anti").collect()
    ]
    if missing:
        batch = uuid.uuid4().hex
        staging = f"{bronze_path}/{STAGING}/{batch}"
        build_bronze(spark, missing, spread=spread).write.parquet(staging)
        _rename(spark, staging, f"{bronze_path}/batch={batch}")
        if commit:
            rows = [(path, batch) for path in missing]
            ledger = spark.createDataFrame(rows, "file_path string, batch string")
            ledger.write.mode("append").parquet(f"{bronze_path}/{LEDGER}")
    batches = sorted({r.batch for r in _committed(spark, bronze_path).select("batch").distinct().collect()})
    if not batches:
        return spark.createDataFrame([], schemas.BRONZE)
    paths = [f"{bronze_path}/batch={b}" for b in batches]
    return spark.read.schema(schemas.BRONZE).parquet(*paths)
