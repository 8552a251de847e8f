"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# AQE coalesces small shuffle partitions and splits skewed joins, so the initial
# partition count only has to be an upper bound for the cluster at hand; see
# ``initial_partitions``.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    # Call sites in error messages cost a stack walk per column expression.
    "spark.sql.dataFrameQueryContext.enabled": "false",
}


def build_session(
    app_name: str = "likeness",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the engine's settings; the master is the cluster's own by default."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    chosen = dict(SETTINGS)
    if shuffle_partitions:
        chosen["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in {**chosen, **(settings or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if not shuffle_partitions and spark.conf.get(initial, None) is None:
        spark.conf.set(initial, str(initial_partitions(spark)))
    return spark


def initial_partitions(spark: SparkSession) -> int:
    """Shuffle partitions before AQE joins them: enough for four waves over all cores."""
    return max(200, 4 * spark.sparkContext.defaultParallelism)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a temporary
    folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="likeness-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a DataFrame to the shared folder and read it back.

    Cuts the lineage when several branches need the same rows, so the corpus is
    scanned once.  A written table survives lost executors and keeps column
    pruning for the branches.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """A DataFrame cut off from its lineage by a checkpoint in the shared folder.

    Like :func:`staged` it survives lost executors; Spark's cleaner removes the
    files with the DataFrame where ``cleanCheckpoints`` is set.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """Persist a DataFrame around a multi-output job and release it after."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()
