"""Readers and small column helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from likeness.session import shared_folder

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Beyond ASCII and small Latin-1 letters, ``lower`` would change more than A-Z.
_OTHER_LETTERS = r"[^\x00-\x7F\xDF-\xFF]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, read whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def filled(text: Column | str) -> Column:
    """Text with null as empty."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column.cast("string"), F.lit(""))


def lower_a_to_z(text: Column) -> Column:
    """``text`` with A-Z in lower case and every other character as it is."""
    return F.when(text.rlike(_OTHER_LETTERS), F.translate(text, _UPPER, _LOWER)).otherwise(
        F.lower(text)
    )


def bound(value: Column, build) -> Column:
    """``build(value)`` with ``value`` computed once.

    A lambda variable is evaluated once per element, whatever the optimizer
    makes of the projection below, so an array used inside another lambda is
    not built again for each element.
    """
    return F.element_at(F.transform(F.array(value), build), 1)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first variant of it that is no column of ``df`` yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def held(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, with its lineage cut.

    The files outlive lost executors; Spark's cleaner removes them with the
    DataFrame where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    # New names, so that branches of one table can be joined with each other.
    return df.checkpoint().toDF(*df.columns)
