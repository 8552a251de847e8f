"""Output folders written by Spark.

Every output is a folder of part files.  Nothing is forced into one part
unless the caller asks for it (``single_part``, for limited or aggregated tables):
ordered count tables are range-partitioned and AQE merges the parts of a small
table, limited samples come out as one part anyway.  Candidate tables hold rare
matches from every split of the corpus; they are rebalanced to parts of AQE's
advisory size before they are written, or each split would leave a tiny file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    compact: bool = True,
) -> None:
    """Write a Parquet table; ``compact`` rebalances its rows first (by partition column)."""
    rows = df.hint("rebalance", *(partition_by or [])) if compact else df
    writer = rows.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def one_part(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """``df`` in one partition, sorted within it by ``order``.

    Only for a limited or aggregated table, which one task holds: the caller
    chooses it by argument, never by the table's size.
    """
    single = df.repartition(1)
    return single.sortWithinPartitions(*order) if order else single


def write_csv(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    single_part: bool = False,
    order: list[str] | None = None,
) -> None:
    """Write CSV with a header; ``single_part`` writes one ordered file (see ``one_part``)."""
    rows = one_part(df, order) if single_part else df
    rows.write.mode(mode).option("header", True).csv(path)


def write_json(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    single_part: bool = False,
    order: list[str] | None = None,
) -> None:
    """Write JSON lines; every record keeps all its fields, also null ones."""
    rows = one_part(df, order) if single_part else df
    rows.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_csv_tables(tables: dict[str, DataFrame], folder: str, mode: str = "overwrite") -> None:
    """Write several CSV outputs below one folder."""
    for name, table in tables.items():
        write_csv(table, f"{folder}/{name}", mode)


def write_json_tables(tables: dict[str, DataFrame], folder: str, mode: str = "overwrite") -> None:
    """Write several JSON-lines outputs below one folder."""
    for name, table in tables.items():
        write_json(table, f"{folder}/{name}", mode)


def read_csv_table(spark, path: str, schema) -> DataFrame:
    """A CSV folder written by ``write_csv``, read back with its table's schema.

    The header must name the schema's fields in their order and every value
    must parse as its type, or the read fails; an empty field is null, a quoted
    empty one the empty text.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_json_table(spark, path: str, schema) -> DataFrame:
    """A JSON-lines folder written by ``write_json``, read back with its table's schema.

    Fields are taken by name into the schema's order; a value of another type
    fails the read.
    """
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_back(spark, folder: str, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every output of ``tables`` written below ``folder``, read back by the schema of its table."""
    found = {}
    for name, table in tables.items():
        reader = read_csv_table if name.endswith(".csv") else read_json_table
        found[name] = reader(spark, f"{folder}/{name}", table.schema)
    return found
