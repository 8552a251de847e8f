"""Compare registered queries with their SQL: names, row count, values."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = """
region nation customer supplier part orders lineitem events documents embeddings pages
benchmark labels conversations
""".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """DuckDB with the driver tables as views."""
    con = duckdb.connect()
    for name in TABLES:
        con.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return con


# DuckDB type per Spark type.
TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def _normal(value: object) -> object:
    if isinstance(value, float):
        return round(value, 9)
    return value


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when both sides agree, else a short description."""
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    expected = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns differ: {sorted(set(df.columns) ^ set(names))}"
    kinds = {column[0]: str(column[1]) for column in result.description}
    other = {
        name: (kind, kinds[name]) for name, kind in df.dtypes if TYPES.get(kind) != kinds[name]
    }
    if other:
        return f"types differ: {other}"
    order = sorted(names)
    at = [names.index(name) for name in order]
    left = Counter(tuple(_normal(row[name]) for name in order) for row in df.collect())
    right = Counter(tuple(_normal(row[i]) for i in at) for row in expected)
    if left == right:
        return ""
    only_left, only_right = list((left - right))[:2], list((right - left))[:2]
    return (
        f"{sum(left.values())} vs {sum(right.values())} rows; columns {order}; "
        f"only Spark: {only_left}; only SQL: {only_right}"
    )


def main() -> None:
    """Run: compare.py SF_DIR [query ...]."""
    import __spark_entry__ as entry
    from likeness.session import build_session

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "compare", "local[8]", 8, {"spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        begun = time.time()
        try:
            found = difference(query(spark, sf_dir), con, sqls[name])
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:300]}"
        failed += bool(found)
        state = "FAIL" if found else "ok  "
        print(f"{state} {name} {time.time() - begun:.1f}s {found}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
