"""One ordered part for small outputs, by argument."""

from pathlib import Path

from pyspark.sql import functions as F

from likeness.sinks import files


def _parts(folder, suffix):
    return sorted(p for p in Path(folder).iterdir() if p.name.startswith("part-") and p.name.endswith(suffix))


def test_single_part_csv_and_json_keep_the_order(spark, tmp_path):
    counts = spark.range(5000).repartition(7).select(
        (F.col("id") % 97).alias("key"), F.col("id")
    ).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    files.write_csv(counts, str(tmp_path / "csv"), single_part=True, order=["key"])
    parts = _parts(tmp_path / "csv", ".csv")
    assert len(parts) == 1
    lines = parts[0].read_text().splitlines()
    assert lines[0] == "key,n" and [int(x.split(",")[0]) for x in lines[1:]] == list(range(97))
    files.write_json(counts, str(tmp_path / "json"), single_part=True, order=["n", "key"])
    assert len(_parts(tmp_path / "json", ".json")) == 1


def test_tables_are_left_as_they_are_by_default(spark, tmp_path):
    table = spark.range(1000).repartition(4)
    files.write_csv(table, str(tmp_path / "csv"))
    assert len(_parts(tmp_path / "csv", ".csv")) > 1
