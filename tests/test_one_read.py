"""Lines numbered per file from one read of the text."""

import gzip

from likeness.sources import raw_text as rt
from likeness.sources import tables as tb


def _gzip(path, lines):
    with gzip.open(path, "wt", encoding="utf-8") as file:
        file.write("\n".join(lines) + "\n")


def _ids(df):
    return {(r.source_file.rsplit("/", 1)[-1], r.original_line_id): r.raw_text for r in df.collect()}


def test_one_read_numbers_like_two(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for n in range(1, 4):
        _gzip(folder / f"shard-{n}.txt.gz", [f"s{n} l{i}" if i % 4 else "" for i in range(7 * n)])
    plain = folder / "plain.txt"
    plain.write_text("\n".join(f"p{i} {'x' * (i % 50)}" for i in range(5000)) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        want = _ids(rt.read_lines(spark, f"{folder}/*"))
        once = rt.read_lines_once(spark, f"{folder}/*", str(tmp_path / "staged"))
        assert _ids(once) == want
        assert _ids(rt.read_lines_once(spark, f"{folder}/*", str(tmp_path / "named"), name_only=True)) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_one_read_has_one_text_scan_and_no_text_in_the_block_pass(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    _gzip(folder / "a.txt.gz", [f"line {i}" for i in range(20)])
    once = rt.read_lines_once(spark, str(folder), str(tmp_path / "staged"))
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" not in plan  # the text was read when the copy was written
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert any("raw_text" not in line for line in scans)  # the block pass reads ids only


def test_bronze_built_from_one_read_equals_two(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    _gzip(folder / "a.txt.gz", ["Era forte como um touro. <END> Outra frase.", "", "Mais uma como uma rocha."])
    once = tb.build_bronze(spark, str(folder))
    from likeness.operators.segments import bronze_segments

    plain = bronze_segments(rt.read_lines(spark, str(folder)))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, plain.collect()))
