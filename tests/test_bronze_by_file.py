"""Bronze built by file: only missing files are built, a killed build goes on."""

import gzip

from likeness.operators.segments import bronze_segments
from likeness.sources import raw_text as rt
from likeness.sources import tables as tb


def _gzip(path, lines):
    with gzip.open(path, "wt", encoding="utf-8") as file:
        file.write("\n".join(lines) + "\n")


def _rows(df):
    return sorted(map(tuple, df.collect()))


def _full(spark, folder):
    return _rows(bronze_segments(rt.read_lines(spark, f"{folder}/*.gz")))


def test_new_files_are_built_alone_and_the_table_equals_a_full_build(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for n in (1, 2):
        _gzip(folder / f"s{n}.txt.gz", [f"file {n} line {i} <END> more" for i in range(4)])
    bronze = str(tmp_path / "bronze")
    assert _rows(tb.build_bronze_by_file(spark, f"{folder}/*.gz", bronze)) == _full(spark, folder)
    _gzip(folder / "s3.txt.gz", ["", "third file"])
    grown = tb.build_bronze_by_file(spark, f"{folder}/*.gz", bronze)
    assert _rows(grown) == _full(spark, folder)
    ledger = spark.read.parquet(f"{bronze}/{tb.LEDGER}").collect()
    assert len(ledger) == 3 and len({r.batch for r in ledger}) == 2
    # Nothing missing: nothing is built, the same table is read.
    assert _rows(tb.build_bronze_by_file(spark, f"{folder}/*.gz", bronze)) == _full(spark, folder)
    assert spark.read.parquet(f"{bronze}/{tb.LEDGER}").count() == 3


def test_a_killed_build_goes_on_with_its_files(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    _gzip(folder / "a.txt.gz", ["alpha one", "alpha two"])
    bronze = str(tmp_path / "bronze")
    tb.build_bronze_by_file(spark, f"{folder}/*.gz", bronze)
    _gzip(folder / "b.txt.gz", ["beta one"])
    killed = tb.build_bronze_by_file(spark, f"{folder}/*.gz", bronze, commit=False)
    assert _rows(killed) == _rows(bronze_segments(rt.read_lines(spark, f"{folder}/a.txt.gz")))
    resumed = tb.build_bronze_by_file(spark, f"{folder}/*.gz", bronze)
    assert _rows(resumed) == _full(spark, folder)


def test_an_empty_input_folder(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    _gzip(folder / "a.txt.gz", [""])
    built = tb.build_bronze_by_file(spark, f"{folder}/*.gz", str(tmp_path / "bronze"))
    assert built.count() == 0
