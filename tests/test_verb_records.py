"""Verb groups read as records between empty lines equal the whole-file reading."""

from pyspark.sql import functions as F

from likeness.sources import lexicon_files as lf


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_records_equal_whole_files(spark, tmp_path):
    folder = tmp_path / "verbs"
    folder.mkdir()
    groups = [[f"verb{g}", f"form{g}a", f"form{g}b"] + (["shared"] if g % 7 == 3 else []) for g in range(400)]
    text = "\n\n".join("\n".join(words) for words in groups)
    text = text.replace("verb5\n", "verb5\r\n").replace("\n\nverb9\n", "\n \n\n\nverb9\n")
    (folder / "a.txt").write_text(text + "\n", encoding="utf-8")
    (folder / "b.txt").write_text("\n\nlone\nlonely\n\n\n\nshared\nagain\n", encoding="utf-8")
    whole = spark.read.text(str(folder), wholetext=True).select(
        "value", F.col("_metadata.file_path").alias("path")
    )
    want = _rows(lf.verb_groups(whole))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        assert spark.read.text(str(folder / "a.txt"), lineSep="\n\n").rdd.getNumPartitions() > 1
        got = _rows(lf.read_verb_groups(spark, str(folder)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == want
    assert ("shared", "verb3") in {(r[0], r[1]) for r in got}


def test_first_group_of_shared_and_null_paths(spark):
    files = [
        ("b", "run\nran\n\ngo\nwent"),
        ("a", "go\nshared\n\nzeta\nboth"),
        ("a", "fly\nflew\n\nalpha\nboth\n\nshared"),
        (None, "null\nwent"),
        ("c", None),
        ("c", ""),
        ("d", "\n\n \n"),
    ]
    got = _rows(
        lf.verb_groups(spark.createDataFrame(files, "path string, value string"))
        .select("form", "lemma", F.coalesce("ground_reference_path", F.lit("-")))
    )
    best = {}
    for path, value in files:
        for at, block in enumerate((value or "").split("\n\n")):
            words = [w.strip() for w in block.split("\n") if w.strip()]
            for w in words:
                key = (path or "", at, words[0])
                best[w] = min(best.get(w, key), key)
    assert got == sorted((w, lemma, path or "-") for w, (path, _, lemma) in best.items())
    assert ("both", "alpha", "a") in got and ("shared", "go", "a") in got


def test_words_are_grouped_by_hash(spark):
    files = spark.createDataFrame([("a", "go\nwent")], "path string, value string")
    plan = lf.verb_groups(files)._jdf.queryExecution().executedPlan().toString()
    words = [line for line in plan.splitlines() if "partial_min(" in line and "struct(" not in line]
    assert words and all(" HashAggregate(" in line for line in words)  # no sort of every word
