"""Ground lexicons from editable text files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from likeness import lexicon as lx
from likeness import schemas
from likeness.session import checkpointed

_LINE_BREAK = r"\r?\n"
_BLANK_LINES = r"\r?\n[ \t]*(?:\r?\n[ \t]*)+"
#: Groups of a record are numbered below this: array indices have 31 bits.
_GROUPS = 2**31


def quality_words(lines: DataFrame) -> DataFrame:
    """Lexicon rows of word lines (``value``, ``path``): every word is its own lemma.

    Blank lines are ignored.
    """
    return lines.select(
        F.lower(F.trim("value")).alias("form"),
        F.lower(F.trim("value")).alias("lemma"),
        F.lit(lx.QUALITY_ADJECTIVE).alias("ground_type"),
        F.lit("quality_reference").alias("ground_source"),
        F.col("path").alias("ground_reference_path"),
    ).where(F.col("form") != "")


def read_quality_words(spark: SparkSession, path: str) -> DataFrame:
    """One word per line of a text file."""
    return quality_words(
        spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path"))
    )


def read_verb_groups(spark: SparkSession, path: str) -> DataFrame:
    """Groups of forms in text files, read as records that end at an empty line.

    The records are split like any text, so a large file is read by many
    tasks.  A record's place in its file is its block's start and its scan id
    within the block; blank lines that hold spaces or carriage returns split
    groups inside a record.
    """
    records = spark.read.text(path, lineSep="\n\n").select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("scan"),
        ).alias("record"),
    )
    return _groups(records)


def verb_groups(files: DataFrame) -> DataFrame:
    """Lexicon rows of whole files (``value``, ``path``) of forms, one a line.

    Groups are separated by blank lines; the first form of a group is the lemma.
    A form listed under several verbs keeps the one listed first.
    """
    first = F.struct(F.lit(0).cast("long").alias("block"), F.lit(0).cast("long").alias("scan"))
    return _groups(files.select("value", "path", first.alias("record")))


def _ranked(records: DataFrame) -> DataFrame:
    """``path, record, rank``: every different place of a record, numbered in order.

    Held, because the numbers of a sort are only alike within one run of it.
    """
    places = records.select("path", "record").distinct().orderBy("path", "record")
    return checkpointed(places.withColumn("rank", F.monotonically_increasing_id()))


def _words(block: Column) -> Column:
    return F.filter(
        F.transform(F.split(block, _LINE_BREAK), lambda w: F.lower(F.trim(w))),
        lambda w: w != "",
    )


def _groups(records: DataFrame) -> DataFrame:
    """Lexicon rows of records (``value, path, record``), ``record`` ordering them in a file.

    A form's first group is found as the smallest of one number for record and
    group, so that forms are counted together by hash in their map tasks (a
    smallest struct would sort every word).  Only the groups found are read again
    for their lemma; where records share path and place, the smallest lemma counts.
    """
    ranks = _ranked(records).toDF("_path", "_record", "rank")
    same = F.col("path").eqNullSafe(F.col("_path")) & (F.col("record") == F.col("_record"))
    keyed = records.join(ranks, same).select(
        "path", "rank", F.split(F.trim("value"), _BLANK_LINES).alias("blocks")
    )
    # An array index has 31 bits; the number is a decimal, so no rank is too large.
    group = F.expr(f"CAST(rank AS decimal(19,0)) * {_GROUPS}BD + at").alias("group")
    first = (
        keyed.select("rank", F.posexplode("blocks").alias("at", "block"))
        .select(group, _words(F.col("block")).alias("words"))
        .select("group", F.explode("words").alias("form"))
        .groupBy("form")
        .agg(F.min("group").alias("group"))
    )
    found = (
        first.groupBy("group")
        .agg(F.collect_list("form").alias("forms"))
        .select(
            F.expr(f"CAST(group div {_GROUPS}BD AS bigint)").alias("rank"),
            F.expr(f"CAST(group % {_GROUPS}BD AS int)").alias("at"),
            "forms",
        )
        .groupBy("rank")
        .agg(F.collect_list(F.struct("at", "forms")).alias("found"))
    )
    blocks = F.transform(
        "found", lambda g: F.struct(F.get("blocks", g["at"]).alias("block"), g["forms"].alias("forms"))
    )
    return (
        keyed.join(found, "rank")
        .select("path", F.inline(blocks))
        .select("path", "forms", _words(F.col("block")).alias("words"))
        .select(
            "path",
            F.get("words", F.lit(0)).alias("lemma"),
            F.array_intersect("forms", "words").alias("forms"),
        )
        .select("path", "lemma", F.explode("forms").alias("form"))
        .groupBy("form")
        .agg(F.min(F.struct("path", "lemma")).alias("first"))
        .select(
            "form",
            F.col("first.lemma").alias("lemma"),
            F.lit(lx.SALIENT_VERB).alias("ground_type"),
            F.lit("verb_reference").alias("ground_source"),
            F.col("first.path").alias("ground_reference_path"),
        )
    )


def read_lexicon(
    spark: SparkSession, quality_path: str | None = None, verb_path: str | None = None
) -> DataFrame:
    """A ground lexicon from word files, one row per form.

    A form in both files counts as a quality word.
    """
    parts = []
    if quality_path:
        parts.append(read_quality_words(spark, quality_path))
    if verb_path:
        parts.append(read_verb_groups(spark, verb_path))
    if not parts:
        return lx.default_lexicon(spark)
    table = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    rest = ["lemma", "ground_source", "ground_reference_path"]
    best = F.min(F.struct("ground_type", *rest))  # quality_adjective sorts before salient_verb
    return (
        table.groupBy("form")
        .agg(best.alias("best"))
        .select("form", "best.*")
        .select(*schemas.columns(schemas.LEXICON))
    )
