"""Line tables derived from the driver tables.

The driver's documents hold no Portuguese, so the default corpus re-words
them: frequent function words become Portuguese ones, line breaks become
segment markers, and every document ends with one sentence of known outcome.
Every document is used with its whole text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from likeness.sources.raw_text import spread_lines

WORDS = [
    ("of", "como"), ("the", "uma"), ("a", "um"), ("and", "forte"), ("in", "duro"),
    ("is", "fria"), ("it", "caiu"), ("to", "leve"), ("with", "que nem"),
    ("by", "feito"), ("from", "conhecido"),
    ("der", "como"), ("und", "doce"), ("le", "como"), ("et", "livre"),
]

SENTENCES = [
    "Ele parecia forte como um cavalo.",
    "O vestido era leve como uma pluma ao vento.",
    "O casaco caiu como uma luva.",
    "O conselho caiu como uma luva na equipe.",
    "O rio corria frio como aço.",
    "Ela canta que nem um pássaro.",
    "O sorriso era falso como uma nota.",
    "O assunto virou grande como um tipo comum.",
    "O remédio era usado forte como um veneno.",
    "Acordou frio como uma lâmina bem velha na gaveta do armário.",
    "Leve como um sopro!",
    "Saiu leve como uma 3 folhas.",
    "Saiu leve como uma folha 3.",
    "Foi forte como um todo.",
    "Forte como um leão e leve como uma nuvem.",
    "Correu como um rio, voou como um pardal.",
    "Estava forte como um",
    "quase-forte como um leão",
    "Parecia frágil como um - copo fino.",
    "Estava duro como um sapato usado.",
    "Caiu como uma bomba é triste.",
    "  Sopa   FRIA como UMA Neve  ",
    "O vento era frio como neve, mas passou.",
    "O filho cresceu forte como o avô.",
    "Estava claro como se fosse cedo.",
    "Era doce como seu olhar.",
    "Segue forte como agora.",
    "Era grande como quando nasceu.",
    "Andava leve como mais ninguém.",
    "Ela corre feito lebre quando foge.",
    "O pão saiu tão leve como uma esponja.",
    "Segue forte como sistema.",
    "Segue forte como Maria Bonita.",
    "Era doce como açúcar 7.",
    "Ficou duro como casca de pinheiro muito velho.",
    "Segue forte como o mesmo.",
    "Segue forte como o.",
    "Era claro como cristal.",
    "Foi brilhante como advogado de defesa.",
    "Era claro como sendo raro.",
    "Estava usado forte como mesa.",
    "Ele é alto como cantor.",
    "Era claro como sala de vidro novo.",
    "O Campo Alegre como uma praça aberta.",
    "Era alto como um poste 😀 torto.",
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text_table(
    spark: SparkSession, sf_dir: str, name: str, source: Column, line: str, text: str
) -> DataFrame:
    lines = _table(spark, sf_dir, name).select(
        source.alias("source_file"),
        F.col(line).alias("original_line_id"),
        F.col(text).alias("raw_text"),
    )
    # The driver's tables are one row group each, so one task would read all.
    return spread_lines(lines)


def corpus_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-worded documents as raw lines with segment markers."""
    text = "replace(raw_text, '\\n', ' <END> ')"
    for english, portuguese in WORDS:
        text = f"replace({text}, ' {english} ', ' {portuguese} ')"
    sentences = ", ".join(f"'{sentence}'" for sentence in SENTENCES)
    sentence = f"get(array({sentences}), int(pmod(original_line_id, {len(SENTENCES)})))"
    return document_lines(spark, sf_dir).withColumn(
        "raw_text", F.expr(f"concat({text}, ' <END> ', {sentence}, ' <END>  ')")
    )


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unmodified documents as raw lines."""
    return _text_table(spark, sf_dir, "documents", F.col("source"), "doc_id", "text")


def page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unmodified web pages as raw lines."""
    return _text_table(spark, sf_dir, "pages", F.col("url"), "page_id", "html")


def conversation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unmodified conversation turns as raw lines."""
    source = F.concat_ws("-", F.col("conv_id"), F.col("role"))
    return _text_table(spark, sf_dir, "conversations", source, "turn", "text")


def benchmark_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ground lexicon of all words of the benchmark passages."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    return (
        _table(spark, sf_dir, "benchmark")
        .select(F.explode(words).alias("form"))
        .distinct()
        .select(
            "form",
            F.col("form").alias("lemma"),
            F.lit("quality_adjective").alias("ground_type"),
            F.lit("benchmark").alias("ground_source"),
            F.lit("benchmark").alias("ground_reference_path"),
        )
    )


def benchmark_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark lexicon and the two-word phrases of its passages."""
    words = benchmark_lexicon(spark, sf_dir)
    pairs = F.regexp_extract_all(
        F.lower("text"), F.lit(r"[\p{L}\p{N}_]+ [\p{L}\p{N}_]+"), F.lit(0)
    )
    phrases = (
        _table(spark, sf_dir, "benchmark")
        .select(F.explode(pairs).alias("form"))
        .distinct()
        .select(
            "form",
            F.col("form").alias("lemma"),
            F.lit("quality_adjective").alias("ground_type"),
            F.lit("phrase").alias("ground_source"),
            F.lit("benchmark").alias("ground_reference_path"),
        )
    )
    return words.unionByName(phrases)


def word_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of the documents, as lines of word files."""
    return _table(spark, sf_dir, "documents").select(
        F.col("source").alias("path"), F.explode(F.split("text", "\n")).alias("value")
    )


def verb_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of forms: a word is a line, a full stop ends a group."""
    value = "replace(replace(text, '.', '\\n\\n'), ' ', '\\n')"
    return _table(spark, sf_dir, "documents").select(
        F.concat_ws("-", "source", "doc_id").alias("path"), F.expr(value).alias("value")
    )
