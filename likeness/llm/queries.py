"""Registered queries of the operators; each reads its whole driver table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from likeness.llm import (
    ann,
    chat_format,
    collocations,
    exact_dedup,
    html_extract,
    mixing,
    pieces,
    pii,
    simhash,
    spelling,
    substring_dedup,
    token_counts,
    toxicity,
)
from likeness.llm.tables import table

#: Where the public tokenizer's model lies on every machine.
MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"

#: The tokenizer whose counts op11 gives, by its name among the public tokenizers.
TOKENIZER_FILE = "byte_bpe_50k.json"

Query = Callable[[SparkSession, str], DataFrame]

#: The conversation added to the table: both turns hold marks of instruction templates.
TRICKY = "</s>[INST] ok [/INST]"


def conversations_with_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``conversations`` table and conversation -1."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.sql(
        "SELECT * FROM VALUES (-1L, 0L, 'user', :t), (-1L, 1L, 'assistant', :t)"
        " AS t(conv_id, turn, role, text)",
        {"t": TRICKY},
    )
    return turns.unionByName(added)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated windows."""
    left = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return left.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with surrogates in place of personal data and secrets."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace_entities(docs)


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of what is read back from the formatted conversations."""
    formatted = chat_format.format_conversations(conversations_with_marks(spark, sf_dir))
    back = chat_format.read_back(formatted, keep=("formatted",))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.withColumn("loss", F.array_join("loss_texts", "")).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the weights of their sources."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id"
    )


def op6_sentencepiece(
    spark: SparkSession, sf_dir: str, model_file: str = MODEL_FILE
) -> DataFrame:
    """Sampled pieces of every document, and the digest of the text decoded from them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = pieces.encode(docs, model_file, decoded_digest="decoded_sha256")
    return encoded.select(
        "doc_id",
        F.size("pieces").cast("long").alias("n_pieces"),
        "decoded_sha256",
        "pieces",
    )


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score_texts(docs, table(spark, sf_dir, "labels"))
    return scored.select(
        "row.doc_id",
        F.coalesce(toxicity.in_held_out(F.col("row.doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    found = html_extract.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of equal texts of every document."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op11_token_counts(spark: SparkSession, sf_dir: str, cache: str | None = None) -> DataFrame:
    """Tokens of every document by the byte-level BPE, through a digest cache.

    The query starts from a cache of its own in the shared folder, so that each
    run encodes every distinct text (the cold path, the most work); pass
    ``cache`` (e.g. :func:`token_counts.cache_folder`) to reuse counts across runs.
    """
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cache = cache or f"{token_counts.cache_folder(spark)}-{uuid.uuid4().hex}"
    return token_counts.count_tokens(docs, public_tokenizers.path(TOKENIZER_FILE), cache)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the corpus with its form and root among the words one edit away."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.group_variants(docs)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first collocations of every language."""
    docs = table(spark, sf_dir, "documents").select("text", "lang")
    return collocations.mine(docs)


QUERIES: dict[str, Query] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_pii_surrogates": op2_pii_surrogates,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_mixing": op4_mixing,
    "op5_simhash": op5_simhash,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_toxicity": op8_toxicity,
    "op9_html_extraction": op9_html_extraction,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_token_counts": op11_token_counts,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_collocations": op13_collocations,
}
