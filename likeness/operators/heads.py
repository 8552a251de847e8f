"""Head-word labels for bare-connector candidates.

Lemma and part of speech of the vehicle head come from a morphology table
``(form, lemma, pos)`` by join; the rules are one ``when`` chain.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from likeness import lexicon as lx
from likeness import schemas
from likeness.functions import text as tx
from likeness.session import checkpointed

# ---- fixed values -----------------------------------------------------------
ROLE_CONTEXT_WORDS = """
atua atuou atuar atuando trabalha trabalhou trabalhar trabalhando
serve serviu servir servindo presa preso presas presos
""".split()
ROLE_CONTEXT_STEMS = "usad utilizad considerad definid classificad condenad contratad".split()
ROLE_SUFFIXES = """
dor dora ista nte ário ária eiro eira or ora ante ente ólogo óloga
""".split()
LONG_PHRASE_WORDS = 3
LABELLED_PATTERN = "bare_como_spacy_filter"
PROMOTED_PATTERN = "bare_como_visual_whitelist"
PROMOTED_REASON = "visual_head_whitelist"

_ROLE_CONTEXT = (
    rf"(?iU){tx.NOT_AFTER_WORD}(?:(?:{tx.any_of(ROLE_CONTEXT_WORDS)}){tx.NOT_BEFORE_WORD}"
    rf"|(?:{'|'.join(ROLE_CONTEXT_STEMS)}))"
)
_ROLE_SUFFIX = rf"(?iU)(?:{'|'.join(ROLE_SUFFIXES)})$"


def _head() -> Column:
    return F.lower(tx.strip_spaces(F.coalesce(F.col("vehicle_head_clean"), F.lit(""))))


def _decision(head: Column, lemma: Column, pos: Column) -> Column:
    raw_words = F.split(tx.collapse_spaces(F.coalesce("vehicle_text_raw", F.lit(""))), " ")
    full_text = F.coalesce(F.col("candidate_full_text"), F.lit(""))

    def decided(label: str, reason: Column, review: bool) -> Column:
        return F.struct(
            F.lit(label).alias("nlp_quality_label"),
            reason.alias("nlp_quality_reason"),
            F.lit(review).alias("nlp_needs_review"),
        )

    def is_in(words: list[str]) -> Column:
        return tx.one_of(lemma, words) | tx.one_of(head, words)

    return (
        F.when(head == "", decided("reject", F.lit("missing_vehicle_head"), True))
        .when(is_in(lx.VISUAL_HEADS), decided("keep", F.lit(PROMOTED_REASON), False))
        .when(is_in(lx.ROLE_HEADS), decided("reject", F.lit("role_head_lexicon"), True))
        .when(full_text.rlike(_ROLE_CONTEXT), decided("review", F.lit("role_context"), True))
        .when(
            tx.one_of(pos, lx.NON_NOMINAL_POS),
            decided("reject", F.concat(F.lit("bad_spacy_pos_"), F.lower(pos)), True),
        )
        .when(
            lemma.rlike(_ROLE_SUFFIX) & tx.one_of(pos, lx.NOMINAL_POS),
            decided("review", F.lit("role_like_suffix"), True),
        )
        .when(
            F.size(raw_words) > LONG_PHRASE_WORDS,
            decided("review", F.lit("long_vehicle_phrase"), True),
        )
        .otherwise(decided("keep", F.lit("spacy_short_nominal_vehicle"), False))
    )


def with_morphology(candidates: DataFrame, morphology: DataFrame | None = None) -> DataFrame:
    """Add ``head_lemma`` and ``head_pos`` of the vehicle head.

    Heads outside the table fall back to the head itself and an empty part of
    speech.  A given table may list a form more than once; the smallest
    ``(lemma, pos)`` then counts.  Catalyst broadcasts the table below its size
    threshold and otherwise shuffles, with AQE splitting hot heads.
    """
    if morphology is None:
        table = lx.default_morphology(candidates.sparkSession)
    else:
        table = (
            morphology.groupBy("form")
            .agg(F.min(F.struct("lemma", "pos")).alias("reading"))
            .select("form", "reading.*")
        )
    known = table.select(
        F.col("form").alias("_head"),
        F.lower("lemma").alias("_lemma"),
        F.col("pos").alias("_pos"),
    )
    return (
        candidates.withColumn("_head", _head())
        .join(known, "_head", "left")
        .withColumn("head_lemma", F.coalesce(F.nullif("_lemma", F.lit("")), F.col("_head")))
        .withColumn("head_pos", F.coalesce(F.col("_pos"), F.lit("")))
        .drop("_head", "_lemma", "_pos")
    )


def with_tagger(
    candidates: DataFrame, tag: Callable[[pd.DataFrame], pd.DataFrame]
) -> DataFrame:
    """Add ``head_lemma`` and ``head_pos`` from a user's own tagger.

    ``tag`` gets Arrow batches with ``vehicle_head_clean`` and
    ``candidate_full_text`` and returns ``head_lemma, head_pos`` in row order.
    Batches stay small and nothing passes through the driver.
    """

    def tag_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tags = tag(batch[["vehicle_head_clean", "candidate_full_text"]])
            yield batch.assign(
                head_lemma=tags["head_lemma"].to_numpy(), head_pos=tags["head_pos"].to_numpy()
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in candidates.schema.fields]
    return candidates.mapInPandas(
        tag_batches, ", ".join([*fields, "head_lemma string", "head_pos string"])
    )


#: A (head, text) pair held by at least one in this many candidates is joined back by broadcast.
HEAVY_SHARE = 4096
#: Rows given to the tagger at once within a task.
TAG_BATCH = 256

_taggers: dict[int, Callable] = {}


def with_tagger_on_distinct(
    candidates: DataFrame,
    tag: Callable[[pd.DataFrame], pd.DataFrame] | None = None,
    setup: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]] | None = None,
) -> DataFrame:
    """``with_tagger``, with each distinct (head, text) tagged once.

    The pairs come from a partial aggregate, so copies fold in their map task;
    they are tagged in batches of at most ``TAG_BATCH`` rows by ``tag``, or by
    the tagger that ``setup`` builds once per Python worker (a model loads
    once, not per batch).  Tags go back to the candidates by a join on the
    pair: pairs held by at least ``1 / HEAVY_SHARE`` of the rows are at most
    ``HEAVY_SHARE`` by arithmetic and are broadcast, the others are light keys
    of a shuffle join.  Null heads or texts are tagged like any value.

    Candidates and tags are each made once and held, as several branches read
    them; pass only the columns that are needed afterwards.
    """
    if (tag is None) == (setup is None):
        raise ValueError("Give either tag or setup")
    keys = ["vehicle_head_clean", "candidate_full_text"]
    candidates = checkpointed(candidates)
    pairs = candidates.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))

    def tag_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tagger = tag
        if tagger is None:
            tagger = _taggers.get(id(setup))
            if tagger is None:
                tagger = _taggers[id(setup)] = setup()
        for batch in batches:
            for start in range(0, len(batch), TAG_BATCH):
                part = batch.iloc[start : start + TAG_BATCH]
                tags = tagger(part[keys].reset_index(drop=True))
                yield part[[*keys, "_copies"]].assign(
                    head_lemma=tags["head_lemma"].to_numpy(), head_pos=tags["head_pos"].to_numpy()
                )

    tagged = checkpointed(
        pairs.mapInPandas(
            tag_batches,
            "vehicle_head_clean string, candidate_full_text string, _copies long, "
            "head_lemma string, head_pos string",
        )
    )
    # The tag side gets names of its own: it comes from the candidates, and a join
    # of a table with itself would not tell the sides apart.
    named = tagged.select(
        F.col("vehicle_head_clean").alias("_head"),
        F.col("candidate_full_text").alias("_text"),
        "_copies",
        F.col("head_lemma").alias("_lemma"),
        F.col("head_pos").alias("_pos"),
    )
    everything = tagged.agg(F.sum("_copies").alias("_rows"))
    heavy = named.crossJoin(everything).filter(
        F.col("_copies") * F.lit(HEAVY_SHARE) >= F.col("_rows")
    ).drop("_copies", "_rows")

    def pair_of(side: DataFrame) -> Column:
        return F.col(keys[0]).eqNullSafe(side["_head"]) & F.col(keys[1]).eqNullSafe(side["_text"])

    with_heavy = candidates.join(F.broadcast(heavy), pair_of(heavy), "left").withColumn(
        "_hot", F.col("_head").isNotNull() | F.col("_text").isNotNull()
    ).drop("_head", "_text")
    hot = with_heavy.filter("_hot")
    light = with_heavy.filter("NOT _hot").drop("_lemma", "_pos")
    rest = named.drop("_copies")
    joined = light.join(rest, pair_of(rest), "left").drop("_head", "_text")
    columns = [*candidates.columns, F.col("_lemma").alias("head_lemma"), F.col("_pos").alias("head_pos")]
    return hot.select(*columns).unionByName(joined.select(*columns))


def label_heads(tagged: DataFrame) -> DataFrame:
    """Append the five head-label columns to tagged candidates."""
    labels = schemas.columns(schemas.HEAD_LABELS)
    decision = _decision(_head(), F.col("head_lemma"), F.col("head_pos"))
    return (
        tagged.select("*", F.inline(F.array(decision)))
        .withColumnsRenamed(
            {"head_lemma": "spacy_vehicle_head_lemma", "head_pos": "spacy_vehicle_head_pos"}
        )
        .select(*[name for name in tagged.columns if not name.startswith("head_")], *labels)
    )


def classify_heads(
    candidates: DataFrame,
    morphology: DataFrame | None = None,
    pattern_type: str | None = LABELLED_PATTERN,
) -> DataFrame:
    """Head labels by morphology join; relabels ``pattern_type`` unless None."""
    labelled = label_heads(with_morphology(candidates, morphology))
    if pattern_type is None:
        return labelled
    return labelled.withColumn("pattern_type", F.lit(pattern_type))


def head_accepted(labelled: DataFrame) -> DataFrame:
    """Candidates whose head label is keep or trimmed."""
    return labelled.where(F.col("nlp_quality_label").isin("keep", "trimmed"))


def promoted(labelled: DataFrame) -> DataFrame:
    """Candidates with a visual head, under the promoted pattern's name."""
    return labelled.where(F.col("nlp_quality_reason") == PROMOTED_REASON).withColumn(
        "pattern_type", F.lit(PROMOTED_PATTERN)
    )
