"""Analyses on gold candidates: dominance, fingerprints, diversity, profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from likeness import lexicon as lx
from likeness.functions import text as tx
from likeness.operators.extract import STRICT_MAX_TOKENS

# Word lists of the noise profile and the use types: own choice.
PREPOSITIONS = """
de do da dos das em no na nos nas para pra ao aos à às com por pelo pela sem sobre entre
""".split()
PRONOUNS = "ele ela eles elas me mim minha meu seu sua seus suas isso você".split()
CONJUNCTIONS = "e ou mas que porque pois".split()
FINITE_VERBS = "é foi era fica tem deve são está estava vai pode".split()
MODIFIER_HEADS = "coisa raro grande novo verdadeiro alternativa profissional bom".split()
IDIOM_GROUNDS = "cair encaixar caber assentar".split()
IDIOM_HEADS = "luva bomba".split()
EXTENT_GROUNDS = "alto baixo grande pequeno pesado".split()
EXTENT_HEADS = "prédio caminhão casa torre montanha porta".split()


def _pairs(gold: DataFrame, key: str, related: str) -> DataFrame:
    return gold.groupBy(key, related).agg(F.count(F.lit(1)).alias("n"))


def dominance(gold: DataFrame) -> DataFrame:
    """Per ground: its top vehicle, that vehicle's share and the variety."""
    best = F.min(F.struct((-F.col("n")).alias("n"), "vehicle_head_lemma"))
    return (
        _pairs(gold, "ground_lemma", "vehicle_head_lemma")
        .groupBy("ground_lemma")
        .agg(
            best.alias("top"),
            F.sum("n").alias("total_count"),
            F.count(F.lit(1)).alias("distinct_vehicle_count"),
        )
        .select(
            "ground_lemma",
            F.col("top.vehicle_head_lemma").alias("top_vehicle_head_lemma"),
            (-F.col("top.n")).alias("top_vehicle_count"),
            "total_count",
            F.round(-F.col("top.n") / F.col("total_count"), 4).alias("top_vehicle_share"),
            "distinct_vehicle_count",
        )
        .orderBy(F.desc("total_count"), "ground_lemma")
    )


def fingerprint(gold: DataFrame, key: str, related: str, top: int = 10) -> DataFrame:
    """The most frequent partners of every key with their share.

    Totals are a second aggregate of the pair counts that reuses their shuffle;
    the rank filter is a window group limit, so no key gathers all its pairs.
    """
    pairs = _pairs(gold, key, related)
    totals = pairs.groupBy(key).agg(F.sum("n").alias("total"))
    order = Window.partitionBy(key).orderBy(F.desc("n"), related)
    ranked = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return (
        ranked.join(totals, key)
        .select(
            key,
            related,
            "rank",
            F.col("n").alias("count"),
            F.round(F.col("n") / F.col("total"), 4).alias("share"),
        )
        .orderBy(key, "rank")
    )


def ground_fingerprint(gold: DataFrame, top: int = 10) -> DataFrame:
    """Top vehicles of every ground."""
    return fingerprint(gold, "ground_lemma", "vehicle_head_lemma", top)


def vehicle_fingerprint(gold: DataFrame, top: int = 10) -> DataFrame:
    """Top grounds of every vehicle."""
    return fingerprint(gold, "vehicle_head_lemma", "ground_lemma", top)


def simpson_index(
    gold: DataFrame, key: str = "vehicle_head_lemma", related: str = "ground_lemma"
) -> DataFrame:
    """Simpson diversity per key: 0 for a specialist, towards 1 for a generalist."""
    total = F.sum("n")
    # Squares of counts leave the range of integers long before that of doubles.
    n, all_of_it = F.col("n").cast("double"), total.cast("double")
    return (
        _pairs(gold, key, related)
        .groupBy(key)
        .agg(
            total.alias("total_count"),
            F.count(F.lit(1)).alias("distinct_count"),
            F.round(1 - F.sum(n * n) / (all_of_it * all_of_it), 4).alias("diversity"),
        )
        .orderBy(F.desc("diversity"), F.desc("total_count"), key)
    )


def length_distribution(gold: DataFrame) -> DataFrame:
    """Candidates per vehicle length in tokens."""
    length = "vehicle_phrase_length_tokens"
    return gold.groupBy(length).count().orderBy(length)


def noise_profile(gold: DataFrame) -> DataFrame:
    """Counts of eight noise signals, one row each, from one pass."""
    tokens = tx.word_tokens(F.col("vehicle_text"))
    tail = F.transform(tx.drop_first(F.col("tokens")), F.lower)
    head = F.lower("vehicle_head")

    def tail_has(words: list[str]) -> Column:
        return F.exists("tail", lambda t: tx.one_of(t, words))

    signals = {
        "preposition_after_head": tail_has(PREPOSITIONS),
        "reaches_maximum_length": F.size("tokens") >= STRICT_MAX_TOKENS,
        "pronoun_after_head": tail_has(PRONOUNS),
        "conjunction_after_head": tail_has(CONJUNCTIONS),
        "generic_or_modifier_head": tx.one_of(head, MODIFIER_HEADS + lx.STRICT_GENERIC_HEADS),
        "finite_verb_tail": tail_has(FINITE_VERBS),
        "capitalized_multi_token": (F.size("tokens") > 1)
        & F.forall("tokens", lambda t: t.rlike(r"^\p{Lu}")),
        "contains_digit": F.col("vehicle_text").rlike(r"\p{Nd}"),
    }
    counted = (
        gold.select("vehicle_text", "vehicle_head", tokens.alias("tokens"))
        .withColumn("tail", tail)
        .agg(*[F.count_if(rule).alias(name) for name, rule in signals.items()])
    )
    return counted.unpivot([], list(signals), "signal", "count").orderBy(
        F.desc("count"), "signal"
    )


def with_use_type(gold: DataFrame) -> DataFrame:
    """Classify how a candidate uses the comparison (``comparison_use_type``)."""
    ground, head = F.col("ground_lemma"), F.col("vehicle_head_lemma")
    named = F.col("ground_text").rlike(r"^\p{Lu}") & (F.col("text_before") != "")
    use = (
        F.when(F.col("vehicle_text").rlike(r"\p{Nd}"), "noise")
        .when(ground.isin(IDIOM_GROUNDS) & head.isin(IDIOM_HEADS), "idiom")
        .when((ground == "trabalhar") | tx.one_of(head, lx.ROLE_HEADS), "role")
        .when(named, "classification")
        .when(ground.isin(EXTENT_GROUNDS) & head.isin(EXTENT_HEADS), "literal_extent")
        .otherwise("comparison")
    )
    return gold.withColumn("comparison_use_type", use)


def use_type_counts(gold: DataFrame) -> DataFrame:
    """Candidates per use type."""
    counts = with_use_type(gold).groupBy("comparison_use_type").count()
    return counts.orderBy(F.desc("count"), "comparison_use_type")


def reject_report(labelled: DataFrame) -> DataFrame:
    """Candidates per reject reason with distinct grounds and heads."""
    keys = ["reject_reason", "ground_lemma", "vehicle_head_lemma"]
    cells = labelled.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return (
        cells.groupBy("reject_reason")
        .agg(
            F.sum("n").alias("count"),
            F.count_distinct("ground_lemma").alias("distinct_ground_count"),
            F.count_distinct("vehicle_head_lemma").alias("distinct_vehicle_count"),
        )
        .orderBy(F.desc("count"), "reject_reason")
    )


def reject_sample(labelled: DataFrame, per_reason: int = 20) -> DataFrame:
    """A few rejected candidates of every reason, for debugging."""
    order = Window.partitionBy("reject_reason").orderBy("candidate_id")
    return (
        labelled.where(F.col("reject_reason") != "")
        .select(
            "reject_reason", "candidate_id", "ground_text", "vehicle_text", "candidate_full_text"
        )
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= per_reason)
        .orderBy("reject_reason", "rank")
    )


def lexicon_source_counts(labelled: DataFrame) -> DataFrame:
    """Candidates per lexicon source and ground."""
    keys = ["ground_source", "ground_reference_path", "ground_lemma"]
    return labelled.groupBy(*keys).count().orderBy(F.desc("count"), *keys)
