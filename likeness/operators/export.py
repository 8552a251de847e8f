"""Export quality pass and export tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from likeness import lexicon as lx
from likeness import schemas
from likeness.functions import text as tx

# ---- fixed values -----------------------------------------------------------
DATASET_VERSION = "v1"
SCHEMA_VERSION = 1
EXAMPLES_PER_PAIR = 5
EXPORT_EXAMPLE_COLUMNS = [
    "candidate_id",
    "ground_text",
    "connector_text",
    "vehicle_text_clean",
    "tenor_text",
    "candidate_full_text",
]


def _text_or(df: DataFrame, name: str, fallback: Column) -> Column:
    """A text column, or the fallback where it is missing, null or empty."""
    if name not in df.columns:
        return fallback
    return F.coalesce(F.nullif(F.col(name), F.lit("")), fallback)


def _absent() -> dict[str, Column]:
    """What cleanup takes for columns that the candidates do not have."""
    texts = "vehicle_text ground_text text_before candidate_full_text reject_reason".split()
    return {
        **{name: F.lit("") for name in texts},
        "vehicle_head": F.lit(None).cast("string"),
        "needs_review": F.lit(False),
    }


def clean_candidates(candidates: DataFrame) -> DataFrame:
    """Append the cleanup columns to gold candidates.

    The vehicle is cut at the first clause word after its head, or else after
    the head when the head is a common idiom head.  Columns the rules look at
    may be missing; they are added empty.  Narrow, no Python.
    """
    absent = {n: c for n, c in _absent().items() if n not in candidates.columns}
    candidates = candidates.withColumns(absent) if absent else candidates
    raw = _text_or(candidates, "vehicle_text_raw", F.col("vehicle_text"))
    tokens = F.col("_tokens")
    size = F.size(tokens)
    later = F.transform(tx.drop_first(tokens), lambda t: tx.one_of(F.lower(t), lx.CLAUSE_STARTS))
    clause_at = F.array_position(later, True).cast("int")
    head = F.lower(tx.first_or_empty(tokens))
    rule = (
        F.when((size > 1) & (clause_at > 0), "trimmed_clause_start")
        .when((size > 1) & tx.one_of(head, lx.CLEANUP_HEADS), "trimmed_common_head_tail")
        .otherwise("unchanged")
    )
    kept = (
        F.when(F.col("vehicle_cleaning_rule") == "trimmed_clause_start", clause_at)
        .when(F.col("vehicle_cleaning_rule") == "trimmed_common_head_tail", F.lit(1))
        .otherwise(size)
    )
    rejected = F.coalesce(F.col("reject_reason"), F.lit(""))
    role_text = tx.join_nonempty(
        *[
            F.coalesce(F.col(name), F.lit(""))
            for name in ("text_before", "ground_text", "candidate_full_text")
        ]
    )
    in_role = role_text.rlike(tx.stem_after_boundary(lx.ROLE_STEMS))
    trimmed = F.col("vehicle_cleaning_rule") != "unchanged"
    label = (
        F.when(rejected != "", "reject")
        .when(in_role, "review")
        .when(trimmed, "trimmed")
        .otherwise("keep")
    )
    reasons = F.array_compact(
        F.array(
            F.when(trimmed, F.col("vehicle_cleaning_rule")),
            F.when(F.col("quality_label") == "reject", rejected),
            F.when(F.col("quality_label") == "review", "role_or_classification_context"),
        )
    )
    return (
        candidates.withColumn("vehicle_text_raw", F.coalesce(raw, F.lit("")))
        .withColumn("_tokens", tx.word_tokens(F.col("vehicle_text_raw")))
        .withColumn("vehicle_cleaning_rule", rule)
        .withColumn("_kept", kept)
        .withColumns(
            {
                "dataset_version": F.lit(DATASET_VERSION),
                "vehicle_text_clean": tx.joined(F.slice(tokens, F.lit(1), F.col("_kept"))),
                "vehicle_tail_text": tx.joined(F.slice(tokens, F.col("_kept") + F.lit(1), size)),
                "vehicle_lemma": _text_or(
                    candidates, "vehicle_lemma", F.lower("vehicle_text_raw")
                ),
                "vehicle_head_clean": F.coalesce(F.get(tokens, F.lit(0)), F.col("vehicle_head")),
                "quality_label": label,
            }
        )
        .withColumns(
            {
                "vehicle_head_clean_lemma": F.lower("vehicle_head_clean"),
                "quality_reason": reasons,
                "visualization_ready": F.col("quality_label").isin("keep", "trimmed"),
                "needs_review": F.coalesce(F.col("needs_review"), F.lit(False))
                | (F.col("quality_label") == "review"),
            }
        )
        .drop("_tokens", "_kept")
    )


def export_records(cleaned: DataFrame) -> DataFrame:
    """The 37 contract fields of the export, in order."""
    return cleaned.select(*schemas.EXPORT_COLUMNS)


def _filled(cleaned: DataFrame, *names: str) -> DataFrame:
    """Rows in which none of the named text columns is null or empty."""
    for name in names:
        cleaned = cleaned.where(F.coalesce(F.col(name), F.lit("")) != "")
    return cleaned


def pair_counts(cleaned: DataFrame, first: str, second: str) -> DataFrame:
    """Counts per pair with the ids of its first five candidates.

    The ``row_number() <= 5`` filter is a window group limit: every map task
    keeps at most five rows of a pair before the shuffle, so a hot pair does
    not gather in one task.  Counts come from partial aggregation.  Both sides
    are partitioned by the pair, so the join adds no shuffle.  The input is
    read twice; pass a stored table, not a corpus scan.
    """
    rows = _filled(cleaned, first, second)
    order = Window.partitionBy(first, second).orderBy(*schemas.PROVENANCE, "candidate_id")
    shown = (
        rows.select(first, second, "candidate_id", F.row_number().over(order).alias("_rank"))
        .where(F.col("_rank") <= EXAMPLES_PER_PAIR)
        .groupBy(first, second)
        .agg(F.sort_array(F.array_agg(F.struct("_rank", "candidate_id"))).alias("_shown"))
        .select(first, second, F.col("_shown.candidate_id").alias("example_candidate_ids"))
    )
    return (
        rows.groupBy(first, second)
        .count()
        .join(shown, [first, second])
        .select(first, second, "count", "example_candidate_ids")
        .orderBy(F.desc("count"), first, second)
    )


def key_counts(
    cleaned: DataFrame, key: str, related: str, distinct_as: str, top_as: str, top_prefix: str
) -> DataFrame:
    """Counts per key with distinct related values and the most frequent one.

    Two aggregations, no window: rows to pairs, pairs to keys.  Ties go to the
    smallest related value; keys without any related value drop out, but rows
    with an empty related value still count.
    """
    other = F.coalesce(F.col(related), F.lit(""))
    pairs = (
        _filled(cleaned, key)
        .groupBy(key, other.alias("_related"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    named = F.col("_related") != ""
    return (
        pairs.groupBy(key)
        .agg(
            F.sum("_n").alias("count"),
            F.count_if(named).alias(distinct_as),
            F.min(F.when(named, F.struct((-F.col("_n")).alias("n"), "_related"))).alias("_top"),
        )
        .where(F.col("_top").isNotNull())
        .select(
            key,
            "count",
            distinct_as,
            F.col("_top._related").alias(top_as),
            (-F.col("_top.n")).alias(f"{top_prefix}_count"),
            F.round(-F.col("_top.n") / F.col("count"), 4).alias(f"{top_prefix}_share"),
        )
        .orderBy(F.desc("count"), key)
    )


def ground_vehicle_export(cleaned: DataFrame) -> DataFrame:
    """Pair counts, ground first."""
    return pair_counts(cleaned, "ground_lemma", "vehicle_head_clean_lemma")


def vehicle_ground_export(cleaned: DataFrame) -> DataFrame:
    """Pair counts, vehicle first."""
    return pair_counts(cleaned, "vehicle_head_clean_lemma", "ground_lemma")


def ground_export(cleaned: DataFrame) -> DataFrame:
    """Ground counts with their top vehicle."""
    return key_counts(
        cleaned,
        "ground_lemma",
        "vehicle_head_clean_lemma",
        "distinct_vehicle_count",
        "top_vehicle_head_clean_lemma",
        "top_vehicle",
    )


def vehicle_export(cleaned: DataFrame) -> DataFrame:
    """Vehicle counts with their top ground."""
    return key_counts(
        cleaned,
        "vehicle_head_clean_lemma",
        "ground_lemma",
        "distinct_ground_count",
        "top_ground_lemma",
        "top_ground",
    )


def _in_corpus_order(rows: DataFrame, limit: int) -> DataFrame:
    return rows.orderBy(*schemas.PROVENANCE, "candidate_id").limit(limit)


def export_examples(cleaned: DataFrame, limit: int = 5000) -> DataFrame:
    """The first candidates in corpus order, six display fields."""
    return _in_corpus_order(cleaned, limit).select(*EXPORT_EXAMPLE_COLUMNS)


def export_review(cleaned: DataFrame, limit: int = 500) -> DataFrame:
    """The first candidates in corpus order that need a review."""
    return export_records(_in_corpus_order(needing_review(cleaned), limit))


def needing_review(candidates: DataFrame) -> DataFrame:
    """Candidates flagged for review."""
    return candidates.where(F.col("needs_review"))


def rejected_or_review(cleaned: DataFrame) -> DataFrame:
    """Every candidate labelled reject or review, as export records."""
    return export_records(cleaned.where(F.col("quality_label").isin("reject", "review")))


def manifest(
    cleaned: DataFrame,
    dataset_name: str = "comparisons",
    source_gold_path: str = "",
    generated_at: str | None = None,
) -> DataFrame:
    """One row of dataset totals and metadata.

    Candidates are reduced to pairs first, so the distinct counts work on the
    pair table instead of expanding the candidates three times.
    """
    ground = F.coalesce(F.col("ground_lemma"), F.lit("")).alias("g")
    vehicle = F.coalesce(F.col("vehicle_head_clean_lemma"), F.lit("")).alias("v")
    pairs = cleaned.groupBy(ground, vehicle).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("visualization_ready").alias("ready")
    )
    g, v = F.nullif(F.col("g"), F.lit("")), F.nullif(F.col("v"), F.lit(""))
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("candidate_count"),
        F.coalesce(F.sum("ready"), F.lit(0)).alias("visualization_ready_count"),
        F.count_distinct(g).alias("ground_count"),
        F.count_distinct(v).alias("vehicle_count"),
        F.count_if(g.isNotNull() & v.isNotNull()).alias("ground_vehicle_pair_count"),
    ).select(
        F.lit(dataset_name).alias("dataset_name"),
        F.lit(DATASET_VERSION).alias("dataset_version"),
        F.lit("como_article_ground_vehicle").alias("pattern_type"),
        (now if generated_at is None else F.lit(generated_at)).alias("generated_at"),
        F.lit(source_gold_path).alias("source_gold_path"),
        "candidate_count",
        "visualization_ready_count",
        "ground_count",
        "vehicle_count",
        "ground_vehicle_pair_count",
        F.lit(SCHEMA_VERSION).alias("schema_version"),
    )
