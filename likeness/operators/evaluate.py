"""Side-by-side evaluation of pattern variants.

Every table here starts from one small aggregate of the matches ("cells"), so
the corpus is scanned once; the branches on top of it share its shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from likeness import lexicon as lx
from likeness.operators import extract as ex
from likeness.operators import patterns as pt

# ---- fixed values: verdict texts and thresholds ------------------------------
WINDOW_PROMOTE_RATE = 0.90
BARE_ITERATE_RATE = 0.55
V2_PROMOTE_RATE = 0.60
NO_REASON = "none"
NOT_ACCEPTED_REASONS = """
missing_vehicle bad_definite_article_vehicle bad_vehicle_start
generic_or_role_like_vehicle_head vehicle_noise capitalized_multi_token_vehicle
""".split()


def new_pairs(pairs: DataFrame, baseline: DataFrame) -> DataFrame:
    """Distinct accepted pairs the baseline does not have."""
    keys = ["ground_lemma", "vehicle_head_clean"]
    return pairs.select(*keys).distinct().join(baseline.select(*keys), keys, "left_anti")


def baseline_pairs(gold: DataFrame) -> DataFrame:
    """Distinct pairs of the gold table under the variants' column names."""
    return gold.select(
        "ground_lemma", F.col("vehicle_head_lemma").alias("vehicle_head_clean")
    ).distinct()


def _is_accepted() -> Column:
    return F.col("quality_label").isin("keep", "trimmed")


def match_cells(matches: DataFrame) -> DataFrame:
    """Counts per pattern, label, reason, ground and head of labelled matches."""
    return matches.groupBy(
        "pattern_type", "quality_label", "quality_reason", "ground_lemma", "vehicle_head_clean"
    ).agg(
        F.count_if(F.size("tokens") > 0).alias("n"),
        F.count_if(F.col("nth") == 0).alias("segments"),
    )


def top_reject_reason(candidates: DataFrame) -> DataFrame:
    """The most frequent reason among not accepted candidates, per pattern."""
    reasons = (
        ex.not_accepted(candidates).groupBy("pattern_type", "quality_reason").count()
    )
    best = F.min(F.struct((-F.col("count")).alias("n"), "quality_reason"))
    return (
        reasons.groupBy("pattern_type")
        .agg(best.alias("best"))
        .select("pattern_type", "best.quality_reason", (-F.col("best.n")).alias("count"))
        .orderBy("pattern_type")
    )


def _metrics(cells: DataFrame, pattern_types: list[str]) -> DataFrame:
    """Metrics per pattern; patterns without any match get a row of zeros.

    One aggregate over the cells: the reasons are a fixed list, so their counts
    are columns and the most frequent one needs no second grouping.
    """
    taken = _is_accepted() & (F.col("n") > 0)
    ground = F.when(taken, F.col("ground_lemma"))
    head = F.when(taken, F.col("vehicle_head_clean"))
    pair = F.when(taken, F.struct("ground_lemma", "vehicle_head_clean"))
    sums = cells.groupBy("pattern_type").agg(
        F.sum("segments").alias("prefiltered_rows"),
        F.sum("n").alias("candidate_rows"),
        F.sum(F.when(taken, F.col("n")).otherwise(0)).alias("accepted_rows"),
        F.count_distinct(ground).alias("distinct_grounds"),
        F.count_distinct(head).alias("distinct_vehicle_heads"),
        F.count_distinct(pair).alias("distinct_pairs"),
        *[
            F.sum(F.when(F.col("quality_reason") == reason, F.col("n")).otherwise(0)).alias(reason)
            for reason in NOT_ACCEPTED_REASONS
        ],
    )
    top = F.array_min(
        F.array(
            *[
                F.when(
                    F.col(reason) > 0,
                    F.struct((-F.col(reason)).alias("n"), F.lit(reason).alias("reason")),
                )
                for reason in NOT_ACCEPTED_REASONS
            ]
        )
    )["reason"]
    counts = """
    prefiltered_rows candidate_rows accepted_rows distinct_grounds distinct_vehicle_heads
    distinct_pairs
    """.split()
    rate = F.try_divide("accepted_rows", "candidate_rows")
    named = lx.values_table(cells.sparkSession, [(n,) for n in pattern_types], ["pattern_type"])
    return named.join(sums, "pattern_type", "left").select(
        F.col("pattern_type").alias("experiment_slug"),
        *[F.coalesce(F.col(name), F.lit(0)).alias(name) for name in counts],
        F.coalesce(rate, F.lit(0.0)).alias("accepted_rate"),
        F.coalesce(top, F.lit(NO_REASON)).alias("top_false_positive_reason"),
    )


def comparison_table(matches: DataFrame, pattern_types: list[str] | None = None) -> DataFrame:
    """Yield and quality of every variant with a promotion recommendation."""
    slug, rate = F.col("experiment_slug"), F.col("accepted_rate")
    advice = (
        F.when(
            (slug == pt.WINDOW.pattern_type) & (rate >= WINDOW_PROMOTE_RATE),
            "promote after baseline overlap check",
        )
        .when(
            (slug == pt.BARE.pattern_type) & (rate >= BARE_ITERATE_RATE),
            "iterate cleanup, then reconsider",
        )
        .otherwise("report-only for visualization build")
    )
    names = list(pt.VARIANTS) if pattern_types is None else pattern_types
    return (
        _metrics(match_cells(matches), names)
        .withColumn("promotion_recommendation", advice)
        .orderBy(F.desc("accepted_rows"), "experiment_slug")
    )


def promotion_summary(
    matches: DataFrame, pattern_type: str = pt.BARE_V2.pattern_type
) -> DataFrame:
    """One-row summary of one variant with the promotion threshold."""
    cells = match_cells(matches.where(F.col("pattern_type") == pattern_type))
    advice = F.when(
        F.col("accepted_rate") >= V2_PROMOTE_RATE, "review top pairs before promotion"
    ).otherwise("needs another cleanup pass")
    return _metrics(cells, [pattern_type]).withColumn("promotion_recommendation", advice)


def pair_cells(candidates: DataFrame) -> DataFrame:
    """All and accepted candidates per pattern and pair."""
    return candidates.groupBy("pattern_type", "ground_lemma", "vehicle_head_clean").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(_is_accepted()).alias("accepted")
    )


def _strategy_columns(overlap: DataFrame) -> DataFrame:
    """Strategy rows from ``pattern_type, n, accepted, known`` per pair."""
    is_pair = F.col("accepted") > 0
    slug = F.col("experiment_slug")
    strategy = (
        F.when(
            slug == pt.WINDOW.pattern_type,
            "use now: high precision, small enough to review, article-como compatible",
        )
        .when(
            slug == pt.BARE.pattern_type,
            "do not use for first viz: keep as next expansion after article-head cleanup",
        )
        .otherwise("do not use for first viz: split/redesign connector experiment")
    )
    return (
        overlap.groupBy(F.col("pattern_type").alias("experiment_slug"))
        .agg(
            F.sum("accepted").alias("accepted_rows"),
            (F.sum("accepted") / F.sum("n")).alias("accepted_rate"),
            F.count_if(is_pair).alias("accepted_distinct_pairs"),
            F.count_if(is_pair & F.col("known")).alias("baseline_overlapping_pairs"),
            F.count_if(is_pair & ~F.col("known")).alias("new_pairs_vs_baseline"),
        )
        .withColumn("dataset_strategy", strategy)
        .orderBy(F.desc("accepted_rows"), "experiment_slug")
    )


def strategy_table(cells: DataFrame, baseline: DataFrame) -> DataFrame:
    """Overlap of every variant's accepted pairs with the baseline pairs.

    ``cells`` comes from :func:`pair_cells`, ``baseline`` holds distinct
    ``ground_lemma, vehicle_head_clean``.
    """
    keys = ["ground_lemma", "vehicle_head_clean"]
    marked = cells.join(baseline.select(*keys, F.lit(True).alias("_known")), keys, "left")
    return _strategy_columns(marked.withColumn("known", F.col("_known").isNotNull()))


def quality_notes(candidates: DataFrame) -> DataFrame:
    """Totals per pattern: candidates, accepted, rate and label counts."""
    label = F.col("quality_label")
    return (
        candidates.groupBy("pattern_type")
        .agg(
            F.count(F.lit(1)).alias("candidate_rows"),
            F.count_if(_is_accepted()).alias("accepted_rows"),
            F.avg(_is_accepted().cast("double")).alias("accepted_rate"),
            *[
                F.count_if(label == name).alias(f"{name}_rows")
                for name in ("keep", "trimmed", "review", "reject")
            ],
        )
        .orderBy("pattern_type")
    )


def stage_counts(
    segments: DataFrame, lexicon: DataFrame | None = None, spec: pt.PatternSpec = pt.ARTICLE
) -> DataFrame:
    """Rows per stage of the strict extraction, from one pass over the matches."""
    matches = ex.strict_matches(segments, lexicon, spec)
    return matches.agg(
        F.count_if(F.col("nth") == 0).alias("prefiltered_rows"),
        F.count(F.lit(1)).alias("match_rows"),
        F.count_if(F.col("reject_reason") == "").alias("candidate_rows"),
    )
