"""Ranked samples: total order plus limit, run as top-k without a full sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from likeness.operators.counts import variant_pair_counts
from likeness.operators.extract import accepted
from likeness.operators.heads import head_accepted

# ---- fixed values: column contracts ------------------------------------------
EXAMPLE_COLUMNS = """
ground_text connector_text vehicle_text tenor_text candidate_full_text
""".split()
REVIEW_COLUMNS = """
candidate_id ground_type ground_text connector_text vehicle_text tenor_text
confidence needs_review candidate_full_text
""".split()
VARIANT_REVIEW_COLUMNS = """
candidate_id pattern_type ground_text ground_lemma connector_text vehicle_text_raw
vehicle_text_clean vehicle_head_clean quality_label quality_reason needs_review
candidate_full_text source_file original_line_id segment_id
""".split()
HEAD_REVIEW_COLUMNS = """
candidate_id pattern_type ground_text ground_lemma connector_text vehicle_text_raw
vehicle_text_clean vehicle_head_clean quality_label quality_reason nlp_quality_label
nlp_quality_reason spacy_vehicle_head_lemma spacy_vehicle_head_pos candidate_full_text
""".split()
MERGED_EXAMPLE_COLUMNS = """
pattern_type ground_text ground_lemma connector_text vehicle_text_clean
vehicle_head_clean candidate_full_text
""".split()


def examples(gold: DataFrame, limit: int = 5000) -> DataFrame:
    """Display examples ordered by ground, vehicle head and id."""
    ranked = gold.orderBy("ground_lemma", "vehicle_head_lemma", "candidate_id").limit(limit)
    return ranked.select(*EXAMPLE_COLUMNS)


def review_sample(gold: DataFrame, limit: int = 500) -> DataFrame:
    """Gold candidates to review: flagged first, then least confident."""
    ranked = gold.orderBy(F.desc("needs_review"), "confidence", "candidate_id").limit(limit)
    return ranked.select(*REVIEW_COLUMNS)


def variant_review_sample(candidates: DataFrame, limit: int = 200) -> DataFrame:
    """Variant candidates to review: flagged first, then by label."""
    ranked = candidates.orderBy(F.desc("needs_review"), "quality_label", "candidate_id")
    return ranked.limit(limit).select(*VARIANT_REVIEW_COLUMNS)


def accepted_review_sample(candidates: DataFrame, limit: int = 200) -> DataFrame:
    """Accepted variant candidates, trimmed and long vehicles first."""
    ranked = accepted(candidates).orderBy(
        F.desc("quality_label"),
        F.length("vehicle_text_clean").desc(),
        "ground_lemma",
        "vehicle_head_clean",
        "candidate_id",
    )
    return ranked.limit(limit).select(*VARIANT_REVIEW_COLUMNS)


def head_accepted_sample(labelled: DataFrame, limit: int = 500) -> DataFrame:
    """Head-accepted candidates by reason, ground and head."""
    ranked = head_accepted(labelled).orderBy(
        "nlp_quality_reason", "ground_lemma", "vehicle_head_clean", "candidate_id"
    )
    return ranked.limit(limit).select(*HEAD_REVIEW_COLUMNS)


def head_review_sample(labelled: DataFrame, limit: int = 500) -> DataFrame:
    """Head-labelled candidates to review, flagged first."""
    ranked = labelled.orderBy(
        F.desc("nlp_needs_review"), "nlp_quality_label", "nlp_quality_reason", "candidate_id"
    )
    return ranked.limit(limit).select(*HEAD_REVIEW_COLUMNS)


def merged_examples(merged: DataFrame, limit: int = 5000) -> DataFrame:
    """Display examples of the merged set."""
    ranked = merged.orderBy("ground_lemma", "vehicle_head_clean", "pattern_type", "candidate_id")
    return ranked.limit(limit).select(*MERGED_EXAMPLE_COLUMNS)


def merged_review_sample(merged: DataFrame, limit: int = 1000) -> DataFrame:
    """Review sample of the merged set."""
    ranked = merged.orderBy("pattern_type", "ground_lemma", "vehicle_head_clean", "candidate_id")
    return ranked.limit(limit).select(*HEAD_REVIEW_COLUMNS)


def top_pairs(candidates: DataFrame, limit: int = 30) -> DataFrame:
    """Most frequent accepted pairs."""
    return variant_pair_counts(accepted(candidates)).limit(limit)
