"""Merge gold and promoted bare candidates into one 26-column set."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from likeness import schemas


def gold_as_merged(gold: DataFrame) -> DataFrame:
    """Gold candidates in the merged layout.

    The gold side has no separate cleanup: raw and clean vehicle are the same.
    """
    filled = {
        "vehicle_text_raw": F.col("vehicle_text"),
        "vehicle_text_clean": F.col("vehicle_text"),
        "vehicle_head_clean": F.col("vehicle_head_lemma"),
        "vehicle_tail_text": F.lit(""),
        "quality_label": F.lit("keep"),
        "quality_reason": F.lit("spec_0006_strict_filter"),
        "nlp_quality_label": F.lit("keep"),
        "nlp_quality_reason": F.lit("spec_0006_baseline"),
        "spacy_vehicle_head_lemma": F.col("vehicle_head_lemma"),
        "spacy_vehicle_head_pos": F.lit(""),
        "nlp_needs_review": F.lit(False),
    }
    return gold.withColumns(filled).select(*schemas.MERGED_COLUMNS)


def merge_candidates(gold: DataFrame, promoted: DataFrame) -> DataFrame:
    """Union by name, one row per candidate id.

    Equal ids mean equal rows (the id hashes the provenance and the pattern),
    so which copy stays does not matter.
    """
    merged = gold_as_merged(gold).unionByName(promoted.select(*schemas.MERGED_COLUMNS))
    return merged.dropDuplicates(["candidate_id"])


def union_patterns(tables: list[DataFrame]) -> DataFrame:
    """Union candidate tables of several patterns, keeping ``pattern_type``."""
    return reduce(lambda left, right: left.unionByName(right), tables)
