"""Grouped counts, all in the same shape: keys, count, most frequent first.

Partial aggregation reduces every key on the map side, so a key that holds a
third of the rows costs one row per map task in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ranked_counts(df: DataFrame, *keys: str) -> DataFrame:
    """Row count per key, ordered by count and then by the keys."""
    return df.groupBy(*keys).count().orderBy(F.desc("count"), *keys)


def ground_vehicle_counts(gold: DataFrame) -> DataFrame:
    """How often each ground goes with each vehicle head."""
    return ranked_counts(gold, "ground_lemma", "vehicle_head_lemma")


def vehicle_ground_counts(gold: DataFrame) -> DataFrame:
    """How often each vehicle head goes with each ground."""
    return ranked_counts(gold, "vehicle_head_lemma", "ground_lemma")


def ground_counts(gold: DataFrame) -> DataFrame:
    """Candidates per ground."""
    return ranked_counts(gold, "ground_lemma")


def vehicle_counts(gold: DataFrame) -> DataFrame:
    """Candidates per vehicle head."""
    return ranked_counts(gold, "vehicle_head_lemma")


def label_counts(candidates: DataFrame) -> DataFrame:
    """Candidates per pattern and quality label."""
    return (
        candidates.groupBy("pattern_type", "quality_label")
        .count()
        .orderBy("pattern_type", F.desc("count"), "quality_label")
    )


def variant_pair_counts(candidates: DataFrame) -> DataFrame:
    """Candidates per pattern, ground and vehicle head."""
    return ranked_counts(candidates, "pattern_type", "ground_lemma", "vehicle_head_clean")


def variant_vehicle_counts(candidates: DataFrame) -> DataFrame:
    """Candidates per pattern and vehicle head."""
    return ranked_counts(candidates, "pattern_type", "vehicle_head_clean")


def pattern_counts(candidates: DataFrame) -> DataFrame:
    """Candidates per pattern."""
    return candidates.groupBy("pattern_type").count().orderBy("pattern_type")


def head_label_counts(labelled: DataFrame, by_pattern: bool = True) -> DataFrame:
    """Candidates per rule label, head label and head reason."""
    keys = ["quality_label", "nlp_quality_label", "nlp_quality_reason"]
    groups = ["pattern_type", *keys] if by_pattern else keys
    return labelled.groupBy(*groups).count().orderBy(F.desc("count"), *keys)


def head_vehicle_counts(labelled: DataFrame) -> DataFrame:
    """Candidates per vehicle head with its lemma and part of speech."""
    keys = ["vehicle_head_clean", "spacy_vehicle_head_lemma", "spacy_vehicle_head_pos"]
    return labelled.groupBy("pattern_type", *keys).count().orderBy(F.desc("count"), *keys)


def merged_pair_counts(merged: DataFrame) -> DataFrame:
    """Merged set: candidates per ground and vehicle head."""
    return ranked_counts(merged, "ground_lemma", "vehicle_head_clean")


def merged_reverse_pair_counts(merged: DataFrame) -> DataFrame:
    """Merged set: candidates per vehicle head and ground."""
    return ranked_counts(merged, "vehicle_head_clean", "ground_lemma")


def merged_vehicle_counts(merged: DataFrame) -> DataFrame:
    """Merged set: candidates per vehicle head."""
    return ranked_counts(merged, "vehicle_head_clean")


def reason_counts(candidates: DataFrame, reason: str = "quality_reason") -> DataFrame:
    """Candidates per reason."""
    return ranked_counts(candidates, reason)


def display_pairs(pairs: DataFrame) -> DataFrame:
    """Pair counts under display names."""
    return pairs.withColumnsRenamed(
        {"ground_lemma": "ground", "vehicle_head_lemma": "vehicle_head"}
    )
