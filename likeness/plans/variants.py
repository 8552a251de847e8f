"""Pattern variants: datasets, review tables, comparison and strategy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from likeness.operators import counts as ct
from likeness.operators import evaluate as ev
from likeness.operators import extract as ex
from likeness.operators import heads as hd
from likeness.operators import merge as mg
from likeness.operators import patterns as pt
from likeness.operators import samples as sm
from likeness.session import cached
from likeness.sinks.files import write_csv, write_csv_tables, write_parquet
from likeness.sources.tables import read_variants


def dataset_path(root: str, pattern_type: str | None = None) -> str:
    """Candidate dataset of all variants, or of one (a partition folder)."""
    if pattern_type is None:
        return f"{root}/candidates"
    return f"{root}/candidates/pattern_type={pt.variant(pattern_type).pattern_type}"


def accepted_path(root: str) -> str:
    """Accepted-candidate dataset, partitioned like the candidate dataset."""
    return f"{root}/accepted_candidates"


def output_path(root: str, pattern_type: str) -> str:
    """Review tables of one variant."""
    return f"{root}/{pt.variant(pattern_type).pattern_type}"


#: Accepted rows to review: the second bare pattern is reviewed in a larger sample.
ACCEPTED_SAMPLE = 200
ACCEPTED_SAMPLES = {pt.BARE_V2.pattern_type: 500}


def variant_reports(
    candidates: DataFrame, accepted_sample: int = ACCEPTED_SAMPLE
) -> dict[str, DataFrame]:
    """Review tables of one variant's candidates by output name."""
    taken = ex.accepted(candidates)
    return {
        "candidate_counts.csv": ct.label_counts(candidates),
        "ground_vehicle_counts.csv": ct.variant_pair_counts(taken),
        "vehicle_counts.csv": ct.variant_vehicle_counts(taken),
        "review_sample.csv": sm.variant_review_sample(candidates),
        "accepted_review_sample.csv": sm.accepted_review_sample(candidates, accepted_sample),
        "quality_notes.csv": ev.quality_notes(candidates),
        "top_pairs.csv": sm.top_pairs(candidates),
    }


def write_variants(
    phrases: DataFrame,
    dataset_root: str,
    output_root: str,
    pattern_types: list[str] | None = None,
    mode: str = "overwrite",
    accepted_samples: dict[str, int] | None = None,
) -> DataFrame:
    """Label variant matches, write datasets and review tables.

    ``phrases`` is a stored match table (``match_phrases``): candidates and
    comparison both read it.  ``accepted_samples`` gives the rows of the accepted
    review sample by pattern, ``ACCEPTED_SAMPLES`` and then ``ACCEPTED_SAMPLE``
    by default.  All reports read the candidates once.  Returns the written
    candidates.
    """
    samples = {**ACCEPTED_SAMPLES, **(accepted_samples or {})}
    names = list(pt.VARIANTS) if pattern_types is None else pattern_types
    matches = ex.label_variants(ex.of_patterns(phrases, *names))
    write_parquet(ex.variant_columns(matches), dataset_path(dataset_root), mode, ["pattern_type"])
    candidates = read_variants(phrases.sparkSession, dataset_path(dataset_root))
    with cached(candidates) as held:
        write_parquet(ex.accepted(held), accepted_path(dataset_root), mode, ["pattern_type"])
        for name in names:
            one = held.where(F.col("pattern_type") == name)
            reports = variant_reports(one, samples.get(name, ACCEPTED_SAMPLE))
            write_csv_tables(reports, output_path(output_root, name), mode)
    write_csv(ev.comparison_table(matches, names), f"{output_root}/comparison_table.csv", mode)
    if pt.BARE_V2.pattern_type in names:
        folder = output_path(output_root, pt.BARE_V2.pattern_type)
        write_csv(ev.promotion_summary(matches), f"{folder}/promotion_summary.csv", mode)
    return candidates


def write_strategy(
    candidates: DataFrame, gold: DataFrame, output_root: str, mode: str = "overwrite"
) -> None:
    """Write the overlap of every variant with the gold pairs."""
    table = ev.strategy_table(ev.pair_cells(candidates), ev.baseline_pairs(gold))
    write_csv(table, f"{output_root}/dataset_strategy.csv", mode)


def head_reports(labelled: DataFrame) -> dict[str, DataFrame]:
    """Review tables of head-labelled candidates by output name."""
    taken = hd.head_accepted(labelled)
    return {
        "candidate_counts.csv": ct.head_label_counts(labelled),
        "ground_vehicle_counts.csv": ct.variant_pair_counts(taken),
        "vehicle_counts.csv": ct.head_vehicle_counts(taken),
        "accepted_review_sample.csv": sm.head_accepted_sample(labelled),
        "review_sample.csv": sm.head_review_sample(labelled),
    }


def write_head_labels(
    candidates: DataFrame,
    dataset_root: str,
    output_root: str,
    morphology: DataFrame | None = None,
    mode: str = "overwrite",
) -> DataFrame:
    """Label bare candidates by their heads, write datasets and tables."""
    bare = candidates.where(F.col("pattern_type") == pt.BARE_V2.pattern_type)
    path = f"{dataset_root}/{hd.LABELLED_PATTERN}/candidates"
    labels = hd.classify_heads(bare, morphology)
    write_parquet(labels, path, mode)
    labelled = candidates.sparkSession.read.schema(labels.schema).parquet(path)
    taken = f"{dataset_root}/{hd.LABELLED_PATTERN}/accepted_candidates"
    with cached(labelled) as held:
        write_parquet(hd.head_accepted(held), taken, mode)
        write_csv_tables(head_reports(held), f"{output_root}/{hd.LABELLED_PATTERN}", mode)
    return labelled


def merged_reports(merged: DataFrame) -> dict[str, DataFrame]:
    """Tables of the merged set by output name."""
    return {
        "candidate_counts.csv": ct.pattern_counts(merged),
        "ground_vehicle_counts.csv": ct.merged_pair_counts(merged),
        "vehicle_ground_counts.csv": ct.merged_reverse_pair_counts(merged),
        "ground_counts.csv": ct.ground_counts(merged),
        "vehicle_counts.csv": ct.merged_vehicle_counts(merged),
        "examples.csv": sm.merged_examples(merged),
        "review_sample.csv": sm.merged_review_sample(merged),
    }


def write_merged(
    gold: DataFrame, labelled: DataFrame, dataset_path: str, output_root: str,
    mode: str = "overwrite",
) -> DataFrame:
    """Merge gold and promoted candidates, write the set and its tables."""
    rows = mg.merge_candidates(gold, hd.promoted(labelled))
    write_parquet(rows, dataset_path, mode)
    merged = gold.sparkSession.read.schema(rows.schema).parquet(dataset_path)
    with cached(merged) as held:
        write_csv_tables(merged_reports(held), output_root, mode)
    return merged
