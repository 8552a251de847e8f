"""From raw text files to every output, in one call."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from likeness.operators import extract as ex
from likeness.operators import patterns as pt
from likeness.plans import gold as gp
from likeness.plans import variants as vp
from likeness.sinks.files import write_parquet
from likeness.sources.tables import load_or_build_bronze


@dataclass(frozen=True)
class Layout:
    """Where a run keeps its tables and outputs below one root folder."""

    bronze: str
    matches: str
    gold: str
    variants: str
    merged: str
    export: str
    reports: str
    variant_reports: str
    merged_reports: str

    @classmethod
    def below(cls, root: str) -> Layout:
        """The default layout."""
        return cls(
            bronze=f"{root}/data/bronze/segments",
            matches=f"{root}/data/silver/matches",
            gold=f"{root}/data/gold/como_article_ground_vehicle_candidates",
            variants=f"{root}/data/gold/experiments",
            merged=f"{root}/data/gold/visualization/ground_vehicle_candidates",
            export=f"{root}/data/export/backend/comparisons/v1",
            reports=f"{root}/outputs",
            variant_reports=f"{root}/outputs/experiments",
            merged_reports=f"{root}/outputs/visualization",
        )


def run(
    spark: SparkSession,
    input_path: str | list[str],
    root: str,
    morphology: DataFrame | None = None,
    generated_at: str | None = None,
    lexicon: DataFrame | None = None,
    line_ids: str = "per_file",
    pattern_types: list[str] | None = None,
    accepted_samples: dict[str, int] | None = None,
    spread: bool = False,
) -> dict[str, object]:
    """Build bronze if missing, then gold, reports, export, variants and merged set.

    ``lexicon`` replaces the built-in grounds, ``pattern_types`` chooses the
    variants (all by default; head labels and the merged set need the second
    bare pattern), ``accepted_samples`` sizes their accepted review samples,
    ``line_ids`` and ``spread`` say how raw text is numbered and dealt out.

    The bronze table is scanned once: the matches of all patterns are stored
    and every output is made from them.
    Returns the export manifest.
    """
    at = Layout.below(root)
    segments = load_or_build_bronze(spark, input_path, at.bronze, line_ids, spread)
    names = list(pt.VARIANTS) if pattern_types is None else pattern_types
    specs = [pt.ARTICLE, *(pt.variant(name) for name in names)]
    found = ex.match_phrases(segments, specs, lexicon)
    write_parquet(found, at.matches)
    phrases = spark.read.schema(found.schema).parquet(at.matches)
    gold, _ = gp.write_gold(phrases, at.gold)
    gp.write_gold_reports(gold, at.reports)
    manifest = gp.write_export(gold, at.export, "comparisons", at.gold, generated_at)
    candidates = vp.write_variants(
        phrases, at.variants, at.variant_reports, names, accepted_samples=accepted_samples
    )
    vp.write_strategy(candidates, gold, at.variant_reports)
    if pt.BARE_V2.pattern_type in names:
        labelled = vp.write_head_labels(candidates, at.variants, at.variant_reports, morphology)
        vp.write_merged(gold, labelled, at.merged, at.merged_reports)
    return manifest
