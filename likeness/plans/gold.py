"""Gold table, its CSV reports and the export."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from likeness.operators import counts as ct
from likeness.operators import export as xp
from likeness.operators import extract as ex
from likeness.operators import patterns as pt
from likeness.operators import samples as sm
from likeness.session import cached
from likeness.sinks.files import write_csv_tables, write_json_tables, write_parquet
from likeness.sources.tables import read_gold


def write_gold(
    phrases: DataFrame, path: str, mode: str = "overwrite"
) -> tuple[DataFrame, dict[str, int]]:
    """Label article matches, write and re-read the gold table.

    ``phrases`` comes from ``match_phrases``.  Also returns row counts observed
    during the write: matches found, segments that held one, and candidates
    kept.  No extra pass is made for them.
    """
    seen = Observation("gold")
    article = ex.of_patterns(phrases, pt.ARTICLE.pattern_type)
    matches = ex.label_strict(article).observe(
        seen,
        F.count(F.lit(1)).alias("match_rows"),
        F.coalesce(F.sum((F.col("nth") == 0).cast("long")), F.lit(0)).alias("prefiltered_rows"),
        F.coalesce(F.sum((F.col("reject_reason") == "").cast("long")), F.lit(0)).alias(
            "candidate_rows"
        ),
    )
    write_parquet(ex.gold_from_matches(matches), path, mode)
    return read_gold(phrases.sparkSession, path), dict(seen.get)


def gold_reports(gold: DataFrame) -> dict[str, DataFrame]:
    """The six report tables of a gold table by output name."""
    return {
        "como_article_ground_vehicle_counts.csv": ct.ground_vehicle_counts(gold),
        "como_article_vehicle_ground_counts.csv": ct.vehicle_ground_counts(gold),
        "como_article_ground_counts.csv": ct.ground_counts(gold),
        "como_article_vehicle_counts.csv": ct.vehicle_counts(gold),
        "como_article_examples.csv": sm.examples(gold),
        "como_article_review_sample.csv": sm.review_sample(gold),
    }


def write_gold_reports(gold: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """Write the six report tables as CSV; the gold rows are cached for it."""
    with cached(gold) as rows:
        write_csv_tables(gold_reports(rows), folder, mode)


def export_tables(
    cleaned: DataFrame,
    dataset_name: str = "comparisons",
    source_gold_path: str = "",
    generated_at: str | None = None,
) -> dict[str, DataFrame]:
    """The nine export tables by output name."""
    return {
        "candidates.jsonl": xp.export_records(cleaned),
        "ground_vehicle_counts.json": xp.ground_vehicle_export(cleaned),
        "vehicle_ground_counts.json": xp.vehicle_ground_export(cleaned),
        "ground_counts.json": xp.ground_export(cleaned),
        "vehicle_counts.json": xp.vehicle_export(cleaned),
        "examples.jsonl": xp.export_examples(cleaned),
        "review_sample.jsonl": xp.export_review(cleaned),
        "rejected_or_review_candidates.jsonl": xp.rejected_or_review(cleaned),
        "manifest.json": xp.manifest(cleaned, dataset_name, source_gold_path, generated_at),
    }


def write_export(
    gold: DataFrame,
    folder: str,
    dataset_name: str = "comparisons",
    source_gold_path: str = "",
    generated_at: str | None = None,
    mode: str = "overwrite",
) -> dict[str, object]:
    """Clean gold candidates, write the nine export outputs, return the manifest."""
    with cached(xp.clean_candidates(gold)) as cleaned:
        tables = export_tables(cleaned, dataset_name, source_gold_path, generated_at)
        write_json_tables(tables, folder, mode)
        schema = tables["manifest.json"].schema
    written = gold.sparkSession.read.schema(schema).json(f"{folder}/manifest.json")
    return written.first().asDict()
