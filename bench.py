"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores.  Every
query writes to the noop sink, so all rows and columns are computed.  A pass
over the smallest data folder, when it is there, warms the JVM up first.

Two kinds of figures come out.  The queries start from the driver tables, so
each of them also pays for making its corpus.  The extraction figures start, like
the published ones, from a stored bronze table of at least ``BRONZE_MB`` of text,
made once and timed apart.
"""

from __future__ import annotations

import json
import math
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from likeness.operators import extract as ex  # noqa: E402
from likeness.operators import patterns as pt  # noqa: E402
from likeness.operators.segments import bronze_segments  # noqa: E402
from likeness.session import build_session  # noqa: E402
from likeness.sources.tables import read_bronze  # noqa: E402
from registry.corpus import corpus_lines, document_lines  # noqa: E402
from registry.queries import QUERIES  # noqa: E402

HEADLINE = """
bronze_segments prefilter_article gold_candidates reject_reason_counts ground_vehicle_counts
examples backend_candidates export_ground_vehicle export_ground_counts manifest
pattern_candidates experiment_comparison dataset_strategy accepted_review_sample
nlp_labels merged_dataset ground_fingerprint simpson_index lexicon_join_counts
english_the_counts
""".split()
BRONZE_MB = int(os.environ.get("BENCH_BRONZE_MB", "600"))


def seconds_of(df: DataFrame) -> float:
    """Seconds to run a DataFrame into the noop sink."""
    begun = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begun


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    """Seconds to build, plan and run one query."""
    begun = time.perf_counter()
    seconds_of(QUERIES[name](spark, sf_dir))
    return round(time.perf_counter() - begun, 3)


def text_mb(df: DataFrame, column: str) -> float:
    """Megabytes of UTF-8 text in a column."""
    return (df.agg(F.sum(F.octet_length(column)).alias("n")).first().n or 0) / 1e6


def copied(lines: DataFrame, times: int) -> DataFrame:
    """The lines so often, with line numbers of their own."""
    copies = lines.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
    line = F.col("original_line_id") * times + F.col("copy")
    return copies.withColumn("original_line_id", line).drop("copy")


def extraction(spark: SparkSession, sf_dir: str, folder: str) -> dict[str, float]:
    """Extraction from a stored bronze table, of the corpus and of unmodified text."""
    mb = text_mb(document_lines(spark, sf_dir), "raw_text")
    times = max(1, math.ceil(BRONZE_MB / max(mb, 0.1)))
    found: dict[str, float] = {}
    for kind, source in (("corpus", corpus_lines), ("documents", document_lines)):
        path = f"{folder}/{kind}"
        begun = time.perf_counter()
        bronze_segments(copied(source(spark, sf_dir), times)).write.parquet(path)
        found[f"{kind}_bronze_build_sec"] = time.perf_counter() - begun
        bronze = read_bronze(spark, path)
        mb = text_mb(bronze, "text_normalized")
        found[f"{kind}_bronze_mb"] = mb
        jobs = {
            "prefilter": pt.prefilter(bronze, pt.ARTICLE).select("segment_id"),
            "gold": ex.gold_candidates(bronze),
            "variants": ex.variant_candidates(bronze),
        }
        for name, df in jobs.items():
            took = seconds_of(df)
            found[f"{kind}_{name}_sec"] = took
            found[f"{kind}_{name}_mb_per_sec"] = mb / took
    return {name: round(value, 2) for name, value in found.items()}


def main() -> None:
    """Run the headline queries once each after the warm-up, then the extraction."""
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    settings = {"spark.ui.enabled": "false", "spark.driver.memory": "16g"}
    spark = build_session("bench", f"local[{cpus}]", int(cpus), settings)
    spark.sparkContext.setLogLevel("ERROR")
    mb = text_mb(document_lines(spark, sf_dir), "raw_text")
    small = Path(sf_dir).resolve().parent / "sf0.001"
    if small.is_dir():
        for name in HEADLINE:
            run(spark, name, str(small))
    seconds = {name: run(spark, name, sf_dir) for name in HEADLINE}
    with tempfile.TemporaryDirectory(prefix="likeness-bench-") as folder:
        stored = extraction(spark, sf_dir, folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "gold_mb_per_sec": stored["corpus_gold_mb_per_sec"],
                "gold_with_corpus_mb_per_sec": round(mb / seconds["gold_candidates"], 2),
                "extraction": stored,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
