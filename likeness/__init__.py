"""Mine comparison phrases ("strong as a bull") from text corpora with Spark.

Typical use::

    from likeness import build_session, load_or_build_bronze, gold_candidates
    spark = build_session()
    bronze = load_or_build_bronze(spark, "corpus/*.txt.gz", "data/bronze")
    gold = gold_candidates(bronze)
"""

from likeness.lexicon import default_lexicon, default_morphology
from likeness.operators.evaluate import comparison_table, promotion_summary, strategy_table
from likeness.operators.export import clean_candidates, export_records, manifest
from likeness.operators.extract import (
    accepted,
    gold_candidates,
    labelled_candidates,
    match_phrases,
    not_accepted,
    variant_candidates,
)
from likeness.operators.heads import classify_heads, with_tagger
from likeness.operators.merge import merge_candidates
from likeness.operators.patterns import ARTICLE, VARIANTS, PatternSpec, find_matches, prefilter
from likeness.operators.segments import bronze_segments, source_files
from likeness.plans.full_run import run
from likeness.session import build_session
from likeness.sources.lexicon_files import read_lexicon
from likeness.sources.raw_text import read_lines, spread_lines
from likeness.sources.tables import load_or_build_bronze, read_bronze, read_gold, read_variants

__all__ = [
    "ARTICLE",
    "VARIANTS",
    "PatternSpec",
    "accepted",
    "bronze_segments",
    "build_session",
    "classify_heads",
    "clean_candidates",
    "comparison_table",
    "default_lexicon",
    "default_morphology",
    "export_records",
    "find_matches",
    "gold_candidates",
    "labelled_candidates",
    "load_or_build_bronze",
    "manifest",
    "match_phrases",
    "merge_candidates",
    "not_accepted",
    "prefilter",
    "promotion_summary",
    "read_bronze",
    "read_gold",
    "read_lexicon",
    "read_lines",
    "read_variants",
    "run",
    "source_files",
    "spread_lines",
    "strategy_table",
    "variant_candidates",
    "with_tagger",
]
