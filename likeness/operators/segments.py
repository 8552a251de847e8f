"""Bronze segments: boundary-safe pieces of raw lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from likeness.functions import text as tx

SEGMENT_MARKER = "<END>"  # fixed value: hard boundary inside a raw line


def _exploded(lines: DataFrame) -> DataFrame:
    # Blank pieces leave the array before posexplode, so segment_id is dense.
    pieces = F.filter(F.split("raw_text", SEGMENT_MARKER), tx.has_text)
    return lines.select(
        "source_file",
        "original_line_id",
        F.posexplode(pieces).alias("segment_id", "piece"),
    )


def _bronze_columns(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "source_file",
        "original_line_id",
        "segment_id",
        tx.strip_spaces(F.col("piece")).alias("text_original"),
        tx.collapse_spaces(F.col("piece")).alias("text_normalized"),
    ).withColumn("match_text", F.lower("text_normalized"))


def bronze_segments(lines: DataFrame) -> DataFrame:
    """Split raw lines at the marker, normalise whitespace, drop empty pieces.

    ``lines`` has ``source_file, original_line_id, raw_text``.  Narrow: no
    shuffle, one output row per non-blank piece.
    """
    return _bronze_columns(_exploded(lines))


def bronze_segments_with(lines: DataFrame, literals: tuple[str, ...]) -> DataFrame:
    """Bronze segments that contain one of the given lower-case literals.

    Gives the same rows as filtering :func:`bronze_segments` on ``match_text``
    but tests the raw piece first, so the whitespace regexes only run on
    segments that can match.  The literals must not contain whitespace.
    """
    # Lower-casing costs more than the searches, so it is done once per piece.
    pieces = tx.computed_once(_exploded(lines), lowered=F.lower("piece"))
    held = pieces.where(contains_any(F.col("lowered"), literals))
    # Generated columns: a later test of match_text stays above the whitespace regex.
    spaced = tx.computed_once(held, text_normalized=tx.collapse_spaces(F.col("piece")))
    lowered = tx.computed_once(spaced, match_text=F.lower("text_normalized"))
    return lowered.select(
        "source_file",
        "original_line_id",
        "segment_id",
        tx.strip_spaces(F.col("piece")).alias("text_original"),
        "text_normalized",
        "match_text",
    )


def contains_any(lowered: Column, literals: tuple[str, ...]) -> Column:
    """True when the lower-case text holds one of the literals."""
    hit = lowered.contains(literals[0])
    for literal in literals[1:]:
        hit = hit | lowered.contains(literal)
    return hit


def source_files(segments: DataFrame) -> DataFrame:
    """Distinct source files of a bronze table, in order."""
    return segments.select("source_file").distinct().orderBy("source_file")
