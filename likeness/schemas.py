"""Table schemas and column contracts (fixed values: names, order, types)."""

from __future__ import annotations


def columns(ddl: str) -> list[str]:
    """Column names of a DDL schema string."""
    return [field.split()[0] for field in ddl.split(",")]


RAW = ("source_file string, original_line_id bigint, raw_text string")

BRONZE = (
    "source_file string, original_line_id bigint, segment_id int, "
    "text_original string, text_normalized string, match_text string"
)

LEXICON = (
    "form string, lemma string, ground_type string, ground_source string, "
    "ground_reference_path string"
)

MORPHOLOGY = ("form string, lemma string, pos string")

GOLD = (
    "candidate_id string, source_file string, original_line_id bigint, segment_id int, "
    "pattern_type string, connector string, connector_text string, matched_text string, "
    "candidate_full_text string, text_before string, tenor_text string, tenor_lemma string, "
    "tenor_confidence string, ground_text string, ground_lemma string, ground_type string, "
    "ground_source string, vehicle_text string, vehicle_lemma string, vehicle_head string, "
    "vehicle_head_lemma string, vehicle_phrase_length_tokens int, filter_label string, "
    "reject_reason string, confidence double, needs_review boolean, char_start int, "
    "char_end int, connector_start int, connector_end int, vehicle_start int, vehicle_end int"
)

VARIANT = (
    "candidate_id string, pattern_type string, source_file string, original_line_id bigint, "
    "segment_id int, connector_text string, matched_text string, candidate_full_text string, "
    "text_before string, ground_text string, ground_lemma string, ground_source string, "
    "vehicle_text_raw string, vehicle_text_clean string, vehicle_head_clean string, "
    "vehicle_tail_text string, quality_label string, quality_reason string, "
    "needs_review boolean, char_start int, char_end int"
)

HEAD_LABELS = (
    "nlp_quality_label string, nlp_quality_reason string, spacy_vehicle_head_lemma string, "
    "spacy_vehicle_head_pos string, nlp_needs_review boolean"
)

MERGED_COLUMNS = """
candidate_id pattern_type source_file original_line_id segment_id connector_text
matched_text candidate_full_text text_before ground_text ground_lemma ground_source
vehicle_text_raw vehicle_text_clean vehicle_head_clean vehicle_tail_text quality_label
quality_reason nlp_quality_label nlp_quality_reason spacy_vehicle_head_lemma
spacy_vehicle_head_pos nlp_needs_review needs_review char_start char_end
""".split()

EXPORT_COLUMNS = """
candidate_id dataset_version pattern_type connector_text candidate_full_text text_before
tenor_text tenor_lemma tenor_confidence ground_text ground_lemma ground_type ground_source
vehicle_text_raw vehicle_text_clean vehicle_tail_text vehicle_cleaning_rule vehicle_lemma
vehicle_head vehicle_head_lemma vehicle_head_clean vehicle_head_clean_lemma
vehicle_phrase_length_tokens quality_label quality_reason visualization_ready confidence
needs_review source_file original_line_id segment_id char_start char_end connector_start
connector_end vehicle_start vehicle_end
""".split()

PROVENANCE = ["source_file", "original_line_id", "segment_id", "char_start", "char_end"]
