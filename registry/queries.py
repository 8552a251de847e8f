"""One query per operator; each reads the driver tables and returns a DataFrame."""

from __future__ import annotations

import uuid

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from likeness.operators import analyses as an
from likeness.operators import counts as ct
from likeness.operators import evaluate as ev
from likeness.operators import export as xp
from likeness.operators import extract as ex
from likeness.operators import heads as hd
from likeness.session import shared_folder
from likeness.operators import merge as mg
from likeness.operators import patterns as pt
from likeness.operators import samples as sm
from likeness.operators import segments as sg
from likeness.session import checkpointed
from likeness.sources import lexicon_files
from registry import corpus

Query = Callable[[SparkSession, str], DataFrame]

ENGLISH = pt.PatternSpec("english_preposition_the", r"(?:of|in|by|was)\s+the", ("the",))


# ---- shared inputs ---------------------------------------------------------------


def _bronze(spark: SparkSession, sf: str) -> DataFrame:
    return sg.bronze_segments(corpus.corpus_lines(spark, sf))


def _segments(spark: SparkSession, sf: str, *specs: pt.PatternSpec) -> DataFrame:
    return sg.bronze_segments_with(
        corpus.corpus_lines(spark, sf), pt.all_literals(list(specs))
    )


def _gold(spark: SparkSession, sf: str) -> DataFrame:
    return ex.gold_candidates(_segments(spark, sf, pt.ARTICLE))


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    return ex.labelled_candidates(_segments(spark, sf, pt.ARTICLE))


def _cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return xp.clean_candidates(_gold(spark, sf))


def _stored_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return xp.clean_candidates(checkpointed(_gold(spark, sf)))


def _variants(spark: SparkSession, sf: str) -> DataFrame:
    return ex.variant_candidates(_segments(spark, sf, *pt.VARIANTS.values()))


def _variant_matches(spark: SparkSession, sf: str) -> DataFrame:
    segments = _segments(spark, sf, *pt.VARIANTS.values())
    return ex.variant_matches(segments, list(pt.VARIANTS))


def _heads(spark: SparkSession, sf: str) -> DataFrame:
    segments = _segments(spark, sf, pt.BARE_V2)
    return hd.classify_heads(ex.variant_candidates(segments, [pt.BARE_V2.pattern_type]))


_ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def plain_tagger(batch):
    """A tagger in plain Python: ASCII lower case as lemma, capitals as proper nouns."""
    import pandas as pd

    lower = str.maketrans(_ASCII_UPPER, _ASCII_UPPER.lower())
    heads = batch["vehicle_head_clean"]
    return pd.DataFrame(
        {
            "head_lemma": [None if h is None else h.translate(lower) for h in heads],
            "head_pos": [
                "X" if h is None else "PROPN" if h[:1] in _ASCII_UPPER and h[:1] else "NOUN"
                for h in heads
            ],
        }
    )


def _tagged_head_counts(spark: SparkSession, sf: str) -> DataFrame:
    segments = _segments(spark, sf, pt.BARE_V2)
    candidates = ex.variant_candidates(segments, [pt.BARE_V2.pattern_type])
    pairs = candidates.select("vehicle_head_clean", "candidate_full_text")
    tagged = hd.with_tagger_on_distinct(pairs, plain_tagger)
    return tagged.groupBy("head_lemma", "head_pos").agg(F.count(F.lit(1)).alias("n"))


def _written_and_read(spark: SparkSession, table: DataFrame, name: str) -> DataFrame:
    """``table`` written by the plans' writer to the shared folder and read back."""
    from likeness.sinks import files

    folder = f"{shared_folder(spark)}/read-back-{uuid.uuid4().hex}"
    write = files.write_csv_tables if name.endswith(".csv") else files.write_json_tables
    write({name: table}, folder)
    return files.read_back(spark, folder, {name: table})[name]


def _stored_matches(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    # Gold and bare candidates from one corpus scan: the matches, a small part
    # of the text, are stored once and both branches read them.
    specs = [pt.ARTICLE, pt.BARE_V2]
    phrases = checkpointed(ex.match_phrases(_segments(spark, sf, *specs), specs))
    article = ex.of_patterns(phrases, pt.ARTICLE.pattern_type)
    bare = ex.of_patterns(phrases, pt.BARE_V2.pattern_type)
    gold = ex.gold_from_matches(ex.label_strict(article))
    return gold, ex.variant_columns(ex.label_variants(bare))


def _merged(spark: SparkSession, sf: str) -> DataFrame:
    gold, bare = _stored_matches(spark, sf)
    return mg.merge_candidates(gold, hd.promoted(hd.classify_heads(bare, pattern_type=None)))


def _english(lines: DataFrame, spark: SparkSession, sf: str) -> DataFrame:
    segments = sg.bronze_segments_with(lines, ENGLISH.literals)
    return ex.gold_candidates(segments, corpus.benchmark_lexicon(spark, sf), ENGLISH)


def _english_segments(spark: SparkSession, sf: str) -> DataFrame:
    return sg.bronze_segments_with(corpus.document_lines(spark, sf), ENGLISH.literals)


def _english_labelled(spark: SparkSession, sf: str) -> DataFrame:
    words = corpus.benchmark_lexicon(spark, sf)
    return ex.labelled_candidates(_english_segments(spark, sf), words, ENGLISH)


def _english_gold(spark: SparkSession, sf: str) -> DataFrame:
    return _english(corpus.document_lines(spark, sf), spark, sf)


def _english_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return xp.clean_candidates(_english_gold(spark, sf))


def _english_variants(spark: SparkSession, sf: str) -> DataFrame:
    words = corpus.benchmark_lexicon(spark, sf)
    phrases = ex.match_phrases(_english_segments(spark, sf), [ENGLISH], words)
    return ex.variant_columns(ex.label_variants(phrases))


def _english_heads(spark: SparkSession, sf: str) -> DataFrame:
    return hd.classify_heads(_english_variants(spark, sf))


def _english_stages(spark: SparkSession, sf: str) -> DataFrame:
    words = corpus.benchmark_lexicon(spark, sf)
    return ev.stage_counts(_english_segments(spark, sf), words, ENGLISH)


def _phrase_counts(spark: SparkSession, sf: str) -> DataFrame:
    words = corpus.benchmark_phrases(spark, sf)
    matches = pt.find_matches(_english_segments(spark, sf), [ENGLISH], words)
    return ct.ranked_counts(matches, "ground_source", "ground_lemma")


def _flat(df: DataFrame) -> DataFrame:
    """Arrays as text, for comparison with SQL results."""
    arrays = [f.name for f in df.schema.fields if f.dataType.typeName() == "array"]
    return df.withColumns({name: F.array_join(name, "|") for name in arrays})


def _on(source: Callable[[SparkSession, str], DataFrame], operator: Callable) -> Query:
    return lambda spark, sf: _flat(operator(source(spark, sf)))


def _prefilter(spec: pt.PatternSpec) -> Query:
    columns = ["source_file", "original_line_id", "segment_id", "match_text"]
    return lambda spark, sf: pt.prefilter(_segments(spark, sf, spec), spec).select(*columns)


def _match_offsets(spark: SparkSession, sf: str) -> DataFrame:
    specs = [pt.ARTICLE, *pt.VARIANTS.values()]
    matches = pt.find_matches(_segments(spark, sf, *specs), specs)
    return matches.drop("text_normalized", "ground_reference_path")


def _new_pairs(spark: SparkSession, sf: str) -> DataFrame:
    gold, bare = _stored_matches(spark, sf)
    return ev.new_pairs(ex.accepted(bare), ev.baseline_pairs(gold))


def _strategy(spark: SparkSession, sf: str) -> DataFrame:
    # One corpus scan for gold and all variants, then the table that a run writes.
    specs = [pt.ARTICLE, *pt.VARIANTS.values()]
    phrases = checkpointed(ex.match_phrases(_segments(spark, sf, *specs), specs))
    article = ex.of_patterns(phrases, pt.ARTICLE.pattern_type)
    gold = ex.gold_from_matches(ex.label_strict(article))
    others = ex.label_variants(ex.of_patterns(phrases, *pt.VARIANTS))
    cells = ev.pair_cells(ex.variant_columns(others))
    return ev.strategy_table(cells, ev.baseline_pairs(gold))


def _pattern_union(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["candidate_id", "pattern_type", "ground_lemma", "vehicle_head_clean"]
    gold, bare = _stored_matches(spark, sf)
    baseline = gold.withColumnRenamed("vehicle_head_lemma", "vehicle_head_clean")
    return mg.union_patterns([baseline.select(*columns), bare.select(*columns)])


def _manifest(cleaned: DataFrame) -> DataFrame:
    return xp.manifest(cleaned).drop("generated_at")


def _same(df: DataFrame) -> DataFrame:
    return df


QUERIES: dict[str, Query] = {
    # bronze and prefilters
    "bronze_segments": _on(_bronze, _same),
    "source_files": _on(_bronze, sg.source_files),
    "prefilter_article": _prefilter(pt.ARTICLE),
    "prefilter_bare": _prefilter(pt.BARE),
    "prefilter_bare_v2": _prefilter(pt.BARE_V2),
    "prefilter_colloquial": _prefilter(pt.COLLOQUIAL),
    "prefilter_window": _prefilter(pt.WINDOW),
    # extraction
    "match_offsets": _match_offsets,
    "gold_candidates": _on(_gold, _same),
    "labelled_candidates": _on(_labelled, _same),
    "stage_counts": _on(lambda s, d: _segments(s, d, pt.ARTICLE), ev.stage_counts),
    "reject_reason_counts": _on(_labelled, an.reject_report),
    "reject_sample": _on(_labelled, an.reject_sample),
    # gold tables
    "ground_vehicle_counts": _on(_gold, ct.ground_vehicle_counts),
    "vehicle_ground_counts": _on(_gold, ct.vehicle_ground_counts),
    "ground_counts": _on(_gold, ct.ground_counts),
    "vehicle_counts": _on(_gold, ct.vehicle_counts),
    "display_pairs": _on(_gold, lambda g: ct.display_pairs(ct.ground_vehicle_counts(g))),
    "examples": _on(_gold, sm.examples),
    "review_sample": _on(_gold, sm.review_sample),
    "gold_needing_review": _on(_gold, xp.needing_review),
    # export
    "backend_candidates": _on(_cleaned, xp.export_records),
    "export_ground_vehicle": _on(_stored_cleaned, xp.ground_vehicle_export),
    "export_vehicle_ground": _on(_stored_cleaned, xp.vehicle_ground_export),
    "export_ground_counts": _on(_cleaned, xp.ground_export),
    "export_vehicle_counts": _on(_cleaned, xp.vehicle_export),
    "export_examples": _on(_cleaned, xp.export_examples),
    "export_review": _on(_cleaned, xp.export_review),
    "export_rejected_or_review": _on(_cleaned, xp.rejected_or_review),
    "manifest": _on(_cleaned, _manifest),
    # pattern variants
    "pattern_candidates": _on(_variants, _same),
    "accepted_candidates": _on(_variants, ex.accepted),
    "not_accepted_candidates": _on(_variants, ex.not_accepted),
    "label_counts": _on(_variants, ct.label_counts),
    "pattern_pair_counts": _on(_variants, lambda v: ct.variant_pair_counts(ex.accepted(v))),
    "pattern_vehicle_counts": _on(_variants, lambda v: ct.variant_vehicle_counts(ex.accepted(v))),
    "reason_counts": _on(_variants, lambda v: ct.reason_counts(ex.not_accepted(v))),
    "top_reject_reason": _on(_variants, ev.top_reject_reason),
    "pattern_review_sample": _on(_variants, sm.variant_review_sample),
    "accepted_review_sample": _on(_variants, sm.accepted_review_sample),
    "top_pairs": _on(_variants, sm.top_pairs),
    "quality_notes": _on(_variants, ev.quality_notes),
    "experiment_comparison": _on(_variant_matches, ev.comparison_table),
    "promotion_summary": _on(_variant_matches, ev.promotion_summary),
    "pattern_union": _pattern_union,
    "pattern_union_counts": _on(_pattern_union, ct.pattern_counts),
    "new_pairs": _new_pairs,
    "dataset_strategy": _strategy,
    # head labels
    "nlp_labels": _on(_heads, _same),
    "tagged_head_counts": _tagged_head_counts,
    "csv_read_back": lambda s, d: _written_and_read(
        s, ct.ground_vehicle_counts(_gold(s, d)), "como_article_ground_vehicle_counts.csv"
    ),
    "json_read_back": lambda s, d: _written_and_read(
        s, xp.export_records(_cleaned(s, d)), "candidates.jsonl"
    ),
    "nlp_accepted": _on(_heads, hd.head_accepted),
    "nlp_promoted": _on(_heads, hd.promoted),
    "nlp_label_counts": _on(_heads, ct.head_label_counts),
    "nlp_reason_counts": _on(_heads, lambda h: ct.head_label_counts(h, by_pattern=False)),
    "nlp_pair_counts": _on(_heads, lambda h: ct.variant_pair_counts(hd.head_accepted(h))),
    "nlp_vehicle_counts": _on(_heads, lambda h: ct.head_vehicle_counts(hd.head_accepted(h))),
    "nlp_accepted_sample": _on(_heads, sm.head_accepted_sample),
    "nlp_review_sample": _on(_heads, sm.head_review_sample),
    # merged set
    "merged_dataset": _on(_merged, _same),
    "merged_pattern_counts": _on(_merged, ct.pattern_counts),
    "merged_pair_counts": _on(_merged, ct.merged_pair_counts),
    "merged_reverse_pair_counts": _on(_merged, ct.merged_reverse_pair_counts),
    "merged_ground_counts": _on(_merged, ct.ground_counts),
    "merged_vehicle_counts": _on(_merged, ct.merged_vehicle_counts),
    "merged_examples": _on(_merged, sm.merged_examples),
    "merged_review_sample": _on(_merged, sm.merged_review_sample),
    # analyses
    "dominance": _on(_gold, an.dominance),
    "ground_fingerprint": _on(_gold, an.ground_fingerprint),
    "vehicle_fingerprint": _on(_gold, an.vehicle_fingerprint),
    "simpson_index": _on(_gold, an.simpson_index),
    "length_distribution": _on(_gold, an.length_distribution),
    "noise_profile": _on(_gold, an.noise_profile),
    "use_type_counts": _on(_gold, an.use_type_counts),
    "lexicon_source_counts": _on(_labelled, an.lexicon_source_counts),
    # other languages and sources, lexicon from a table
    "lexicon_join_counts": lambda s, d: ct.ranked_counts(
        pt.find_matches(
            sg.bronze_segments_with(corpus.document_lines(s, d), ENGLISH.literals),
            [ENGLISH],
            corpus.benchmark_lexicon(s, d),
        ),
        "ground_source",
        "ground_lemma",
    ),
    "english_the_counts": lambda s, d: ct.ground_vehicle_counts(
        _english(corpus.document_lines(s, d), s, d)
    ),
    "english_page_counts": lambda s, d: ct.ground_vehicle_counts(
        _english(corpus.page_lines(s, d), s, d)
    ),
    "english_conversation_counts": lambda s, d: ct.ground_vehicle_counts(
        _english(corpus.conversation_lines(s, d), s, d)
    ),
    "lexicon_phrase_counts": _phrase_counts,
    "prefilter_with_lexicon": lambda s, d: pt.prefilter_with_lexicon(
        _english_segments(s, d), [ENGLISH], corpus.benchmark_phrases(s, d)
    ),
    "stage_counts_with_lexicon": _english_stages,
    # lexicon files parsed from tables
    "quality_words": _on(corpus.word_lines, lexicon_files.quality_words),
    "verb_groups": _on(corpus.verb_files, lexicon_files.verb_groups),
    # the same operators on unmodified documents, with connectors and grounds of their own
    "english_gold_candidates": _on(_english_gold, _same),
    "english_labelled_candidates": _on(_english_labelled, _same),
    "english_reject_reason_counts": _on(_english_labelled, an.reject_report),
    "english_ground_counts": _on(_english_gold, ct.ground_counts),
    "english_vehicle_counts": _on(_english_gold, ct.vehicle_counts),
    "english_examples": _on(_english_gold, sm.examples),
    "english_review_sample": _on(_english_gold, sm.review_sample),
    "english_backend_candidates": _on(_english_cleaned, xp.export_records),
    "english_export_ground_vehicle": _on(_english_cleaned, xp.ground_vehicle_export),
    "english_export_ground_counts": _on(_english_cleaned, xp.ground_export),
    "english_manifest": _on(_english_cleaned, _manifest),
    "english_dominance": _on(_english_gold, an.dominance),
    "english_ground_fingerprint": _on(_english_gold, an.ground_fingerprint),
    "english_simpson_index": _on(_english_gold, an.simpson_index),
    "english_length_distribution": _on(_english_gold, an.length_distribution),
    "english_noise_profile": _on(_english_gold, an.noise_profile),
    "english_use_type_counts": _on(_english_gold, an.use_type_counts),
    "english_pattern_candidates": _on(_english_variants, _same),
    "english_label_counts": _on(_english_variants, ct.label_counts),
    "english_pattern_pair_counts": _on(
        _english_variants, lambda v: ct.variant_pair_counts(ex.accepted(v))
    ),
    "english_reason_counts": _on(
        _english_variants, lambda v: ct.reason_counts(ex.not_accepted(v))
    ),
    "english_nlp_labels": _on(_english_heads, _same),
    "english_nlp_label_counts": _on(_english_heads, ct.head_label_counts),
}
