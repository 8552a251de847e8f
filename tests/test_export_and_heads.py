"""Export cleanup and tables, head labels, merged set."""

import pandas as pd
from pyspark.sql import functions as F

from likeness import schemas
from likeness.operators import export as xp
from likeness.operators import extract as ex
from likeness.operators import heads as hd
from likeness.operators import merge as mg
from likeness.operators import patterns as pt
from likeness.operators.segments import bronze_segments
from registry.corpus import SENTENCES


def _cleaned(lines):
    return xp.clean_candidates(ex.gold_candidates(bronze_segments(lines)))


def test_trims_common_head_tail(lines_of):
    row = _cleaned(lines_of("O programa saiu leve como uma pluma no ar.")).first()
    assert row.dataset_version == "v1"
    assert (row.vehicle_text_raw, row.vehicle_text_clean) == ("pluma no ar", "pluma")
    assert row.vehicle_tail_text == "no ar"
    assert row.vehicle_cleaning_rule == "trimmed_common_head_tail"
    assert row.vehicle_head_clean_lemma == "pluma"
    assert (row.quality_label, row.quality_reason) == ("trimmed", ["trimmed_common_head_tail"])
    assert row.visualization_ready


def test_trims_clause_and_marks_role(lines_of):
    clause, role = (
        _cleaned(lines_of("Caiu como uma luva é linda.", "Ficou duro como um pneu usado."))
        .orderBy("original_line_id")
        .collect()
    )
    assert (clause.vehicle_text_clean, clause.vehicle_tail_text) == ("luva", "é linda")
    assert clause.vehicle_cleaning_rule == "trimmed_clause_start"
    assert (role.quality_label, role.visualization_ready) == ("review", False)


def test_role_words_in_edited_rows_need_review(lines_of):
    gold = ex.gold_candidates(bronze_segments(lines_of("Sentia-se forte como um touro.")))
    edited = gold.withColumns(
        {
            "text_before": F.lit("usado"),
            "candidate_full_text": F.lit("usado forte como um touro"),
        }
    )
    row = xp.clean_candidates(edited).first()
    assert row.quality_label == "review"
    assert "role_or_classification_context" in row.quality_reason
    assert not row.visualization_ready
    assert row.needs_review


def test_rejected_rows_stay_rejected(lines_of):
    labelled = ex.labelled_candidates(bronze_segments(lines_of("Era forte como um todo.")))
    row = xp.clean_candidates(labelled).first()
    assert (row.quality_label, row.quality_reason) == ("reject", ["bad_vehicle_start"])


def test_export_tables(lines_of):
    cleaned = _cleaned(
        lines_of(
            "A decisão caiu como uma luva para todos.",
            "A decisão caiu como uma luva.",
            "Sentia-se forte como um touro.",
        )
    ).cache()
    ids = [r.candidate_id for r in cleaned.orderBy("original_line_id").collect()]
    first = xp.ground_vehicle_export(cleaned).first()
    assert tuple(first)[:3] == ("cair", "luva", 2)
    assert first.example_candidate_ids == ids[:2]
    assert xp.vehicle_ground_export(cleaned).columns[0] == "vehicle_head_clean_lemma"
    grounds = [tuple(r) for r in xp.ground_export(cleaned).collect()]
    assert grounds == [("cair", 2, 1, "luva", 2, 1.0), ("forte", 1, 1, "touro", 1, 1.0)]
    assert xp.export_records(cleaned).columns == schemas.EXPORT_COLUMNS
    assert len(schemas.EXPORT_COLUMNS) == 37
    total = xp.manifest(cleaned, generated_at="2026-05-17T00:00:00+00:00").first()
    assert (total.candidate_count, total.ground_count, total.vehicle_count) == (3, 2, 2)
    assert (total.ground_vehicle_pair_count, total.visualization_ready_count) == (2, 3)
    cleaned.unpersist()


def test_pair_examples_are_the_first_five_of_a_hot_pair(lines_of):
    cleaned = _cleaned(lines_of(*["A decisão caiu como uma luva."] * 400).repartition(8)).cache()
    row = xp.ground_vehicle_export(cleaned).first()
    order = [r.candidate_id for r in cleaned.orderBy("original_line_id").take(5)]
    assert row["count"] == 400
    assert row.example_candidate_ids == order
    cleaned.unpersist()


def test_key_counts_ties_and_empty_values(spark):
    rows = [("g", "b"), ("g", "a"), ("g", ""), ("g", None), ("h", ""), ("", "a")]
    df = spark.createDataFrame(rows, "ground_lemma string, vehicle_head_clean_lemma string")
    got = [tuple(r) for r in xp.ground_export(df).collect()]
    assert got == [("g", 4, 2, "a", 1, 0.25)]


# ---- head labels ---------------------------------------------------------------------

# head, raw, full text, morphology (lemma, pos) or None, label, reason
HEADS = [
    ("água", "água", "ficou claro como água", None, "keep", "visual_head_whitelist"),
    ("jogador", "jogador de futebol", "foi brilhante como jogador de futebol", None, "reject",
     "role_head_lexicon"),
    ("parceiro", "parceiro estratégico", "a empresa trabalha forte como parceiro estratégico",
     None, "reject", "role_head_lexicon"),
    ("sendo", "sendo comum", "ficou claro como sendo comum", ("ser", "AUX"), "reject",
     "bad_spacy_pos_aux"),
    ("casa", "casa", "ficou usado forte como casa", None, "review", "role_context"),
    ("cantor", "cantor", "era alto como cantor", ("cantor", "NOUN"), "review",
     "role_like_suffix"),
    ("muro", "muro de pedra velha", "era claro como muro de pedra velha", None, "review",
     "long_vehicle_phrase"),
    ("muro", "muro", "era claro como muro", None, "keep", "spacy_short_nominal_vehicle"),
    ("", "", "", None, "reject", "missing_vehicle_head"),
]


def _head_rows(spark):
    rows = [(i, head, raw, full) for i, (head, raw, full, *_) in enumerate(HEADS)]
    return spark.createDataFrame(
        rows,
        "id int, vehicle_head_clean string, vehicle_text_raw string, candidate_full_text string",
    )


def _check_heads(df):
    for row in df.collect():
        _, _, _, known, label, reason = HEADS[row.id]
        assert (row.nlp_quality_label, row.nlp_quality_reason) == (label, reason)
        assert row.nlp_needs_review == (label != "keep")
        if known:
            assert (row.spacy_vehicle_head_lemma, row.spacy_vehicle_head_pos) == known


def test_head_rules_with_given_morphology(spark):
    known = [(head, *m) for head, _, _, m, _, _ in HEADS if m]
    table = spark.createDataFrame(known, schemas.MORPHOLOGY)
    _check_heads(hd.classify_heads(_head_rows(spark), table, pattern_type=None))


def test_head_rules_with_built_in_morphology(spark):
    labelled = hd.classify_heads(_head_rows(spark).withColumn("pattern_type", F.lit("x")))
    _check_heads(labelled)
    assert {r.pattern_type for r in labelled.collect()} == {"bare_como_spacy_filter"}


def test_head_rules_with_own_tagger(spark):
    known = {head: m for head, _, _, m, _, _ in HEADS if m}

    def tag(batch: pd.DataFrame) -> pd.DataFrame:
        pairs = [known.get(head, (head, "")) for head in batch["vehicle_head_clean"]]
        return pd.DataFrame(pairs, columns=["head_lemma", "head_pos"])

    _check_heads(hd.label_heads(hd.with_tagger(_head_rows(spark), tag)))


def test_merged_set(lines_of):
    segments = bronze_segments(lines_of(*SENTENCES, "Ficou claro como água. <END> doce como mel"))
    gold = ex.gold_candidates(segments)
    bare = ex.variant_candidates(segments, [pt.BARE_V2.pattern_type])
    promoted = hd.promoted(hd.classify_heads(bare, pattern_type=None))
    merged = mg.merge_candidates(gold, promoted).cache()
    assert merged.columns == schemas.MERGED_COLUMNS
    assert merged.count() == gold.count() + promoted.count()
    assert mg.merge_candidates(gold.union(gold), promoted).count() == merged.count()
    names = {r[0] for r in merged.select("pattern_type").distinct().collect()}
    assert names == {"como_article_ground_vehicle", "bare_como_visual_whitelist"}
    merged.unpersist()


def test_cleanup_of_few_columns(spark):
    rows = spark.createDataFrame([("luva é linda",), ("",)], "vehicle_text string")
    cleaned = xp.clean_candidates(rows).orderBy(F.desc("vehicle_text")).collect()
    assert (cleaned[0].vehicle_text_clean, cleaned[0].quality_label) == ("luva", "trimmed")
    assert (cleaned[1].vehicle_head_clean, cleaned[1].quality_label) == (None, "keep")
    assert not cleaned[1].needs_review
