"""Article pattern on sentences with known outcome."""

import pytest

from likeness.operators import extract as ex
from likeness.operators import patterns as pt
from likeness.operators.segments import bronze_segments
from likeness import lexicon as lx
from likeness import schemas
from registry.corpus import SENTENCES

# sentence, reason ("" = kept), ground lemma, vehicle text, char_start, char_end
CASES = [
    ("Sentia-se forte como um touro.", "", "forte", "touro", 10, 29),
    ("O programa saiu leve como uma pluma no ar.", "", "leve", "pluma no ar", 16, 41),
    ("A decisão caiu como uma luva.", "", "cair", "luva", 10, 28),
    ("A decisão caiu como uma luva para todos.", "", "cair", "luva para todos", 10, 39),
    ("O debate ficou grande como um tema nacional.", "generic_vehicle_head", "grande",
     "tema nacional", 15, 43),
    ("O termo foi conhecido forte como um sinal.", "role_or_classification_context", "forte",
     "sinal", 22, 41),
    ("Ele ficou frio como uma pedra muito antiga no fundo do rio.", "vehicle_too_long", "frio",
     "pedra muito antiga no fundo", 10, 51),
    ("Forte como um touro!", "", "forte", "touro", 0, 19),
    ("Ficou leve como uma 2 penas.", "bad_vehicle_start", "leve", "2 penas", 6, 27),
    ("Ficou leve como uma pena 2.", "vehicle_noise", "leve", "pena 2", 6, 26),
    ("Era forte como um todo.", "bad_vehicle_start", "forte", "todo", 4, 22),
    ("Ficou forte como um", "missing_ground_or_vehicle", "forte", "", 6, 19),
    ("super-forte como um touro", "", "forte", "touro", 6, 25),
    ("Ficou frágil como um - vaso raro.", "", "frágil", "vaso raro", 6, 32),
    ("Ficou duro como um pneu usado.", "", "duro", "pneu usado", 6, 29),
    ("Caiu como uma luva é linda.", "", "cair", "luva é linda", 0, 26),
    ("😀 Duro como uma 😀 pedra.", "", "duro", "pedra", 2, 23),
]
NO_MATCH = [
    "O quarto estava frio como gelo.",
    "Ele trabalha que nem um robô.",
    "Ele ficou falso como uma moeda.",
    "éforte como um touro",
    "forte como umbigo",
    "forte comoum touro",
    "_forte como um touro",
]


def test_known_sentences(lines_of):
    labelled = ex.labelled_candidates(bronze_segments(lines_of(*[c[0] for c in CASES], start=0)))
    got = {r.original_line_id: r for r in labelled.collect()}
    assert len(got) == len(CASES)
    for i, (sentence, reason, ground, vehicle, start, end) in enumerate(CASES):
        row = got[i]
        assert (row.reject_reason, row.ground_lemma, row.vehicle_text) == (
            reason, ground, vehicle), sentence
        assert (row.char_start, row.char_end) == (start, end), sentence


def test_no_match(lines_of):
    segments = bronze_segments(lines_of(*NO_MATCH))
    assert ex.labelled_candidates(segments).count() == 0
    assert pt.prefilter(segments, pt.ARTICLE).count() == 0


def test_all_fields_of_one_candidate(lines_of):
    row = ex.gold_candidates(bronze_segments(lines_of("Sentia-se forte como um touro."))).first()
    assert row.asDict() == {
        "candidate_id": row.candidate_id,
        "source_file": "sample.txt", "original_line_id": 1, "segment_id": 0,
        "pattern_type": "como_article_ground_vehicle",
        "connector": "como um", "connector_text": "como um",
        "matched_text": "forte como um",
        "candidate_full_text": "Sentia-se forte como um touro",
        "text_before": "Sentia-se", "tenor_text": "Sentia-se", "tenor_lemma": "sentia-se",
        "tenor_confidence": "fallback_left_context",
        "ground_text": "forte", "ground_lemma": "forte", "ground_type": "quality_adjective",
        "ground_source": "curated_quality_list",
        "vehicle_text": "touro", "vehicle_lemma": "touro",
        "vehicle_head": "touro", "vehicle_head_lemma": "touro",
        "vehicle_phrase_length_tokens": 1, "filter_label": "keep", "reject_reason": "",
        "confidence": 0.95, "needs_review": False,
        "char_start": 10, "char_end": 29, "connector_start": 16, "connector_end": 23,
        "vehicle_start": 24, "vehicle_end": 29,
    }
    import hashlib

    text = "sample.txt|1|0|10|29|como_article_ground_vehicle"
    assert row.candidate_id == hashlib.sha1(text.encode()).hexdigest()


def test_columns_and_confidence(lines_of):
    gold = ex.gold_candidates(
        bronze_segments(lines_of("Forte como um touro!", "Saiu leve como uma pluma no ar."))
    ).orderBy("original_line_id")
    assert gold.columns == schemas.columns(schemas.GOLD)
    alone, phrase = gold.collect()
    assert (alone.confidence, alone.needs_review, alone.tenor_confidence) == (0.75, True, "missing")
    assert (phrase.confidence, phrase.needs_review) == (0.9, False)


def test_several_matches_in_one_segment(lines_of):
    segments = bronze_segments(
        lines_of("Forte como um touro e leve como uma pluma.",
                 "Correu como um raio, voou como um avião.")
    )
    rows = ex.labelled_candidates(segments).orderBy("original_line_id", "char_start").collect()
    got = [(r.reject_reason, r.char_start, r.char_end) for r in rows]
    assert got == [("vehicle_too_long", 0, 35), ("", 22, 41), ("", 0, 19), ("", 21, 39)]


def test_left_context_and_tenor_are_cut(lines_of):
    before = " ".join(f"palavra{i}" for i in range(30))
    row = ex.gold_candidates(bronze_segments(lines_of(f"{before} forte como um touro"))).first()
    assert row.text_before == before[-80:].lstrip()
    assert row.tenor_text == " ".join(f"palavra{i}" for i in range(25, 30))


@pytest.mark.parametrize("partitions", [1, 7])
def test_invariants_and_partition_independence(lines_of, partitions):
    lines = lines_of(*SENTENCES)
    segments = bronze_segments(lines.repartition(partitions)).cache()
    labelled = ex.labelled_candidates(segments)
    joined = labelled.join(
        segments.select("original_line_id", "segment_id", "text_normalized"),
        ["original_line_id", "segment_id"],
    )
    assert joined.where(
        "not startswith(substring(text_normalized, char_start + 1), ground_text) or "
        "substring(text_normalized, connector_start + 1, connector_end - connector_start) "
        "<> connector_text"
    ).count() == 0
    ids = [r.candidate_id for r in labelled.collect()]
    assert len(ids) == len(set(ids))
    kept = {r.candidate_id for r in ex.gold_candidates(segments).collect()}
    assert kept == {r.candidate_id for r in labelled.where("filter_label = 'keep'").collect()}
    reference = ex.labelled_candidates(bronze_segments(lines)).collect()
    assert sorted(ids) == sorted(r.candidate_id for r in reference)
    segments.unpersist()


def test_prefilter_keeps_exactly_the_matching_segments(lines_of):
    segments = bronze_segments(lines_of(*SENTENCES))
    for spec in [pt.ARTICLE, *pt.VARIANTS.values()]:
        key = ["source_file", "original_line_id", "segment_id"]
        found = pt.find_matches(segments, [spec])
        left = {tuple(r) for r in pt.prefilter(segments, spec).select(*key).collect()}
        assert left == {tuple(r) for r in found.select(*key).collect()}
        first = found.where("nth = 0")
        assert first.count() == len(left)


def test_lexicon_join_equals_built_in(lines_of, spark):
    segments = bronze_segments(lines_of(*SENTENCES))
    built_in = ex.gold_candidates(segments).collect()
    joined = ex.gold_candidates(segments, lx.default_lexicon(spark)).collect()
    assert sorted(built_in) == sorted(joined)


def test_lexicon_sizes():
    rows = lx.ground_rows()
    assert len(rows) == len({r[0] for r in rows}) == 135
    assert len({r[1] for r in rows}) == 40
    assert len(lx.ground_forms((lx.QUALITY_ADJECTIVE,))) == 102
    forms = [r[0] for r in lx.morphology_rows()]
    assert len(forms) == len(set(forms))
