"""Labelled pattern variants and their evaluation."""

import itertools

import pytest
from pyspark.sql import functions as F

from likeness import schemas
from likeness.operators import evaluate as ev
from likeness.operators import extract as ex
from likeness.operators import patterns as pt
from likeness.operators.segments import bronze_segments
from registry.corpus import SENTENCES

BARE, V2, COLLOQUIAL, WINDOW = list(pt.VARIANTS)

# pattern, sentence, raw, clean, head, label, reason
CASES = [
    (BARE, "O quarto estava frio como gelo, mas era limpo.", "gelo", "gelo", "gelo", "keep",
     "short_vehicle"),
    (BARE, "O menino ficou forte como o pai.", "o pai", "o pai", "o", "reject",
     "bad_vehicle_start"),
    (V2, "O menino ficou forte como o pai.", "o pai", "pai", "pai", "keep",
     "stripped_definite_article"),
    (V2, "Ficou claro como se nada tivesse acontecido.", "se nada tivesse acontecido",
     "se nada tivesse", "se", "reject", "bad_vehicle_start"),
    (V2, "Ficou doce como seu gesto.", "seu gesto", "seu gesto", "seu", "reject",
     "bad_vehicle_start"),
    (V2, "Está forte como agora parecia.", "agora parecia", "agora parecia", "agora", "reject",
     "bad_vehicle_start"),
    (V2, "Era grande como quando saiu.", "quando saiu", "quando saiu", "quando", "reject",
     "bad_vehicle_start"),
    (V2, "Ficou leve como mais ninguém.", "mais ninguém", "mais ninguém", "mais", "reject",
     "bad_vehicle_start"),
    (COLLOQUIAL, "Ele corre feito louco quando chove.", "louco quando chove", "louco", "louco",
     "trimmed", "trimmed_clause_like_tail"),
    (WINDOW, "O tecido parecia tão leve como uma pluma.", "pluma", "pluma", "pluma", "keep",
     "short_vehicle"),
    (BARE, "Ficou forte como sistema.", "sistema", "sistema", "sistema", "review",
     "generic_or_role_like_vehicle_head"),
    (BARE, "Ficou forte como Ayrton Senna.", "Ayrton Senna", "Ayrton Senna", "ayrton", "review",
     "capitalized_multi_token_vehicle"),
    (BARE, "Ficou doce como mel 5.", "mel 5", "mel 5", "mel", "reject", "vehicle_noise"),
    (BARE, "Ficou duro como pedra de amolar faca velha.", "pedra de amolar faca velha",
     "pedra de amolar faca", "pedra", "trimmed", "trimmed_clause_like_tail"),
    (V2, "Ficou forte como o mesmo.", "o mesmo", "mesmo", "mesmo", "reject",
     "bad_definite_article_vehicle"),
    (V2, "Ficou forte como o.", "o", "o", "o", "reject", "bad_definite_article_vehicle"),
]


def test_known_sentences(lines_of):
    segments = bronze_segments(lines_of(*[c[1] for c in CASES], start=0))
    found = ex.variant_candidates(segments).collect()
    rows = {(r.pattern_type, r.original_line_id): r for r in found}
    for i, (pattern, sentence, *wanted) in enumerate(CASES):
        r = rows[pattern, i]
        got = [r.vehicle_text_raw, r.vehicle_text_clean, r.vehicle_head_clean,
               r.quality_label, r.quality_reason]
        assert got == wanted, sentence
        assert r.needs_review == (r.quality_label in ("review", "reject"))


def test_bare_skips_articles(lines_of):
    segments = bronze_segments(lines_of("Sentia-se forte como um touro."))
    assert ex.variant_candidates(segments, [BARE, V2]).count() == 0
    assert pt.prefilter(segments, pt.BARE).count() == 0


def test_window_fields(lines_of):
    segments = bronze_segments(lines_of("O tecido parecia tão leve como uma pluma."))
    row = ex.variant_candidates(segments, [WINDOW]).first()
    assert (row.ground_text, row.ground_lemma, row.connector_text) == ("leve", "leve", "como uma")
    assert (row.char_start, row.char_end) == (21, 40)


def test_columns_and_unknown_name(lines_of):
    segments = bronze_segments(lines_of("frio como gelo"))
    candidates = ex.variant_candidates(segments)
    assert candidates.columns == schemas.columns(schemas.VARIANT)
    with pytest.raises(ValueError):
        ex.variant_candidates(segments, ["nope"])


def test_one_pass_equals_pattern_by_pattern(lines_of):
    segments = bronze_segments(lines_of(*SENTENCES))
    together = ex.variant_candidates(segments).collect()
    apart = [r for name in pt.VARIANTS for r in ex.variant_candidates(segments, [name]).collect()]
    assert sorted(together) == sorted(apart)


def _walk(tokens):
    """Plain restatement of the vehicle selection, token by token."""
    taken = []
    for token in tokens:
        if taken and token == "que":
            break
        taken.append(token)
        if len(taken) == 4 or (len(taken) == 3 and taken[1] != "de"):
            break
    return taken


def test_selection_on_all_short_token_sequences(spark):
    sequences = [
        list(s) for n in range(1, 7) for s in itertools.product(["que", "de", "pedra"], repeat=n)
    ]
    df = spark.createDataFrame([(s,) for s in sequences], "t array<string>")
    rows = df.select("t", ex._selected(F.col("t")).alias("got")).collect()
    assert all(r.got == _walk(r.t) for r in rows)


def test_accepted_and_not_accepted_split_the_rows(lines_of):
    candidates = ex.variant_candidates(bronze_segments(lines_of(*SENTENCES))).cache()
    taken, left = ex.accepted(candidates), ex.not_accepted(candidates)
    assert taken.count() + left.count() == candidates.count()
    labels = {r[0] for r in taken.select("quality_label").distinct().collect()}
    assert labels == {"keep", "trimmed"}
    candidates.unpersist()


def test_comparison_lists_patterns_without_matches(lines_of):
    segments = bronze_segments(lines_of("frio como gelo", "frio como", "doce como mel 5"))
    table = ev.comparison_table(ex.variant_matches(segments, list(pt.VARIANTS)))
    rows = {r.experiment_slug: r for r in table.collect()}
    bare, none = rows[BARE], rows[COLLOQUIAL]
    assert (bare.prefiltered_rows, bare.candidate_rows, bare.accepted_rows) == (2, 2, 1)
    assert (bare.distinct_grounds, bare.distinct_vehicle_heads, bare.distinct_pairs) == (1, 1, 1)
    assert (bare.accepted_rate, bare.top_false_positive_reason) == (0.5, "vehicle_noise")
    assert bare.promotion_recommendation == "report-only for visualization build"
    assert (none.prefiltered_rows, none.accepted_rate) == (0, 0.0)
    assert none.top_false_positive_reason == "none"


def test_promotion_advice(lines_of):
    good = bronze_segments(lines_of("frio como gelo", "leve como pluma"))
    names = list(pt.VARIANTS)
    table = ev.comparison_table(ex.variant_matches(good, names))
    rows = {r.experiment_slug: r for r in table.collect()}
    assert rows[BARE].promotion_recommendation == "iterate cleanup, then reconsider"
    summary = ev.promotion_summary(ex.variant_matches(good, [V2])).first()
    assert summary.promotion_recommendation == "review top pairs before promotion"
    window = bronze_segments(lines_of("frio como um gelo"))
    row = ev.comparison_table(ex.variant_matches(window, [WINDOW]), [WINDOW]).first()
    assert row.promotion_recommendation == "promote after baseline overlap check"


def test_strategy_and_new_pairs(lines_of):
    segments = bronze_segments(
        lines_of("leve como uma pluma", "leve como pluma", "frio como gelo", "leve como pluma")
    )
    gold = ex.gold_candidates(segments)
    variants = ex.variant_candidates(segments)
    table = ev.strategy_table(ev.pair_cells(variants), ev.baseline_pairs(gold))
    rows = {r.experiment_slug: r for r in table.collect()}
    bare = rows[BARE]
    assert (bare.accepted_rows, bare.accepted_distinct_pairs) == (3, 2)
    assert (bare.baseline_overlapping_pairs, bare.new_pairs_vs_baseline) == (1, 1)
    assert rows[WINDOW].baseline_overlapping_pairs == 1
    fresh = ev.new_pairs(ex.accepted(variants), ev.baseline_pairs(gold)).collect()
    assert [tuple(r) for r in fresh] == [("frio", "gelo")]
