"""The Bloom filter of a lexicon's last words: fewer rows, the same matches."""

from likeness.operators import patterns as pt
from likeness.operators.segments import bronze_segments

from test_lexicon_forms import lexicon


def sentences():
    grounds = ["bem-humorado", "bem humorado", "triste", "alegre", "frio", "quente"]
    others = ["azul", "verde", "lento", "rápido", "calmo", "novo", "velho", "doce"]
    lines = []
    for n in range(60):
        word = grounds[n % len(grounds)] if n % 3 == 0 else others[n % len(others)]
        lines.append(f"Era {word} como um palhaço e {others[(n + 1) % len(others)]} como uma noite.")
    return lines


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_filter_keeps_every_match_and_drops_rows(spark, lines_of):
    segments = bronze_segments(lines_of(*sentences()))
    words = lexicon(spark, "bem-humorado", "bem humorado", "d'água", "triste", "alegre", "frio", "quente")
    with_filter = pt.find_matches(segments, [pt.ARTICLE], words)
    without = pt.find_matches(segments, [pt.ARTICLE], words, filtered=False)
    assert rows(with_filter) == rows(without)
    assert with_filter.count() > 0

    reach = pt.reach_of(words)
    bloom = pt.last_words(words)
    before = pt.find_hits(segments, [pt.ARTICLE], reach).count()
    after = pt.find_hits(segments, [pt.ARTICLE], reach, bloom).count()
    assert after < before / 2


def test_filter_of_an_empty_lexicon_and_its_size(spark):
    empty = lexicon(spark)
    bloom = pt.last_words(empty)
    assert bloom.bits == pt.BLOOM_MIN_BITS and not any(bloom.filled)
    many = lexicon(spark, *[f"w{n}" for n in range(5000)])
    grown = pt.last_words(many)
    assert pt.BLOOM_MIN_BITS < grown.bits <= pt.BLOOM_MAX_BITS
    assert len(grown.filled) == grown.bits // 8


def test_prefilter_with_lexicon_counts_matches_per_segment(spark, lines_of):
    segments = bronze_segments(lines_of(*sentences()))
    words = lexicon(spark, "alegre", "humorado")
    found = {(r.original_line_id, r.n_matches) for r in pt.prefilter_with_lexicon(segments, [pt.ARTICLE], words).collect()}
    plain = pt.find_matches(segments, [pt.ARTICLE], words, filtered=False)
    want = {}
    for r in plain.collect():
        want[r.original_line_id] = want.get(r.original_line_id, 0) + 1
    assert found == set(want.items()) and found
