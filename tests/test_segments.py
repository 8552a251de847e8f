from likeness.operators.segments import bronze_segments, bronze_segments_with, source_files


def _rows(df):
    return [tuple(r) for r in df.orderBy("original_line_id", "segment_id").collect()]


def test_splits_at_marker_and_numbers_densely(lines_of):
    df = bronze_segments(lines_of("  Primeiro   trecho <END>   <END> Segundo trecho  ", start=7))
    got = [(r.original_line_id, r.segment_id, r.text_normalized) for r in df.collect()]
    assert got == [(7, 0, "Primeiro trecho"), (7, 1, "Segundo trecho")]


def test_keeps_original_and_makes_search_copy(lines_of):
    row = bronze_segments(lines_of("  Água   FRIA como UMA Pedra  ")).first()
    assert row.text_original == "Água   FRIA como UMA Pedra"
    assert row.text_normalized == "Água FRIA como UMA Pedra"
    assert row.match_text == "água fria como uma pedra"


def test_unicode_whitespace(lines_of):
    row = bronze_segments(lines_of("　a\tb c\x1cd ")).first()
    assert row.text_normalized == "a b c d"
    assert row.text_original == "a\tb c\x1cd"


def test_empty_segments_give_no_rows(lines_of):
    assert bronze_segments(lines_of("<END><END>", "", " \t ")).count() == 0


def test_literal_filter_equals_filter_on_match_text(lines_of):
    lines = lines_of("nada <END> frio COMO gelo <END> x", "Como?", "que NEM um robô", "cOmO x")
    full = bronze_segments(lines)
    wanted = full.where("contains(match_text, 'como') or contains(match_text, 'nem')")
    assert _rows(bronze_segments_with(lines, ("como", "nem"))) == _rows(wanted)


def test_source_files(lines_of):
    lines = lines_of("a", source="b.txt").union(lines_of("b", "c", source="a.txt"))
    assert [r[0] for r in source_files(bronze_segments(lines)).collect()] == ["a.txt", "b.txt"]
