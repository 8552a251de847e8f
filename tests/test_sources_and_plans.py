"""Text files, lexicon files, stored tables and the end-to-end plan."""

import gzip
import json
from pathlib import Path

import pytest

from likeness import schemas
from likeness.operators import export as xp
from likeness.operators import extract as ex
from likeness.operators import patterns as pt
from likeness.operators.segments import bronze_segments
from likeness.plans import full_run
from likeness.plans import gold as gp
from likeness.plans import variants as vp
from likeness.session import shared_folder, staged
from likeness.sources import lexicon_files as lf
from likeness.sources import raw_text as rt
from likeness.sources import tables as tb
from registry.corpus import SENTENCES


def _gzip(path, lines):
    with gzip.open(path, "wt", encoding="utf-8") as file:
        file.write("\n".join(lines) + "\n")


@pytest.fixture
def shards(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for n in range(1, 4):
        _gzip(folder / f"shard-{n}.txt.gz", [f"s{n} l{i}" for i in range(5 * n)])
    return folder


def _ids(df):
    rows = df.collect()
    return {(r.source_file.rsplit("/", 1)[-1], r.original_line_id): r.raw_text for r in rows}


def test_line_numbers_per_file_do_not_depend_on_the_file_set(spark, shards):
    everything = _ids(rt.read_lines(spark, f"{shards}/*.txt.gz"))
    assert len(everything) == 30
    assert all(text == f"s{name[6]} l{line}" for (name, line), text in everything.items())
    half = _ids(rt.read_lines(spark, f"{shards}/shard-[12].txt.gz", name_only=True))
    one = _ids(rt.read_lines(spark, f"{shards}/shard-2.txt.gz"))
    assert half.items() <= everything.items()
    assert one.items() <= everything.items()
    assert (len(half), len(one)) == (15, 10)


def test_line_numbers_over_several_blocks_of_one_file(spark, tmp_path):
    path = tmp_path / "plain.txt"
    path.write_text("".join(f"line {i}\n" for i in range(2000)), encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        scan = spark.read.text(str(path))
        assert scan.rdd.getNumPartitions() > 1
        rows = rt.read_lines(spark, str(path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == 2000
    assert all(r.raw_text == f"line {r.original_line_id}" for r in rows)


def test_shuffled_block_join_gives_the_same_lines(spark, shards):
    wanted = _ids(rt.read_lines(spark, f"{shards}/*.gz"))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        assert _ids(rt.read_lines(spark, f"{shards}/*.gz")) == wanted
    finally:
        spark.conf.set(threshold, old)


def test_scan_order_ids_are_unique(spark, shards):
    rows = rt.read_lines(spark, f"{shards}/*.gz", line_ids="scan_order").collect()
    assert len({r.original_line_id for r in rows}) == 30
    with pytest.raises(ValueError):
        rt.read_lines(spark, str(shards), line_ids="other")


def test_spreading_keeps_all_lines(spark, shards):
    lines = rt.read_lines(spark, f"{shards}/*.gz")
    spread = rt.spread_lines(lines, 6)
    assert spread.rdd.getNumPartitions() == 6
    assert _ids(spread) == _ids(lines)


def test_bronze_is_built_once_and_rebuilt_when_incomplete(spark, shards, tmp_path):
    path = str(tmp_path / "bronze")
    Path(path).mkdir()
    assert not tb.is_complete(spark, path)
    built = tb.load_or_build_bronze(spark, f"{shards}/*.gz", path)
    assert built.columns == schemas.columns(schemas.BRONZE)
    assert built.count() == 30
    _gzip(shards / "shard-9.txt.gz", ["new"])
    assert tb.load_or_build_bronze(spark, f"{shards}/*.gz", path).count() == 30


def test_staged_rows_live_in_the_shared_folder(spark, lines_of):
    df = bronze_segments(lines_of("a", "b"))
    stored = staged(df, "t")
    assert sorted(stored.collect()) == sorted(df.collect())
    assert stored.inputFiles()[0].startswith(f"file://{shared_folder(spark)}")


def test_lexicon_files(spark, tmp_path):
    quality, verbs = tmp_path / "quality.txt", tmp_path / "verbs.txt"
    quality.write_text("duro\n\nLeve\nduro\nvoa\n", encoding="utf-8")
    verbs.write_text("cair\ncai\ncaiu\n\n\nvoar\nvoa\nvoou\n \nder\ncai\n", encoding="utf-8")
    rows = {r.form: r for r in lf.read_lexicon(spark, str(quality), str(verbs)).collect()}
    assert set(rows) == {"duro", "leve", "cair", "cai", "caiu", "voar", "voa", "voou", "der"}
    assert (rows["leve"].lemma, rows["leve"].ground_source) == ("leve", "quality_reference")
    assert (rows["caiu"].lemma, rows["caiu"].ground_type) == ("cair", "salient_verb")
    assert rows["cai"].lemma == "cair"
    assert rows["voa"].ground_type == "quality_adjective"
    assert rows["voou"].ground_reference_path.endswith("verbs.txt")
    assert lf.read_lexicon(spark).count() == 135


def test_extraction_with_lexicon_files(spark, tmp_path, lines_of):
    verbs = tmp_path / "verbs.txt"
    verbs.write_text("nadar\nnada\nnadou\n", encoding="utf-8")
    lexicon = lf.read_lexicon(spark, verb_path=str(verbs))
    segments = bronze_segments(
        lines_of("Ele nadou como um peixe.", "Sentia-se forte como um touro.", "nada como gelo")
    )
    row = ex.labelled_candidates(segments, lexicon).collect()
    assert [(r.ground_lemma, r.vehicle_text) for r in row] == [("nadar", "peixe")]
    assert row[0].ground_reference_path.endswith("verbs.txt")
    assert ex.variant_candidates(segments, [pt.BARE.pattern_type], lexicon).count() == 0


def test_full_run_writes_every_output(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    _gzip(raw / "a.txt.gz", [f"{s} <END> {s}" for s in SENTENCES])
    root = str(tmp_path / "out")
    manifest = full_run.run(spark, f"{raw}/*.gz", root, generated_at="2026-05-17T00:00:00+00:00")
    at = full_run.Layout.below(root)
    gold = tb.read_gold(spark, at.gold)
    assert manifest["candidate_count"] == gold.count() > 0
    assert manifest["generated_at"] == "2026-05-17T00:00:00+00:00"
    export = {p.name for p in Path(at.export).iterdir()}
    assert export == set(gp.export_tables(xp.clean_candidates(gold)))
    assert len(export) == 9
    line = next(Path(at.export, "candidates.jsonl").glob("part-*")).read_text().splitlines()[0]
    assert list(json.loads(line)) == schemas.EXPORT_COLUMNS
    assert len(list(Path(at.reports).glob("como_article_*.csv"))) == 6
    examples = spark.read.option("header", True).csv(f"{at.reports}/como_article_examples.csv")
    assert examples.count() == gold.count()
    candidates = tb.read_variants(spark, vp.dataset_path(at.variants))
    names = {r[0] for r in candidates.select("pattern_type").distinct().collect()}
    assert names == set(pt.VARIANTS)
    accepted = tb.read_variants(spark, vp.accepted_path(at.variants))
    assert accepted.count() == ex.accepted(candidates).count()
    for name in pt.VARIANTS:
        folder = Path(vp.output_path(at.variant_reports, name))
        assert len(list(folder.iterdir())) >= 7
    comparison = spark.read.option("header", True).csv(f"{at.variant_reports}/comparison_table.csv")
    assert comparison.count() == 4
    strategy = spark.read.option("header", True).csv(f"{at.variant_reports}/dataset_strategy.csv")
    assert strategy.count() == 4
    assert len(list(Path(at.merged_reports).iterdir())) == 7
    merged = spark.read.parquet(at.merged)
    assert merged.columns == schemas.MERGED_COLUMNS


def test_full_run_with_a_lexicon_and_chosen_patterns(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    lines = [f"Era bem humorado como o pai {i}." for i in range(3)]
    heads = [chr(97 + i % 26) + chr(97 + i // 26) for i in range(600)]
    lines += [f"Era bem-humorado como uma pedra e forte como palavra{h}." for h in heads]
    _gzip(raw / "a.txt.gz", lines)
    rows = [(f, f, "quality_adjective", "own", "own") for f in ("bem humorado", "bem-humorado", "forte")]
    words = spark.createDataFrame(rows, schemas.LEXICON)
    root = str(tmp_path / "out")
    names = [pt.BARE.pattern_type, pt.BARE_V2.pattern_type]
    manifest = full_run.run(
        spark, f"{raw}/*.gz", root, lexicon=words, line_ids="scan_order", pattern_types=names, spread=True
    )
    assert manifest["candidate_count"] == 600
    at = full_run.Layout.below(root)
    gold = tb.read_gold(spark, at.gold)
    assert {r[0] for r in gold.select("ground_lemma").distinct().collect()} == {"bem-humorado"}
    candidates = tb.read_variants(spark, vp.dataset_path(at.variants))
    assert {r[0] for r in candidates.select("pattern_type").distinct().collect()} == set(names)

    def sampled(name):
        path = f"{vp.output_path(at.variant_reports, name)}/accepted_review_sample.csv"
        return spark.read.option("header", True).csv(path).count()

    assert (sampled(names[0]), sampled(names[1])) == (200, 500)
    # Rare matches are rebalanced: no file for each split of the corpus.
    assert len(list(Path(at.gold).glob("part-*"))) == 1


def test_gold_write_reports_row_counts(spark, tmp_path, lines_of):
    segments = bronze_segments(lines_of(*SENTENCES))
    specs = [pt.ARTICLE, pt.BARE]
    gold, seen = gp.write_gold(ex.match_phrases(segments, specs), str(tmp_path / "gold"))
    labelled = ex.labelled_candidates(segments)
    assert seen == {
        "match_rows": labelled.count(),
        "prefiltered_rows": pt.prefilter(segments, pt.ARTICLE).count(),
        "candidate_rows": gold.count(),
    }
    nothing = ex.match_phrases(bronze_segments(lines_of("nada")), specs)
    none, seen = gp.write_gold(nothing, str(tmp_path / "none"))
    assert none.count() == 0
    assert seen == {"match_rows": 0, "prefiltered_rows": 0, "candidate_rows": 0}


def test_dataset_paths():
    assert vp.dataset_path("r") == "r/candidates"
    assert vp.output_path("r", pt.BARE.pattern_type) == "r/bare_como_curated_ground"
    assert vp.dataset_path("r", pt.BARE.pattern_type).endswith(
        "/pattern_type=bare_como_curated_ground"
    )
    with pytest.raises(ValueError):
        vp.output_path("r", "other")
