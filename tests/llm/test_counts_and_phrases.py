"""Token counts, spelling variants and collocations against plain Python."""

import random

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from brute import collocations_by_hand, spelling_by_hand
from cases import awkward, awkward_rows, empty
from likeness.llm import collocations, spelling, token_counts

BPE = public_tokenizers.path("byte_bpe_50k.json")


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def doc_dicts(rows):
    return [{"doc_id": r[0], "text": r[1], "lang": r[2]} for r in rows]


def test_token_counts_equal_the_library_and_reuse_the_cache(spark, tmp_path):
    rows = awkward_rows() + [(20, "a <|endoftext|> b", "en", "a", 1, 1, "c", None, "r")]
    docs = spark.createDataFrame(rows, awkward(spark).schema)
    cache = str(tmp_path / "cache")
    tok = Tokenizer.from_file(BPE)
    want = [
        (i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids))
        for i, t, *_ in rows
    ]
    first = token_counts.count_tokens(docs, BPE, cache).collect()
    got = [(r.doc_id, r.n_bytes, r.n_tokens) for r in first]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert all(r.over_limit == (r.n_tokens > 1024) for r in first)
    assert any(r.over_limit for r in first)  # the 60,000-word text
    stored = spark.read.parquet(cache).count()
    assert stored == len({t or "" for _, t, *_ in rows})
    again = token_counts.count_tokens(docs, BPE, cache).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in again if r.doc_id is not None) == sorted(
        (r.doc_id, r.n_tokens) for r in first if r.doc_id is not None
    )
    assert spark.read.parquet(cache).count() == stored  # nothing encoded twice


def test_token_counts_of_an_empty_table(spark, tmp_path):
    assert token_counts.count_tokens(empty(spark), BPE, str(tmp_path / "c")).count() == 0


def variant_docs(seed=7):
    rng = random.Random(seed)
    stems = ["categorisation", "colourful", "neighbourhood", "organisation", "Realisation", "théâtrale"]
    docs = []
    for i in range(400):
        words = []
        for _ in range(12):
            w = rng.choice(stems)
            if rng.random() < 0.15:
                j = rng.randrange(len(w))
                w = w[:j] + rng.choice("aeiouxé") + w[j + 1 :] if rng.random() < 0.5 else w[:j] + w[j + 1 :]
            words.append(w)
        docs.append((i if i % 37 else None, " ".join(words) + "."))
    # A chain of forms: colorfulnex -> colorfulnes -> colorfulness.
    chain = ["colorfulness"] * 300 + ["colorfulnes"] * 25 + ["colorfulnex"] * 2
    docs += [(1000 + i, w) for i, w in enumerate(chain)]
    return docs


def test_spelling_variants_equal_brute_force(spark):
    rows = variant_docs() + [(r[0], r[1]) for r in awkward_rows()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(
        ((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.group_variants(docs).collect()),
        key=str,
    )
    want = sorted(spelling_by_hand([{"doc_id": i, "text": t} for i, t in rows]), key=str)
    assert got == want
    assert any(f for _, f, *_ in got)  # some words have a form
    assert any(root != f for _, f, root, *_ in got if f)  # and some a longer chain or none


def test_spelling_variants_of_an_empty_table(spark):
    assert spelling.group_variants(empty(spark)).count() == 0


def phrase_docs(seed=3):
    rng = random.Random(seed)
    vocab = ["new", "york", "city", "of", "the", "Big", "apple", "x\x0bq", "pie", "é"]
    docs = []
    for i in range(300):
        lang = rng.choice(["en", "fr", None])
        words = [rng.choice(vocab) for _ in range(rng.randrange(0, 25))]
        if rng.random() < 0.5:
            words[0:0] = ["new", "york", "city"]
        text = " ".join(words)
        if rng.random() < 0.3:
            text = text.replace(" of ", ", of\t")
        docs.append((i, text, lang))
    return docs


def test_collocations_equal_brute_force(spark):
    rows = phrase_docs() + [(r[0], r[1], r[2]) for r in awkward_rows()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = sorted(tuple(r) for r in collocations.mine(docs).collect())
    want = sorted(collocations_by_hand(doc_dicts(rows)))
    assert got == want
    assert len(got) > 10


def test_collocations_cut_at_top_and_keep_ties_in_order(spark):
    rows = phrase_docs(5)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = sorted(tuple(r) for r in collocations.mine(docs, top=3).collect())
    assert got == sorted(collocations_by_hand(doc_dicts(rows), top=3))


def test_collocations_of_an_empty_table_and_clashing_columns(spark):
    assert collocations.mine(empty(spark)).count() == 0
    clashing = awkward(spark).withColumnRenamed("digest", "phrase").withColumnRenamed("chunk", "gid")
    assert collocations.mine(clashing).count() >= 0


def test_every_order_is_summed_from_one_shuffle_of_windows(spark):
    docs = spark.createDataFrame([(1, "a b c. d e", "en")], "doc_id long, text string, lang string")
    counted = collocations.counts(collocations.windows(docs))
    got = {(r.order, r.phrase): r.f for r in counted.collect()}
    assert got[0, ""] == 5 and got[2, "d e"] == 1 and got[3, "a b c"] == 1 and len(got) == 10
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan  # no row per word and order
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("Generate inline") <= 1


def test_long_windows_are_counted_where_their_parts_are_frequent(spark):
    rows = phrase_docs(8) + [(1000 + i, f"rare{i} new york, york city\tÉa{i}!b  A a", "en") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    every = collocations.counts(collocations.windows(docs)).collect()
    often = {(r.lang, r.phrase) for r in every if r.order == 2 and r.f >= collocations.MIN_COUNT}
    frequent = spark.createDataFrame(sorted(often), "lang string, phrase string")
    kept = collocations.may_be_frequent(collocations.windows(docs, whole=True), frequent).collect()
    threes = [r for r in every if r.order == 3]
    inside = lambda lang, p: all((lang, q) in often for q in (p.rsplit(" ", 1)[0], p.split(" ", 1)[1]))
    assert len(kept) == sum(r.f for r in threes if inside(r.lang, r.phrase)) < sum(r.f for r in threes) - 700
    got = {(r.lang, r.order, r.phrase): r.f for r in collocations.frequent_phrases(docs).collect()}
    assert got == {(r.lang, r.order, r.phrase): r.f for r in every if r.order == 0 or r.f >= collocations.MIN_COUNT}


def test_a_long_word_is_read_once(spark):
    docs = spark.createDataFrame([(1, "z" * 1_000_000 + " b", "en")], "doc_id long, text string, lang string")
    assert collocations.windows(docs, whole=True).count() == 0
    assert [len(r.words) for r in collocations.windows(docs).collect()] == [1_000_002, 1]


def test_word_lists_are_by_length_and_position(spark):
    # Words of one rare gram each in a list of their own length and place.
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefgh") for _ in range(n)) for n in (9, 12, 15, 30, 60) for _ in range(20)]
    near = [w[:i] + c + w[i + k :] for w in words for i in (0, len(w) // 2, len(w) - 1) for c in ("x", "") for k in (0, 1)]
    vocab = spark.createDataFrame([(w, 2) for w in {*words, *near}], "word string, n long")
    frequent = spelling.frequent_grams(vocab)
    assert 0 < len(frequent) <= 1 / spelling.PRUNE_SHARE
    described = spelling.decompose(vocab, frequent)
    assert described.filter(f"tau >= {spelling.MIN_TAU}").count() > 100
    pairs = {tuple(r) for r in spelling.near_pairs(vocab).collect()}
    rows = {r[0] for r in vocab.collect()}
    by_hand = set()
    for w in rows:
        for i in range(len(w) + 1):
            for c in ["", *"abcdefghx"]:
                for v in (w[:i] + c + w[i:], w[:i] + c + w[i + 1 :]):
                    if v in rows and v != w:
                        by_hand |= {(v, w), (w, v)}
    assert pairs == by_hand


def test_words_of_a_list_share_runs_of_grams_and_every_pair_does(spark):
    rng = random.Random(4)
    stems = ["".join(rng.choice("abcdefgh") for _ in range(n)) for n in (12, 15, 16, 31) for _ in range(30)]
    near = [w[:i] + c + w[i + k :] for w in stems for i in (0, 3, len(w) // 2, len(w) - 1, len(w)) for c in ("x", "") for k in (0, 1)]
    # Words that share their rarest grams at the same places, but no run of them.
    alike = [p + "zqz" + q for p in stems[:30] for q in stems[30:40]]
    vocab = spark.createDataFrame([(w, 2) for w in {*stems, *near, *alike}], "word string, n long")
    size = F.char_length("word")
    listed = (
        spelling.decompose(vocab, spelling.frequent_grams(vocab))
        .filter(f"tau >= {spelling.MIN_TAU}")
        .select("word", spelling._runs(F.col("grams"), size).alias("runs"))
    )
    runs = {r.word: set(r.runs) for r in listed.collect()}
    assert all(len(r) == spelling.MIN_TAU + 1 for r in runs.values())
    pairs = [(r.a, r.b) for r in spelling.near_pairs(vocab).collect()]
    both = [(a, b) for a, b in pairs if a in runs and b in runs]
    assert len(both) > 500 and all(runs[a] & runs[b] for a, b in both)
    met = sum(len(runs[a] & runs[b]) > 0 for a in runs for b in runs if a < b)
    assert met < 6 * len(pairs)


def test_only_moving_words_are_followed(spark):
    # Chains of several lengths, a near word below the factor, words of no near word.
    texts = ["abcdefghij"] * 3000 + ["abcdefghi"] * 290 + ["abcdefgh"] * 28 + ["abcdefg"] * 2
    texts += ["abcdefgx"] * 5 + ["klmnopqrs"] * 4 + ["tuvwxyzabc"] * 30 + ["tuvwxyzab"] * 3
    rows = [(None, t) for t in texts] + [(i, "ÀBCDEFGÉ abc\tK" + "lmnopqrsT") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.group_variants(docs).collect()]
    want = spelling_by_hand([{"doc_id": i, "text": t} for i, t in rows])
    assert sorted(got, key=str) == sorted(want, key=str)
    assert any(form not in (None, root) for _, form, root, *_ in got)
