"""Pieces, surrogates, nearest neighbours, toxicity and HTML."""

import html
import math
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cases import DOCS, awkward, awkward_rows, docs_of, empty
from likeness.llm import ann, html_extract, pieces, pii, queries, toxicity
from likeness.llm.tables import table

MODEL = queries.MODEL_FILE
SF = "/root/testdata/sf0.01"

needs_model = pytest.mark.skipif(not Path(MODEL).is_file(), reason="no tokenizer files")
needs_data = pytest.mark.skipif(not Path(SF).is_dir(), reason="no driver tables")


# ---- pieces ----------------------------------------------------------------------


@needs_model
def test_pieces_round_trip(spark):
    docs = awkward(spark)
    encoded = pieces.encode(docs, MODEL, out="ids")
    assert encoded.columns == [*docs.columns, "ids"]
    back = encoded.withColumn("back", pieces.decode(F.col("ids"), MODEL)).collect()
    assert len(back) == len(awkward_rows())
    assert all(r.back == r.text for r in back)
    assert all((r.ids is None) == (r.text is None) for r in back)
    assert all(r.ids == [] for r in back if r.text == "")
    assert pieces.encode(empty(spark), MODEL).count() == 0


@needs_model
def test_pieces_do_not_depend_on_partitions_or_blocks(spark, monkeypatch):
    docs = docs_of(spark, [f"some words  of\ntext number {i} " * 9 for i in range(40)])
    one = {r.doc_id: r.pieces for r in pieces.encode(docs.coalesce(1), MODEL).collect()}
    many = {r.doc_id: r.pieces for r in pieces.encode(docs.repartition(7), MODEL).collect()}
    assert one == many
    vocab = pieces.vocabulary(MODEL)
    texts = pa.array([r.text for r in docs.orderBy("doc_id").collect()])
    seeds = np.arange(40, dtype=np.uint64)
    whole = pieces.encode_batch(texts, seeds, vocab)
    assert whole == pieces.encode_batch(texts, seeds, vocab, block=11)
    assert whole != pieces.encode_batch(texts, seeds + np.uint64(1), vocab)


def all_segmentations(word, vocab, names):
    found = {}

    def go(at, ids, weight):
        if at == len(word):
            found[tuple(ids)] = math.exp(weight)
        for end in range(at + 1, len(word) + 1):
            if word[at:end] in names:
                piece = names[word[at:end]]
                go(end, [*ids, piece], weight + vocab.weight[piece])

    go(0, [], 0.0)
    total = sum(found.values())
    return {ids: weight / total for ids, weight in found.items()}


@needs_model
@pytest.mark.parametrize("unit", [" thane", "   ab", "ñandú"])
def test_sampled_pieces_follow_the_lattice(unit):
    vocab = pieces.vocabulary(MODEL)
    plain = {i for i in vocab.piece.tolist() if i >= 0}
    names = {vocab.bytes[i].decode().replace(" ", pieces.SPACE): i for i in plain}
    want = all_segmentations(unit.replace(" ", pieces.SPACE), vocab, names)
    n = 40_000
    seeds = pieces._mixed(np.arange(n, dtype=np.uint64))
    tokens, counts = pieces.sample_block(pa.array([unit] * n, pa.large_string()), seeds, vocab)
    ends = np.cumsum(counts)
    got = Counter(tuple(tokens[b - c : b].tolist()) for b, c in zip(ends, counts, strict=True))
    assert set(got) <= set(want)
    for ids, share in want.items():
        assert abs(got[ids] / n - share) < 5 * math.sqrt(share * (1 - share) / n) + 1e-4


# ---- surrogates ------------------------------------------------------------------

PRIVATE = [
    "Mail bob.smith92@mail8.example.com or BOB.SMITH92@MAIL8.EXAMPLE.COM.",
    "bob.smith92@mail8.example.com again, +1 (407) 555-7710, then +1 407 555 7710.",
    "Card 4111 1111 1111 1111, account 4466865973536603, host 192.168.1.7 and 97.51.17.173",
    'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" and Mr. John Smith, Ms SMITH, г-н Иванов',
    "Nothing here: version 1.2.3.4.5, 2020-01-02, 12345, a = b, x@y, M. is a letter.",
]


def test_surrogates_keep_type_and_identity(spark):
    docs = docs_of(spark, PRIVATE)
    out = {r.doc_id: r for r in pii.replace_entities(docs).collect()}
    texts = {i: r.text for i, r in out.items()}
    assert texts[4] == PRIVATE[4] and out[4].n_entities == 0
    for value in ("smith92", "SMITH", "555-7710", "5557710", "4111 1111", "4466865973536603",
                  "192.168.1.7", "97.51.17.173", "04dbebab", "John", "Smith", "Иванов"):
        assert not any(value in texts[i] for i in range(4)), value
    mails = re.findall(r"[\w.]+@[\w.]+\w", " ".join(texts[i] for i in sorted(texts)))
    assert len({m.lower() for m in mails[:3]}) == 1 and mails[1].isupper()
    phones = re.findall(r"\+1[ ()\d-]+\d", texts[1])
    assert len({re.sub(r"\D", "", p) for p in phones}) == 1 and "(" in phones[0]
    card = re.search(r"Card ([\d ]{19}),", texts[2])[1]
    assert pii._luhn(card.replace(" ", "")) == 0
    assert re.search(r"host 10\.", texts[2])
    first, shouted = re.search(r"Mr\. \w+ (\w+), Ms (\w+),", texts[3]).groups()
    assert shouted == first.upper()
    assert re.search(r"г-н [А-Я][а-я]+", texts[3])
    again = {r.doc_id: r.text for r in pii.replace_entities(docs.repartition(4)).collect()}
    assert again == texts
    other = {r.doc_id: r.text for r in pii.replace_entities(docs, key="k2").collect()}
    assert all(other[i] != texts[i] for i in range(4))


def test_colliding_draws_are_drawn_again(spark, monkeypatch):
    # Few given names for many entities: plain draws must collide.
    found = spark.range(300).select(
        F.lit("given_f").alias("kind"), F.concat(F.lit("name"), "id").alias("value")
    )
    found = found.unionByName(
        spark.createDataFrame([("given_f", n.lower()) for n in ("Alice", "Bella")], "kind string, value string")
    )
    given = pii.assign(found).collect()
    assert len(given) == 302
    assert len({r.surrogate for r in given}) == 302
    assert not {r.surrogate for r in given} & {r.value for r in given}


def test_surrogates_of_awkward_rows(spark):
    docs = awkward(spark)
    out = pii.replace_entities(docs)
    assert out.columns == [*docs.columns, "n_entities"]
    got = Counter(map(tuple, out.drop("n_entities").collect()))
    assert got == Counter(map(tuple, docs.collect()))
    assert pii.replace_entities(empty(spark)).count() == 0


# ---- nearest neighbours ----------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, code long, v string"


def nearest_by_hand(rows, k):
    ok = [
        (i, np.array(v, float))
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    width = len(min(ok, key=lambda r: r[0])[1])
    ok = [(i, v) for i, v in ok if len(v) == width]
    out = {}
    for q, a in ok:
        if q % 50 == 0:
            scored = {}
            for i, b in ok:
                if i != q:
                    scored[i] = round(float(a @ b / math.sqrt((a @ a) * (b @ b))), 12)
            out[q] = sorted(scored.items(), key=lambda x: (-x[1], x[0]))[:k]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 12)))
    return out


def test_few_and_odd_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).astype("f").tolist()) for i in range(60)]
    rows += [(100, rows[3][1]), (101, rows[3][1]), (102, [2 * x for x in rows[3][1]])]
    rows += [(200 + i, rows[7][1]) for i in range(20)]
    rows += [(150, None), (250, [0.0] * 6), (300, [1.0, None, 0.0, 0.0, 0.0, 0.0])]
    rows += [(350, [float("nan")] * 6), (400, [float("inf")] + [0.0] * 5), (450, [1.0]), (None, rows[0][1])]
    rows += [rows[50], rows[50]]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], VECTORS)
    got = found(ann.search(df, F.col("vec_id") % 50 == 0))
    want = nearest_by_hand(dict.fromkeys((i, tuple(v) if v else v) for i, v in rows), 5)
    assert {q: len(x) for q, x in got.items()} == {q: 5 for q in want}
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    assert got[200] == want[200]  # twenty equal vectors


def test_fewer_candidates_than_asked(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 1, ""), (1, [0.0, 1.0], 1, ""), (2, [1.0, 1.0], 1, "")], VECTORS)
    got = found(ann.search(df, F.col("vec_id") % 50 == 0))
    assert got == {0: [(2, round(math.sqrt(0.5), 12)), (1, 0.0)]}
    assert ann.search(spark.createDataFrame([], VECTORS), F.col("vec_id") % 50 == 0).count() == 0


@needs_data
def test_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    got, want = found(queries.op7_nearest_neighbours(spark, SF)), nearest_by_hand(rows, 5)
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    for q, pairs in got.items():
        assert pairs == sorted(pairs, key=lambda x: (-x[1], x[0]))


def test_codes_within_the_radius_share_a_probed_byte(spark):
    rng = np.random.default_rng(1)
    sample = rng.normal(size=(500, 32))
    model = ann.fit_model(sample, 5)
    codes = ann._codes(ann._unit(sample), model.axes)
    away = np.bitwise_count(codes[:, None] ^ codes[None, :])
    parts = np.bitwise_count(codes.view(np.uint8).reshape(-1, 1, 8) ^ codes.view(np.uint8).reshape(1, -1, 8))
    near = away <= model.radius
    assert (parts.min(axis=2)[near] <= model.radius // ann.PARTS).all()


# ---- toxicity --------------------------------------------------------------------


@needs_data
def test_held_out_accuracy(spark):
    # All folds of the larger table: recall and precision on rows whose labels were not read.
    folder = "/root/testdata/sf0.1" if Path("/root/testdata/sf0.1").is_dir() else SF
    scored = queries.op8_toxicity(spark, folder).toPandas()
    labels = table(spark, folder, "labels").toPandas().drop_duplicates("doc_id")
    both = scored.merge(labels, on="doc_id")
    both = both[both.held_out]
    toxic, called = both.toxic == 1, both.predicted == 1
    assert (toxic & called).sum() >= 0.85 * toxic.sum()
    assert (~toxic & called).sum() <= 0.02 * (~toxic).sum()
    assert scored.score.between(0, 1).all() and len(scored) == scored.doc_id.nunique()


def test_toxicity_without_usable_labels(spark):
    docs = awkward(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    kept = toxicity.reject_toxic(docs, none)
    assert kept.columns == docs.columns
    assert Counter(map(tuple, kept.collect())) == Counter(map(tuple, docs.collect()))
    one = spark.createDataFrame([(1, 0), (2, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score_texts(docs, one).collect()} == {0.0}
    assert toxicity.score_texts(empty(spark), none).count() == 0


def test_features_are_bounded_by_the_text():
    weights = toxicity._Weights({"vequ*": 5.0, "loser": 4.0})
    names = dict(zip(toxicity.FEATURES, toxicity.features("YOU vequax! loser ... st*pid", weights), strict=True))
    assert names["learned_count"] == pytest.approx(math.log1p(2))
    assert names["best_weight"] == 5.0
    assert names["near_second_person"] > 0 and names["obfuscated"] > 0
    assert len(toxicity.features(None, weights)) == len(toxicity.FEATURES)


# ---- HTML ------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head>
<body><header><h1>Site</h1></header><nav><ul><li><a href="/a>b">A, menu.</a></ul></nav>
<div class="cookie-notice">We use cookies, really.</div><!-- <p>no</p> --><div class="ad">Buy, now.</div>
<main><article><h1>Head &amp; tail</h1><p><b>First   part,<br><p>Second &lt;b&gt; part; it goes on,
and on.<p>Third<script>x()</script> one.</p><ul><li>item one<li>item two</ul></article>
<section id="comments"><p>I, too, have something to say about this. It is long, and has marks!</p></section>
<form><label>Mail</label><input><button>Send</button></form></main>
<aside>Related, things.</aside><footer>&copy; all of it.</footer></body></html>"""


def test_main_text():
    assert html_extract.main_text(PAGE) == (
        "Head & tail First part, Second <b> part; it goes on, and on. Third one. item one item two"
    )


def test_article_without_its_element():
    body = "".join(f"<p>Sentence {i}, of some length, which goes on for a while.</p>" for i in range(5))
    page = f"<div class=top><a href=x>Home</a> <a>News</a></div><div id=c1>{body}</div><div><a>One</a></div>"
    assert html_extract.main_text(page) == " ".join(
        f"Sentence {i}, of some length, which goes on for a while." for i in range(5)
    )


def test_odd_pages(spark):
    deep = "<div>" * 3000 + "deep text, here." + "</div>" * 3000
    odd = {
        None: "", "": "", "plain": "plain", "<p>": "", "a < b & c": "a < b & c", "<!-- open": "",
        "<script>open": "", "</p></div>x": "x", "<p title='a>b'>y": "y", "<p title='a>z": "z", deep: "deep text, here.",
    }
    rows = [(i, None, page, "clash") for i, page in enumerate(odd)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    assert got == dict(enumerate(odd.values()))
    assert html_extract.extract(df.limit(0)).count() == 0


@needs_data
def test_articles_of_the_pages(spark):
    got = {r.page_id: r.text for r in queries.op9_html_extraction(spark, SF).collect()}
    for row in table(spark, SF, "pages").collect():
        inside = re.search(r"<article>(.*)</article>", row.html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1|br)>", re.sub(r"</?b>", "", inside))
        blocks = [re.sub(r"\s+", " ", html.unescape(b)).strip() for b in blocks]
        assert got[row.page_id] == " ".join(filter(None, blocks))


def test_schema_of_the_cases():
    assert DOCS.count(",") + 1 == len(awkward_rows()[0])
