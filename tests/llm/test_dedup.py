"""Exact dedup, substring dedup and SimHash against brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from cases import awkward, awkward_rows, docs_of, empty
from likeness.llm import components, exact_dedup, simhash, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def exact_by_hand(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(text or "", []).append(i)
    out = Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        out.update((i, keep, len(ids), i == keep, sha) for i in ids)
    return out


def test_exact_groups(spark):
    got = Counter(map(tuple, exact_dedup.exact_groups(awkward(spark)).collect()))
    assert got == exact_by_hand([(r[0], r[1]) for r in awkward_rows()])


def test_digest_collisions_do_not_merge_texts(spark):
    texts = [f"text {i % 40}" for i in range(200)]
    docs = docs_of(spark, texts)
    weak = exact_dedup.exact_groups(
        docs, salts=3, digest=lambda t: F.substring(F.md5(t.cast("binary")), 1, 1)
    )
    assert Counter(map(tuple, weak.collect())) == exact_by_hand(list(enumerate(texts)))


def test_deduplicate_keeps_rows_whole(spark):
    docs = awkward(spark)
    kept = exact_dedup.deduplicate(docs)
    assert kept.schema.names == docs.schema.names
    rows = kept.collect()
    assert len(rows) == len({r[1] or "" for r in awkward_rows()})
    assert all(tuple(r) in set(awkward_rows()) for r in rows)
    by_text = {}
    for r in awkward_rows():
        by_text.setdefault(r[1] or "", []).append(-1 if r[0] is None else r[0])
    assert all(max(by_text[r.text or ""]) == (-1 if r.doc_id is None else r.doc_id) for r in rows)


def test_empty_tables(spark):
    none = empty(spark)
    assert exact_dedup.exact_groups(none).count() == 0
    assert exact_dedup.deduplicate(none).count() == 0
    assert substring_dedup.remove_repeats(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.keep_one(none).count() == 0


def substring_by_hand(rows, window):
    split = [(i, WORD.findall(t or "")) for i, t in rows]
    seen = Counter(
        tuple(w[k : k + window]) for _, w in split for k in range(len(w) - window + 1)
    )
    out = Counter()
    for i, w in split:
        cut = [False] * len(w)
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                cut[k : k + window] = [True] * window
        kept = " ".join(x for x, c in zip(w, cut, strict=True) if not c)
        out[i, len(w), sum(cut), kept] += 1
    return out


@pytest.mark.parametrize("window", [1, 3, 35])
def test_substring_removal(spark, window):
    found = substring_dedup.remove_repeats(awkward(spark), window=window).collect()
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in found)
    assert got == substring_by_hand([(r[0], r[1]) for r in awkward_rows()], window)
    for r in found:
        spans = [(s.start, s.end) for s in r.removed]
        assert sum(b - a for a, b in spans) == r.n_removed
        assert all(b < c for (_, b), (c, _) in zip(spans, spans[1:], strict=False)), "maximal"


def test_substring_removal_over_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BLOCK", 50)
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(90))) for _ in range(60)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").toArrow()
    hashes, _, _ = substring_dedup._hashes(rows.column("text"), 6)
    words = [t.split() for t in texts]
    windows = [tuple(w[i : i + 6]) for w in words for i in range(len(w) - 5)]
    assert len(hashes) == len(windows)
    assert len(set(zip(hashes.tolist(), windows, strict=True))) == len(set(windows))
    assert len(set(hashes.tolist())) == len(set(windows))


def fingerprint_by_hand(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes_by_hand(pairs):
    """Smallest id reachable over fingerprints at most three bits apart."""
    fps = sorted({f for _, f in pairs})
    label = {f: f for f in fps}

    def root(f):
        while label[f] != f:
            f = label[f]
        return f

    for n, a in enumerate(fps):
        for b in fps[n + 1 :]:
            if (a ^ b).bit_count() <= 3:
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    smallest = {}
    for i, f in pairs:
        if i is not None:
            smallest[root(f)] = min(i, smallest.get(root(f), i))
    return Counter((i, f, smallest.get(root(f))) for i, f in pairs)


def unsigned(fp):
    return fp & (2**64 - 1)


def test_simhash_classes(spark):
    got = simhash.near_duplicates(awkward(spark)).collect()
    want = classes_by_hand([(r[0], fingerprint_by_hand(r[1])) for r in awkward_rows()])
    assert Counter((r.doc_id, unsigned(r.fp), r.component_id) for r in got) == want


@pytest.mark.parametrize("max_list", [1, 2, 4096])
def test_links_of_crowded_fingerprints(spark, max_list):
    rng = random.Random(max_list)
    fps = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(25):
            fps.add(base)
            base ^= sum(1 << rng.randrange(64) for _ in range(rng.randrange(1, 4)))
    fps |= {rng.getrandbits(64) for _ in range(200)}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    links = simhash.near_links(spark.createDataFrame(signed, "fp long").repartition(3), max_list)
    rows = links.collect()
    assert all(unsigned(r.a ^ r.b).bit_count() <= 3 for r in rows)
    assert len(rows) <= 56 * 10 * len(fps)
    label = {f: f for f in fps}

    def root(f):
        while label[f] != f:
            f = label[f]
        return f

    for r in rows:
        x, y = root(unsigned(r.a)), root(unsigned(r.b))
        label[max(x, y)] = min(x, y)
    got = Counter((f, f, root(f)) for f in fps)
    assert got == classes_by_hand([(f, f) for f in fps])


def test_one_document_of_each_class_stays(spark):
    base = " ".join(f"word{i}" for i in range(300))
    docs = docs_of(spark, [base, base + " x", base, "something else", None, ""])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 3, 4]


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(1, 60)]
    star = [(1000, 1000 + i) for i in range(1, 80)]
    loops = [(5000, 5000), (61, 62), (62, 61)]
    pairs = spark.createDataFrame(chain + star + loops, "a long, b long")
    labels = {r.node: r.label for r in components.component_labels(pairs).collect()}
    want = {i: 1 for i in range(2, 61)} | {1000 + i: 1000 for i in range(1, 80)} | {62: 61}
    assert labels == want
