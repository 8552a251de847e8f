"""The pipeline's near-copy stage against brute force over planted near copies."""

import random
from collections import Counter

import corpus_pipeline
from cases import awkward, docs_of, empty
from likeness.llm import near_copies


def shingle_set(text, size=5):
    words = (text or "").lower().split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def planted(seed=1):
    """Texts, and copies of them with some words changed, about half of them at 0.8 or more."""
    rng = random.Random(seed)
    texts = []
    for n in (3, 5, 8, 30, 60, 120, 240, 500, 900):
        for _ in range(6):
            base = [f"w{rng.randrange(4000)}" for _ in range(n)]
            texts.append(" ".join(base))
            for _ in range(3):
                copy = list(base)
                for _ in range(rng.randrange(1, max(2, n // 25))):
                    copy[rng.randrange(n)] = f"x{rng.randrange(4000)}"
                texts.append(" ".join(copy))
            texts.append(" ".join([*base, "the", "end"]))
    return texts


def first_of_class(texts):
    sets = [shingle_set(t) for t in texts]
    label = list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    links = 0
    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                links += 1
                x, y = root(i), root(j)
                label[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(texts))], links


def test_planted_near_copies(spark):
    texts = [*planted(), None, "", " "]
    classes, links = first_of_class(texts)
    assert links > 100
    got = near_copies.near_duplicates(docs_of(spark, texts)).collect()
    assert Counter(map(tuple, got)) == Counter(enumerate(classes))
    kept = corpus_pipeline.drop_near_copies(spark, docs_of(spark, texts), "").collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(classes))


def test_lists_where_a_candidate_fails(spark):
    # A chain: each text is close to the next one only, and all share lists.
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[i * 20 : i * 20 + 200]) for i in range(10)]
    classes, _ = first_of_class(texts)
    assert set(classes) == {0}
    got = near_copies.near_duplicates(docs_of(spark, texts)).collect()
    assert {r.component_id for r in got} == {0}


def test_awkward_and_empty_tables(spark):
    docs = awkward(spark)
    kept = near_copies.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {1, 3, 6, 8, 9, 10, None}
    assert near_copies.keep_one(empty(spark)).count() == 0
