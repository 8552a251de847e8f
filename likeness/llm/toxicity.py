"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Labels are read from the rows of the training folds only, in a bounded sample of
``MAX_ROWS`` labelled rows (the first by a hash of the id):

* a lexicon of words and word beginnings that mark toxic texts (document counts
  per label in Spark, smoothed log odds, at most ``MAX_TERMS`` terms),
* a gradient-boosted classifier on the dense features,
* an isotonic regression, on rows apart, from its output to a probability.

The features of the training rows come from two half lexicons, each learned on
the rows of the other half, so no model sees a row's label through another one;
scoring uses the lexicon of all rows.  Every text is scored whole: densities of
the fixed and the learned lexicon, hits close to second-person words, capitals,
punctuation and obfuscation rates, length.

Defined results: null and empty texts get the score of a text without words; with
no labelled row, or labels of one class only, every text gets the share of toxic
labels (0 without any); several labels of one id count as toxic if one of them
is; null labels and ids are left out of training and scored all the same; rows
keep their order of columns, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from likeness.llm.tables import filled, held

#: Labelled rows used at most for all fitting.
MAX_ROWS = 24_000
#: Learned terms at most, and the least support and log odds of one.
MAX_TERMS, MIN_DOCS, MIN_ODDS = 8_000, 4, 2.5
#: Lengths of word beginnings that can be terms.
STEMS = (3, 4, 5, 6)
TREES, DEPTH, SEED = 30, 3, 7
#: Score from which a text is rejected.
THRESHOLD = 0.3

#: General English insults, and second-person words of four languages.
INSULTS = frozenset(
    """
    arrogant bastard clown coward creep crap cretin dimwit disgusting dumb dumbass fool freak
    garbage idiot idiotic imbecile jerk liar loser lunatic moron moronic nasty pathetic pig rat
    retard scum scumbag shit shut sick stupid thug trash ugly useless vermin vile worthless
    """.split()
)
SECOND_PERSON = frozenset(
    """
    you your yours yourself u ur du dich dir dein deine deiner ihr euch sie tu toi te ton ta tes
    vous votre vos usted ustedes ti tus vosotros
    """.split()
)
NEAR = 6
_TOKEN = re.compile(r"[^\W_]+")
_OBFUSCATED = re.compile(r"[^\W\d_]+[@$*#!0-9]+[^\W\d_]+")
FEATURES = (
    "insult_density insult_count learned_density learned_count learned_weight best_weight "
    "near_second_person second_person_density capitals shouted exclaimed questioned "
    "punctuation obfuscated length"
).split()


def in_held_out(doc_id: Column) -> Column:
    """Whether a row is in the fold whose labels are never read."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def _terms(text: Column) -> Column:
    """The different words of a text, and the beginnings of its longer words."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), 0))
    stems = [
        F.transform(
            F.filter(words, lambda w, n=n: F.char_length(w) > n),
            lambda w, n=n: F.concat(F.substring(w, 1, n), F.lit("*")),
        )
        for n in STEMS
    ]
    return F.array_distinct(F.concat(words, *stems))


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Log odds of the terms that mark toxic rows; ``rows`` has ``text`` and ``label``."""
    totals = rows.agg(
        F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")
    ).first()
    if not totals.toxic or not totals.clean:
        return {}
    counts = (
        rows.select("label", F.explode(_terms(filled("text"))).alias("term"))
        .groupBy("term")
        .agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))
        .where(F.col("toxic") >= MIN_DOCS)
    )
    odds = F.log((F.col("toxic") + 0.5) / (totals.toxic + 1)) - F.log(
        (F.col("clean") + 0.5) / (totals.clean + 1)
    )
    found = (
        counts.select("term", odds.alias("odds"))
        .where(F.col("odds") >= MIN_ODDS)
        .orderBy(F.desc("odds"), "term")
        .limit(MAX_TERMS)
    )
    return {r.term: r.odds for r in found.collect()}  # MAX_TERMS rows at most


class _Weights(dict):
    """Weight of a word by the learned terms; remembers a bounded number of words."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> float:
        keys = [word, *[word[:n] + "*" for n in STEMS if len(word) > n]]
        weight = max((self.lexicon.get(k, 0.0) for k in keys), default=0.0)
        if len(self) > 50_000:
            self.clear()
        self[word] = weight
        return weight


def features(text: str | None, weights: _Weights) -> list[float]:
    """The dense features of one text, in the order of ``FEATURES``."""
    text = text or ""
    lowered = text.lower()
    words = _TOKEN.findall(lowered)
    counts = Counter(words)
    total = max(1, len(words))
    insults = sum(counts[w] for w in INSULTS if w in counts)
    marked = {w: weights[w] for w in counts if weights[w] > 0}
    hits = sum(counts[w] for w in marked)
    second = sum(counts[w] for w in SECOND_PERSON if w in counts)
    near = 0
    if (insults or hits) and second:
        addressed = [i for i, w in enumerate(words) if w in SECOND_PERSON]
        at = np.array(addressed)
        for i, w in enumerate(words):
            if w in marked or w in INSULTS:
                j = np.searchsorted(at, i)
                near += any(abs(addressed[k] - i) <= NEAR for k in (j - 1, j) if 0 <= k < len(at))
    capitals = sum(map(len, re.findall(r"[A-ZÀ-ÖØ-Þ]+", text)))
    size = max(1, len(text))
    return [
        insults / total,
        math.log1p(insults),
        hits / total,
        math.log1p(hits),
        sum(counts[w] * x for w, x in marked.items()) / total,
        max(marked.values(), default=0.0),
        near / max(1, hits + insults),
        second / total,
        capitals / size,
        len(re.findall(r"\b[A-ZÀ-ÖØ-Þ]{3,}\b", text)) / total,
        text.count("!") / total,
        text.count("?") / total,
        sum(map(text.count, ".,;:!?")) / size,
        len(_OBFUSCATED.findall(text)) / total,
        math.log1p(len(words)),
    ]


def _features_of(lexicon: dict[str, float]) -> Callable[[Column], Column]:
    @F.pandas_udf("array<double>")
    def run(texts: pd.Series) -> pd.Series:
        weights = _Weights(lexicon)
        return texts.map(lambda t: features(t, weights))

    return lambda text: array_to_vector(run(text))


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """``text, label, part`` of a bounded sample of labelled rows outside the held-out fold."""
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .where(~in_held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("double").alias("label"))
        .orderBy(F.xxhash64("doc_id", F.lit("sample")), "doc_id")
        .limit(max_rows)
    )
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(10))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    # The sample has at most ``max_rows`` rows of two numbers.
    return held(
        texts.join(F.broadcast(chosen), "doc_id").select("text", "label", part.alias("part"))
    )


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Callable:
    """A function from a text column and DataFrame to the DataFrame with a ``score``.

    ``docs`` has ``doc_id`` and ``text``, ``labels`` has ``doc_id`` and ``toxic``.
    """
    rows = training_rows(docs, labels, max_rows)
    halves = [rows.where(F.col("part") % 2 == n) for n in (0, 1)]
    crossed = [
        half.select(_features_of(learn_lexicon(other))(F.col("text")).alias("features"), "label", "part")
        for half, other in zip(halves, reversed(halves), strict=True)
    ]
    # Partitioning by content makes the trees' sums, and so reruns, the same.
    seen = held(crossed[0].unionByName(crossed[1]).repartition(4, "part"))
    vectors = _features_of(learn_lexicon(rows))
    trees, curve = seen.where("part < 8"), seen.where("part >= 8")
    per_part = {
        (r.late, r.label)
        for r in seen.groupBy((F.col("part") >= 8).alias("late"), "label").count().collect()
    }
    if not {(late, y) for late in (False, True) for y in (0.0, 1.0)} <= per_part:
        share = rows.agg(F.avg("label")).first()[0] or 0.0
        return lambda df, text: df.withColumn("score", F.lit(float(share)))
    forest = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, stepSize=0.2).fit(trees)

    def raw(df: DataFrame) -> DataFrame:
        made = forest.transform(df).withColumn("p", vector_to_array("probability")[1])
        return made.drop("rawPrediction", "probability", "prediction", "features")

    curve = raw(curve).select("label", "p")
    model = IsotonicRegression(featuresCol="p", labelCol="label").fit(curve)

    def score(df: DataFrame, text: Column) -> DataFrame:
        scored = model.transform(raw(df.withColumn("features", vectors(text))))
        bounded = F.least(F.greatest(F.col("prediction"), F.lit(0.0)), F.lit(1.0))
        return scored.withColumn("score", bounded).drop("prediction", "p")

    return score


def score_texts(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """``row, score``: every row of ``docs`` as a struct, and its toxicity."""
    score = fit(docs, labels, max_rows)
    held_rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        filled("text").alias("scored_text"),
    )
    return score(held_rows, F.col("scored_text")).select("row", "score")


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score is below the threshold."""
    return score_texts(docs, labels).where(F.col("score") < threshold).select("row.*")
