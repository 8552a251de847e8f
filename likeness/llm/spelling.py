"""Spelling variants grouped through a variable-length gram index.

Words are letter runs of the texts, counted over all documents.  Near words
(one inserted, deleted or replaced code point) are found by the method of
variable-length grams:

1. **Gram dictionary.**  Every gram of ``Q_MIN`` letters is in it; a gram of
   ``l > Q_MIN`` letters (up to ``Q_MAX``) is in it when each of its prefixes of
   ``Q_MIN`` to ``l - 1`` letters is frequent: counted in more than
   ``PRUNE_SHARE`` of all gram positions of that length.  Frequent grams are thus
   made longer and rarer; the share makes the rule alike at every size.
2. **Decomposition.**  At each position of a word the longest dictionary gram
   that starts there is taken, and kept when it ends after every gram taken
   before it.
3. **Affected-gram bound.**  Whether the gram at position j is kept depends on
   letters ``j - (Q_MAX - Q_MIN) .. j + Q_MAX - 1`` only (a gram before it
   may end where it ends), so one edit at letter p can change kept grams
   starting in ``[p - Q_MAX + 1, p + Q_MAX - Q_MIN]``
   and no others.  The most kept grams in such a span is the word's NAG, and a
   word within one edit shares at least ``tau = |VG| - NAG`` grams (as
   multisets) with it.
4. **List merging.**  Those spans are contiguous: the kept grams before the span
   are the first ones of both words, at the same places from the start, those after
   it the last ones, at the same places from the end.  So two words of
   ``tau >= MIN_TAU`` share their first i and their last ``MIN_TAU - i`` grams for
   some i from 0 to ``MIN_TAU``.  A word is listed under its ``MIN_TAU + 1`` such
   runs, each as one number; words of one list share ``MIN_TAU`` grams at least, which
   is the count filter.  Spark's banded Levenshtein then verifies that exactly one
   edit separates them, so that numbers equal by chance add no pair.
5. **The rest, exactly.**  A word with ``tau < MIN_TAU`` is filtered poorly or
   not at all by counting (its runs would be too short, so its lists would hold
   too many words); its one-letter deletions (and itself) are compared with those of
   every word of a length it can reach, which finds every word within one edit, then
   verified likewise.
   Such words are short: ``tau < MIN_TAU`` needs ``|VG| < NAG + MIN_TAU``, and
   NAG is at most the span, which bounds the length.

A word's form is its near word of largest count (ties: the smallest in
code-point order) when that count is at least ``FORM_FACTOR`` times its own;
the root follows forms to the end.  Counts grow by ``FORM_FACTOR`` along a chain,
so ``log10`` of the largest count bounds the steps, whatever the data; each step
takes only the words that are not at their root yet.

Cases: null texts have no runs; a null doc_id is written as the empty text in
the hashed ``<doc_id>:<run>``; a run shortened by the deletion rule is counted
as the shorter word; words below ``MIN_LENGTH`` code points or ``MIN_COUNT``
occurrences are no words; an empty table gives no rows; long runs are taken
whole (the banded distance is linear in their length); extra columns are not
read.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from likeness.llm.tables import bound, filled, held, lower_a_to_z

#: Fixed values of the contract: letter runs, the deletion rule, word limits, forms.
RUN = r"[A-Za-zÀ-ÿ]+"
DELETE_EVERY = 31
MIN_LENGTH = 7
MIN_COUNT = 2
FORM_FACTOR = 10

#: Gram lengths of the dictionary and the share above which a gram is made longer.
Q_MIN = 2
Q_MAX = 3
PRUNE_SHARE = 0.002
#: Words whose bound is below this go the exact way of deletions instead of the lists.
MIN_TAU = 4


def words(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``word, n``: the distinct words after the deletion rule, with their counts."""
    # A run shorter than a word, cut or not, is none: it needs no hash and no count.
    long_run = F.lit(RUN.removesuffix("+") + f"{{{MIN_LENGTH},}}")
    lowered = docs.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("row_key"),
        lower_a_to_z(filled(text)).alias("lowered"),
    )
    runs = lowered.select(
        "row_key", F.explode(F.regexp_extract_all("lowered", long_run, 0)).alias("run")
    )
    h = F.crc32(F.concat("row_key", F.lit(":"), "run"))
    cut = (h % F.char_length("run")).cast("int")
    word = F.when(
        h % DELETE_EVERY == 0,
        F.concat(
            F.col("run").substr(F.lit(1), cut), F.col("run").substr(cut + 2, F.char_length("run"))
        ),
    ).otherwise(F.col("run"))
    counted = runs.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(
        (F.char_length("word") >= MIN_LENGTH) & (F.col("n") >= MIN_COUNT)
    ).select("word", F.col("n").cast("long").alias("n"))


def _gram(word: Column, position: Column, length: int) -> Column:
    return word.substr(position + 1, F.lit(length))


def _positions(word: Column) -> Column:
    """Every position of ``word`` at which a shortest gram starts."""
    # Words have at least MIN_LENGTH letters, so there is a first and a last one.
    return F.sequence(F.lit(0), F.char_length(word) - Q_MIN)


def frequent_grams(vocab: DataFrame) -> list[str]:
    """The grams that are made longer: each prefix of theirs is frequent too.

    At most ``1 / PRUNE_SHARE`` of each length, whatever the table, so they are
    literals of the decomposition.
    """
    word = F.col("word")
    found: list[str] = []
    for q in range(Q_MIN, Q_MAX):
        starts = F.filter(_positions(word), lambda p: p + q <= F.char_length(word))
        grams = vocab.select(F.explode(F.transform(starts, lambda p: _gram(word, p, q))).alias("gram"))
        freq = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("f"))
        total = freq.agg(F.sum("f").alias("total"))
        share = freq.join(F.broadcast(total)).filter(F.col("f") > F.col("total") * F.lit(PRUNE_SHARE))
        shorter = set(found)
        found += [r.gram for r in share.collect() if q == Q_MIN or r.gram[:-1] in shorter]
    return found


def decompose(vocab: DataFrame, frequent: list[str]) -> DataFrame:
    """``vocab`` with ``grams, nag, tau``: the kept grams ``(pos, gram)`` of every word, the most of
    them that one edit affects, and how many are shared at least.

    The longest dictionary gram at a position is as long as its prefixes are
    frequent: every gram of a word is in the table of words.  A gram is kept when it
    ends after every gram before it, of which only those that start less than
    ``Q_MAX - Q_MIN + 1`` letters before can end as late.
    """
    word = F.col("word")

    def size_at(p: Column) -> Column:
        size = F.lit(Q_MIN)
        for q in reversed(range(Q_MIN, Q_MAX)):
            longer = F.lit(q + 1) if q == Q_MAX - 1 else size
            grows = _gram(word, p, q).isin(frequent) & (p + q + 1 <= F.char_length(word))
            size = F.when(grows, longer).otherwise(F.lit(q))
        return size

    def is_kept(ends: Column, p: Column) -> Column:
        kept = F.lit(True)
        for back in range(1, Q_MAX - Q_MIN + 1):
            kept = kept & F.coalesce(F.get(ends, p - back) < F.get(ends, p), F.lit(True))
        return kept

    span = 2 * Q_MAX - Q_MIN

    def in_span(kept: Column, p: Column, i: Column) -> Column:
        near = [F.coalesce(F.get(kept, i + k) < p + span, F.lit(False)) for k in range(1, span)]
        return sum((one.cast("int") for one in near), F.lit(1))

    def described(ends: Column, kept: Column) -> Column:
        return F.struct(
            F.transform(
                kept, lambda p: F.struct(p.alias("pos"), word.substr(p + 1, F.get(ends, p) - p).alias("gram"))
            ).alias("grams"),
            F.array_max(F.transform(kept, lambda p, i: in_span(kept, p, i))).alias("nag"),
        )

    kept_of = lambda ends: F.filter(_positions(word), lambda p: is_kept(ends, p))
    found = bound(
        F.transform(_positions(word), lambda p: p + size_at(p)),
        lambda ends: bound(kept_of(ends), lambda kept: described(ends, kept)),
    )
    return vocab.select("*", F.inline(F.array(found))).withColumn(
        "tau", F.size("grams") - F.col("nag")
    )


def _runs(grams: Column, size: Column) -> Column:
    """The numbers of a word's first i and last ``MIN_TAU - i`` grams, for each i."""

    def run(i: int) -> Column:
        rest = MIN_TAU - i
        last = F.slice(grams, -rest, rest) if rest else F.slice(grams, 1, 0)
        return F.xxhash64(
            F.lit(i),
            F.slice(grams, 1, i),
            F.transform(last, lambda g: F.struct(size - g["pos"], g["gram"])),
        )

    return F.array(*[run(i) for i in range(MIN_TAU + 1)])


def _deletions(word: Column) -> Column:
    """The numbers of a word and its one-letter deletions."""
    shorter = F.transform(
        F.sequence(F.lit(1), F.char_length(word)),
        lambda i: F.concat(word.substr(F.lit(1), i - 1), word.substr(i + 1, F.char_length(word))),
    )
    return F.transform(F.array_union(F.array(word), shorter), lambda w: F.xxhash64(w))


def _one_edit_apart(keyed: DataFrame) -> DataFrame:
    """``a, a_n, b, b_n``: pairs one edit apart of ``key, word, n, loose`` that share a
    key, one or both of them ``loose`` (1, else 0); ``a < b``."""
    # Both sides read one shuffle: no condition below is on one side alone.
    side = lambda x: keyed.select(
        "key", F.col("word").alias(x), F.col("n").alias(f"{x}_n"), F.col("loose").alias(f"{x}_loose")
    )
    return (
        side("a")
        .join(side("b"), "key")
        .filter(
            (F.col("a") < F.col("b"))
            & (F.col("a_loose") + F.col("b_loose") > 0)
            & (F.abs(F.char_length("a") - F.char_length("b")) <= 1)
            & (F.levenshtein("a", "b", 1) == 1)
        )
        .select("a", "a_n", "b", "b_n")
    )


def _pairs(vocab: DataFrame) -> DataFrame:
    """``a, a_n, b, b_n``: every pair of words one edit apart, once, with their counts."""
    word, size = F.col("word"), F.char_length("word")
    by_runs = F.col("tau") >= MIN_TAU
    # Decomposed once and held, with the runs instead of the grams.
    described = held(
        decompose(vocab, frequent_grams(vocab)).select(
            "word", "n", F.when(by_runs, _runs(F.col("grams"), size)).alias("runs")
        )
    )
    listed = described.filter(F.col("runs").isNotNull()).select(
        F.explode("runs").alias("key"), "word", "n", F.lit(1).alias("loose")
    )

    # Words that counting cannot filter, by their deletions.
    loose = F.col("runs").isNull()
    reach = described.filter(loose).agg(F.max(size).alias("longest"))
    reachable = described.join(F.broadcast(reach), size <= F.col("longest") + 1)
    probed = reachable.select(
        F.explode(_deletions(word)).alias("key"), "word", "n", loose.cast("int").alias("loose")
    )
    # A pair may share more than one run or deletion.
    return _one_edit_apart(listed).unionByName(_one_edit_apart(probed)).distinct()


def _both_ways(pairs: DataFrame) -> DataFrame:
    ways = F.array(
        *[
            F.struct(
                F.col(x).alias("word"), F.col(y).alias("near"), F.col(f"{y}_n").alias("near_n")
            )
            for x, y in (("a", "b"), ("b", "a"))
        ]
    )
    return pairs.select(F.inline(ways))


def near_pairs(vocab: DataFrame) -> DataFrame:
    """``a, b``: every pair of words one edit apart, once each way."""
    return _both_ways(_pairs(vocab)).select(F.col("word").alias("a"), F.col("near").alias("b"))


def group_variants(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word."""
    vocab = held(words(docs, text, key))
    best = _both_ways(_pairs(vocab)).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("top"),
    )
    has_form = -F.col("top.less") >= F.lit(FORM_FACTOR) * F.col("n")
    table = held(
        vocab.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has_form, F.col("top.near")).alias("form"),
            F.when(has_form, -F.col("top.less")).alias("form_n"),
        )
    )
    # Each step along a chain multiplies the count by FORM_FACTOR at least.
    largest = vocab.agg(F.max("n")).first()[0] or 1
    steps = max(1, math.ceil(math.log(max(largest, 1), FORM_FACTOR)) + 1)
    links = table.filter(F.col("form").isNotNull()).select("word", "form")
    step = links.select(F.col("word").alias("root"), F.col("form").alias("next_root"))
    moving = links.withColumnRenamed("form", "root")
    moved = []
    for at in range(steps):
        # Only words whose root so far has a form itself go on.
        moving = held(moving.join(step, "root").select("word", F.col("next_root").alias("root")))
        if moving.isEmpty():
            break
        moved.append(moving.withColumn("at", F.lit(at)))
    rooted = table.withColumn("root", F.coalesce("form", "word"))
    if moved:
        ends = reduce(DataFrame.unionByName, moved).groupBy("word").agg(
            F.max_by("root", "at").alias("end")
        )
        rooted = rooted.join(ends, "word", "left").withColumn("root", F.coalesce("end", "root"))
    return rooted.select(
        "word",
        "form",
        "root",
        F.col("n").cast("long").alias("n"),
        "n_near",
        F.col("form_n").cast("long").alias("form_n"),
    )
