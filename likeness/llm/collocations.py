"""Phrase collocations mined from the counts of windows, shorter orders first.

A phrase seen ``MIN_COUNT`` times has only parts seen as often, so the windows of
``ORDER - 1`` words are counted first: every word position of a piece yields one
row, the window that starts there (shorter where the piece ends).  Each distinct
window then adds its count to its prefixes, so no n-gram of a shorter order is made
from the words, and the total of a language is the number of its words.

The windows of ``ORDER`` words are counted only where both windows of ``ORDER - 1``
words in them may be frequent.  The frequent ones are marked in a bitmap by their
hash: ``MARK_ROWS`` rows of 64 bits at most, whatever the input, joined by
broadcast.  A hash shared by chance lets a window through that is then counted
like any other, so the marks change the number of rows shuffled and never a count.

A candidate is a phrase of 2 to ``ORDER`` words seen at least ``MIN_COUNT``
times.  Cutting it after its first k words gives the counts l and r of both
parts; the score of a cut is ``floor(1e6 * a * a / (l * r))`` in exact
decimals (``l >= a`` and ``r >= a``, so the result fits a long), and the
lowest-scoring cut counts, ties to the smallest k.  A candidate whose words lie
contiguously in a longer candidate with ``100 * f(longer) >= 50 * a`` is
dropped.  Each language keeps its first ``TOP`` by score, count and phrase.

Cases: a null text counts as empty (no words); a null lang is ``und``; words
are runs of anything but space and tab inside a piece, so any other character
is part of a word; an empty table gives no rows; extra columns of the input
are not read.  Phrases are space-joined, ordered by UTF-8 bytes.

Skew: counts are partial aggregates before the shuffle, so a hot language or
word is summed in its map tasks.  The lookups of the parts join on the part;
parts counted at least ``1 / HEAVY_SHARE`` of all words are few by arithmetic
(at most ``3 * HEAVY_SHARE``) and are broadcast, the rest are light keys of a
bounded number of candidates each.  The top of each language is cut per map
partition before it is shuffled (Spark's window group limit).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from likeness.llm.tables import filled, held, lower_a_to_z

#: Fixed values of the contract: orders, thresholds.
ORDER = 3
MIN_COUNT = 10
CONTAINED_PERCENT = 50
TOP = 2000
SCALE = 1_000_000

#: Rows of 64 bits in which frequent windows are marked by their hash.
MARK_ROWS = 1 << 20

#: A part counted at least one in this many words of the table is broadcast.
HEAVY_SHARE = 4096

#: What words consist of, tabs being spaces: no space and none of the piece ends.
_LETTER = r"[^ .,;:!?\n\x0B\f\r]"
_EXACT = "decimal(38,0)"


def _spaced(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """``lang, text``: A-Z in lower case, one space for each run of spaces and tabs."""
    spaced = F.replace(lower_a_to_z(filled(text)), F.lit("\t"), F.lit(" "))
    return docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.when(spaced.contains("  "), F.regexp_replace(spaced, " {2,}", " ")).otherwise(spaced).alias("text"),
    )


def windows(
    docs: DataFrame, text: str = "text", lang: str = "lang", order: int = ORDER, whole: bool = False
) -> DataFrame:
    """``lang, words``: one row per word, the window of ``order`` words from it,
    space-joined; shorter where the piece ends, or left out there if ``whole``."""
    words = f"{_LETTER}+"
    for _ in range(order - 1):
        words = f"{_LETTER}+ {words}" if whole else f"{_LETTER}+(?: {words})?"
    # The window is looked at from a word's first letter, and that word alone is consumed.
    # Neither words nor spaces hold a piece end, so no window crosses one.
    window = f"(?<!{_LETTER})(?=({words})){_LETTER}+"
    return _spaced(docs, text, lang).select(
        "lang", F.explode(F.regexp_extract_all("text", F.lit(window), 1)).alias("words")
    )


def _counted(win: DataFrame) -> DataFrame:
    """``lang, words, f``: every distinct window with its count."""
    # One text per window, its words and its language: words hold neither spaces nor
    # line feeds, and one column makes the rows of the shuffle half as long.
    keyed = win.select(F.concat("words", F.lit("\n"), "lang").alias("key"))
    return keyed.groupBy("key").agg(F.count(F.lit(1)).alias("f")).select(
        F.expr(r"substring(key, instr(key, '\n') + 1)").alias("lang"),
        F.substring_index("key", "\n", 1).alias("words"),
        "f",
    )


def counts(win: DataFrame, order: int = ORDER, least: int = 1) -> DataFrame:
    """``lang, order, phrase, f``: counts of every phrase up to ``order`` words, and
    ``order`` 0 with the language's word count ``n``, from windows of ``order`` words.

    Phrases of ``order`` words are left out below the count ``least``; shorter ones
    are all there.
    """
    spaces = F.char_length("words") - F.char_length(F.replace("words", F.lit(" "), F.lit("")))
    # A window that ends before an order is no phrase of that order.
    taken = lambda k: spaces >= k - 1 if k > 1 else F.lit(True)
    parts = [
        F.when(
            (F.col("f") >= least) & taken(k) if k == order else taken(k),
            F.struct(F.lit(k).alias("order"), F.substring_index("words", " ", k).alias("phrase")),
        )
        for k in range(order + 1)
    ]
    return (
        _counted(win)
        .select("lang", "f", F.inline(F.array(*parts)))
        .filter("order IS NOT NULL")
        .groupBy("lang", "order", "phrase")
        .agg(F.sum("f").alias("f"))
    )


def _mark(words: Column) -> Column:
    return F.pmod(F.xxhash64("lang", words), F.lit(64 * MARK_ROWS))


def may_be_frequent(win: DataFrame, frequent: DataFrame, order: int = ORDER) -> DataFrame:
    """The windows of ``order`` words less those whose first or last ``order - 1`` words
    are no phrase of ``frequent`` (``lang, phrase``); a few of these may stay."""
    bit = lambda mark: F.call_function(
        "shiftleft", F.lit(1).cast("long"), (mark % 64).cast("int")
    )
    marks = (
        frequent.select(_mark(F.col("phrase")).alias("mark"))
        .groupBy(F.expr("mark div 64").alias("row"))
        .agg(F.bit_or(bit(F.col("mark"))).alias("bits"))
    )
    for part in (
        F.substring_index("words", " ", order - 1),
        F.substring_index("words", " ", 1 - order),
    ):
        win = (
            win.withColumn("mark", _mark(part))
            .withColumn("row", F.expr("mark div 64"))
            .join(F.broadcast(marks), "row")
            .filter(F.col("bits").bitwiseAND(bit(F.col("mark"))) != 0)
            .select("lang", "words")
        )
    return win


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, order, phrase, f`` of every phrase up to ``ORDER`` words seen at least
    ``MIN_COUNT`` times, and ``order`` 0 with the language's word count."""
    shorter = held(
        counts(windows(docs, text, lang, ORDER - 1), ORDER - 1, MIN_COUNT).filter(
            f"order = 0 OR f >= {MIN_COUNT}"
        )
    )
    longest = may_be_frequent(
        windows(docs, text, lang, ORDER, whole=True), shorter.filter(F.col("order") == ORDER - 1)
    )
    found = _counted(longest).filter(F.col("f") >= MIN_COUNT).select(
        "lang", F.lit(ORDER).alias("order"), F.col("words").alias("phrase"), "f"
    )
    return shorter.unionByName(held(found))


def _lookup(rows: DataFrame, key: str, out: str, table: DataFrame, heavy: DataFrame) -> DataFrame:
    """``rows`` with ``out``: the count of phrase ``key`` of its lang.

    Heavy parts come from a broadcast table of proven size, the others by a
    shuffle join whose keys each serve a bounded number of candidates.
    """
    named = lambda t: t.select("lang", F.col("phrase").alias(key), F.col("f").alias(out))
    tagged = rows.join(F.broadcast(named(heavy)), ["lang", key], "left")
    light = tagged.filter(F.col(out).isNull()).drop(out)
    return tagged.filter(F.col(out).isNotNull()).unionByName(
        light.join(named(table), ["lang", key])
    )


def mine(docs: DataFrame, text: str = "text", lang: str = "lang", top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's best collocations."""
    # Counted once and held: only totals and phrases that can take part are kept.
    counted = frequent_phrases(docs, text, lang)
    totals = counted.filter("order = 0").select("lang", F.col("f").alias("n"))
    grams = counted.filter(f"order > 0 AND f >= {MIN_COUNT}")
    everything = totals.agg(F.sum("n").alias("all_words"))
    heavy = grams.crossJoin(everything).filter(
        F.col("f") * F.lit(HEAVY_SHARE) >= F.col("all_words")
    ).drop("all_words")
    light = grams.join(F.broadcast(heavy.select("lang", "phrase")), ["lang", "phrase"], "left_anti")

    candidates = grams.filter("order >= 2").withColumnRenamed("f", "a")
    words = F.split("phrase", " ")
    cuts = candidates.select(
        "lang",
        "phrase",
        "a",
        F.inline(
            F.transform(
                F.sequence(F.lit(1), F.col("order") - 1),
                lambda k: F.struct(
                    k.alias("k"),
                    F.array_join(F.slice(words, 1, k), " ").alias("left_part"),
                    F.array_join(F.slice(words, k + 1, F.lit(ORDER)), " ").alias("right_part"),
                ),
            )
        ),
    )
    cuts = _lookup(cuts, "left_part", "l", light, heavy)
    cuts = _lookup(cuts, "right_part", "r", light, heavy)
    # l >= a and r >= a, so the quotient is at most SCALE; the products are exact decimals.
    scored = cuts.withColumn(
        "score",
        F.expr(
            f"(CAST({SCALE} AS {_EXACT}) * CAST(a AS {_EXACT}) * CAST(a AS {_EXACT}))"
            f" div (CAST(l AS {_EXACT}) * CAST(r AS {_EXACT}))"
        ),
    )
    lowest = scored.groupBy("lang", "phrase").agg(
        F.min_by(F.struct("score", "k", "l", "r", "a"), F.struct("score", "k")).alias("cut")
    ).select("lang", "phrase", "cut.*")

    inner = candidates.filter(f"order >= 3").select(
        "lang",
        F.col("a").alias("outer_a"),
        F.inline(
            F.transform(
                F.sequence(F.lit(0), F.lit(ORDER - 2)),
                lambda s: F.struct(
                    F.array_join(F.slice(words, s + 1, F.lit(2)), " ").alias("phrase")
                ),
            )
        ),
    )
    # Only phrases one word shorter than ORDER are checked here; with ORDER 3 that
    # covers every pair: a 2-word phrase lies only in 3-word ones.
    containing = inner.groupBy("lang", "phrase").agg(F.max("outer_a").alias("outer_a"))
    survivors = lowest.join(containing, ["lang", "phrase"], "left").filter(
        F.col("outer_a").isNull()
        | (F.lit(100) * F.col("outer_a") < F.lit(CONTAINED_PERCENT) * F.col("a"))
    )
    order = Window.partitionBy("lang").orderBy(
        F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()
    )
    ranked = survivors.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang",
        F.col("rank").cast("long").alias("rank"),
        "phrase",
        F.col("a").cast("long").alias("a"),
        F.col("l").cast("long").alias("l"),
        F.col("r").cast("long").alias("r"),
        F.col("n").cast("long").alias("n"),
        F.col("score").cast("long").alias("score"),
    )
