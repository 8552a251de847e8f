"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions only.

Every document gets a place in its source's shuffled order (a hash of seed and
id).  Its virtual finish time is the number of source words up to and including
it, over all passes so far, divided by the source's target.  The mix is the
documents in order of finish time, cut off where the total budget is used up.
Sources whose target is above their size are gone through again, up to ``repeats``
passes.

The two running sums never put a source or the whole table in one task: rows are
dealt into slots by shuffle hash (within a source) and by finish time (global
range sort), slot totals are summed in a table of a few thousand rows for each
source, and windows order the rows of one slot only.

Targets are shares of the total by weight; a target stops at ``repeats`` times
its source's size and the excess goes to the others by weight.  That water
filling is done in one pass over the sources: in order of size per weight, the
full ones come first, and one level serves all others.

Defined results: null text has size 0; a null source is a source of its own that
comes last; documents of size 0 are never taken; rows with equal ids are ordered
by size, and rows equal in both are interchangeable; an empty table, or one
without a word, gives targets of 0; further columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from likeness.llm.tables import WORD, filled, free_name, held

#: Hex digits of the shuffle hash that choose the slot within a source.
SLOT_DIGITS = 3
#: Slots between finish times 0 and 1.
TIME_SLOTS = 4096
SEED = "mix-1"
#: Passes over a source at most.
REPEATS = 3
#: Weights of the sources by rank, repeating.
WEIGHTS = (1, 2, 3)


def n_words(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``source, source_size, target`` from one row per source.

    The windows have no partition: they order the sources, which are few
    against the documents, and carry three numbers for each.
    """
    ranked = sizes.withColumn(
        "place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    )
    chosen = F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("place") % len(weights) + 1)
    weighed = ranked.withColumn("weight", chosen.cast("long")).withColumn(
        "cap", F.col("source_size") * repeats
    )
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("place"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    filled_up = weighed.select(
        "*",
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("caps_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("weights_before"),
        F.sum("weight").over(whole).alias("weights"),
        F.sum("source_size").over(whole).alias("budget"),
    ).withColumn(
        "level",
        (F.col("budget") - F.col("caps_before")).cast("double")
        / (F.col("weights") - F.col("weights_before")),
    )
    # The first source whose cap reaches the level sets it for all after it.
    reached = F.col("level") * F.col("weight") <= F.col("cap")
    first = F.struct((F.col("cap") / F.col("weight")).alias("ratio"), "place", "level")
    levelled = filled_up.withColumn("level", F.min(F.when(reached, first)).over(whole)["level"])
    share = F.col("level") * F.col("weight")
    return levelled.select(
        "source",
        "source_size",
        "budget",
        F.coalesce(F.least(F.col("cap").cast("double"), share), F.lit(0.0)).alias("target"),
    )


def _time_slot(turn: Column) -> Column:
    """The slot of a finish time.

    The budget is the sum of the targets, so it runs out close to finish time 1;
    all turns after time 2 share one slot, and the slots stay few.
    """
    return F.least(F.floor(turn["finish"] * TIME_SLOTS), F.lit(2 * TIME_SLOTS))


def _starts(rows: DataFrame, keys: list[str], slot: str) -> DataFrame:
    """Words in the slots before each slot, by ``keys``; columns end in an underscore."""
    totals = rows.groupBy(*keys, slot).agg(F.sum("size").alias("slot_size"))
    by = Window.partitionBy(*keys) if keys else Window
    ahead = by.orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        *[F.col(k).alias(f"{k}_") for k in [*keys, slot]],
        F.coalesce(F.sum("slot_size").over(ahead), F.lit(0)).alias("start"),
    )


def _placed(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Adds ``upto``, the source's words up to each row in shuffled order, and the targets."""
    within = (
        Window.partitionBy("source", "slot")
        .orderBy("place", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    starts = _starts(rows, ["source"], "slot")
    same = F.col("source").eqNullSafe(F.col("source_"))
    return (
        rows.withColumn("own", F.sum("size").over(within))
        .join(starts, same & (F.col("slot") == F.col("slot_")))
        .withColumn("upto", F.col("own") + F.col("start"))
        .drop("own", "start", "slot", "slot_", "source_")
        .join(targets.withColumnRenamed("source", "source_"), same)
        .drop("source_")
    )


def _cutoff(queued: DataFrame) -> DataFrame:
    """One row: the slot in which the budget runs out, and its last turn that fits (or null).

    All turns of the slots before fit; only the turns of that slot are sorted.
    """
    starts = _starts(queued, [], "time_slot")
    budget = queued.agg(F.max("budget").alias("budget"))
    last = (
        starts.crossJoin(F.broadcast(budget))  # one row
        .where("start <= budget")
        .agg(F.max(F.struct("time_slot_", "start")).alias("last"))
        .select("last.time_slot_", "last.start")
    )
    in_line = (
        Window.partitionBy("time_slot")
        .orderBy("turn")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        queued.join(F.broadcast(last), F.col("time_slot") <= F.col("time_slot_"))
        .where("time_slot = time_slot_")
        .withColumn("line", F.sum("size").over(in_line) + F.col("start"))
        .agg(
            F.max("time_slot").alias("last_slot"),
            F.max(F.when(F.col("line") <= F.col("budget"), F.col("turn"))).alias("cutoff"),
        )
    )


def _taken(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    repeats: int = REPEATS,
    seed: str = SEED,
) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` for every row of ``docs``."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        F.coalesce(n_words(F.col(text_col)), F.lit(0)).alias("size"),
    ).withColumn("place", F.md5(F.concat(F.lit(seed + ":"), filled("doc_id")).cast("binary")))
    rows = held(rows.withColumn("slot", F.substring("place", 1, SLOT_DIGITS)))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = held(_placed(rows, source_targets(sizes, weights, repeats)))

    def turn(number: Column) -> Column:
        words = (number * F.col("source_size") + F.col("upto")).cast("double")
        return F.struct(
            F.try_divide(words, F.col("target")).alias("finish"), "place", "doc_id", "size"
        )

    turns = F.array(*[turn(F.lit(n)) for n in range(repeats)])
    queued = (
        placed.where("size > 0")
        .select("size", "budget", F.explode(turns).alias("turn"))
        .withColumn("time_slot", _time_slot(F.col("turn")))
    )

    def fits(turn: Column) -> Column:
        slot = _time_slot(turn)
        return (slot < F.col("last_slot")) | (
            (slot == F.col("last_slot")) & (turn <= F.col("cutoff"))
        )

    return placed.crossJoin(F.broadcast(_cutoff(queued))).select(  # one row
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.when(F.col("size") > 0, F.size(F.filter(turns, fits)) * F.col("size"))
        .otherwise(F.lit(0))
        .cast("long")
        .alias("taken"),
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row of ``docs``.

    Options: ``id_col``, ``text_col``, ``source_col``, ``weights``, ``repeats``, ``seed``.
    """
    return _taken(docs, **options).drop("source")


def mixed_rows(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", **options
) -> DataFrame:
    """The rows of ``docs`` that the mix takes, once for each time it takes them.

    Rows that share id and source are taken alike, as often as the luckiest.
    """
    copies, key, source = (free_name(docs, n) for n in ("copies", "key", "source_key"))
    picked = (
        _taken(docs, id_col=id_col, source_col=source_col, **options)
        .where("taken > 0")
        .groupBy(F.col("doc_id").alias(key), F.col("source").alias(source))
        .agg(F.max((F.col("taken") / F.col("size")).cast("int")).alias(copies))
    )
    same = docs[id_col].eqNullSafe(picked[key]) & docs[source_col].eqNullSafe(picked[source])
    return (
        docs.join(picked, same)
        .withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies))))
        .select(*[f"`{c}`" for c in docs.columns])
    )
