"""Chat formatting in Spark expressions only.

Turns are collected as structs and sorted; adjacent turns of one role merge into
one marked run; runs are concatenated.  Every step is linear in the number of
turns: a turn looks at its neighbours by index, nothing is folded into a growing
array or string.

Template::

    <s>[INST:role]text of a turn</t>text of the next turn of the run</s>

A control string inside a text or role gets one backslash after its first
character, one more if it has some already, so the escape can be undone exactly
and no text can end or open a turn.

The loss mask lists for every turn how many characters of the output lie between
the text before and this text, how long this text is in the output, and whether
it counts for the loss.

Defined results: null text and null role count as empty; turns sort by number
(null first), then role, then text, so repeated turns stay and ties are stable;
a null conversation id is a conversation of its own; an empty table gives an
empty result; further columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from likeness.llm.tables import bound, filled

OPEN, ROLE, NEXT, CLOSE = "<s>", "[INST:", "</t>", "</s>"
#: Control strings: those of the template, and the instruction marks it is read by.
TAILS = r"s>|/s>|/t>|INST:|INST\]|/INST\]"
_PLAIN = rf"([<\[])(\\*)({TAILS})"
_ESCAPED = rf"([<\[])\\(\\*)({TAILS})"
LOSS_ROLES = ("assistant",)


def escape(text: Column) -> Column:
    """Text that holds no control string; undone by :func:`unescape`."""
    return F.regexp_replace(text, F.lit(_PLAIN), F.lit(r"$1$2\\$3"))


def unescape(text: Column) -> Column:
    """The text that :func:`escape` was given."""
    return F.regexp_replace(text, F.lit(_ESCAPED), F.lit("$1$2$3"))


def _escape_role(role: Column) -> Column:
    # The role ends at the first bracket of its mark, so it must not hold one.
    return F.replace(F.replace(escape(role), F.lit("%"), F.lit("%25")), F.lit("]"), F.lit("%5D"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("%5D"), F.lit("]")), F.lit("%25"), F.lit("%")))


def format_conversations(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    loss_roles: tuple[str, ...] = LOSS_ROLES,
) -> DataFrame:
    """``conv_id, formatted, loss_mask`` for every conversation.

    ``loss_mask`` is an array of ``(skip, chars, loss)``, one for each turn.
    """
    rows = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.struct(
            F.col(turn_col).alias("turn"),
            filled(role_col).alias("role"),
            filled(text_col).alias("text"),
        ).alias("turn"),
    )
    collected = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))

    def pieces(sorted_turns: Column) -> Column:
        last = F.size(sorted_turns) - 1

        def piece(turn: Column, i: Column) -> Column:
            # There is no turn before the first: get() gives null.
            first = ~F.coalesce(F.get(sorted_turns, i - 1)["role"] == turn["role"], F.lit(False))
            opening = F.concat(F.lit(OPEN + ROLE), _escape_role(turn["role"]), F.lit("]"))
            return F.struct(
                F.when(i == 0, opening)
                .when(first, F.concat(F.lit(CLOSE), opening))
                .otherwise(F.lit(NEXT))
                .alias("mark"),
                escape(turn["text"]).alias("text"),
                F.when(i == last, F.lit(CLOSE)).otherwise(F.lit("")).alias("end"),
                turn["role"].isin(*loss_roles).alias("loss"),
            )

        return F.transform(sorted_turns, piece)

    def output(parts: Column) -> Column:
        return F.struct(
            F.array_join(
                F.transform(parts, lambda p: F.concat(p["mark"], p["text"], p["end"])), ""
            ).alias("formatted"),
            F.transform(
                parts,
                lambda p: F.struct(
                    F.char_length(p["mark"]).alias("skip"),
                    F.char_length(p["text"]).alias("chars"),
                    p["loss"].alias("loss"),
                ),
            ).alias("loss_mask"),
        )

    made = bound(F.col("turns"), lambda t: bound(pieces(t), output))
    return collected.select("conv_id", made.alias("made")).select("conv_id", "made.*")


def read_back(formatted: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``conv_id, turns, loss_texts``: turns and masked texts as read from the output.

    ``turns`` has the role and unescaped text of every turn, ``loss_texts`` the
    unescaped texts that the mask selects, cut to the mask's lengths.
    """
    runs = F.filter(F.split("formatted", f"(?={CLOSE})"), lambda r: r != CLOSE)

    def of_run(run: Column) -> Column:
        # "</s>" before "<s>[INST:role]" belongs to the run before it.
        body = F.regexp_replace(run, F.lit(rf"^(?:{CLOSE})?{OPEN}\[INST:"), F.lit(""))
        role = _unescape_role(F.substring_index(body, "]", 1))
        texts = F.split(F.regexp_replace(body, F.lit(r"^[^\]]*\]"), F.lit("")), NEXT)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), t.alias("raw")))

    def results(parsed: Column, mask: Column) -> Column:
        masked = F.zip_with(
            parsed,
            mask,
            lambda p, m: F.when(m["loss"], F.substring(p["raw"], F.lit(1), m["chars"])),
        )
        return F.struct(
            F.transform(
                parsed, lambda p: F.struct(p["role"].alias("role"), unescape(p["raw"]).alias("text"))
            ).alias("turns"),
            F.transform(F.filter(masked, lambda t: t.isNotNull()), unescape).alias("loss_texts"),
        )

    parsed = bound(
        F.flatten(F.transform(runs, of_run)), lambda p: results(p, F.col("loss_mask"))
    )
    columns = ["conv_id", *keep]
    return formatted.select(*columns, parsed.alias("back")).select(*columns, "back.*")
