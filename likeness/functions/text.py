"""Text column functions: whitespace, tokens, offsets.

Everything here is a built-in Spark expression.  Word characters are spelled
out as ``[\\p{L}\\p{N}_]`` instead of ``\\w``/``\\b``, whose Unicode behaviour
differs between regex engines and JDK versions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]"
NOT_AFTER_WORD = rf"(?<!{WORD})"
NOT_BEFORE_WORD = rf"(?!{WORD})"
SPACES = r"(?U)[\s\x1c-\x1f]+"
SPACE_CHARACTERS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
ANY_TEXT = r"(?U)[^\s\x1c-\x1f]"
TOKEN = r"[\p{L}\p{N}_'-]+"
ALNUM = r"[\p{L}\p{N}]"
BOUNDARY = r"[,.!?;:]|(?i:<END>)"
# One token of a phrase plus whatever separates it from the token before it.
_TOKEN_WITH_LEAD = r"(?:[^\p{L}\p{N}]*[\p{L}\p{N}][\p{L}\p{N}_'-]*)"

_TO_END = 2147483647


def collapse_spaces(text: Column) -> Column:
    """Collapse Unicode whitespace runs to one space and trim."""
    return F.trim(F.regexp_replace(text, SPACES, " "))


def strip_spaces(text: Column) -> Column:
    """Trim Unicode whitespace at both ends, keep the inside as it is."""
    return F.btrim(text, F.lit(SPACE_CHARACTERS))


def has_text(text: Column) -> Column:
    """True when the text has anything but whitespace."""
    return text.rlike(ANY_TEXT)


def tail_from(text: Column, offset: Column) -> Column:
    """Text from a zero-based character offset to the end."""
    return F.substring(text, offset + F.lit(1), F.lit(_TO_END))


def head_to(text: Column, offset: Column) -> Column:
    """Text before a zero-based character offset."""
    return F.substring(text, F.lit(1), offset)


def join_nonempty(*parts: Column) -> Column:
    """Join parts with one space, leaving empty ones out."""
    return F.concat_ws(" ", *[F.nullif(part, F.lit("")) for part in parts])


def word_tokens(text: Column) -> Column:
    """Word tokens (letters, digits, ``_``, ``'``, ``-``) holding an alphanumeric."""
    found = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    return F.filter(found, lambda token: token.rlike(ALNUM))


def until_boundary(text: Column) -> Column:
    """Text up to the first punctuation or segment boundary."""
    return F.get(F.split(text, BOUNDARY, 2), F.lit(0))


def last_tokens(tokens: Column, count: int) -> Column:
    """The last ``count`` elements; the whole array when it is shorter."""
    return F.slice(tokens, F.greatest(F.size(tokens) - F.lit(count - 1), F.lit(1)), F.lit(count))


def drop_first(tokens: Column) -> Column:
    """All elements but the first."""
    return F.slice(tokens, F.lit(2), F.size(tokens))


def joined(tokens: Column) -> Column:
    """Tokens joined by one space."""
    return F.array_join(tokens, " ")


def first_or_empty(tokens: Column) -> Column:
    """First element, or the empty string."""
    return F.coalesce(F.get(tokens, F.lit(0)), F.lit(""))


def end_of_token(phrase: Column, count: Column, most: int) -> Column:
    """Length of the phrase up to the end of its ``count``-th word token."""
    chain = F.lit(0)
    for n in range(1, most + 1):
        reach = F.length(F.regexp_extract(phrase, rf"^{_TOKEN_WITH_LEAD}{{{n}}}", 0))
        chain = F.when(count == n, reach) if n == 1 else chain.when(count == n, reach)
    return chain.otherwise(F.lit(0))


def one_of(text: Column, words: Iterable[str]) -> Column:
    """True when the text is one of the words.

    The list is one constant array written as SQL text: building an ``isin``
    of a hundred words costs a hundred calls into the JVM.
    """
    quoted = ", ".join("'" + word.replace("'", "\\'") + "'" for word in words)
    return F.array_contains(F.expr(f"array({quoted})"), text)


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters are not pushed through.

    A filter on a plain column is moved down and evaluates the column's whole
    expression a second time; one on a generated column stays above it.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def bound(value: Column, build: Callable[[Column], Column]) -> Column:
    """``build(value)`` with the value computed once, however often it is used.

    A lambda variable is computed once per element, so an array that another
    lambda looks into is not built again for each of its elements.
    """
    return F.element_at(F.transform(F.array(value), build), 1)


SUM_BLOCK = 128


def running_sums(numbers: Column) -> Column:
    """Sums up to and including each element of an array of at least one integer.

    Appending copies the array so far, so sums are made block by block: the
    cost is in proportion to the elements, not to their square.
    """

    def running(block: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all"))

        def step(done: Column, number: Column) -> Column:
            at = done["at"] + number
            return F.struct(at.alias("at"), F.array_append(done["all"], at).alias("all"))

        return F.aggregate(block, start, step, lambda done: done["all"])

    last = F.floor((F.size(numbers) - 1) / SUM_BLOCK).cast("int")
    blocks = F.transform(
        F.sequence(F.lit(0), last),
        lambda n: running(F.slice(numbers, n * SUM_BLOCK + 1, F.lit(SUM_BLOCK))),
    )

    def joined_blocks(sums: Column) -> Column:
        ends = running(F.transform(sums, lambda block: F.element_at(block, -1)))
        return bound(
            ends,
            lambda e: F.flatten(
                F.transform(
                    sums,
                    lambda block, n: F.transform(
                        block, lambda x: x + F.coalesce(F.get(e, n - 1), F.lit(0))
                    ),
                )
            ),
        )

    return bound(blocks, joined_blocks)


def any_of(words: Iterable[str]) -> str:
    """Regex alternation of plain words, longest first."""
    return "|".join(sorted(set(words), key=lambda word: (-len(word), word)))


def stem_after_boundary(stems: Iterable[str]) -> str:
    """Regex: a word that starts with one of the stems, any case."""
    return rf"(?iU){NOT_AFTER_WORD}(?:{'|'.join(stems)})"
