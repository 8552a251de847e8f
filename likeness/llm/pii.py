"""PII: keyed surrogates for detected entities, with collision checks in Spark.

Detection finds e-mail addresses, phone numbers, long account and card numbers,
IP addresses, secrets after a key word, and personal names after a title.

A surrogate is drawn from a keyed hash of the entity's type and normal form, so
one entity has one surrogate in all texts (coreference).  It keeps type and
format: letters stay letters of the same script and case, digits stay digits,
separators stay; a card number keeps its length and whether its check digit is
right; an address stays private or public; a name keeps its script, of whatever letters, and in Latin and Cyrillic its gender
(names of other scripts are drawn letter for letter), and
given and family names are entities of their own, so "Ms Ann Lee" and "Ms Lee"
still agree.

All different entities of the corpus draw in rounds.  A draw is accepted if no
other entity of its type has drawn or been given it, and if it is no entity of
the corpus itself; of several that draw the same, the smallest stays.  The others
draw again.  So surrogates stay distinct, and none is somebody else's data.

Texts without an entity never leave their task.  Texts with entities move once,
to meet their surrogates; the draws are a table joined like any other.

Defined results: null text stays null and empty text empty; overlapping
detections go to the first and longest; repeated rows get equal results; ids may
be null; an empty table gives an empty result; further columns may have any name
and stay as they are.
"""

from __future__ import annotations

import hmac
import ipaddress
import re
import unicodedata
from collections.abc import Callable
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from likeness.llm.tables import free_name, held

KEY = "surrogates-1"
#: Rounds of draws after which a corpus is said to have too many entities of a type.
MAX_ROUNDS = 40

_TITLES_M = "Mr Sir Lord Herr Señor Sr Don Monsieur M Signor господин г-н"
_TITLES_F = "Mrs Ms Miss Lady Frau Fräulein Señora Señorita Sra Srta Doña Madame Mme Mlle Signora госпожа г-жа"
_TITLES_N = "Dr Prof Professor Doktor Doctor"
_GENDER = {
    t.lower(): g
    for g, titles in (("m", _TITLES_M), ("f", _TITLES_F), ("n", _TITLES_N))
    for t in titles.split()
}
_TITLE = "|".join(sorted(map(re.escape, f"{_TITLES_M} {_TITLES_F} {_TITLES_N}".split()), key=len, reverse=True))
#: Combining marks, which \w does not know; a letter of any script, with the marks after it.
_MARKS = "".join(c for c in map(chr, range(0x300, 0x1F000)) if unicodedata.category(c)[0] == "M")
_LETTERS = rf"(?:[^\W\d_][{_MARKS}]*+)++(?!\w)"
_NAME = rf"{_LETTERS}(?:[-'’]{_LETTERS})*"
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,24}\b")
#: Where a number with separators may stand, and what it can be.
_NUMERIC = re.compile(r"(?<![\w.])[+(]?\d[\d ().-]{5,}\d(?!\w)")
_NUMBERS = re.compile(
    r"(?P<ip>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d))"
    r"|(?P<card>(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-]))"
    r"|(?P<phone>(?<![\w.])(?:\+\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:[ .-]?\d{2,4}){2,5}"
    r"|\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}|\d{3}[-.]\d{3}[-.]\d{4})(?!\w))"
    r"|(?P<national>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
)
_IBAN = re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")
_SECRET = re.compile(
    r"(?:[:=]\s*|(?i:bearer) )[\"']?(?P<secret>[A-Za-z0-9_+/-]{16,}={0,2})(?![A-Za-z0-9_+/=-])"
)
_SECRET_NAME = re.compile(
    r"(?i:token|secret|password|passwd|pwd|key|bearer|auth|authorization|credential)s?[\"']?\s*\Z"
)
#: The name is looked ahead at, so that a title among its words is found as well.
_NAMED = re.compile(rf"(?<!\w)(?P<title>{_TITLE})\.?[ ](?=(?P<name>{_NAME}(?:[ ]{_NAME}){{0,2}}))")
_JOINT = re.compile("([-'’])")
_TITLE_WORDS = frozenset(f"{t}{dot}" for t in _GENDER for dot in ("", "."))

#: Given names by script and gender, and syllables of family names by script.
_GIVEN = {
    ("latin", "m"): "Adam Bruno Carl David Emil Felix Hugo Ivan Jonas Kevin Lucas Martin Noel Oscar Paul Simon".split(),
    ("latin", "f"): "Alice Bella Clara Diana Emma Flora Hanna Irene Julia Karin Laura Maria Nora Olga Paula Sara".split(),
    ("latin", "n"): "Alex Andrea Chris Dana Eden Jamie Kim Lee Marion Noa Robin Sam Sasha Toni Val Yael".split(),
    ("cyrillic", "m"): "Андрей Борис Виктор Денис Егор Иван Кирилл Максим".split(),
    ("cyrillic", "f"): "Анна Вера Дарья Елена Ирина Мария Нина Ольга".split(),
    ("cyrillic", "n"): "Саша Женя Валя".split(),
}
_SYLLABLES = {
    "latin": "bar ben dor fel gan hol kar len mar nor pel ran sel tor val wen".split(),
    "cyrillic": "бар вол гор дан кар лев мар нор пол рад сар тол".split(),
}


def _script_of(letter: str) -> str:
    return unicodedata.name(letter, "?").partition(" ")[0].lower()


def _script(text: str) -> str:
    """The script of a name: Cyrillic if any letter is, or else that of its first letter."""
    scripts = [_script_of(c) for c in text if c.isalpha()]
    return "cyrillic" if "cyrillic" in scripts else (scripts or ["latin"])[0]


@cache
def _letters(script: str, kind: str, block: int) -> list[str]:
    """The plain letters of a script that may stand for one of that category in that block."""
    around = range(0x4E00, 0x9FA6) if script == "cjk" else range(block << 7, (block + 1) << 7)
    if script == "hangul":
        around = range(0xAC00, 0xD7A4)
    return [
        c
        for c in map(chr, around)
        if unicodedata.category(c) == kind and _script_of(c) == script
        and c.casefold() == c and (script == "hangul" or not unicodedata.decomposition(c))
    ]


def _letter_like(c: str, draw: _Draw) -> str:
    pool = _letters(_script_of(c), unicodedata.category(c), ord(c) >> 7) if c.isalpha() else []
    return pool[draw.below(len(pool))] if len(pool) > 1 else c


def _names(words: list[str]) -> list[str]:
    """The words, from the first on, that are written like names.

    In scripts with case these begin with a capital and have two letters; in
    scripts without, the first two words are taken, and of a run of more than four
    Chinese or Japanese characters, which has no spaces, the first three.
    """
    made: list[str] = []
    for word in words:
        first = word[0]
        if first.islower():
            break
        kept = _JOINT.split(word)
        if first.isupper() or first.istitle():
            while len(kept) > 1 and kept[-1][0].islower():
                del kept[-2:]
            name = "".join(kept)
            if sum(map(str.isalpha, name)) < 2:
                break
        elif len(made) == 2:
            break
        else:
            long = len(word) > 4 and _script_of(first) in ("cjk", "hiragana", "katakana")
            name = word[:3] if long else word
        made.append(name)
        if name != word:
            break
    return made


def _matches(text: str) -> list[tuple[int, int, str, str]]:
    """All detections.  Plain searches decide first whether a pattern can match at all."""
    found = []
    if "@" in text:
        found += [(*m.span(), "email", m[0]) for m in _EMAIL.finditer(text)]
    for place in _NUMERIC.finditer(text):
        for m in _NUMBERS.finditer(text, *place.span()):
            found.append((*m.span(), m.lastgroup, m[0]))
    found += [(*m.span(), "iban", m[0]) for m in _IBAN.finditer(text)]
    for m in _SECRET.finditer(text):
        # What is named must be a secret, and look like one: letters and digits.
        before = text[max(0, m.start() - 40) : m.start()]
        value = m["secret"]
        named = m[0][0] not in ":=" or _SECRET_NAME.search(before)
        if named and re.search(r"\d", value) and re.search(r"[A-Za-z]", value):
            found.append((*m.span("secret"), "secret", value))
    if not _TITLE_WORDS.isdisjoint(text.lower().split()):
        for m in _NAMED.finditer(text):
            gender = _GENDER[m["title"].lower()]
            at, parts = m.start("name"), _names(m["name"].split(" "))
            for i, part in enumerate(parts):
                role = "family" if i == len(parts) - 1 else f"given_{gender}"
                found.append((at, at + len(part), role, part))
                at += len(part) + 1
    return found


def entities(text: str | None) -> list[tuple[int, int, str, str]]:
    """``(start, end, type, normal form)`` of every entity, in order and without overlaps."""
    kept, end = [], 0
    for a, b, kind, value in sorted(_matches(text or ""), key=lambda m: (m[0], -m[1])):
        if a >= end:
            kept.append((a, b, kind, normal(kind, value)))
            end = b
    return kept


def normal(kind: str, value: str) -> str:
    """The form that all ways to write an entity share."""
    if kind in ("phone", "card", "national"):
        return re.sub(r"[^\d+]", "", value)
    if kind == "iban":
        return value.replace(" ", "")
    if kind == "family" or kind.startswith("given"):
        return unicodedata.normalize("NFC", unicodedata.normalize("NFC", value).casefold())
    if kind == "email":
        return value.casefold()
    return value


class _Draw:
    """Numbers from a keyed hash, as many as needed."""

    def __init__(self, key: str, *what: str):
        self.key, self.what, self.n, self.pool = key.encode(), "\x00".join(what), 0, 0
        self.left = 0

    def below(self, n: int) -> int:
        if self.left < 64:
            block = hmac.digest(self.key, f"{self.what}\x00{self.n}".encode(), "sha256")
            self.pool, self.left, self.n = int.from_bytes(block, "big"), 256, self.n + 1
        self.pool, value = divmod(self.pool, n)
        self.left -= n.bit_length()
        return value


def _like(text: str, draw: _Draw) -> str:
    """Letters for letters and digits for digits; a first digit that is not 0 stays so."""
    out = []
    for i, c in enumerate(text):
        if c.isdigit():
            out.append(str(draw.below(10) if i or c == "0" else 1 + draw.below(9)))
        elif "a" <= c <= "z":
            out.append(chr(97 + draw.below(26)))
        elif "A" <= c <= "Z":
            out.append(chr(65 + draw.below(26)))
        else:
            out.append(c)
    return "".join(out)


def _luhn(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def surrogate(kind: str, value: str, key: str, attempt: int) -> str:
    """The draw of an entity, in its normal form."""
    draw = _Draw(key, kind, value, str(attempt))
    if kind == "email":
        local, _, domain = value.partition("@")
        labels = domain.split(".")
        site = _Draw(key, "domain", domain)  # one domain stays one domain
        made = ".".join([*(_like(x, site) for x in labels[:-1]), labels[-1]])
        return f"{_like(local, draw)}@{made}"
    if kind == "ip":
        old = ipaddress.ip_address(value)
        while True:
            if old.is_private and attempt < 16:
                new = ipaddress.ip_address((10 << 24) + draw.below(1 << 24))
            else:
                new = ipaddress.ip_address(draw.below(1 << 32))
            if attempt >= 16 or new.is_global or old.is_private:
                return str(new)
    if kind == "card":
        made = _like(value, draw)
        right = _luhn(value) == 0
        for last in (str((int(made[-1]) + i) % 10) for i in range(10)):
            if (_luhn(made[:-1] + last) == 0) == right:
                return made[:-1] + last
    if kind == "phone":
        # The country code stays; a national number has ten digits at most.
        cut = max(0, len(value) - 10) if value.startswith("+") else 0
        return value[:cut] + _like(value[cut:], draw)
    if kind == "iban":
        return value[:2] + _like(value[2:], draw)
    if kind == "secret" and re.fullmatch(r"[0-9a-fA-F]+", value):
        digits = "0123456789ABCDEF" if value.upper() == value else "0123456789abcdef"
        return "".join(digits[draw.below(16)] for _ in value)
    if (kind == "family" or kind.startswith("given")) and _script(value) not in _SYLLABLES:
        # Letter for letter; later draws are longer, so that short names do not run out.
        more = [c for c in value if c.isalpha()][-1:] * (attempt // 4)
        return "".join(_letter_like(c, draw) for c in [*value, *more])
    if kind.startswith("given"):
        names = _GIVEN[_script(value), kind[-1]]
        made = names[draw.below(len(names))]
        # The lists are short: later draws are double names of the same gender.
        for _ in range(attempt):
            made += "-" + names[draw.below(len(names))]
        return made.casefold()
    if kind == "family":
        parts = _SYLLABLES[_script(value)]
        return "".join(parts[draw.below(len(parts))] for _ in range(2 + attempt % 4 + draw.below(2)))
    return _like(value, draw)


def written_like(drawn: str, original: str, kind: str) -> str:
    """A surrogate in the original's separators and case."""
    if kind in ("phone", "card", "national", "iban"):
        source = iter(drawn.lstrip("+"))
        return "".join(next(source) if c.isalnum() else c for c in original)
    if kind == "family" or kind.startswith("given"):
        return drawn.upper() if original.isupper() and len(original) > 1 else drawn.title()
    if kind == "email" and original.isupper():
        return drawn.upper()
    return drawn


_SPANS = "array<struct<start: int, end: int, kind: string, value: string>>"


def _detect() -> Callable[[Column], Column]:
    names = ("start", "end", "kind", "value")

    @F.pandas_udf(_SPANS)
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [dict(zip(names, e, strict=True)) for e in entities(t)])

    return run


def _drawn(key: str, attempt: int) -> Callable[[Column, Column], Column]:
    @F.pandas_udf("string")
    def run(kinds: pd.Series, values: pd.Series) -> pd.Series:
        pairs = zip(kinds, values, strict=True)
        return pd.Series([surrogate(k, v, key, attempt) for k, v in pairs], dtype=object)

    return run


def assign(found: DataFrame, key: str = KEY) -> DataFrame:
    """``kind, value, surrogate`` for the different entities ``kind, value`` of a corpus."""
    pending = held(found.select("kind", "value").distinct())
    originals, given = pending, None
    for attempt in range(MAX_ROUNDS):
        draws = pending.withColumn("surrogate", _drawn(key, attempt)("kind", "value"))
        taken = originals.select("kind", F.col("value").alias("surrogate"))
        if given is not None:
            taken = taken.unionByName(given.select("kind", "surrogate"))
        free = draws.join(taken, ["kind", "surrogate"], "left_anti")
        won = free.groupBy("kind", "surrogate").agg(F.min("value").alias("value"))
        won = won.select("kind", "value", "surrogate")
        given = held(won if given is None else given.unionByName(won))
        pending = held(pending.join(given, ["kind", "value"], "left_anti"))
        if pending.isEmpty():
            return given
    raise ValueError("Some entities found no surrogate of their own")


def _replaced() -> Callable[[Column, Column, Column], Column]:
    @F.pandas_udf("string")
    def run(texts: pd.Series, spans: pd.Series, drawn: pd.Series) -> pd.Series:
        made = []
        for text, found, pairs in zip(texts, spans, drawn, strict=True):
            by = {(p["kind"], p["value"]): p["surrogate"] for p in pairs}
            out, at = [], 0
            for s in found:
                a, b = s["start"], s["end"]
                out += [text[at:a], written_like(by[s["kind"], s["value"]], text[a:b], s["kind"])]
                at = b
            made.append("".join(out) + text[at:])
        return pd.Series(made, dtype=object)

    return run


def replace_entities(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: str = KEY
) -> DataFrame:
    """``docs`` with surrogates in the text, and ``n_entities`` (named freely) as last column."""
    spans, row, match, drawn = (
        free_name(docs, n) for n in ("spans", "row_key", "match_key", "drawn")
    )
    count = free_name(docs, "n_entities")
    marked = docs.withColumn(spans, _detect()(F.col(text_col).cast("string")))
    plain = marked.where(F.size(spans) == 0).drop(spans).withColumn(count, F.lit(0))
    # Rows that are equal in id and text have equal entities, so they may share a key.
    keyed = marked.where(F.size(spans) > 0).withColumn(row, F.xxhash64(id_col, text_col))
    uses = held(
        keyed.select(F.col(row).alias("row"), F.explode(spans).alias("e"))
        .select("row", "e.kind", "e.value")
        .distinct()
    )
    pairs = (
        uses.join(assign(uses, key), ["kind", "value"])
        .groupBy(F.col("row").alias(match))
        .agg(F.collect_list(F.struct("kind", "value", "surrogate")).alias(drawn))
    )
    changed = (
        keyed.join(pairs, F.col(row) == F.col(match))
        .withColumn(text_col, _replaced()(F.col(text_col), F.col(spans), F.col(drawn)))
        .withColumn(count, F.size(spans))
    )
    columns = [*docs.columns, count]
    return plain.select(*columns).unionByName(changed.select(*columns))
