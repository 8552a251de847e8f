"""HTML extraction by tag-path ratios.

A page is read once into text leaves, each with its root-to-leaf tag path (tag,
and first class or id without digits).  Leaves of elements that never hold main
text (scripts, forms, navigation, ...) or whose class or id says so are left
out, unless it holds the page's article or most of its paragraph text.  For every path of the page text length and punctuation are aggregated and
taken per leaf; the two ratios are fused by their product, less the share of
link text, and smoothed over neighbouring paths in page order.  Paths above a
share of the best smoothed ratio are content.  The main text is every leaf of a path
that is content by its own ratio, all of the articles (or main elements) that hold
such leaves, what lies between the first and the last of them in their innermost
common element with the headings before, and the smallest element that holds nearly
all the content's text.  Link lists go only from what that last one adds.

Text of one block is joined as it stands, white space becomes one space, and the
blocks are joined by one space in page order.  Character references are decoded
once.  A page is worked on in one pass whose memory is in proportion to it.

Defined results: null and empty pages, and pages without text, give an empty
text; unclosed and stray tags are tolerated, and an unclosed script or comment
runs to the end; repeated rows are extracted each; further columns may have any
name; null ids and urls are kept.
"""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# One token: a comment, declaration or tag.  Possessive, so no input makes it backtrack.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|"
    r"</?([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>|"
    r"</?([a-zA-Z][^\s/>]*+)([^>]*+)>",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_SPACES = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，！？]")
_WORDS_IN_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: Elements whose content is no markup.
RAW = frozenset("script style textarea title noscript template iframe xmp noframes".split())
#: Elements that hold no main text.
OUT = RAW | frozenset(
    "head nav footer aside form button select option input label fieldset svg canvas object "
    "audio video map dialog menu".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "html head body address article aside blockquote center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav "
    "ol p pre section summary table tbody td tfoot th thead title tr ul br button select option".split()
)
#: Elements that a start tag of the same set closes.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
#: Where the search for an element to close stops.
SCOPES = frozenset("html body table ul ol dl select article section div main aside nav".split())
#: Words of a class, id or role that mark what is not main text.
OUT_NAMES = frozenset(
    """
    ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner
    nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar side footer masthead
    topbar toolbar comment comments commentlist disqus reply replies respond discussion notice
    notices alert cookie cookies consent gdpr newsletter subscribe subscription signup login
    share sharing social related recommended widget popup modal overlay form search pagination
    pager copyright disclaimer contentinfo complementary skip outbrain taboola
    """.split()
)
#: Of these, the ones for what readers write, which may be longer than the article.
COMMENTS = frozenset("comment comments commentlist disqus reply replies respond discussion".split())
#: First and last words of a class that say something about the page around the element.
ABOUT_FIRST = frozenset("no not has have with without is hide hides".split())
ABOUT_LAST = frozenset("open opened closed enabled disabled on off none price prices".split())
#: Share of the page's paragraph text from which a name does not mark an element.
MOST_TEXT, MOST_COMMENTS = 0.5, 0.9
#: Share of the best smoothed ratio from which a path is content; share of the
#: content's text that its element holds.
LEAST_RATIO, LEAST_HELD = 0.15, 0.85
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())


class _Element:
    __slots__ = ("tag", "name", "out", "link", "parent", "marks", "in_p", "said", "articles")

    def __init__(self, tag: str, name: str, out: bool, parent: _Element | None, marks: set[str]):
        self.tag, self.name, self.out, self.parent, self.marks = tag, name, out, parent, marks
        self.link = tag == "a" or (parent is not None and parent.link)
        self.in_p = tag == "p" or (parent is not None and parent.in_p)
        self.said = self.articles = 0  # characters in paragraphs, article and main elements


def _marks(names: str) -> set[str]:
    """The words of classes, ids or a role that mark what is not main text."""
    found: set[str] = set()
    for name in names.split():
        words = [w.lower() for w in _WORDS_IN_NAME.findall(name)]
        if words and (len(words) == 1 or not (words[0] in ABOUT_FIRST or words[-1] in ABOUT_LAST)):
            found.update(OUT_NAMES.intersection(words))
    return found


def _element(tag: str, attributes: str, parent: _Element | None, in_main: bool) -> _Element:
    names, marks, hidden = [], set(), False
    for key, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        key, value = key.lower(), next(filter(None, values), "")
        if key in ("class", "id", "role"):
            names.append(value)
            marks |= _marks(value)
        elif key == "hidden":
            hidden = hidden or value.lower() != "false"
        elif key == "aria-hidden":
            hidden = hidden or value.strip().lower() == "true"
        elif key == "style":
            hidden = hidden or bool(_NOT_SHOWN.search(value))
    out = tag in OUT or (tag == "header" and not in_main) or hidden or bool(parent and parent.out)
    if tag in ("html", "body", "article", "main"):
        marks = set()
    name = f"{tag}.{_DIGITS.sub('', names[0])}" if names else tag
    return _Element(tag, name, out, parent, marks)


def _drop_marked(elements: list[_Element]) -> None:
    """Leave out what a class, id or role marks, but no element that holds the page's text.

    That is one with most of the paragraph text, or with an article or main
    element, where no article or main element stands outside of it.
    """
    said = articles = 0
    for e in reversed(elements):
        e.articles += e.tag in ("article", "main") and not e.out
        if e.parent is not None:
            e.parent.said += e.said
            e.parent.articles += e.articles
        else:
            said += e.said
            articles += e.articles
    for e in elements:
        if e.parent is not None and e.parent.out:
            e.out = True
        elif e.marks and not e.out:
            most = MOST_TEXT if e.marks.isdisjoint(COMMENTS) else MOST_COMMENTS
            holds = e.articles > 0 and e.marks.isdisjoint(COMMENTS) or e.said > most * said
            e.out = not (holds and e.articles == articles)


def leaves(page: str) -> list[tuple[tuple[str, ...], int, bool, str, _Element | None]]:
    """``(path, block, in a link, text, element)`` of every text leaf that may be main text."""
    seen: list[tuple[_Element | None, int, str]] = []
    elements: list[_Element] = []
    stack: list[_Element] = []
    block, at, size = 0, 0, len(page)

    def text(a: int, b: int) -> None:
        if a < b and not (stack and stack[-1].out):
            said = html.unescape(page[a:b])
            if stack and stack[-1].in_p:
                stack[-1].said += len(said.strip())
            seen.append((stack[-1] if stack else None, block, said))

    while at < size:
        token = _TOKEN.search(page, at)
        if token is None:
            text(at, size)
            break
        text(at, token.start())
        at = token.end()
        tag = (token[1] or token[3] or "").lower()
        if not tag:
            continue
        if page[token.start() + 1] == "/":
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if stack[i].tag in SCOPES and tag not in SCOPES:
                    break
            block += tag in BLOCK
            continue
        attributes = token[2] or token[4] or ""
        if tag in BLOCK:
            block += 1
            if tag != "br":
                closed = CLOSES.get(tag, set()) | {"p"}
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i].tag in closed:
                        del stack[i:]
                        break
                    if stack[i].tag in SCOPES:
                        break
        if tag in VOID:
            continue
        in_main = any(e.tag in ("article", "main") for e in stack)
        stack.append(_element(tag, attributes, stack[-1] if stack else None, in_main))
        elements.append(stack[-1])
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            stack.pop()
            at = end.end() if end else size
    _drop_marked(elements)
    found, paths = [], {}
    for element, number, said in seen:
        if element is None or not element.out:
            if element not in paths:
                paths[element] = tuple(e.name for e in reversed(_chain(element)))
            found.append((paths[element], number, element is not None and element.link, said, element))
    return found


def _chain(element: _Element | None) -> list[_Element]:
    """An element and those around it, from the inside."""
    made = []
    while element is not None:
        made.append(element)
        element = element.parent
    return made


def _smoothed(ratios: list[float]) -> list[float]:
    """Each ratio with its neighbours in page order, weighed 1, 2, 1."""
    last = len(ratios) - 1
    return [
        (2 * r + ratios[max(0, i - 1)] + ratios[min(last, i + 1)]) / 4
        for i, r in enumerate(ratios)
    ]


def content_paths(found: list[tuple]) -> tuple[dict[tuple[str, ...], int], set[tuple[str, ...]]]:
    """Characters of the content paths, and those that are so without their neighbours."""
    paths: dict[tuple[str, ...], list[int]] = {}  # leaves, characters, punctuation, in links
    for path, _, link, text, _ in found:
        chars = len(text) - text.count(" ")
        if not text.isspace() and chars:
            row = paths.setdefault(path, [0, 0, 0, 0])
            row[0] += 1
            row[1] += chars
            row[2] += len(_PUNCTUATION.findall(text))
            row[3] += chars if link else 0
    if not paths:
        return {}, set()
    fused = [
        chars / n * (1 + marks / n) * (1 - links / chars) for n, chars, marks, links in paths.values()
    ]
    smooth = _smoothed(fused)
    least = LEAST_RATIO * max(smooth)
    content = {p: paths[p][1] for p, s in zip(paths, smooth, strict=True) if s >= least}
    own = {p for p, f in zip(paths, fused, strict=True) if p in content and f >= least}
    return content, own


def content_element(content: dict[tuple[str, ...], int]) -> tuple[str, ...]:
    """The path of the smallest element that holds nearly all content paths' text."""
    total = sum(content.values())
    element: tuple[str, ...] = ()
    while True:
        below: dict[str, int] = {}
        for path, chars in content.items():
            if len(path) > len(element) and path[: len(element)] == element:
                below[path[len(element)]] = below.get(path[len(element)], 0) + chars
        best = max(below, key=below.get, default=None)
        if best is None or below[best] < LEAST_HELD * total:
            return element
        # A paragraph is no element to stop in: its neighbours belong to the text.
        if best.partition(".")[0] in ("p", "b", "i", "em", "strong", "span", "a", "blockquote"):
            return element
        element = (*element, best)


def _article(element: _Element | None) -> _Element | None:
    """The outermost article around an element, or else the outermost main element."""
    around = _chain(element)
    return next(
        (e for tag in ("article", "main") for e in reversed(around) if e.tag == tag), None
    )


def _common(elements: list[_Element | None]) -> _Element | None:
    """The innermost element around all of them; None is the page."""
    shared = _chain(elements[0])[::-1]
    for element in dict.fromkeys(elements):
        other = _chain(element)[::-1]
        same = 0
        while same < min(len(shared), len(other)) and shared[same] is other[same]:
            same += 1
        del shared[same:]
    return shared[-1] if shared else None


def _text_parts(found: list[tuple], own: set[tuple[str, ...]]) -> list[bool]:
    """Which leaves are in the article, or between leaves of content paths."""
    chosen = [i for i, f in enumerate(found) if f[0] in own and not f[3].isspace()]
    kept = [False] * len(found)
    if not chosen:
        return kept
    articles = {_article(found[i][4]) for i in chosen} - {None}
    inside: dict[_Element | None, bool] = {}

    def within(element: _Element | None, of: set[_Element | None]) -> bool:
        if element not in inside:
            inside[element] = None in of or any(e in of for e in _chain(element))
        return inside[element]

    if articles:
        for i, f in enumerate(found):
            kept[i] = within(f[4], articles)
        for i in chosen:
            kept[i] = True
        inside.clear()
        # What lies between is text in an element of its own, not all over the page.
        roots = {e for e in (_common([found[i][4] for i in chosen]),) if e and e.tag in ("article", "main")}
        if not roots:
            return kept
    else:
        roots = {_common([found[i][4] for i in chosen])}
    first, last = chosen[0], chosen[-1]
    headings = {e: any(x.tag in HEADINGS for x in _chain(e)) for e in {f[4] for f in found}}
    while first and (headings[found[first - 1][4]] or found[first - 1][3].isspace()):
        first -= 1
    for i in range(first, last + 1):
        kept[i] = kept[i] or within(found[i][4], roots)
    return kept


def main_text(page: str | None) -> str:
    """The main text of a page."""
    found = leaves(page or "")
    content, own = content_paths(found)
    element = content_element(content)
    depth = len(element)
    sure = _text_parts(found, own)
    blocks: dict[int, list[str]] = {}
    linked: dict[int, list[int]] = {}
    in_text: set[int] = set()
    for (path, block, link, text, _), part in zip(found, sure, strict=True):
        if part or path[:depth] == element:
            blocks.setdefault(block, []).append(text)
            counts = linked.setdefault(block, [0, 0])
            counts[link] += len(text.strip())
            if part:
                in_text.add(block)
    made = []
    for block, parts in blocks.items():
        joined = _SPACES.sub(" ", "".join(parts)).strip()
        # Link lists go where they are outside of the text.
        if joined and (block in in_text or not linked[block][1] > 2 * linked[block][0]):
            made.append(joined)
    return " ".join(made)


@F.pandas_udf(StringType())
def _main_texts(pages: pd.Series) -> pd.Series:
    return pages.map(main_text)


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``page_id, url, text`` for every row of ``pages``."""
    return pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).alias("url"),
        _main_texts(F.col(html_col).cast("string")).alias("text"),
    )
