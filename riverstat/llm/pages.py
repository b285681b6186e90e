"""Main text of web pages by tag-path ratios.

Text nodes are grouped by the path of tags from the root to them. For each path the text length and the punctuation are
summed and divided by its number of nodes; both ratios are smoothed over the sequence of the nodes in the page, fused by
multiplication, and nodes above a share of the mean are content. Where `article` and `main` elements hold half of the
content's characters or more, the smallest element around all of them that have content is chosen (a single one itself);
else the smallest container around all content nodes, which is never a text block such as a paragraph, a list or a table
itself. Ratios select no single blocks, which would lose headings and short paragraphs: all blocks inside that element are
returned, in page order, but for parts that are marked as something else: menus, headers, footers, side bars, notices,
adverts, forms, scripts, styles and comments, by their tag, role, class or id.

A form and a word in a class or id may also belong to a wrapper (`no-sidebar`, a form around the page). So their text is read
too, and such a mark is lifted where the element holds most of the content: more than half of the characters of content
nodes that it and all unmarked parts hold. Where the class or id is the word alone (`comments`), no unmarked part may hold a
content node. Where an unmarked article has text, only wrappers of other articles come into question, from nine tenths on.
Inside an article, a word that may also be the article's subject (`social-science`, `share-price`) and is not the whole
class or id does not drop a part whose blocks' path ratios are half of those of unmarked text or more. A `main` element with
content lifts the marks around it. The marks inside a lifted element are judged in their turn. So a page
that has nothing but, say, a cookie notice gives that notice.

Elements nested deeper than 512 are taken as siblings, as browsers do. Pages are read whole; unclosed and stray tags are tolerated as browsers do in the common cases (a paragraph ends where the
next block begins, a list item at the next one, an end tag closes what is open inside it).

Defined cases: null or empty html, and pages without text, give an empty text; equal rows are treated alike; other columns
are kept.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import with_struct

# Names of elements, of roles, and words in class and id attributes.
RAW = "script style textarea title xmp iframe noembed noframes plaintext".split()
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr br img".split()
)
DROPPED = frozenset(
    "head script style noscript template nav footer aside button select option textarea iframe svg canvas object"
    " dialog menu audio video map title noembed noframes".split()
)
DROPPED_ROLES = frozenset("navigation banner complementary contentinfo search menu menubar alert dialog".split())
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent"
    " gdpr notice notification alert sidebar menu nav navbar navigation breadcrumb breadcrumbs footer comment comments"
    " disqus respond replies share sharing social related recommended newsletter subscribe subscription popup modal overlay"
    " paywall pagination pager toolbar login signup widget masthead".split()
)
HEADER_WORDS = frozenset("header topbar site-header".split())
SUBJECT_WORDS = frozenset(
    "promotion banner notice notification alert menu navigation share sharing social related recommended popup modal overlay"
    " toolbar widget".split()
)
DEEPEST = 512
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NO_CONTAINERS = INLINE | HEADINGS | frozenset(  # text blocks and what is part of one
    "p pre blockquote address figure figcaption ul ol li dl dt dd table caption colgroup thead tbody tfoot tr td th details"
    " summary fieldset legend label hgroup".split()
)
CLOSED_BY = {  # an open element of the first kind ends where one of the second begins
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"]),
}
SCOPES = frozenset("ul ol dl table body article main section div nav aside footer header form blockquote".split())

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<![^>]*>|<\?[^>]*>"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.DOTALL,
)
_CLOSE = {name: re.compile(rf"</{name}\b", re.IGNORECASE) for name in RAW}
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。、，！？]")


@dataclass
class _Element:
    name: str
    number: int
    path: str
    dropped: bool
    above: tuple[int, ...]  # numbers of the elements around it and its own
    marks: tuple[int, ...]  # those of them that are marked


@dataclass
class _Block:
    """Text that is set as one: its parts, the elements around it, its path."""

    above: tuple[int, ...]
    marks: tuple[int, ...]
    path: str
    parts: list[str] = field(default_factory=list)


# a mark that may be the subject, a mark among others, a mark that names the element, a mark that always holds
KEPT, SUBJECT, MARKED, NAMED, GONE = range(5)


def _mark(name: str, rest: str, inside_article: bool) -> int:
    if name in DROPPED or (name == "header" and not inside_article):
        return GONE
    mark = MARKED if name == "form" else KEPT
    if "=" not in rest:
        return mark
    for key, *values in _ATTRIBUTE.findall(rest):
        key, value = key.lower(), "".join(values)
        if key == "role" and value.lower() in DROPPED_ROLES:
            return GONE
        if key == "role" and value.lower() == "form":
            mark = max(mark, MARKED)
        if key in ("class", "id") and name not in ("body", "html", "article", "main"):
            marks = DROPPED_WORDS if inside_article else DROPPED_WORDS | HEADER_WORDS
            met = marks.intersection(w.lower() for w in _WORD.findall(value))
            if met and not marks.isdisjoint(value.lower().split()):
                mark = max(mark, NAMED)
            elif met:
                mark = max(mark, SUBJECT if inside_article and met <= SUBJECT_WORDS else MARKED)
    return mark


class _Reader:
    """Reads a page into blocks of text outside of parts that are gone; what may be dropped has marks."""

    def __init__(self) -> None:
        self.blocks: list[_Block] = []
        self.articles: list[_Element] = []
        self.marked: dict[int, _Element] = {}
        self.named: set[int] = set()
        self.subjects: set[int] = set()
        self.containers = {0}
        self._open = [_Element("", 0, "", False, (0,), ())]
        self._made = 0
        self._block: _Block | None = None
        self._article = 0  # open article or main elements

    def _pop(self, to: int) -> None:
        for element in self._open[to:]:
            if element.name not in INLINE:
                self._block = None
            self._article -= element.name in ("article", "main")
        del self._open[to:]

    def _start(self, name: str, rest: str) -> None:
        if name not in INLINE:
            self._block = None
            if name not in VOID:
                for at in range(len(self._open) - 1, 0, -1):
                    open_name = self._open[at].name
                    if open_name == "p" or name in CLOSED_BY.get(open_name, ()):
                        self._pop(at)
                        break
                    if open_name in SCOPES:
                        break
        if name in VOID:
            if name == "br":
                self.text(" ")
            return
        mark = _mark(name, rest, self._article > 0)
        dropped = self._open[-1].dropped or mark == GONE
        if len(self._open) > DEEPEST:
            self._pop(DEEPEST)
        top = self._open[-1]
        self._made += 1
        above, marks = (*top.above, self._made), top.marks
        if mark in (SUBJECT, MARKED, NAMED):
            marks = (*marks, self._made)
        element = _Element(name, self._made, f"{top.path}/{name}", dropped, above, marks)
        self._open.append(element)
        if mark in (SUBJECT, MARKED, NAMED) and not dropped:
            self.marked[self._made] = element
            if mark == NAMED:
                self.named.add(self._made)
            if mark == SUBJECT:
                self.subjects.add(self._made)
        if name not in NO_CONTAINERS:
            self.containers.add(self._made)
        if name in ("article", "main"):
            self._article += 1
            if not dropped:
                self.articles.append(element)

    def _end(self, name: str) -> None:
        for at in range(len(self._open) - 1, 0, -1):
            if self._open[at].name == name:
                self._pop(at)
                return
            if name in INLINE and self._open[at].name not in INLINE:
                return

    def text(self, raw: str) -> None:
        top = self._open[-1]
        if top.dropped or not raw:
            return
        if self._block is None:
            if raw.isspace():
                return
            around = next(x for x in reversed(self._open) if x.name not in INLINE)
            self._block = _Block(around.above, top.marks, top.path)
            self.blocks.append(self._block)
        self._block.parts.append(raw)

    def read(self, page: str) -> None:
        at = 0
        while (token := _TOKEN.search(page, at)) is not None:
            self.text(page[at:token.start()])
            at = token.end()
            if token["name"] is None:
                continue
            name = token["name"].lower()
            if token["end"]:
                self._end(name)
                continue
            self._start(name, token["rest"])
            if name in _CLOSE:
                close = _CLOSE[name].search(page, at)
                to = close.start() if close else len(page)
                self.text(page[at:to])
                at = to
        self.text(page[at:])


def _weights(paths: list[str], texts: list[str]) -> np.ndarray:
    """Fused ratios of each block's path, smoothed over the sequence of blocks."""
    names, index = np.unique(paths, return_inverse=True)
    count = np.bincount(index, minlength=len(names))
    length = np.bincount(index, [len(t) for t in texts], len(names)) / count
    marks = np.bincount(index, [len(_PUNCTUATION.findall(t)) for t in texts], len(names)) / count
    kernel = np.array([0.25, 0.5, 0.25])
    smooth = [np.convolve(np.pad(x[index], 1, mode="edge"), kernel, "valid") for x in (length, marks)]
    return smooth[0] * (smooth[1] + 0.1)


def _content(found: list[tuple[_Block, str]]) -> tuple[np.ndarray, np.ndarray]:
    """Whether each block is a content node, and its characters if it is."""
    weight = _weights([b.path for b, _ in found], [t for _, t in found])
    content = weight >= 0.3 * weight.mean()
    return content, np.array([len(t) for _, t in found]) * content


def _held(found: list[tuple[_Block, str]], size: np.ndarray, numbers: set[int]) -> int:
    """Characters of content nodes inside any of the elements."""
    return int(sum(n for (b, _), n in zip(found, size) if not numbers.isdisjoint(b.above)))


def _subjects(reader: _Reader, found: list[tuple[_Block, str]]) -> set[int]:
    """Elements marked by what may be the subject whose own blocks have the path ratios of unmarked text."""
    weight = _weights([b.path for b, _ in found], [t for _, t in found])
    plain = [w for (b, _), w in zip(found, weight) if reader.subjects.issuperset(b.marks) and not b.marks]
    if not reader.subjects or not plain:
        return set(reader.subjects)
    own: dict[int, list[float]] = {}
    for (block, _), w in zip(found, weight):
        if block.marks:
            own.setdefault(block.marks[-1], []).append(w)
    least = 0.5 * float(np.mean(plain))
    return {n for n in reader.subjects if n not in own or np.mean(own[n]) >= least}


def _inside(found: list[tuple[_Block, str]], size: np.ndarray, numbers: dict[int, _Element]) -> dict[int, int]:
    """Characters of content nodes inside each of the elements that holds some."""
    held: dict[int, int] = {}
    for (block, _), n in zip(found, size.tolist()):
        if n:
            for number in block.marks:
                if number in numbers:
                    held[number] = held.get(number, 0) + n
    return held


def _lifted(reader: _Reader, found: list[tuple[_Block, str]]) -> set[int]:
    """Marked elements that hold the content, so their marks do not drop them."""
    _, size = _content(found)
    lifted = _subjects(reader, found)
    for article in reader.articles:
        if article.name == "main" and _held(found, size, {article.number}):
            lifted.update(article.marks)
    holding = _inside(found, size, reader.marked)
    wrappers = {n for a in reader.articles for n in a.above}
    while True:
        free = [((b, ""), n) for (b, _), n in zip(found, size) if lifted.issuperset(b.marks)]
        articles = {a.number for a in reader.articles if lifted.issuperset(a.marks)}
        article = any(not articles.isdisjoint(b.above) for (b, _), _ in free)
        total = int(sum(n for _, n in free))
        free_inside = _inside([x for x, _ in free], np.array([n for _, n in free]), holding)
        best = (0.0, 0)
        for number, held in holding.items():
            if number in lifted or not lifted.issuperset(reader.marked[number].marks[:-1]):
                continue
            around, named = number in wrappers, number in reader.named
            share = held / (held + total - free_inside.get(number, 0))
            if article and (named or not around) or named and share < 1:
                continue
            if share > (0.9 if article else 0.5):
                best = max(best, (share + around, -number))  # one around an article first
        if not best[0]:
            return lifted
        lifted.add(-best[1])


def _around(chains: list[tuple[int, ...]]) -> tuple[int, ...]:
    """The elements that all of the chains have in common, outermost first."""
    least, most = min(chains), max(chains)  # those that differ first
    same = next((at for at, (x, y) in enumerate(zip(least, most)) if x != y), min(len(least), len(most)))
    return least[:same]


def main_text(page: str | None) -> str:
    """The article's blocks, joined by empty lines."""
    if not page:
        return ""
    reader = _Reader()
    reader.read(page)
    found = [(b, " ".join(html.unescape("".join(b.parts)).split())) for b in reader.blocks]
    found = [(b, t) for b, t in found if t]
    if not found:
        return ""
    if any(b.marks for b, _ in found):
        lifted = _lifted(reader, found)
        found = [(b, t) for b, t in found if lifted.issuperset(b.marks)]
        if not found:
            return ""
    content, size = _content(found)
    articles = [a for a in reader.articles if _held(found, size, {a.number})]
    if articles and 2 * _held(found, size, {a.number for a in articles}) >= size.sum():
        chosen = _around([a.above for a in articles])[-1]
    else:
        around = _around([b.above for (b, _), of in zip(found, content) if of])
        chosen = next(number for number in reversed(around) if number in reader.containers)
    return "\n\n".join(t for b, t in found if chosen in b.above)


_FIELDS = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])


def extract(pages: DataFrame, column: str = "html", into: str = "main") -> DataFrame:
    """Add a struct of `text` and `n_chars` (its code points)."""

    def start():
        def compute(texts):
            found = [main_text(t) for t in texts]
            return [pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())]

        return compute

    return with_struct(pages, column, into, _FIELDS, start)
