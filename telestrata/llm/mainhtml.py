"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams events; block elements cut the page into lines. Each line
has a text-to-tag ratio: its characters outside links, over the tags since the line before. Ratios
are smoothed over neighbouring lines with a Gaussian and split by a threshold: lines at or above
one deviation (or the mean, if that is lower) are dense.

Dense lines select content regions. Elements that name themselves something else (navigation,
footers, asides, forms, and blocks whose class, id or role says advert, comment, notice and so
on) are no lines at all. Where the page marks articles and at least a third of the dense
characters lie in them, the articles are the regions. Otherwise the region lies in the innermost
element that holds at least ``MAJORITY`` of the dense characters, from the first to the last dense
line there and with a heading before it. All lines of a region count, also short ones, except
those that are mostly links and not dense.

Lines hold decoded text with single spaces, and are joined by two line breaks.

Defined cases: a null or empty page, and one without lines, has an empty text. Elements left
open end with their parents or the page, and end tags without a start are ignored. Malformed
declarations are comments. Pages don't influence each other; repeated rows get equal results and
extra columns play no part. A long page is handled as a whole by one task.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telestrata.llm.common import ship

RADIUS, SIGMA = 2, 1.0  # lines on each side that the smoothing covers, and its width
MAJORITY = 0.7
IN_ARTICLES = 1 / 3
LINKED = 0.5  # share of a line from which on it is mostly links

# Names of elements and words in class, id and role.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li legend main menu nav ol "
    "p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset(
    "aside audio button canvas datalist dialog footer form head iframe input label math menu nav "
    "noframes noscript object option script select style svg template textarea title video".split()
)
ARTICLES = frozenset(("article", "main"))
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation "
    "search status toolbar".split()
)
LABELS = frozenset(
    "ad ads adbox adsense adslot advert adverts advertisement advertising alert banner breadcrumb "
    "breadcrumbs comment comments commentlist consent cookie cookies copyright discussion disqus "
    "footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices "
    "notification outbrain overlay pager pagination popup promo promoted promotion recommendation "
    "recommendations recommended related replies reply respond responses share sharing sidebar "
    "signup skip social sponsor sponsored sponsors subscribe subscription taboola toolbar topbar".split()
)
# A header is a part of these, and names that begin so tell of something elsewhere.
CONTENT = frozenset("article entry post story".split())
ELSEWHERE = frozenset("has no with without".split())
DEEPEST = 50  # blocks inside each other that are told apart
_LABEL = re.compile(r"[a-z]+|[A-Z][a-z]*")
_HIDDEN = re.compile(r"(?i)display\s*:\s*none|visibility\s*:\s*hidden")
# Starting one of these ends an open paragraph; a new item or cell ends the one before it.
_ENDS_PARAGRAPH = BLOCKS - {"caption", "html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "legend", "summary"}
_SAME_LEVEL = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",), "option": ("option",)}


def labels(value: str) -> set[str]:
    """The words of a class or id, in lower case: of ``adBox top-nav has-menu`` the first four."""
    said: set[str] = set()
    for name in value.split():
        words = [w.lower() for w in _LABEL.findall(name)]
        if words and words[0] not in ELSEWHERE:
            said.update(words, re.split(r"[^a-z]+", name.lower()))
    return said


def names_something_else(tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> bool:
    """Whether an element says that it isn't part of the main text."""
    if tag in SKIPPED or tag == "header" and not in_article:
        return True
    if tag in ("html", "body", "main"):
        return False
    for name, value in attrs:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and value and _HIDDEN.search(value):
            return True
        if name == "role" and value and value.strip().lower() in ROLES:
            return True
        if name in ("class", "id") and value:
            said = labels(value)
            if said & LABELS or "header" in said and not in_article and not said & CONTENT:
                return True
    return False


class Line:
    """One block of text: its words, ratio and the elements around it."""

    __slots__ = ("text", "ratio", "linked", "path", "heading")

    def __init__(self, text: str, tags: int, linked: int, path: tuple[int, ...], heading: bool):
        self.text, self.path, self.heading = text, path, heading
        self.linked = linked / len(text)
        self.ratio = max(len(text) - linked, 0) / max(tags, 1)


class LineReader(HTMLParser):
    """Collects the lines of a page from parser events."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.articles: set[int] = set()
        self._open: list[tuple[str, int, bool]] = []  # name, blocks around it, and whether it is left out
        self._held: dict[str, int] = {}  # open elements by name
        self._blocks: tuple[int, ...] = ()
        self._parts: list[str] = []
        self._linked: list[str] = []
        self._tags = self._number = self._left_out = self._links = 0

    # Elements

    def handle_starttag(self, tag, attrs):
        self._tags += not self._left_out
        if tag == "br":
            self.handle_data(" ")
        if tag == "a" and self._links:
            self._close("a", stop=())
        if tag in BLOCKS:
            self._end_line()
            if self._held.get("head"):
                self._close("head", stop=())
            if tag in _ENDS_PARAGRAPH and self._held.get("p"):
                self._close("p", stop=("td", "th", "table"))
            for other in _SAME_LEVEL.get(tag, ()):
                if self._held.get(other):
                    self._close(other, stop=("ul", "ol", "dl", "table", "menu", "dir"))
        if tag in VOID:
            return
        in_article = any(self._held.get(a) for a in ARTICLES)
        out = names_something_else(tag, attrs, in_article)
        self._number += 1
        self._open.append((tag, len(self._blocks), out))
        self._held[tag] = self._held.get(tag, 0) + 1
        self._left_out += out
        self._links += tag == "a"
        if tag in BLOCKS and tag not in ("html", "body") and len(self._blocks) < DEEPEST:
            self._blocks += (self._number,)
        if tag in ARTICLES and not self._left_out and self._blocks:
            self.articles.add(self._number)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._tags += not self._left_out
        if tag in BLOCKS:
            self._end_line()
        if self._held.get(tag):
            # Inline elements don't reach out of their block.
            self._close(tag, stop=() if tag in BLOCKS else BLOCKS)

    def _close(self, tag: str, stop) -> None:
        """Close the innermost open ``tag`` and all in it, unless one of ``stop`` lies between."""
        at = len(self._open) - 1
        while at >= 0 and self._open[at][0] != tag:
            if self._open[at][0] in stop:
                return
            at -= 1
        if at < 0:
            return
        self._blocks = self._blocks[: self._open[at][1]]
        for name, _, out in self._open[at:]:
            self._held[name] -= 1
            self._left_out -= out
            self._links -= name == "a"
        del self._open[at:]

    # Text

    def handle_data(self, data):
        if not self._left_out:
            self._parts.append(data)
            if self._links:
                self._linked.append(data)

    # The page is fed as a whole, so what has no end ends with the page. The base class would look
    # for the end again and again.

    def _endless(self, i: int, end: str = ">") -> bool:
        return self.rawdata.find(end, i) < 0

    def parse_starttag(self, i):
        return len(self.rawdata) if self._endless(i) else super().parse_starttag(i)

    def parse_endtag(self, i):
        return len(self.rawdata) if self._endless(i) else super().parse_endtag(i)

    def parse_pi(self, i):
        return len(self.rawdata) if self._endless(i) else super().parse_pi(i)

    def parse_comment(self, i, report=1):
        return len(self.rawdata) if self._endless(i, "-->") else super().parse_comment(i, report)

    def parse_html_declaration(self, i):
        if self.rawdata.startswith("<!--", i):
            return self.parse_comment(i)
        return len(self.rawdata) if self._endless(i) else super().parse_html_declaration(i)

    def parse_marked_section(self, i, report=1):
        return self.parse_bogus_comment(i)

    def _end_line(self) -> None:
        if self._parts:
            text = " ".join("".join(self._parts).split())
            if text:
                linked = len(" ".join("".join(self._linked).split()))
                heading = any(self._held.get(h) for h in HEADINGS)
                self.lines.append(Line(text, self._tags, linked, self._blocks, heading))
                self._tags = 0
            self._parts, self._linked = [], []

    def close(self):
        super().close()
        self._end_line()


def smoothed(ratios: list[float], radius: int = RADIUS) -> list[float]:
    """Each ratio as a Gaussian mean over itself and its neighbours."""
    weight = [math.exp(-(d * d) / (2 * SIGMA * SIGMA)) for d in range(radius + 1)]
    out = []
    for i in range(len(ratios)):
        total = share = 0.0
        for j in range(max(0, i - radius), min(len(ratios), i + radius + 1)):
            total += weight[abs(i - j)] * ratios[j]
            share += weight[abs(i - j)]
        out.append(total / share)
    return out


def dense_lines(lines: list[Line]) -> list[bool]:
    """Whether each line belongs to the dense cluster."""
    ratios = smoothed([x.ratio for x in lines])
    mean = sum(ratios) / len(ratios)
    deviation = math.sqrt(sum((r - mean) ** 2 for r in ratios) / len(ratios))
    least = min(mean, deviation) * (1 - 1e-9)
    return [r >= least for r in ratios]


def region(lines: list[Line], dense: list[bool], articles: set[int]) -> list[int]:
    """The places of the lines that lie in a content region."""
    weight = [len(x.text) * d for x, d in zip(lines, dense)]
    total = sum(weight)
    marked = [i for i, x in enumerate(lines) if articles.intersection(x.path)]
    if marked and sum(weight[i] for i in marked) >= total * IN_ARTICLES:
        return marked
    depth, place = 0, list(range(len(lines)))
    while True:
        inside: dict[int, int] = {}
        for i in place:
            if len(lines[i].path) > depth:
                inside[lines[i].path[depth]] = inside.get(lines[i].path[depth], 0) + weight[i]
        best = max(inside, key=inside.get, default=None)
        holds = [i for i in place if len(lines[i].path) > depth and lines[i].path[depth] == best]
        if best is None or inside[best] < total * MAJORITY:
            break
        if len(holds) < len(place) and all(lines[i].path == lines[holds[0]].path for i in holds):
            break  # a single block among others
        depth, place = depth + 1, holds
    first = next(i for i in place if dense[i])
    last = max(i for i in place if dense[i])
    while first > place[0] and lines[first - 1].heading:
        first -= 1
    return [i for i in place if first <= i <= last]


def main_text(html: str | None) -> str:
    """The text of the content regions of a page."""
    if not html:
        return ""
    reader = LineReader()
    reader.feed(html)
    reader.close()
    lines = reader.lines
    if not lines:
        return ""
    dense = dense_lines(lines)
    chosen = region(lines, dense, reader.articles)
    return "\n\n".join(lines[i].text for i in chosen if dense[i] or lines[i].linked < LINKED)


def extracted(pages: DataFrame, html: str = "html", out: str = "main_text") -> DataFrame:
    """``pages`` with the main text of ``html``; a column named ``out`` is replaced."""
    ship(pages.sparkSession)

    @F.arrow_udf("string")
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(x.as_py()) for x in batch], pa.string())

    return pages.withColumn(out, read(F.col(html)))


def texts(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One ``(page_id, url, text, n_chars)`` per row of ``pages``."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    found = extracted(rows, "html", "text")
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
