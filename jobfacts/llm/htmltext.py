"""Main text of web pages.

A streaming parser turns a page into blocks (the lines of the text-to-tag ratio).  Each
block's ratio of characters to tags is smoothed by a Gaussian over its neighbours, and the
smoothed ratios are clustered into two by a threshold.  The blocks of the upper cluster whose own ratio
is above the threshold too select the content region: the ``article`` or ``main`` elements that
hold most of their text (the smallest element around them, if there are several), else the
smallest element that holds all of them.  All blocks of the region are the main text, with
the headings that stand directly before it.  At the edges of a region that is neither
``article`` nor ``main``, runs of blocks made of links are left out.

Blocks never come from scripts, styles, forms, navigation, asides, page headers and
footers, hidden elements, or elements with a class, id or role that names such a part (adverts,
notices, side bars, reader comments).  A name does if all its words speak of a part:
``comment-list``, but not ``comments-open`` or ``no-sidebar``.  An element that holds an ``article``,
``main`` or first heading and most of the text is the page's frame, whatever its name.

Time is linear in the page: open elements are found by name, regions and named parts are numbered
in page order with their ends, and what follows the last ``>`` goes to the parser only up to
an unfinished tag.

Defined results: NULL or empty html, and pages without text, give an empty text; unclosed
and misnested tags close with their surroundings; a tag that the page's end cuts off is no
text, an unfinished reference is what the parser makes of it; repeated rows have no effect on
one another; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobfacts.llm.common import by_value

by_value(__name__)

SIGMA = 1.5
#: share of the selecting blocks' text that named regions must hold
NAMED_SHARE = 0.5
#: blocks with this share of their characters in links, RUN or more in a row, are a menu
LINK_SHARE, RUN = 0.9, 3

# Element names of HTML.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp "
                    "small span strike strong sub sup time tt u var wbr".split())
_SKIPPED = frozenset("script style noscript template svg math head title nav aside form button select textarea input "
                     "iframe object canvas audio video dialog menu footer".split())
_REGIONS = frozenset("article main section div td body".split())
_CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
                      "h5 h6 header hr main menu nav ol p pre section table ul".split())
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}
_PART = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav "
                  "navbar navigation footer cookie cookies consent gdpr notice alert popup modal overlay comment comments "
                  "disqus reply replies respond share sharing social related recommended breadcrumb breadcrumbs pagination "
                  "pager newsletter subscribe signup login search widget copyright complementary contentinfo".split())
_HEADER = frozenset("header masthead topbar".split())
#: words that say nothing about what a part is
_PLAIN = frozenset("area bar block bottom box button buttons container desktop fixed float full global group holder icon icons inner "
                   "item items left link links list lists main mobile module outer page panel post posts primary right "
                   "row secondary section site slot small sticky sub thread top unit wrap wrapper zone".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_FRAMED = frozenset("article main h1".split())
_WORDS = re.compile(r"[a-z]+")
_UNFINISHED = re.compile(r"<[a-zA-Z/!?]")


def _names_part(value: str, parts: frozenset[str]) -> bool:
    """Whether a token of a class, id or role is made of words for a part alone."""
    for token in value.lower().split():
        words = {w for w in _WORDS.findall(token) if len(w) > 1}
        if words & parts and words <= parts | _PLAIN:
            return True
    return False


class Block(NamedTuple):
    text: str
    tags: int
    region: int      # number of the innermost region
    part: int        # number of the innermost element named as a part, -1 if none
    heading: bool
    links: float     # share of its characters in links


class _Blocks(HTMLParser):
    """Collects blocks, and the tree of regions and of named parts."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.stack: list[tuple[str, bool, bool, bool]] = []  # name, skipped, region, part
        self.places: dict[str, list[int]] = {}  # stack positions of the open elements by name
        self.skipped = 0
        # regions by number, in page order; 0 is the page
        self.region, self.names, self.parents, self.ends, self.outer = 0, ["page"], [-1], [0], [0]
        # named parts, likewise; ``framed`` if an article, main or first heading is inside
        self.part, self.part_parents, self.framed = -1, [], []
        self.text: list[str] = []
        self.linked = self.tags = 0
        self.heading = False

    def _flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.blocks.append(Block(text, max(self.tags, 1), self.region, self.part, self.heading, self.linked / max(1, sum(map(len, self.text)))))
            self.tags = 0
        self.text.clear()
        self.linked, self.heading = 0, False

    def _open(self, *names: str) -> bool:
        return any(self.places.get(n) for n in names)

    def _kind(self, tag: str, attrs) -> tuple[bool, bool]:
        """(skipped for good, named as a part)."""
        if tag in _SKIPPED:
            return True, False
        if tag in ("html", "body", "article", "main"):
            return False, False
        inside = self._open("article", "main")
        if tag == "header":
            return not inside, False
        parts, named = _PART if inside else _PART | _HEADER, False
        for name, value in attrs:
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return True, False
            if name == "style" and value and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return True, False
            named = named or name in ("class", "id", "role") and bool(value) and _names_part(value, parts)
        return False, named

    def _push(self, tag: str, attrs) -> None:
        (skipped, part), region = self._kind(tag, attrs), tag in _REGIONS
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, skipped, region, part))
        self.skipped += skipped
        if region:
            number = len(self.names)
            self.outer.append(self.outer[self.region] or (number if tag in ("article", "main") else 0))
            self.parents.append(self.region)
            self.names.append(tag)
            self.ends.append(0)
            self.region = number
        if part:
            self.part_parents.append(self.part)
            self.framed.append(False)
            self.part = len(self.framed) - 1
        if tag in _FRAMED and self.part >= 0 and not self.skipped:
            self.framed[self.part] = True

    def _pop(self) -> None:
        tag, skipped, region, part = self.stack.pop()
        self.places[tag].pop()
        self.skipped -= skipped
        if region:
            self.ends[self.region] = len(self.names)
            self.region = self.parents[self.region]
        if part:
            self.part = self.part_parents[self.part]

    def _close(self, names: set[str], stop: frozenset[str]) -> None:
        """Closes the nearest open element of ``names`` with all inside it, up to a ``stop``."""
        nearest = max((self.places[n][-1] for n in names if self.places.get(n)), default=-1)
        if nearest >= 0 and nearest > max((self.places[n][-1] for n in stop if self.places.get(n)), default=-1):
            while len(self.stack) > nearest:
                self._pop()

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag == "br":
            self.text.append(" ")
        if tag not in _INLINE:
            self._flush()
            if tag in _CLOSES_P and self._open("p"):
                self._close({"p"}, frozenset({"td", "th", "button", "li", "blockquote"}))
            if tag in _SIBLINGS:
                self._close(_SIBLINGS[tag], frozenset({"ul", "ol", "dl", "table", "select"}))
        if tag not in _VOID:
            self._push(tag, attrs)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag not in _INLINE:
            self._flush()
        if self._open(tag):
            self._close({tag}, frozenset())

    def handle_data(self, data):
        if not self.skipped:
            self.text.append(data)
            self.heading = self.heading or self._open(*_HEADINGS)
            if self._open("a"):
                self.linked += len(data)

    def read(self, html: str) -> None:
        end = html.rfind(">") + 1
        cut = _UNFINISHED.search(html, end)
        self.feed(html[:cut.start()] if cut else html)
        self.close()
        self._flush()
        while self.stack:
            self._pop()
        self.ends[0] = len(self.names)


def smooth(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian-weighted mean over the neighbouring blocks, renormalised at the ends."""
    reach = int(3 * sigma + 0.5)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return (np.convolve(ratios, kernel)[reach:reach + len(ratios)]
            / np.convolve(np.ones(len(ratios)), kernel)[reach:reach + len(ratios)])


def threshold(values: np.ndarray) -> float:
    """The cut between two clusters: halfway between their means, iterated until it rests."""
    cut = float(values.mean())
    for _ in range(100):
        low, high = values[values < cut], values[values >= cut]
        if not len(low) or not len(high):
            return float(values.min())
        new = (float(low.mean()) + float(high.mean())) / 2
        if new == cut:
            break
        cut = new
    return cut


def _frames(page: _Blocks) -> set[int]:
    """Named parts that hold an article, main or first heading and most of the text."""
    held, framed = [0] * len(page.framed), list(page.framed)
    for b in page.blocks:
        if b.part >= 0:
            held[b.part] += len(b.text)
    for i in range(len(held) - 1, -1, -1):  # what is inside has the larger number
        if (up := page.part_parents[i]) >= 0:
            held[up] += held[i]
            framed[up] = framed[up] or framed[i]
    total = sum(len(b.text) for b in page.blocks)
    return {i for i, n in enumerate(held) if framed[i] and 2 * n > total}


def _content(page: _Blocks) -> list[Block]:
    """The blocks outside named parts."""
    if not page.framed:
        return page.blocks
    frames = _frames(page)
    inside = []  # of each part: whether it or one around it is left out
    for i, up in enumerate(page.part_parents):
        inside.append(i not in frames or up >= 0 and inside[up])
    return [b for b in page.blocks if b.part < 0 or not inside[b.part]]


def _around(page: _Blocks, regions: list[int]) -> int:
    """The smallest region around all of ``regions``."""
    low, high = min(regions), max(regions)
    while page.ends[low] <= high:
        low = page.parents[low]
    return low


def _without_menus(blocks: list[Block], content: list[bool]) -> list[Block]:
    """Without the runs of link blocks before the first and after the last block of content."""
    marks = [i for i, good in enumerate(content) if good]
    first, last = (marks[0], marks[-1]) if marks else (len(blocks), -1)
    drop: set[int] = set()
    run: list[int] = []
    for i, b in enumerate([*blocks, None]):
        if b is not None and b.links >= LINK_SHARE and not first <= i <= last:
            run.append(i)
            continue
        drop.update(run if len(run) >= RUN else ())
        run = []
    return [b for i, b in enumerate(blocks) if i not in drop]


def main_blocks(html: str | None) -> list[str]:
    """The texts of the main content's blocks, in page order."""
    page = _Blocks()
    page.read(html or "")
    blocks = _content(page)
    if not blocks:
        return []
    raw = np.array([len(b.text) / b.tags for b in blocks], dtype=float)
    ratios = smooth(raw)
    cut = threshold(ratios) * (1 - 1e-9)  # equal ratios differ by rounding
    own = np.flatnonzero((ratios >= cut) & (raw >= cut))
    chosen = [blocks[i] for i in (own if len(own) else np.flatnonzero(ratios >= cut))]
    named = [b for b in chosen if page.outer[b.region]]
    if sum(len(b.text) for b in named) >= NAMED_SHARE * sum(len(b.text) for b in chosen):
        region, frame = _around(page, [page.outer[b.region] for b in named]), True
    else:
        region, frame = _around(page, [b.region for b in chosen]), False
    inside = [i for i, b in enumerate(blocks) if region <= b.region < page.ends[region]]
    kept = [blocks[i] for i in inside]
    if not frame:
        kept = _without_menus(kept, [bool(ratios[i] >= cut) for i in inside])
    before = inside[0]
    while before > 0 and blocks[before - 1].heading:
        before -= 1
    return [b.text for b in (*blocks[before:inside[0]], *kept)]


def main_text(html: str | None) -> str:
    return "\n".join(main_blocks(html))


def extract(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep`` with ``text``."""
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{html}`").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(x.as_py()) for x in batch.column("html")], pa.string())
            yield pa.record_batch([batch.column("row"), texts], ["row", "text"])

    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, text string").select("row.*", "text")


def html_query(pages: DataFrame) -> DataFrame:
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
