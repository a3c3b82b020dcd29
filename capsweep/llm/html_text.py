"""The main text of web pages by text-to-tag ratios.

The standard library's parser streams a page's events; no tree is kept. They are cut into lines at every start and
end of a block element and at line breaks. A line's ratio is its characters outside links by the tags that were met since the
line before it ended; lines of menus, headers, footers, sidebars, notices, adverts, forms and readers' comments, by
their elements, roles or class names, have none. The ratios are smoothed by a Gaussian window over neighbouring lines of
the same article or of none, and the page's threshold (the standard deviation of the smoothed ratios, the usual choice for it) parts content lines from
others. Content lines select regions: the outermost articles or main elements that hold one, or, where the page
names none, the innermost block that holds them all, with the heading before it. A selected region is given whole, so that an article's
short lines, which have low ratios, stay; outside articles, lists of nothing but links don't. If no line reaches the threshold, the line
with the highest ratio selects.

Defined results: null and empty html, and pages without any such line, give an empty text; character references are decoded; white
space of any kind in a line is one space; lines that are blank aren't lines; a script, style, comment or tag that isn't closed runs to the end
of the page; other elements that aren't closed end with the next one around them; pages of any length and depth are read whole; repeated
rows and null ids are rows of their own; an empty table gives an empty result; other columns are kept, but for those that carry the names of the result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import bounded_batches, text_or_empty, text_slices

#: Standard deviation of the window, in lines; it reaches two lines to each side. Threshold by the smoothed ratios' deviation.
SIGMA, REACH, SHARE = 1.0, 2, 1.0
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "html head body address article aside blockquote caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav "
    "ol option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose text is never the article's.
BOILERPLATE = frozenset("aside audio button canvas datalist dialog fieldset footer form head header iframe input label legend menu meter nav noscript object option output progress script search select style svg template textarea title video".split())
HIDDEN = re.compile(r"display\s*:\s*none", re.I)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar".split())
#: Words of class names and ids that mark such blocks.
MARKS = frozenset(
    "ad ads adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright dialog discussion disqus footer form gdpr header login masthead menu menus modal nav navbar "
    "navigation newsletter notice notices notification overlay pager pagination paywall popup promo promoted promotion related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription "
    "toc toolbar topbar widget widgets".split()
)
COMMENT_MARKS = frozenset("comment comments commentlist discussion disqus replies reply respond".split())
HEADER_MARKS = frozenset("header masthead".split())
#: A name with one of these tells of a page's make-up, not of the block's kind.
RELATIONS = frozenset("has with without no not is wrap layout".split())
OPEN_END = re.compile(r"<[A-Za-z/!?]")
WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
#: Blocks that are ended by the start of others, if no block was opened in them since.
CLOSED_BY = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
MADE = "text string, n_chars long"
#: What an open element's text is: the article's, what stands beside the headings of an article's own header, or another's.
FREE, BESIDE, BARRED = 0, 1, 2


def names_of(tag: str, attrs: dict[str, str | None]) -> set[str]:
    """Words of an element's class names and id that mark it."""
    if tag in ("html", "body", "main"):
        return set()
    words = COMMENT_MARKS if tag == "article" else MARKS - HEADER_MARKS if tag in HEADINGS else MARKS
    out: set[str] = set()
    for name in f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split():
        parts = {w.lower() for w in WORD.findall(name)}
        if not parts & RELATIONS:
            out |= parts & words
    return out


def state_of(tag: str, attrs: dict[str, str | None], around: int, in_article: bool) -> int:
    if around == BARRED or tag in BOILERPLATE - {"header"} or "hidden" in attrs or attrs.get("aria-hidden") == "true" or (attrs.get("role") or "").lower() in ROLES or HIDDEN.search(attrs.get("style") or ""):
        return BARRED
    names = names_of(tag, attrs)
    if names - HEADER_MARKS:
        return BARRED
    if names or tag == "header":
        return BESIDE if in_article else BARRED
    return FREE if tag in HEADINGS else around


@dataclass(slots=True)
class Line:
    text: str
    chars: int  # outside links
    tags: int
    barred: bool
    kind: str  # the block that holds it
    holder: int  # the number of that block
    article: int  # the number of the outermost article or main element, or 0
    listed: bool


@dataclass(slots=True)
class Element:
    tag: str
    state: int
    number: int  # blocks are numbered as they open, others have 0
    block: int  # the place of the innermost block in the stack


class Lines(HTMLParser):
    """A page's lines, as its events come; above[n] is the block around block n, last[n] the last one opened in it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[Line] = []
        self.open = [Element("", FREE, 0, 0)]
        self.above, self.last = [0], [0]
        self.counts: Counter[str] = Counter()
        self.said: list[str] = []
        self.linked = self.tags = self.article = 0

    def end_line(self) -> None:
        if not self.said:
            return
        text = " ".join("".join(self.said).split())
        if text:
            block = self.open[self.open[-1].block]
            self.out.append(Line(text, max(0, len(text) - self.linked), self.tags, block.state != FREE, block.tag, block.number, self.article, self.counts["li"] > 0))
            self.tags = 0
        self.said, self.linked = [], 0

    def handle_starttag(self, tag, attrs):
        block = tag in BLOCKS
        if block:
            self._end_implied(tag)
        if block or tag == "br":
            self.end_line()
        self.tags += 1
        if tag in VOID:
            return
        around = self.open[-1]
        given = dict(reversed(attrs))  # of repeated names the first counts
        state = state_of(tag, given, around.state, self.article > 0)
        number = 0
        if block:
            number = len(self.above)
            self.above.append(self.open[around.block].number)
            self.last.append(number)
            if not self.article and state == FREE and (tag in ("article", "main") or given.get("role") == "main" or given.get("itemprop") == "articleBody"):
                self.article = number
        self.open.append(Element(tag, state, number, len(self.open) if block else around.block))
        self.counts[tag] += 1

    def handle_startendtag(self, tag, attrs):
        if tag in BLOCKS or tag in VOID:  # a slash doesn't close a block
            self.handle_starttag(tag, attrs)
        else:
            self.tags += 1

    def handle_endtag(self, tag):
        if tag in BLOCKS or tag == "br":
            self.end_line()
        self.tags += 1
        if self.counts[tag]:
            self._end(tag)

    def handle_data(self, data):
        top = self.open[-1]
        if top.state == BARRED and self.open[top.block].state != BARRED:
            return  # scripts and the like within a line
        self.said.append(data)
        if self.counts["a"]:
            self.linked += len(" ".join(data.split()))

    def _end(self, tag: str) -> None:
        while True:
            e = self.open.pop()
            self.counts[e.tag] -= 1
            if e.number:
                self.last[e.number] = len(self.above) - 1
                if e.number == self.article:
                    self.article = 0
            if e.tag == tag:
                return

    def _end_implied(self, tag: str) -> None:
        block = self.open[self.open[-1].block].tag
        if tag in CLOSED_BY.get(block, ()):
            self.end_line()
            self._end(block)
            if block in ("td", "th") and tag == "tr":
                self._end_implied(tag)

    def close(self):
        if OPEN_END.match(self.rawdata):  # a comment or tag that the page's end cuts
            self.rawdata = ""
        super().close()
        self.end_line()
        while len(self.open) > 1:
            self._end(self.open[-1].tag)
        self.last[0] = len(self.above) - 1


def lines_of(markup: str) -> Lines:
    parser = Lines()
    parser.feed(markup)
    parser.close()
    return parser


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """A Gaussian window over the lines; beyond their ends there is nothing."""
    reach = np.arange(-REACH, REACH + 1)
    window = np.exp(-(reach**2) / (2 * SIGMA**2))
    padded = np.pad(ratios, REACH)
    return sum(w * padded[i : i + len(ratios)] for i, w in enumerate(window / window.sum()))


def selected(page: Lines) -> list[str]:
    """The texts of the lines of the regions that content lines select."""
    lines = page.out
    free = np.array([not x.barred for x in lines], bool)
    if not free.any():
        return []
    ratios = np.array([0.0 if x.barred else x.chars / max(1, x.tags) for x in lines])
    turns = np.flatnonzero(np.diff([x.article for x in lines])) + 1  # an article's lines have nothing to say of another's
    smooth = np.concatenate([smoothed(x) for x in np.split(ratios, turns)])
    smooth = np.where(free, smooth, -1.0)
    content = smooth >= SHARE * smooth[free].std() if free.sum() > 1 else free
    content &= free & (smooth > 0)
    named = free & np.array([x.article > 0 for x in lines])
    pool = named if named.any() else free
    content &= pool
    if not content.any():
        content[int(np.argmax(np.where(pool, smooth, -2.0)))] = True
    if named.any():
        regions = {lines[i].article for i in np.flatnonzero(content)}
        return [x.text for x in lines if not x.barred and x.article in regions]
    holders = [lines[i].holder for i in np.flatnonzero(content)]
    common, far = min(holders), max(holders)
    while page.last[common] < far:
        common = page.above[common]
    inside = [not x.barred and common <= x.holder <= page.last[common] and not (x.listed and not x.chars) for x in lines]
    if True not in inside:
        return [lines[i].text for i in np.flatnonzero(content)]
    before = next((i for i in range(inside.index(True) - 1, -1, -1) if free[i]), None)
    if before is not None and lines[before].kind in HEADINGS:
        inside[before] = True
    return [x.text for x, keep in zip(lines, inside, strict=True) if keep]


def main_text(markup: str) -> str:
    return " ".join(selected(lines_of(markup)))


def extract(pages: DataFrame) -> DataFrame:
    """pages with text, the main text of html, and n_chars, its code points; html goes."""
    names = [f.split()[0] for f in MADE.split(", ")]
    kept = [c for c in pages.columns if c.lower() not in (*names, "html")]
    bounded_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, len(kept)):
            texts = [main_text(h) for h in text_or_empty(batch.column(len(kept)))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(kept))), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*kept, *names])

    return pages.select(*kept, "html").mapInArrow(run, T.StructType([*[pages.schema[c] for c in kept], *T._parse_datatype_string(MADE).fields]))
