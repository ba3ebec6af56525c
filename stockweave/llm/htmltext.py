"""Main text of web pages: text-to-tag ratio per line over streaming parser events.

The page is parsed as a stream of events. Every block of the page is one line,
with its text and the tags met in it. The text-to-tag ratio of the lines,
smoothed by a Gaussian, is high where the article is; lines above a threshold
are clustered into regions and the regions with article text are kept. Scripts,
styles and controls are left out. Lines in other markup that seldom is article
text (menus, headers, footers, sidebars, notices, adverts, forms, comments of
readers), by its element or its class, bear a penalty and join no cluster of
others; an element that holds the article or most of the page's text is a layout
wrapper and bears none. An ``article`` or ``main`` element is a
prior: its lines weigh more, and lines outside it weigh by their length, so a
body outside wins over a teaser inside.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.llm.common import picked

SIGMA = 1.0
# A line counts as text if its smoothed ratio reaches this share of the page's mean.
MEAN_SHARE = 0.25
# Lines this close to a cluster (in lines) join it if they are text and not links.
GAP = 2
MAX_LINK_SHARE = 0.5
# Prior of the lines in an article or main element; lines outside have half weight at so many characters.
REGION_WEIGHT = 8.0
OUTSIDE_CHARS = 100.0
# Weight of a line in unwanted markup.
PENALTY = 0.01
# An unwanted element with this share of the page's text is a wrapper, unless a region outside
# it has this one.
WRAPPER_SHARE = 0.5
REGION_SHARE = 0.25

# Elements that hold no article text, those that seldom do, elements that end a
# line, and elements without content.
SKIPPED = frozenset(
    "script style noscript template svg head title button select textarea iframe object "
    "embed canvas audio video map annotation annotation-xml".split()
)
# What may stand in a head; what may stand in a select. Anything else ends them, and a block ends
# an iframe, which holds no markup, or a button left open.
IN_HEAD = frozenset("head base basefont bgsound link meta title style script noscript noframes template".split())
IN_SELECT = frozenset("option optgroup hr script template".split())
SELDOM = frozenset("nav footer aside dialog menu".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
REGIONS = frozenset(("article", "main"))
ENDS_BUTTON = BLOCKS - {"div", "center", "li", "dd", "dt"}
# A p ends where one of these begins; items and cells end where their like begins.
CLOSES_P = BLOCKS - {"td", "th", "tr", "tbody", "thead", "tfoot", "li", "dd", "dt", "option", "body", "html"}
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
# Class, id and role words of what is not the article.
_BEGIN = r"(?:^|[\s_-])(?<!has-)(?<!with-)(?<!no-)"
UNWANTED = re.compile(
    _BEGIN + r"(?:ad|ads|advert\w*|adsense|sponsor\w*|promo\w*|nav\w*|menu\w*|"
    r"breadcrumbs?|sidebar\w*|side-bar|aside|widget\w*|footer|site-?footer|site-?header|"
    r"topbar|toolbar|cookies?|consent|gdpr|notice\w*|alert|popup|modal|overlay|"
    r"newsletter|subscri\w*|signup|login|share|sharing|social\w*|comments?|comment-\w+|disqus\w*|"
    r"respond|replies|related(?!-?works?)|recommend\w*|pagination|pager|skip-?link|copyright|legal|search\w*|"
    r"navigation|contentinfo|complementary|dialog|form)(?=$|[\s_-])",
    re.IGNORECASE,
)
# The same, but the article's own header holds its title.
UNWANTED_OUTSIDE = re.compile(
    _BEGIN + r"(?:header|page-?header|masthead|banner)(?=$|[\s_-])", re.IGNORECASE
)
SPACES = re.compile(r"\s+")


class Line(NamedTuple):
    text: str
    tags: int
    link_chars: int
    region: bool
    unwanted: bool


class Lines(HTMLParser):
    """Collects a Line per block of a page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, bool, tuple[int, ...]]] = []
        self.stack: list[tuple[str, bool, int | None]] = []  # element, whether it is skipped, its mark
        self.marks: list[int] = []  # open unwanted elements
        self.wrappers: set[int] = set()  # unwanted elements that hold a region
        self.by_class: set[int] = set()  # unwanted for a word, or a form
        self.left_open: set[int] = set()  # unwanted elements without an end tag of their own
        self.made = 0
        self.skips = 0
        self.regions = 0
        self.links = 0
        self.parts: list[str] = []
        self.tags = 0
        self.link_chars = 0

    def end_line(self) -> None:
        if self.parts:
            text = SPACES.sub(" ", "".join(self.parts)).strip()
            if text:
                marks = tuple(self.marks)
                self.lines.append((text, self.tags, self.link_chars, self.regions > 0, marks))
                self.tags = 0
        self.parts = []
        self.link_chars = 0

    def _unwanted(self, tag: str, attrs: list) -> bool:
        """Whether the element's name, class, id or role is that of other text."""
        if tag in SELDOM or tag == "form":
            return True
        if tag == "header":  # the header of an article holds its title
            return not self.regions
        if tag in REGIONS or tag in ("body", "html"):
            return False
        for name, value in attrs:
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return True
            if name in ("class", "id", "role") and value:
                if UNWANTED.search(value):
                    return True
                if not self.regions and UNWANTED_OUTSIDE.search(value):
                    return True
        return False

    def _pop(self, own: bool = False) -> None:
        tag, skip, mark = self.stack.pop()
        if tag in BLOCKS or mark is not None:
            self.end_line()
        if mark is not None:
            self.marks.remove(mark)
            if not own:
                self.left_open.add(mark)
        self.skips -= skip
        self.regions -= tag in REGIONS
        self.links -= tag == "a"

    def _close_to(self, wanted, stop) -> None:
        """Close the innermost open element of ``wanted``, unless one of ``stop`` is nearer."""
        for at in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[at][0]
            if tag in wanted:
                while len(self.stack) > at:
                    self._pop(len(self.stack) == at + 1)
                return
            if tag in stop:
                return

    def _end_skipped(self, tag: str) -> None:
        """Close a head, select, iframe or button in which ``tag`` cannot stand."""
        while self.stack:
            inside = self.stack[-1][0]
            if not (
                (inside == "head" and tag not in IN_HEAD)
                or (inside == "select" and tag not in IN_SELECT)
                or (inside in ("option", "optgroup") and tag not in IN_SELECT)
                or (inside == "iframe" and tag in BLOCKS)
                or (inside == "button" and (tag in ENDS_BUTTON or tag == "button"))
            ):
                return
            self._pop()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.skips:
            self._end_skipped(tag)
        if tag in CLOSES_P:
            self._close_to(("p",), BLOCKS - {"p"})
        elif tag in SIBLINGS:
            self._close_to(*SIBLINGS[tag])
        if tag in BLOCKS:
            self.end_line()
        self.tags += 1
        if tag in VOID:
            if tag == "br":
                self.parts.append(" ")
            return
        skip, mark = tag in SKIPPED, None
        if not skip and not self.skips:
            if tag in REGIONS:
                self.wrappers.update(self.marks)
            elif self._unwanted(tag, attrs):
                self.end_line()
                mark = self.made
                self.made += 1
                self.marks.append(mark)
                if tag not in SELDOM:
                    self.by_class.add(mark)
        self.stack.append((tag, skip, mark))
        self.skips += skip
        self.regions += tag in REGIONS
        self.links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in VOID:
            return
        if tag in BLOCKS and tag not in ("p",):
            self._close_to((tag,), ())
        else:  # an inline end tag does not close the block around it
            self._close_to((tag,), BLOCKS - {tag})

    def handle_data(self, data: str) -> None:
        if self.skips and self.stack[-1][0] == "head" and not data.isspace():
            self._pop()  # text ends the head as well
        if not self.skips:
            self.parts.append(data)
            if self.links:
                self.link_chars += len(data)

    def _excused(self) -> set[int]:
        """Unwanted elements that wrap the article."""
        total = stated = 0
        held: Counter = Counter()  # characters in each
        for text, _, link_chars, region, marks in self.lines:
            size = len(text) - link_chars
            total += size
            stated += size if region else 0
            for mark in marks:
                held[mark] += size
        excused = set(self.wrappers)
        if stated < REGION_SHARE * total:
            excused |= {m for m in self.by_class if held[m] > WRAPPER_SHARE * total}
        return excused

    def finish(self) -> list[Line]:
        self.close()
        while self.stack:
            self._pop()
        self.end_line()
        self._shorten()
        excused = self._excused()
        return [Line(*line, not excused.issuperset(marks)) for *line, marks in self.lines]

    def _shorten(self) -> None:
        """Unwanted elements without an end tag hold one line: where they end is not known."""
        if not self.left_open:
            return
        met: set[int] = set()
        for i, (*line, marks) in enumerate(self.lines):
            if marks:
                gone = met.intersection(marks)
                met.update(self.left_open.intersection(marks))
                self.lines[i] = (*line, tuple(m for m in marks if m not in gone))


def smooth(ratios: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian smoothing with the weights that fall inside the page."""
    reach = max(1, int(np.ceil(3 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    inside = np.convolve(np.ones(len(ratios)), kernel)[reach : reach + len(ratios)]
    return np.convolve(ratios, kernel)[reach : reach + len(ratios)] / inside


def outside_weight(size):
    """Weight of lines of ``size`` characters that no region holds."""
    return size / (size + OUTSIDE_CHARS)


def content_lines(lines: list[Line]) -> list[bool]:
    """Which lines are article text."""
    keep, least = _clustered([x for x in lines if not x.unwanted])
    rest = iter(keep)
    return [_stands_alone(x, least) if x.unwanted else next(rest) for x in lines]


def _stands_alone(line: Line, least: float) -> bool:
    """Whether a line in unwanted markup reaches the threshold in spite of the penalty."""
    weight = PENALTY if line.region else PENALTY * outside_weight(len(line.text))
    ratio = len(line.text) / max(1, line.tags)
    return weight * ratio >= least and line.link_chars <= MAX_LINK_SHARE * len(line.text)


def _clustered(lines: list[Line]) -> tuple[list[bool], float]:
    """Which of the lines without penalty are article text, and the threshold."""
    if not lines:
        return [], np.inf
    sizes = np.array([len(x.text) for x in lines], dtype=float)
    ratios = np.array([len(x.text) / max(1, x.tags) for x in lines])
    links = np.array([x.link_chars for x in lines]) / sizes
    stated = np.array([x.region for x in lines])
    if not (links[stated] <= MAX_LINK_SHARE).any():
        stated[:] = False  # a region of links only is no article
    smoothed = smooth(ratios, SIGMA)
    usable = stated | (links <= MAX_LINK_SHARE)
    # Where the page states a region, lines outside need evidence of their own: their length.
    prior = np.ones(len(lines))
    if stated.any():
        prior = np.where(stated, REGION_WEIGHT, outside_weight(sizes))
    least = MEAN_SHARE * (smoothed * np.minimum(prior, 1)).mean()
    high = (smoothed * prior >= least) & usable
    if not high.any():
        return [False] * len(lines), least
    # Clusters grow over lines next to them, so short paragraphs and titles inside stay; not over
    # the edge of a region.
    grown = high.copy()
    for part in (stated, ~stated):
        for at in np.flatnonzero(high & part):
            near = slice(max(0, at - GAP), at + GAP + 1)
            grown[near] |= part[near]
    first, last = np.flatnonzero(grown & usable)[[0, -1]]
    # An article is one stretch: what stands between its clusters belongs to it, a paragraph that
    # is one link as well.
    return [first <= i <= last for i in range(len(lines))], least


def main_text(html: str | None) -> str:
    """The article of a page, blocks joined by two newlines; empty for NULL or no text."""
    if not html:
        return ""
    parser = Lines()
    parser.feed(html)
    lines = parser.finish()
    return "\n\n".join(x.text for x, keep in zip(lines, content_lines(lines)) if keep)


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``.

    The whole html is parsed, malformed markup as browsers would roughly: a head
    without an end tag ends where the body begins, and an unwanted element without
    one holds a line. NULL
    and empty html, and pages without article text, give an empty text.
    Repeated rows give repeated rows, an empty table an empty one; NULL ids and
    urls and further columns play no part.
    """
    rows = picked(pages, page_id=id_col, url=url_col, html=html_col)
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column(2)]
            columns = [
                batch.column(0),
                batch.column(1),
                pa.array(texts, type=pa.string()),
                pa.array([len(t) for t in texts], type=pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    rows = rows.withColumn("html", F.col("html").cast("string"))
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    return rows.mapInArrow(run, schema)
