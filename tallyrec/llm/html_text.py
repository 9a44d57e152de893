"""Main text of web pages by text-to-tag ratios.

The page runs through the standard library's streaming parser. Block elements cut it
into lines; a line has its text and the number of tags met in it. Ratios of text to
tags are smoothed along the page with a Gaussian, and lines above a threshold set by the
spread of the ratios form the content cluster. Elements that are never part of an
article (menus, headers, footers, asides, forms, scripts, styles, adverts, notices,
reader comments, hidden parts) carry no content lines. Class, id and role mark them too:
inside an article by a whole class, id or role or a known compound, elsewhere by one word
of it as well; headings are not marked by an id. A mark that does not name its element for
sure is void if the element holds long lines of the cluster. The cluster's text decides on the
region: the heaviest article or main element is weighed against the heaviest container
of the text outside of such elements. Unless the container leads by more than ``BONUS``
characters, the region is all articles and main elements that hold cluster lines. If it
leads, the region is the container, the articles too if they weigh as much together, and
lines elsewhere that stand out by themselves. Within a region every line stays, however
short.

Defined results: a null, empty or blank page has empty text; a page where no line stands
out gives all lines outside excluded elements; repeated rows are kept; an empty table
gives an empty table; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrec.llm.batches import map_arrow, text_groups

#: Characters fed to the parser at first; each later part is twice as long, so that an
#: unfinished construct is looked at a bounded number of times.
CHUNK = 1 << 16
SIGMA = 1.0
RADIUS = 2
#: Lines above this share of the ratios' standard deviation are content.
THRESHOLD = 0.5
#: Characters of cluster text by which a container must outweigh article and main
#: elements: less than this is no paragraph.
BONUS = 32

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
    "nav ol p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
SILENT = frozenset("head script style noscript template title svg math iframe object canvas audio video".split())
EXCLUDED = SILENT | frozenset(
    "nav footer aside form button select option textarea dialog menu input label fieldset".split()
)
REGIONS = frozenset(("article", "main"))
CONTAINERS = frozenset(("article", "main", "section", "div", "td", "body", "html"))
#: Words of class, id and role that mark an excluded element.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies "
    "consent gdpr notice notices banner alert sidebar side menu nav navbar navigation breadcrumb "
    "breadcrumbs footer header masthead topbar comment comments disqus respond replies share sharing "
    "social related recommended newsletter subscribe subscription popup modal overlay login search "
    "contentinfo complementary pagination".split()
)
#: Marks that say for sure what an element is, if they are its whole name.
FIRM = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies "
    "consent gdpr nav navbar navigation breadcrumb breadcrumbs comment comments disqus respond replies "
    "newsletter subscribe subscription popup modal overlay login contentinfo complementary pagination".split()
)
#: Compound names that are marks as a whole.
COMPOUNDS = frozenset(
    "ad-banner ad-block ad-container ad-slot ad-unit ad-wrapper cookie-notice cookie-banner cookie-consent "
    "cookie-bar consent-banner gdpr-notice gdpr-banner comment-list comment-form comments-area "
    "comments-section comments-list newsletter-signup newsletter-form share-buttons sharing-buttons "
    "social-share social-links social-media related-posts related-articles related-links main-nav site-nav "
    "nav-menu site-header site-footer search-form login-form".split()
)
_SURE = FIRM | COMPOUNDS
#: Words that mark an element of an article as the first or last part of a name.
PARTS = FIRM | {"sidebar"}
#: Words of names that say what a page has or how it is set, and mark nothing.
STATES = frozenset("no has with without open closed enabled disabled".split())
UNMARKED = frozenset(("body", "html", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose id is a place in the text more often than a name.
ANCHORS = frozenset(("section", "p", "article"))
_CLOSES_P = BLOCKS - {"body", "html", "head"}


@dataclass
class Line:
    text: str
    tags: int
    excluded: bool
    #: number of the innermost article or main element, and of the innermost container; 0 if none
    region: int
    container: int
    #: number of the innermost element whose mark is not sure; 0 if none
    mark: int = 0


@dataclass
class _Open:
    name: str
    excluded: bool
    region: int
    container: int
    mark: int = 0


def _words(value: str | None) -> list[str]:
    return (value or "").lower().replace("-", " ").replace("_", " ").split()


def _names(value: str | None) -> list[str]:
    return (value or "").lower().replace("_", "-").split()


def _marking(tag: str) -> tuple[str, ...]:
    """Attributes by which an element can be marked."""
    if tag in UNMARKED:
        return ()
    return ("class", "role") if tag in HEADINGS or tag == "article" else ("class", "id", "role")


def _is_part(name: str) -> bool:
    parts = name.split("-")
    return (parts[0] in PARTS or parts[-1] in PARTS) and STATES.isdisjoint(parts)


@dataclass
class PageLines(HTMLParser):
    """Lines of a page, from parser events."""

    lines: list[Line] = field(default_factory=list)

    def __post_init__(self) -> None:
        HTMLParser.__init__(self, convert_charrefs=True)
        self.open = [_Open("", False, 0, 0)]
        self.parents = {0: 0}
        self.regions: set[int] = set()
        #: containers that are the whole page
        self.whole = {0}
        self.pieces: list[str] = []
        self.tags = 0
        self.numbered = 0
        #: outer mark of each mark that is not sure
        self.marks = {0: 0}

    def flush(self) -> None:
        text = " ".join("".join(self.pieces).split())
        top = self.open[-1]
        if text:
            self.lines.append(Line(text, self.tags, top.excluded, top.region, top.container, top.mark))
            self.tags = 0
        self.pieces = []

    def _is_excluded(self, tag: str, attrs: list[tuple[str, str | None]], region: int) -> bool:
        if tag in EXCLUDED or (tag == "header" and not region):
            return True
        for name, value in attrs:
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return True
            if name == "style" and "display:none" in (value or "").replace(" ", "").lower():
                return True
            if name == "role" and not MARKS.isdisjoint(_names(value)) and tag not in UNMARKED:
                return True
            if name in _marking(tag) and tag != "article" and not _SURE.isdisjoint(_names(value)):
                return True
        return False

    def _is_marked(self, tag: str, attrs: list[tuple[str, str | None]], region: int) -> bool:
        """Whether class, id or role may mark an excluded element.

        Inside an article, and of an article itself, whole names and the first and last part of names are
        read; elsewhere every word.
        """
        inside = region or tag == "article"
        for name, value in attrs:
            if name not in _marking(tag):
                continue
            if not inside:
                if any(w in MARKS for n in _names(value) if STATES.isdisjoint(n.split("-")) for w in n.split("-")):
                    return True
                continue
            known = FIRM if tag == "article" else MARKS
            anchor = name == "id" and tag in ANCHORS
            if any(n in known or (not anchor and _is_part(n)) for n in _names(value)):
                return True
        return False

    def _pop_to(self, at: int) -> None:
        del self.open[at:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.flush()
        elif tag == "br":
            self.pieces.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        if tag in _CLOSES_P:
            # an open paragraph ends here, with whatever was left open in it
            for at in range(len(self.open) - 1, 0, -1):
                if self.open[at].name == "p":
                    self._pop_to(at)
                    break
                if self.open[at].name in BLOCKS:
                    break
        top = self.open[-1]
        region, container = top.region, top.container
        if tag in CONTAINERS:
            self.numbered += 1
            self.parents[self.numbered] = container
            container = self.numbered
            if tag in REGIONS:
                region = self.numbered
                self.regions.add(region)
            elif tag in ("body", "html"):
                self.whole.add(container)
        excluded = top.excluded or self._is_excluded(tag, attrs, top.region)
        mark = top.mark
        if not excluded and self._is_marked(tag, attrs, top.region):
            mark = len(self.marks)
            self.marks[mark] = top.mark
        self.open.append(_Open(tag, excluded, region, container, mark))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        elif tag == "br":
            self.pieces.append(" ")
        self.tags += 1
        for at in range(len(self.open) - 1, 0, -1):
            name = self.open[at].name
            if name == tag:
                self._pop_to(at)
                return
            if name in CONTAINERS and tag not in CONTAINERS and tag not in EXCLUDED:
                return  # a stray end tag does not close what is around it

    def handle_data(self, data: str) -> None:
        if self.open[-1].name not in SILENT:
            self.pieces.append(data)


def page_lines(html: str) -> PageLines:
    page = PageLines()
    at, size = 0, CHUNK
    while at < len(html):
        page.feed(html[at : at + size])
        at, size = at + size, 2 * size
    if re.match("<[a-zA-Z/!?]", page.rawdata):
        page.rawdata = ""  # a tag that the page ends in is no text
    page.close()
    page.flush()
    return page


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Gaussian smoothing; weights beyond either end of the page are left out."""
    offsets = np.arange(-RADIUS, RADIUS + 1)
    kernel = np.exp(-(offsets**2) / (2 * SIGMA**2))
    weight = np.convolve(np.ones(len(ratios)), kernel, "full")[RADIUS : RADIUS + len(ratios)]
    return np.convolve(ratios, kernel, "full")[RADIUS : RADIUS + len(ratios)] / weight


def _cluster(lines: list[Line]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ratios of text to tags, smoothed ratios, and whether a line is in the content cluster."""
    # an excluded line has tags but no text to speak of
    ratios = np.array([0 if x.excluded else len(x.text) / max(1, x.tags) for x in lines])
    smooth = smoothed(ratios)
    return ratios, smooth, smooth > THRESHOLD * smooth.std()


def _apply_marks(page: PageLines) -> None:
    """Excludes the lines of marked elements, except of one that holds most of the page's cluster text."""
    lines = page.lines
    if len(page.marks) == 1:
        return
    _, _, cluster = _cluster(lines)
    weight = [len(x.text) if c and not x.excluded else 0 for x, c in zip(lines, cluster, strict=True)]
    if not any(weight):
        weight = [0 if x.excluded else len(x.text) for x in lines]
    held = [0] * len(page.marks)
    for x, w in zip(lines, weight, strict=True):
        held[x.mark] += w
    for at in range(len(held) - 1, 0, -1):  # a mark's number is above that of the mark around it
        held[page.marks[at]] += held[at]
    for x in lines:
        x.excluded = x.excluded or 2 * held[x.mark] <= held[0]


def content_lines(page: PageLines) -> list[str]:
    """Text of the lines in the selected regions, in page order."""
    lines = page.lines
    if not lines:
        return []
    _apply_marks(page)
    ratios, smooth, cluster = _cluster(lines)
    regions = {x.region for x in lines if x.region and not x.excluded}
    found = [x for x, c in zip(lines, cluster, strict=True) if c and not x.excluded]
    held = {x.region for x in found if x.region}
    inside = _masses(page, [x for x in found if x.region])
    main, weight = _heaviest_container(page, [x for x in found if not x.region])
    if regions and weight <= max((inside[r] for r in page.regions), default=0) + BONUS:
        under = _under(page, held or regions)
        return [x.text for x in lines if not x.excluded and under[x.container]]
    if not found:
        return [x.text for x in lines if not x.excluded]
    under = _under(page, {main} | (held if inside[0] >= weight else set()))
    # elsewhere a line must stand out by itself: smoothing reaches over the region's edge
    strong = cluster & (ratios > THRESHOLD * smooth.std())
    return [
        x.text for x, c in zip(lines, strong, strict=True) if not x.excluded and (c or under[x.container])
    ]


def _masses(page: PageLines, found: list[Line]) -> list[int]:
    """Text of the lines in each container and all that is inside it."""
    mass = [0] * (page.numbered + 1)
    for x in found:
        mass[x.container] += len(x.text)
    for at in range(page.numbered, 0, -1):  # a container's number is above its parent's
        mass[page.parents[at]] += mass[at]
    return mass


def _heaviest_container(page: PageLines, found: list[Line]) -> tuple[int, int]:
    """The innermost container of more than half of the text, and its text.

    If only the whole page has that much: the container with most text of its own.
    """
    mass = _masses(page, found)
    at = max(k for k in range(len(mass)) if 2 * mass[k] > mass[0] or k == 0)
    if at in page.whole:
        own: dict[int, int] = {}
        for x in found:
            own[x.container] = own.get(x.container, 0) + len(x.text)
        at = max(own, key=lambda k: (own[k], -k), default=0)
        return at, own.get(at, 0)
    return at, mass[at]


def _under(page: PageLines, chosen: set[int]) -> list[bool]:
    """Per container: whether it is a chosen one or inside one."""
    under = [0 in chosen]
    for at in range(1, page.numbered + 1):
        under.append(at in chosen or under[page.parents[at]])
    return under


def main_text(html: str | None) -> str:
    return "\n".join(content_lines(page_lines(html))) if html else ""


def extract_pages(df: DataFrame, id_column: str, url_column: str, html_column: str) -> DataFrame:
    """Per row: page_id, url, text, n_chars (code points)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, pages in text_groups(batch, 2):
                n = len(pages)
                texts = [main_text(p) for p in pages]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, n).cast(pa.int64()),
                        batch.column(1).slice(start, n),
                        pa.array(texts, pa.string()),
                    ],
                    ["page_id", "url", "text"],
                )

    found = map_arrow(
        df, [id_column, url_column, html_column], run, "page_id bigint, url string, text string"
    )
    return found.withColumn("n_chars", F.char_length("text").cast("bigint"))
