"""Main text of HTML pages: parser events, text-to-tag ratios, Gaussian smoothing and threshold clustering.

The standard library's parser streams a page's events. Every block-level tag ends a line; a line has a text and the number of
tags met on the way, and remembers the elements around it. Lines in menus, headers, footers, sidebars, notices,
adverts, forms and comments are furniture and weigh nothing. The ratio of text to tags per line is smoothed by a Gaussian over
its neighbours; lines over a threshold form clusters. The cluster with most text is the seed. The content region is the smallest
``article`` or ``main`` around the seed's longest line, with the other outermost articles of the page that a cluster reaches, else the smallest element that holds most
of the clusters' text; all its lines that are no furniture are kept, so that short paragraphs between long ones are not lost.

Class and id names mark furniture outside an article by any of their words. Inside one, a name counts only as a whole, so that
``search-results`` or ``tags-explained`` hide nothing, and a paragraph must have no other name. Open elements are counted by tag and an
element knows its parent's answers, so the work grows with the page, however deep its tags are nested.

Edge cases: a null page, an empty one, or one without text gives an empty text; unclosed and misnested tags are accepted, as are left out
ones around head and body, a page
cut off anywhere gives what came before; repeated rows are extracted each on its own; an empty table gives an empty table;
other columns are not read; nothing is dropped or capped by length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import text_or_empty

#: Standard deviation of the smoothing, in lines; the threshold, as a share of the smoothed ratios' standard deviation.
SIGMA = 1.0
THRESHOLD_SHARE = 0.5
#: Share of the clusters' text that the content region must hold where no element names the article.
REGION_SHARE = 0.9

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never shown as text.
HIDDEN = frozenset("script style template noscript head title iframe object svg math canvas audio video select datalist".split())
FURNITURE = frozenset("nav header footer aside form button menu dialog fieldset label textarea".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2"
    " h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead"
    " tr ul".split()
)
#: Elements that a head may hold; any other, or text, ends a head that is still open.
IN_HEAD = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
#: Tags that an opening block ends when they are still open; and what a tag of the same kind ends.
ENDED_BY_BLOCK = frozenset(["p"])
ENDED_BY_SAME = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",), "option": ("select",)}
CONTAINERS = frozenset(["", *"article body center div html main section table tbody td tr".split()])
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
_WORDS = (
    r"(?:ads?|ad-?(?:box|container|slot|unit|wrapper)|adverts?|advertisements?|advertorial|banners?|sponsor(?:ed|s)?|promos?|promotions?|nav(?:bar|igation)?|menus?|"
    r"breadcrumbs?|sidebars?|side|aside|widgets?|footers?|foot|site-?header|page-?header|masthead|topbar|toolbar|comments?|"
    r"commentlist|disqus|replies|respond|reactions?|related|recommend(?:ed|ations?)?|more-?stories|share|sharing|social|"
    r"newsletter|subscribe|subscription|signup|sign-?up|login|cookies?|consent|gdpr|notices?|alerts?|popups?|modals?|overlay|"
    r"pagination|pager|tags|taglist|legal|copyright|disclaimer|skip-?link|search)"
)
_NAMES = re.compile(rf"(?:^|[\s_-]){_WORDS}(?=$|[\s_-])")
#: Words that say where or in what shape a thing stands, not what it is.
_SHAPES = (
    r"(?:site|page|post|article|entry|main|inline|in|top|bottom|left|right|the|box|container|wrapper|wrap|slot|unit|block|bar|area|section|"
    r"panel|list|item|items|link|links|button|buttons|icon|icons|form|\d+)"
)
_WHOLE_NAME = re.compile(rf"(?:{_SHAPES}[_-]+)*{_WORDS}(?:[_-]+(?:{_SHAPES}|{_WORDS}))*")
#: A tag that the end of the page cuts off is no text.
_CUT_TAG = re.compile(r"<[a-zA-Z/!][^<>]*\Z")
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar note".split())


class _Element:
    """An open or closed element; what holds for its parent is settled when it opens."""

    __slots__ = ("tag", "parent", "hidden", "furniture", "article", "outermost", "depth", "inline", "ends", "held", "inside")

    def __init__(self, tag: str, parent: _Element | None, attributes: list[tuple[str, str | None]]) -> None:
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        #: Tags that are open inside this block without another block around them.
        self.inline: dict[str, int] = {} if tag in BLOCKS or not parent else parent.inline
        #: What an opening block of a tag closes from here, once asked.
        self.ends: dict[str, _Element | None] | None = None
        self.held, self.inside = 0.0, False
        held = dict(attributes)
        role = (held.get("role") or "").lower()
        style = (held.get("style") or "").replace(" ", "").lower()
        gone = tag in HIDDEN or "hidden" in held or "display:none" in style or held.get("aria-hidden") == "true"
        self.hidden = gone or bool(parent and parent.hidden)
        names = " ".join(filter(None, (held.get("class"), held.get("id")))).lower()
        around = parent.article if parent else None
        #: The innermost article or main that holds the element, itself included; the outermost ``article`` alone.
        self.article = self if tag in ("article", "main") or role in ("main", "article") else around
        self.outermost = parent.outermost if parent else None
        if self.outermost is None and (tag == "article" or role == "article") and not any(map(_WHOLE_NAME.fullmatch, names.split())):
            self.outermost = self
        marked = tag in FURNITURE or role in _ROLES or bool(names) and self._named(names, around is not None)
        self.furniture = marked or bool(parent and parent.furniture)
        if tag in HEADINGS and parent and parent.tag in ("header", "hgroup") and parent.article:
            self.furniture = parent.parent.furniture  # an article's own header holds its headline

    def _named(self, names: str, in_article: bool) -> bool:
        """Whether class and id make the element furniture."""
        if self.tag in ("html", "body", "article", "main") or not (self.tag in BLOCKS or self.tag in ("span", "a") or "-" in self.tag):
            return False
        if not in_article:
            return bool(_NAMES.search(names))
        return (all if self.tag == "p" else any)(map(_WHOLE_NAME.fullmatch, names.split()))


class _Lines(HTMLParser):
    """Collects ``(element, text, tags)`` of each line."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.top = _Element("", None, [])
        self.elements = [self.top]
        self._open: Counter = Counter()
        self.lines: list[tuple[_Element, str, int]] = []
        self._parts: list[str] = []
        self._tags = 0
        self._visible, self._at = False, self.top

    def end_line(self) -> None:
        text = " ".join("".join(self._parts).split())
        if text:
            self.lines.append((self._at, text, self._tags))
            self._tags = 0
        self._parts, self._visible = [], False

    def handle_starttag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        self._tags += 1
        if tag == "br":
            self._parts.append("\n")
        if tag == "body" or self.top.tag == "head" and tag not in IN_HEAD:
            self._close_head()
        if tag in BLOCKS:
            self.end_line()
            self._close_implied(tag)
        if tag not in VOID:
            opened = _Element(tag, self.top, attributes)
            if opened.furniture and not self.top.furniture:
                self.end_line()
            self._open[tag] += 1
            if tag not in BLOCKS:
                opened.inline[tag] = opened.inline.get(tag, 0) + 1
            self.elements.append(opened)
            self.top = opened

    def handle_startendtag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attributes)  # the slash means nothing in HTML

    def _close(self, element: _Element) -> None:
        """Close ``element`` and all that is open inside it."""
        while True:
            closed = self.top
            self._open[closed.tag] -= 1
            if closed.tag not in BLOCKS:
                closed.inline[closed.tag] -= 1
            self.top = closed.parent
            if closed is element:
                return

    def _nearest(self, tag: str) -> _Element:
        return next(element for element in _around(self.top) if element.tag == tag)

    def _close_head(self) -> None:
        if self._open["head"]:
            self._close(self._nearest("head"))

    def _close_implied(self, tag: str) -> None:
        """Close what an opening block ends; each element remembers the answer for the tag, so no stretch is walked twice."""
        limits = ENDED_BY_SAME.get(tag, ())
        found, passed, element = None, [], self.top
        while element.parent and not (element.ends and tag in element.ends):
            passed.append(element)
            if element.tag in ENDED_BY_BLOCK or limits and element.tag == tag:
                found = element
                break
            if element.tag in BLOCKS and (not limits or element.tag in limits):
                break
            element = element.parent
        else:
            found = element.ends[tag] if element.parent else None
        for element in passed:
            if element.ends is None:
                element.ends = {}
            element.ends[tag] = found
        if found:
            self._close(found)

    def handle_endtag(self, tag: str) -> None:
        self._tags += 1
        if tag in BLOCKS:
            self.end_line()
        # an inline end tag does not close the block around it
        if (self._open if tag in BLOCKS else self.top.inline).get(tag):
            element = self._nearest(tag)
            if element.furniture and not element.parent.furniture:
                self.end_line()
            self._close(element)

    def handle_data(self, data: str) -> None:
        if self.top.tag == "head" and data.strip():
            self._close_head()
        if self.top.hidden:
            return
        if not self._visible and data.strip():
            self._visible, self._at = True, self.top  # a line belongs to the element of its first visible text
        self._parts.append(data)


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = max(1, round(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    padded = np.pad(ratios, reach, mode="edge")
    return np.convolve(padded, kernel / kernel.sum(), "valid")


def _clusters(values: np.ndarray) -> list[np.ndarray]:
    """Runs of lines whose smoothed ratio reaches the threshold."""
    over = np.flatnonzero(values >= THRESHOLD_SHARE * values.std()) if len(values) else np.zeros(0, int)
    return [run for run in np.split(over, np.flatnonzero(np.diff(over) > 1) + 1) if len(run)]


def _around(element: _Element | None) -> Iterator[_Element]:
    while element:
        yield element
        element = element.parent


def _regions(lines: list[tuple[_Element, str, int]], elements: list[_Element]) -> list[_Element]:
    """The elements that hold the content; none on a page of furniture alone."""
    weights = np.array([0.0 if element.furniture else float(len(text)) for element, text, _ in lines])
    if not weights.any():
        return []
    tags = np.array([max(1, tags) for _, _, tags in lines])
    clusters = _clusters(smoothed(weights / tags))
    seed = max(clusters, key=lambda run: weights[run].sum())
    named = lines[seed[np.argmax(weights[seed])]][0].article
    reached = [line for line in np.concatenate(clusters).tolist() if weights[line]]
    if named:
        return [named, *{lines[line][0].outermost for line in reached if lines[line][0].outermost}]
    for line in reached:
        lines[line][0].held += weights[line]
    for element in reversed(elements[1:]):  # an element stands behind its parent
        element.parent.held += element.held
    most = REGION_SHARE * elements[0].held
    holders = [element for element in elements if element.held >= most and element.tag in CONTAINERS]
    return [max(holders, key=lambda element: element.depth)]


def main_text(html: str) -> str:
    """The main text of a page, its blocks joined by single blanks."""
    parser = _Lines()
    parser.feed(_CUT_TAG.sub("", html))
    parser.close()
    parser.end_line()
    for region in _regions(parser.lines, parser.elements):
        region.inside = True
    for element in parser.elements[1:]:
        element.inside = element.inside or element.parent.inside
    return " ".join(text for element, text, _ in parser.lines if element.inside and not element.furniture)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of each page."""

    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for htmls in batches:
            yield htmls.map(main_text)

    read = pages.select("page_id", "url", text_of(text_or_empty(html_col)).alias("text"))
    return read.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
