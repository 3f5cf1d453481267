"""Main text of web pages, by the ratio of text to tags.

The page goes through the standard library's parser as a stream of events, which
become lines: the text between two block boundaries, with the number of tags in
it. A line's ratio is its characters over its tags, not counting those in links.
The ratios are smoothed with a Gaussian, and lines above a threshold, their standard
deviation, are the content that the region is chosen by: of the sectioning elements
that hold such lines, the one with most of their text, widened to the article or main
element it stands in. Within the region, lines that are mostly links stand or fall
by the ratios: a run of them is a menu, whatever it is called, if the threshold is
not reached all along the run, and some other line of the region reaches it. All other lines are kept, short ones too, except those in elements
that are no content by their kind: menus, headers, footers, asides, forms, scripts,
styles, notices, adverts and comments.

Text in an article is preferred, unless the lines above the threshold outside of
articles are more than twice as long as the longest article.

A class, id or role that names such a kind marks an element, but can also stand
on a wrapper of the page's content ("has-sidebar"). A mark is void if an article
inside is longer than the lines above the threshold that no mark covers (twice
as long, if one of those is in an article), or if the marked element's lines
above the threshold are five times as long as all that no mark covers and no
article stands elsewhere. For marks of comments only the second holds.

Defined results
* A null or empty page, and one without content, gives an empty text.
* Tags that are never closed end with the element around them, or the page. A
  tag cut off by the end of the page is left out.
* Repeated rows come out as often as they come in; an empty table gives none.
* Columns other than the three named ones are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline.llm.text import slices

SIGMA = 1.0

# The elements of HTML by what they are to a text extractor.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var wbr".split()
)
NO_CONTENT = frozenset(
    "head title script style noscript template nav footer aside form button select option textarea fieldset"
    " iframe object svg canvas audio video menu dialog".split()
)
SECTIONS = frozenset("html body main article section div td".split())
# Words in classes, ids and roles of elements that are no content.
NO_CONTENT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising advertorial sponsor sponsored promo promotion banner"
    " cookie cookies consent gdpr notice notices alert popup modal overlay sidebar complementary nav navbar"
    " navigation menu breadcrumb breadcrumbs footer contentinfo masthead comment comments respond replies reply"
    " discussion disqus share sharing social related recommended newsletter subscribe subscription signup login"
    " search pagination pager widget".split()
)

TALK_WORDS = frozenset("comment comments respond replies reply discussion disqus".split())
# How much longer text has to be than what it is preferred to.
OVER_ARTICLE = 2
# A line of which so much stands in links is one of links.
LINK_SHARE = 0.8
OVER_UNMARKED = 5

_WORD = re.compile(r"[a-z]+")
_CUT_TAG = re.compile(r"<[A-Za-z/!?][^>]*\Z")


@dataclass
class Element:
    tag: str
    number: int
    content: bool
    section: Element | None = field(repr=False, default=None)
    article: Element | None = field(repr=False, default=None)
    mark: int = -1
    link: bool = False


@dataclass
class Mark:
    """An element whose class, id or role has a word for what is no content."""

    outer: int
    number: int
    article: Element | None = field(repr=False)
    talk: bool


class Lines(HTMLParser):
    """Parser events to lines: text, tags, and the section they stand in."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Element("html", 0, True)
        self.root.section = self.root
        self.stack = [self.root]
        self.sections = [self.root]
        self.parents = [-1]
        self.marks: list[Mark] = []
        self.buffer: list[str] = []
        self.tags = 0
        self.linked = 0
        self.links: list[float] = []  # the share of each line that stands in links
        self.lines: list[tuple[str, int, Element]] = []

    def end_line(self) -> None:
        text = " ".join("".join(self.buffer).split())
        if text:
            self.lines.append((text, self.tags, self.stack[-1]))
            self.links.append(min(1.0, self.linked / len(text)))
        self.buffer.clear()
        self.tags = self.linked = 0

    def handle_data(self, data: str) -> None:
        self.buffer.append(data)
        if self.stack[-1].link:
            self.linked += len(" ".join(data.split()))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in INLINE:
            self.end_line()
        self.tags += 1
        if tag in VOID:
            return
        above = self.stack[-1]
        content, mark = above.content and tag not in NO_CONTENT, above.mark
        if tag == "header":  # a page's, not an article's
            content = content and above.article is not None
        elif content and tag not in ("html", "body", "main", "article"):
            named = " ".join(v or "" for k, v in attrs if k in ("class", "id", "role"))
            words = NO_CONTENT_WORDS.intersection(_WORD.findall(named.lower()))
            if words:
                talk = bool(words & TALK_WORDS) or (mark >= 0 and self.marks[mark].talk)
                self.marks.append(Mark(mark, len(self.sections), above.article, talk))
                mark = len(self.marks) - 1
        elif tag == "article" and attrs:
            named = " ".join(v or "" for k, v in attrs if k in ("class", "id"))
            content = content and NO_CONTENT_WORDS.isdisjoint({"comment", "reply"} & set(_WORD.findall(named.lower())))
        elif tag == "main" and not (above.content and mark < 0):  # what stands around it was never closed
            content, mark = True, -1
        # A block in a link is text of its own; the link may never have been closed.
        link = (above.link and tag in INLINE) or (tag == "a" and any(k == "href" for k, _ in attrs))
        element = Element(tag, len(self.sections), content, above.section, above.article, mark, link)
        if tag in SECTIONS:
            self.parents.append(above.section.number)
            self.sections.append(element)
            element.section = element
        if tag in ("article", "main"):
            element.article = element
        self.stack.append(element)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self.end_line()
        self.tags += 1
        for at in range(len(self.stack) - 1, 0, -1):
            found = self.stack[at].tag
            if found == tag:
                del self.stack[at:]
                return
            # An inline end tag does not close blocks, nor a block its section.
            if found in SECTIONS and tag not in SECTIONS and tag not in NO_CONTENT and tag != "header":
                return


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """The ratios, each averaged with its neighbours under a Gaussian."""
    reach = max(1, int(np.ceil(3 * sigma)))
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    total = np.convolve(np.pad(ratios, reach), weights, mode="valid")
    return total / np.convolve(np.pad(np.ones(len(ratios)), reach), weights, mode="valid")


def _outermost(article: Element, parents: list[int], sections: list[Element]) -> Element:
    outer = sections[parents[article.number]]
    while outer.article is not None:
        article = outer.article
        outer = sections[parents[article.number]]
    return article


def _longest_article(at: np.ndarray, lines: list[tuple[str, int, Element]], least: int = 0) -> float:
    """The length of the longest article of some lines, of those numbered from ``least``."""
    lengths: dict[int, float] = {}
    for n in at:
        text, _, place = lines[n]
        if place.article is not None and place.article.number >= least:
            lengths[place.article.number] = lengths.get(place.article.number, 0.0) + len(text)
    return max(lengths.values(), default=0.0)


def unmarked(parser: Lines, sizes: np.ndarray, smooth: np.ndarray) -> np.ndarray:
    """Which lines are content, when marks on wrappers of the content are void."""
    lines, marks = parser.lines, parser.marks
    kind = np.array([place.content for _, _, place in lines])
    mark = np.array([place.mark for _, _, place in lines])
    if not (kind & (mark >= 0)).any():
        return kind
    rated = kind & (smooth >= min(smooth.std(), smooth[kind].max()))
    talk = np.array([m >= 0 and marks[m].talk for m in mark])
    void: set[int] = set()
    while True:
        # The outermost mark in force; only those can become void.
        tops: list[int] = []
        for m, own in enumerate(marks):
            above = tops[own.outer] if own.outer >= 0 else -1
            tops.append(above if above >= 0 or m in void else m)
        top = np.array([*tops, -1])[mark]
        free = kind & (top < 0)
        places = {lines[n][2].article.number: lines[n][2].article for n in np.flatnonzero(free) if lines[n][2].article}
        by_article, by_length = [], []
        for m in sorted(set(top[kind & (top >= 0)].tolist())):
            own = marks[m]
            around = set()
            article = own.article
            while article is not None:
                around.add(article.number)
                article = parser.sections[parser.parents[article.number]].article
            elsewhere = not around.issuperset(places)
            if not own.talk and (own.article is None or own.article.tag == "main"):
                longest = _longest_article(np.flatnonzero(kind & ~talk & (top == m)), lines, own.number)
                if longest > (OVER_ARTICLE if elsewhere else 1) * sizes[rated & free].sum():
                    by_article.append((longest, -m))
            length = sizes[rated & (top == m)].sum()
            if length and not elsewhere and length >= OVER_UNMARKED * sizes[free].sum():
                by_length.append((not own.talk, length, -m))
        if by_article:
            void.add(-max(by_article)[-1])
        elif by_length:
            void.add(-max(by_length)[-1])
        else:
            return free


def main_text(html: str, sigma: float = SIGMA) -> str:
    """The text of the page's content region."""
    parser = Lines()
    parser.feed(_CUT_TAG.sub("", html))
    parser.close()
    parser.end_line()
    lines = parser.lines
    if not lines:
        return ""
    sizes = np.array([len(text) for text, _, _ in lines], dtype=float)
    links = np.array(parser.links)
    smooth = smoothed(sizes * (1 - links) / np.maximum(1, [tags for _, tags, _ in lines]), sigma)
    content = unmarked(parser, sizes, smooth)
    if not content.any():
        return ""
    in_article = content & np.array([place.article is not None for _, _, place in lines])
    above = lambda able: able & (smooth >= min(smooth.std(), smooth[able].max()))
    chosen = above(in_article if in_article.any() else content)
    outside = content & ~in_article
    if in_article.any() and outside.any():
        whole: dict[int, float] = {}
        for n in np.flatnonzero(in_article):
            number = _outermost(lines[n][2].article, parser.parents, parser.sections).number
            whole[number] = whole.get(number, 0.0) + sizes[n]
        if sizes[above(outside)].sum() > OVER_ARTICLE * max(whole.values()):
            chosen = above(outside)
    weight: dict[int, float] = {}
    for n in np.flatnonzero(chosen):
        number = lines[n][2].section.number
        weight[number] = weight.get(number, 0.0) + sizes[n]
    region = parser.sections[max(weight, key=lambda k: (weight[k], -k))]
    total = sum(weight.values())
    inside = {region.number}
    while region.article is None and region.number and sum(
        w for k, w in weight.items() if _within(k, region.number, parser.parents)
    ) < total / 2:
        region = parser.sections[parser.parents[region.number]]
    if region.article is not None:  # or an article in a main element
        region = _outermost(region.article, parser.parents, parser.sections)
    inside = {k for k in {place.section.number for _, _, place in lines} if _within(k, region.number, parser.parents)}
    kept = content & np.array([place.section.number in inside for _, _, place in lines])
    threshold = min(smooth.std(), smooth[kept].max())
    kept &= ~menu_lines(kept, links, smooth, threshold)
    return " ".join(text for (text, _, _), stays in zip(lines, kept) if stays)


def menu_lines(region: np.ndarray, links: np.ndarray, smooth: np.ndarray, threshold: float) -> np.ndarray:
    """Which of a region's lines stand in runs of links that fall below the threshold."""
    linked = region & (links >= LINK_SHARE)
    menus = np.zeros(len(region), dtype=bool)
    if not linked.any():
        return menus
    at = np.flatnonzero(region)
    runs = np.cumsum(np.diff(linked[at], prepend=False))
    for run in np.unique(runs[linked[at]]):
        members = at[runs == run]
        menus[members] = (smooth[members] < threshold).any()
    # Without a rated line beside them, the links are what the page is about.
    return menus & (smooth[region & ~linked] >= threshold).any()


def _within(number: int, outer: int, parents: list[int]) -> bool:
    while number > outer:
        number = parents[number]
    return number == outer


def extracted(
    pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", sigma: float = SIGMA
) -> DataFrame:
    """``id_col``, ``url_col``, ``text`` and ``n_chars`` of every page."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, htmls in slices(batch, "html"):
                texts = [main_text(h, sigma) for h in htmls]
                yield pa.RecordBatch.from_pydict({
                    "id": part.column("id"),
                    "url": part.column("url"),
                    "text": pa.array(texts, pa.string()),
                    "n_chars": pa.array(map(len, texts), pa.int64()),
                })

    kinds = dict(rows.dtypes)
    found = rows.mapInArrow(extract, f"id {kinds['id']}, url {kinds['url']}, text string, n_chars long")
    return found.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
