"""Main text of web pages, by the ratio of text to tags.

The standard library's parser sends events; block elements cut the page into lines, each with its text and
the tags seen in it. Lines inside elements that never hold the article (menus, footers, scripts) are set
aside, and so are boxes named as comments or sidebars, however much they hold. Forms and elements whose class or id
names something else of that kind go unless they hold the article: an article or main element, or the main heading and
most of the text, or nearly all of it; or unless nearly nothing would be left. Each other line has the ratio of its
characters to its tags; the ratios are smoothed by a Gaussian over neighbouring lines, so a short
paragraph between long ones counts as text and a long line among links does not. Two-means clustering of
the smoothed ratios gives the threshold; lines above it are content, three or more links in a row are not.

The deepest container with nearly all content is the region; text marked ``article`` or ``main`` weighs four
times. The region stays with its short lines; of a whole page, what is between its first and last content
line, and headings right before. Rows of links go that stand before or after all content with no heading of their own;
references and tables of contents stay.

Within a line white space becomes one blank; lines are joined by an empty line. A null or empty page, and one
without text, has an empty text. Pages are independent of each other, so equal pages have equal texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements by what they hold.
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_ASIDE = frozenset(
    "aside button canvas datalist dialog embed footer head iframe map menu nav noscript object script select style "
    "svg template textarea title".split()
)
_MARKED = frozenset(("article", "main"))
# Elements that may not be closed; another of the same kind closes them.
_SELF_CLOSING = {"li": {"li"}, "p": _BLOCKS, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}
_ASIDE_NAMES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer header masthead menu modal nav navbar navigation newsletter notice popup promo promoted related replies "
    "reply respond share sharing sidebar signup social sponsor sponsored subscribe widget".split()
)
_ARTICLE_NAMES = frozenset("article content entry post single story".split())
# Boxes beside the article, when this is what a name ends in; words that may follow, and words that make it a wrapper's name.
_TALK = frozenset("comment comments discussion disqus replies reply respond responses sidebar".split())
_PARTS_OF_BOXES = frozenset("area block body box container content inner item list section thread wrap wrapper".split())
_WRAPPERS = frozenset("and has no plus with without".split())
_CONTAINERS = frozenset("article body center div main section".split())
_NAME = re.compile(r"[a-z]+")

_GAUSS = np.exp(-0.5 * np.arange(-2, 3) ** 2)
_TEXT_RATIO = 12.0  # characters to a tag; menus have fewer
_MARK_WEIGHT = 4
_NEARLY_ALL = 0.9  # of the content, in its region
_WRAPS = 0.8  # of the page's text, in a wrapper
_LITTLE = 0.1  # of the page's text; less is no article
_LINKED = 0.8  # of a line's characters, in a link list


@dataclass
class Element:
    tag: str
    parent: int
    hint: bool = False  # a name or kind that seldom holds the article
    aside: bool = False
    marked: bool = False  # in an article or main element
    talk: bool = False  # named as comments or a sidebar


@dataclass
class Line:
    parts: list[str] = field(default_factory=list)
    tags: int = 0
    heading: bool = False
    element: int = 0
    hinted: int = 0  # the innermost element around it that is aside or hinted
    linked: int = 0  # characters in links
    text: str = ""


def _is_talk(words: list[str]) -> bool:
    """Whether a name, as its words, is that of a box of comments or a sidebar, not of what has one."""
    last = next((w for w in reversed(words) if w not in _PARTS_OF_BOXES), "")
    return last in _TALK and not _WRAPPERS & set(words)


class _Lines(HTMLParser):
    """Events to lines."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines = [Line()]
        self.elements = [Element("", -1)]  # a parent before its children
        self.open: list[tuple[str, int, int, bool]] = []  # name, element, innermost aside or hinted one, in a link

    def _state(self) -> tuple[int, int, bool]:
        return self.open[-1][1:] if self.open else (0, 0, False)

    def _cut(self) -> None:
        if self.lines[-1].parts:
            self.lines.append(Line())
        else:
            self.lines[-1].heading = False

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _BLOCKS:
            self._cut()
            while self.open and tag in _SELF_CLOSING.get(self.open[-1][0], ()):
                self.open.pop()
        self.lines[-1].tags += 1
        if tag == "br":
            self.lines[-1].parts.append("\n")
        if tag in _EMPTY:
            return
        if tag == "body":
            self.open = []
        parent, hinted, linked = self._state()
        above = self.elements[parent]
        given = [_NAME.findall(name) for key, value in attrs if key in ("class", "id", "role") and value for name in value.lower().split()]
        names = {word for words in given for word in words}
        found = names & _ASIDE_NAMES
        if found == {"header"} and (above.marked or names & _ARTICLE_NAMES):
            found = set()
        may_be = tag not in ("body", "html", "main")
        talk = may_be and any(_is_talk(words) for words in given)
        hint = may_be and bool(found) or tag == "form" or talk
        aside = tag in _ASIDE or tag == "header" and not above.marked
        here = len(self.elements)
        self.elements.append(Element(tag, parent, hint, aside, above.marked or tag in _MARKED, talk))
        self.open.append((tag, here, here if hint or aside else hinted, linked or tag == "a"))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag in _EMPTY:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in _BLOCKS:
            self._cut()
        self.lines[-1].tags += 1
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                del self.open[at:]
                break

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """Sections like ``<![CDATA[`` are comments in a page, whatever their name."""
        return self.rawdata.find(">", i) + 1 or -1

    def handle_data(self, data: str) -> None:
        line, (element, hinted, linked) = self.lines[-1], self._state()
        if not line.parts or not any(p.strip() for p in line.parts):
            line.element, line.hinted = element, hinted
            line.heading = any(o[0] in _HEADINGS for o in self.open[-3:])
        elif hinted != line.hinted and data.strip():
            # Inline elements that are set aside are lines of their own.
            tags, line.tags = line.tags, 1
            line = Line(tags=tags, element=element, hinted=hinted)
            self.lines.append(line)
        line.parts.append(data)
        line.linked += len(data.strip()) * linked


def lines_of(html: str) -> tuple[list[Line], list[Element]]:
    """Lines with text, in page order, and the page's elements."""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    for line in parser.lines:
        line.text = " ".join("".join(line.parts).split())
    return [line for line in parser.lines if line.text], parser.elements


def _below(elements: list[Element], lines: list[Line], weights: list[float]) -> np.ndarray:
    """The weight of the lines in each element and all below it."""
    total = np.zeros(len(elements))
    np.add.at(total, [line.element for line in lines], weights)
    for e in range(len(elements) - 1, 0, -1):
        total[elements[e].parent] += total[e]
    return total


def _inherited(elements: list[Element], own: list[bool]) -> list[bool]:
    for e in range(1, len(elements)):
        own[e] = own[e] or own[elements[e].parent]
    return own


def without_asides(lines: list[Line], elements: list[Element]) -> list[Line]:
    """Lines that are not set aside."""
    never = _inherited(elements, [e.aside for e in elements])
    lines = [line for line in lines if not never[line.element]]
    talk = _inherited(elements, [e.talk for e in elements])
    lines = [line for line in lines if not talk[line.element]] or lines
    text = _below(elements, lines, [len(line.text) for line in lines])
    titles = _below(elements, lines, [float(_in_title(line, elements)) for line in lines])
    boxes = np.zeros(len(elements))  # unhinted article and main elements
    for e in range(len(elements) - 1, 0, -1):
        one = elements[e]
        boxes[e] += one.tag in _MARKED and not one.hint
        boxes[one.parent] += boxes[e]
    # A wrapper of the article, whatever its name.
    marked = np.array([e.tag in _MARKED for e in elements])
    holds = (text > _WRAPS * text[0]) | (text > text[0] / 2) & ((titles > 0) | marked) | (boxes > 0)
    named = _inherited(elements, [e.hint and not h for e, h in zip(elements, holds)])
    left = [line for line in lines if not named[line.element]]
    return left if sum(len(line.text) for line in left) >= _LITTLE * text[0] else lines


def _in_title(line: Line, elements: list[Element]) -> bool:
    at = line.element if line.heading else 0
    while at > 0 and elements[at].tag not in _HEADINGS:
        at = elements[at].parent
    return elements[at].tag == "h1"


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Gaussian mean over two neighbours to each side."""
    width = len(_GAUSS) // 2
    padded = np.pad(ratios, width)
    weights = np.convolve(np.pad(np.ones(len(ratios)), width), _GAUSS, "valid")
    return np.convolve(padded, _GAUSS, "valid") / weights


def threshold(values: np.ndarray) -> float:
    """The border between the two clusters of ``values``; below all of them if they are alike."""
    low, high = values.min(), values.max()
    if high <= 2 * low:
        return low - 1.0
    for _ in range(30):
        border = (low + high) / 2
        below, above = values[values <= border], values[values > border]
        now = below.mean(), above.mean()
        if now == (low, high):
            break
        low, high = now
    return (low + high) / 2


def region(lines: list[Line], elements: list[Element], content: np.ndarray) -> int:
    """The deepest container with nearly all of the content; text in article and main elements weighs more."""
    weights = [
        len(line.text) * c * (_MARK_WEIGHT if elements[line.element].marked else 1) for line, c in zip(lines, content)
    ]
    mass, number = _below(elements, lines, weights), _below(elements, lines, content.astype(float))
    best = 0
    for e in range(1, len(elements)):
        if elements[e].tag in _CONTAINERS and mass[e] >= _NEARLY_ALL * mass[0] and (number[e] >= 3 or number[e] == number[0] or elements[e].marked):
            best = e
    return best


def link_lists(lines: list[Line]) -> np.ndarray:
    """Which lines are in a row of at least three that are links."""
    out = np.zeros(len(lines), bool)
    for begin, end in _link_rows(lines):
        out[begin:end] = True
    return out


def _link_rows(lines: list[Line]) -> list[tuple[int, int]]:
    linked = np.array([line.linked >= _LINKED * len(line.text) for line in lines])
    edges = np.diff(np.pad(linked.astype(np.int8), 1))
    rows = zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist())
    return [(begin, end) for begin, end in rows if end - begin >= 3]


def stray_links(lines: list[Line], content: np.ndarray) -> np.ndarray:
    """Rows of links before or after all content, unless a heading introduces them."""
    out, at = np.zeros(len(lines), bool), np.flatnonzero(content)
    for begin, end in _link_rows(lines):
        inside = len(at) and at[0] < begin and end <= at[-1]
        titled = begin > 0 and lines[begin - 1].heading and not set(_NAME.findall(lines[begin - 1].text.lower())) & _ASIDE_NAMES
        out[begin:end] = not inside and not titled
    return out


def main_lines(lines: list[Line], elements: list[Element]) -> list[str]:
    """The texts of the content region."""
    lines = without_asides(lines, elements)
    if not lines:
        return []
    ratios = np.array([len(line.text) / max(1, line.tags) for line in lines])
    smooth = smoothed(ratios)
    # Where nearly all is text, the clusters are long and short paragraphs; those all stay.
    content = smooth > min(threshold(smooth), _TEXT_RATIO)
    links = link_lists(lines)
    if not links.all():
        content &= ~links
    if not content.any():
        content = ~links if not links.all() else np.ones(len(lines), bool)
    best = region(lines, elements, content)
    inside = _inherited(elements, [e == best for e in range(len(elements))])
    keep = np.array([inside[line.element] for line in lines])
    if elements[best].tag in ("", "html", "body"):
        # The page itself: from the first content line to the last.
        at = np.flatnonzero(content)
        first = at[0]
        while first > 0 and lines[first - 1].heading:
            first -= 1
        keep[:first] = keep[at[-1] + 1:] = False
    stray = stray_links(lines, content)
    if not links.all():
        keep &= ~stray
    return [line.text for line, k in zip(lines, keep) if k]


def main_text(html: str | None) -> str:
    return "\n\n".join(main_lines(*lines_of(html or "")))


def extract(html: Column | str) -> Column:
    """The main text of an html column."""

    @F.arrow_udf("string")
    def extracted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(value.as_py()) for value in batch], pa.string())

    return extracted(html)
