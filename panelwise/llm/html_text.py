"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped to lines, one per block of the page, and the empty lines that the ends
of containers leave are kept.  The sum of text lengths over a sliding window of lines rises
where an article begins (surge) and falls to nothing where it ends (dive).  Text from the
first surge to the last dive is the article; menus and other short lines make low sums and
never surge.  Names of elements are further evidence: lines of navigation, forms and the
like count nothing, and where a page marks articles, the sums say which of them are full ones.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from panelwise.llm.common import filled

#: Lines in a window.
WINDOW = 3
#: A part whose fullest window has this share of the page's fullest holds main text too.
SURGE = 1 / 3
#: Text in a window from which on a part's main text begins, if that share of the fullest is more.
SURGE_CHARS = 60

# Element names of HTML.
HIDDEN = frozenset("script style noscript template title textarea select svg math iframe object canvas audio video".split())
BOILERPLATE = frozenset("nav header footer aside form button menu dialog".split())
CONTAINERS = frozenset("article main".split())
PARTS = frozenset("body".split())
#: Containers whose ends leave an empty line.
SPACED = frozenset("section div table ul ol dl figure blockquote".split())
BLOCKS = frozenset(
    "address blockquote caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hr li ol "
    "p pre section summary table tbody td tfoot th thead tr ul".split()
)
UNLABELLED = frozenset("html body h1 h2 h3 h4 h5 h6 a b i em strong table thead tbody tr td th".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LABELS = frozenset(
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus disclaimer footer gdpr header masthead menu modal nav navbar navigation newsletter notice "
    "notices overlay pagination popup promo promoted promotion recommended related replies reply respond share "
    "sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget".split()
)
#: A compound name is a label if it has labels and such words alone (ad-box, related-posts), or if its last word is a
#: label (site-footer) and its first does not say that something else has one (with-sidebar); related-work is none.
FRAMES = frozenset(
    "area articles bar block body box button buttons container cta form group holder icons inner item items link links list "
    "outer panel posts section slot stories unit wrap wrapper".split()
)
STATES = frozenset("has have hide hides no not show shows with without".split())
#: Boilerplate that frameworks also put around a whole page.
AROUND = frozenset("form dialog".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())

_NAME = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9:-]*+)")
_INSIDE = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+")
_ATTRIBUTE = re.compile(r"([^\s\"'=/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: End tags that HTML lets a page leave out: the elements that a start tag ends, if they stand right around it.
_ENDED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}}
_ENDED |= {"tr": {"td", "th", "tr"}} | {x: {"td", "th", "tr", "tbody", "thead", "tfoot"} for x in ("tbody", "thead", "tfoot")}
_SPECIAL = BLOCKS | BOILERPLATE | CONTAINERS | PARTS | {"html"}
#: End tags of other elements do not reach out of these.
_CELLS = frozenset("td th caption".split())
_TABLE = frozenset("table tbody thead tfoot tr td th caption body html".split())


def _is_label(token: str) -> bool:
    words = [w.lower() for w in _WORD.findall(token)]
    words = [w for w in words if len(w) > 1]
    if any(w in LABELS for w in words) and all(w in LABELS or w in FRAMES for w in words):
        return True
    return bool(words) and words[-1] in LABELS and words[0] not in STATES


def _unwanted(name: str, attributes: str) -> str:
    """Why an element may be left out: "unseen", "named" by its element or role, "labelled" by a class or id, or not at all."""
    if attributes and _HIDING.search(attributes) and _unseen(attributes):
        return "unseen"
    if name in BOILERPLATE:
        return "named"
    if not attributes:
        return ""
    labelled = ""
    for kind, *values in _ATTRIBUTE.findall(attributes):
        kind, value = kind.lower(), "".join(values)
        if kind == "role":
            if value.strip().lower() in ROLES:
                return "named"
        elif kind in ("class", "id") and name not in UNLABELLED and any(map(_is_label, value.split())):
            labelled = "labelled"
    return labelled


_HIDING = re.compile(r"hidden|display", re.IGNORECASE)
_NOT_SHOWN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.IGNORECASE)


def _unseen(attributes: str) -> bool:
    """Whether the attributes say that a reader does not see the element."""
    for kind, *values in _ATTRIBUTE.findall(attributes):
        kind, value = kind.lower(), "".join(values)
        if kind == "hidden" or (kind == "style" and _NOT_SHOWN.search(value)):
            return True
    return False


@dataclass
class _Element:
    name: str
    why: str
    around: bool
    first: int
    #: Number of the tag that ends it, and whether that is its own end tag.
    last: int = -1
    closed: bool = False


class _Open:
    """Elements that are open; every step takes constant time, elements that it closes aside."""

    def __init__(self):
        self.stack: list[_Element] = []
        self.at: dict[str, list[int]] = {}
        self.special: list[int] = []
        self.cells: list[int] = []

    def push(self, element: _Element) -> None:
        spot, name = len(self.stack), element.name
        self.stack.append(element)
        self.at.setdefault(name, []).append(spot)
        if name in _SPECIAL:
            self.special.append(spot)
        if name in _CELLS:
            self.cells.append(spot)

    def cut(self, spot: int, tag: int) -> None:
        """The elements from ``spot`` on end at the tag."""
        while len(self.stack) > spot:
            element = self.stack.pop()
            element.last = tag
            self.at[element.name].pop()
            if element.name in _SPECIAL:
                self.special.pop()
            if element.name in _CELLS:
                self.cells.pop()

    def start(self, name: str, tag: int) -> None:
        """What a start tag ends: an open paragraph before a block, a list item before the next."""
        if not self.stack:
            return
        if name in _SPECIAL and self.special and self.stack[self.special[-1]].name == "p":
            self.cut(self.special[-1], tag)
        ended = _ENDED.get(name)
        while ended and self.special and self.stack[self.special[-1]].name in ended:
            self.cut(self.special[-1], tag)

    def end(self, name: str, tag: int) -> None:
        """What an end tag ends; those of inline elements do not reach out of a block."""
        spots = self.at.get(name)
        if not spots:
            return
        if name not in _SPECIAL and self.special and spots[-1] < self.special[-1]:
            return
        if name not in _TABLE and self.cells and spots[-1] < self.cells[-1]:
            return
        self.stack[spots[-1]].closed = True
        self.cut(spots[-1], tag)


class _Tags:
    """The tags of a page; every character is looked at a fixed number of times.

    Quotes in a tag hide what is between them, until one is found that does not end: from
    then on tags end at the next >.  A tag that nothing ends takes the rest of the page.
    """

    def __init__(self, html: str):
        self.html, self.quoted = html, True

    def after(self, at: int) -> tuple[int, int, str, str, str] | None:
        """(begin, end, "/" or none, name, attributes) of the next tag; comments and declarations have no name."""
        html = self.html
        while (at := html.find("<", at)) >= 0:
            if html.startswith("<!--", at):
                end = html.find("-->", at + 4)
                return at, len(html) if end < 0 else end + 3, "", "", ""
            declared = html.startswith(("<!", "<?"), at)
            name = None if declared else _NAME.match(html, at + 1)
            if not declared and not name:
                at += 1
                continue
            end = at
            if name:
                end = _INSIDE.match(html, name.end()).end() if self.quoted else len(html)
            if end == len(html) or html[end] != ">":
                self.quoted = self.quoted and not name
                end = html.find(">", name.end() if name else at)
            if end < 0:
                return at, len(html), "", "", ""
            return at, end + 1, *((name[1], name[2], html[name.end() : end]) if name else ("", "", ""))
        return None


def _parsed(html: str) -> tuple[list[tuple[str, str, str]], list[_Element]]:
    """Tags as text before, mark ("/", "-" for a hidden element, or none) and name; and the elements in page order.

    A last tag without a name has the text after all others.  An element that
    is not closed ends where its parent does.
    """
    tags: list[tuple[str, str, str]] = []
    elements: list[_Element] = []
    still = _Open()
    at, before = 0, []
    reader = _Tags(html)
    while tag := reader.after(at):
        start, end, closing, name, attributes = tag
        before.append(html[at:start])
        at, name = end, name.lower()
        if not name:
            continue
        text = "".join(before)
        before = []
        number = len(tags)
        if closing:
            still.end(name, number)
        elif name in HIDDEN:
            if not attributes.endswith("/"):
                end = _raw_end(html, name, at)
                at = len(html) if end is None else end
            closing = "-"
        elif name not in VOID:
            still.start(name, number)
            why = _unwanted(name, attributes)
            element = _Element(name, why, name in AROUND or (why == "named" and name not in BOILERPLATE), number)
            elements.append(element)
            if attributes.endswith("/"):
                element.last, element.closed = number, True
            else:
                still.push(element)
        tags.append((text, closing, name))
    before.append(html[at:])
    still.cut(0, len(tags))
    tags.append(("".join(before), "", ""))
    return tags, elements


def _left_out(tags: list[tuple[str, str, str]], elements: list[_Element]) -> dict[int, _Element]:
    """The unwanted elements by the number of their start tag.

    Kept all the same: an element that is or holds the main element; one with most of the page's
    text if it is labelled, not closed, or has an article in it, other than an article of its own
    label beside one without; and labelled ones if the page would have no text without them.
    """
    unwanted = [e for e in elements if e.why]
    if not unwanted:
        return {}
    size = list(accumulate(len(text.strip()) for text, _, _ in tags))
    mains = [e.first for e in elements if e.name == "main"]
    articles = [e.first for e in elements if e.name == "article" and not e.why]

    def holds(spots: list[int], e: _Element) -> bool:
        return bisect_left(spots, e.first) < bisect_left(spots, e.last)

    free, reach = False, -1
    for e in elements:
        if e.why:
            reach = max(reach, e.last)
        elif e.name in CONTAINERS and e.first >= reach:
            free = True

    def shut(chosen: list[_Element]) -> int:
        """Size of the text in the elements, which may lie in each other."""
        total, reach = 0, 0
        for e in chosen:
            total += max(size[e.last] - size[max(e.first, reach)], 0)
            reach = max(reach, e.last)
        return total

    def spared(e: _Element, text: int) -> bool:
        if e.name == "main" or holds(mains, e):
            return True
        if 2 * (size[e.last] - size[e.first]) <= text or (e.name == "article" and free):
            return False
        return e.why == "labelled" or e.around or not e.closed or holds(articles, e)

    unseen = [e for e in unwanted if e.why == "unseen"]
    named = unseen + [e for e in unwanted if e.why == "named" and not spared(e, size[-1])]
    named.sort(key=lambda e: e.first)
    text = size[-1] - shut(named)
    out = named + [e for e in unwanted if e.why == "labelled" and not spared(e, text)]
    if shut(sorted(out, key=lambda e: e.first)) >= size[-1]:
        out = named
    return {e.first: e for e in out}


def lines_of(html: str) -> tuple[list[str], list[int]]:
    """The page's lines, and for each the number of the article or main element it is in, or -1.

    Hidden and boilerplate elements are left out, each leaving ``WINDOW`` empty lines, as
    do the ends of article and main elements and of the body; other containers leave one.
    """
    lines: list[str] = []
    inside: list[int] = []
    text: list[str] = []
    open_containers: list[tuple[str, int]] = []
    made = 0

    def flush() -> None:
        line = " ".join(unescape("".join(text)).split())
        text.clear()
        if line:
            lines.append(line)
            inside.append(open_containers[0][1] if open_containers else -1)

    def gap() -> None:
        flush()
        lines.extend([""] * WINDOW)
        inside.extend([-1] * WINDOW)

    tags, elements = _parsed(html)
    unwanted = _left_out(tags, elements)
    at, silent = 0, False
    while at < len(tags):
        before, mark, name = tags[at]
        if not silent:
            text.append(before)
        silent = False
        if mark == "-":
            if name == "title":
                flush()
        elif not mark and at in unwanted:
            flush()
            if not open_containers:
                gap()
            element = unwanted[at]
            if element.last > at:
                # Its text ends before the tag that ends it; only its own end tag goes with it.
                at, silent = element.last, True
                if not element.closed:
                    continue
                silent = False
        elif name in CONTAINERS:
            if mark:
                names = [n for n, _ in open_containers]
                if name in names:
                    flush()
                    del open_containers[len(names) - 1 - names[::-1].index(name) :]
                    if not open_containers:
                        gap()
            else:
                gap() if not open_containers else flush()
                open_containers.append((name, made))
                made += 1
        elif name in PARTS:
            flush() if open_containers else gap()
        elif name in BLOCKS or name == "head":
            flush()
            if name in SPACED:
                lines.append("")
                inside.append(open_containers[0][1] if open_containers else -1)
        elif name == "br":
            text.append(" ")
        at += 1
    flush()
    return lines, inside


def _raw_end(html: str, name: str, start: int) -> int | None:
    end = re.compile(rf"</{name}\b[^>]*>", re.IGNORECASE).search(html, start)
    return end.end() if end else None


def window_sums(lines: list[str], window: int = WINDOW) -> list[int]:
    """Text in each line and the ``window`` - 1 lines after it."""
    run = [0, *accumulate(map(len, lines))]
    return [run[min(i + window, len(lines))] - run[i] for i in range(len(lines))]


def regions(lines: list[str], window: int = WINDOW) -> list[tuple[int, int, int]]:
    """Parts between dives: first line, line after the last, fullest window.  A dive is a window without text."""
    found: list[tuple[int, int, int]] = []
    start = None
    sums = window_sums(lines, window)
    for i, total in enumerate(sums):
        if start is None and lines[i]:
            start = i
        if start is not None and total == 0:
            found.append((start, i, max(sums[start:i])))
            start = None
    if start is not None:
        found.append((start, len(lines), max(sums[start:])))
    return found


def main_text(html: str, window: int = WINDOW, surge: float = SURGE) -> str:
    """Text of the page's article: blocks in page order, one line each.

    A part is full if its fullest window has ``surge`` of the fullest of all.  Where
    the page has article or main elements with text, the full ones of those are it, whole.
    Else it goes from the surge of the first full part, where a window first has ``SURGE_CHARS``
    or ``surge`` of the fullest, to the dive after the last full one.  Markup that is not
    closed, an empty page and a page without text give what text there is.
    """
    lines, inside = lines_of(html)
    framed: dict[int, list[str]] = {}
    for line, owner in zip(lines, inside):
        if owner >= 0:
            framed.setdefault(owner, []).append(line)
    peaks = {owner: max(window_sums(mine, window)) for owner, mine in framed.items()}
    if any(peaks.values()):
        enough = surge * max(peaks.values())
        return "\n".join(x for x, owner in zip(lines, inside) if x and owner >= 0 and peaks[owner] >= enough)
    parts = regions(lines, window)
    if not parts:
        return ""
    top = max(peak for _, _, peak in parts)
    full = [part for part in parts if part[2] >= surge * top]
    first, last = full[0][0], full[-1][1]
    sums, enough = window_sums(lines, window), min(surge * top, SURGE_CHARS)
    first = next(i for i in range(first, last) if sums[i] >= enough)
    return "\n".join(x for x in lines[first:last] if x)


def extract_main_text(pages: DataFrame, html: str = "html", text: str = "text", window: int = WINDOW, surge: float = SURGE) -> DataFrame:
    """The rows with their main text in ``text``; a column of that name is replaced.

    Null html is an empty page and gives an empty text.  Every row gives one row,
    repeated rows too.  There is no shuffle.
    """
    kept = [c for c in pages.columns if c != text]
    rows = pages.select(*[f"`{c}`" for c in dict.fromkeys([*kept, html])])
    out = pages.select(*[f"`{c}`" for c in kept]).schema.add(text, "string")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(x, window, surge) for x in filled(batch.column(html)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(found, pa.string())], names=[*kept, text]
            )

    return rows.mapInArrow(work, out)
