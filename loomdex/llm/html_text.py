"""Main text of web pages by text-to-tag ratios over streaming parser events.

The standard library's parser feeds a page's events to one pass that cuts it into lines at block-level
tags, drops what is marked as something else (navigation, forms, scripts, adverts, comments), and counts
each line's text characters and tags. The ratios are smoothed by a Gaussian; lines above the threshold
(one standard deviation, as long as that leaves any) are dense. The smallest element that holds most of
the dense text is the content region, and every line inside it is kept, short ones too. A region in an
article or main element is widened to the whole of it, and other articles with dense text are kept as well.
Elsewhere, dense text outside the region is kept too, up to the common ancestor: the elements that hold it,
the lines between, and the lines that lie directly in the ancestor. Runs of lines that are nothing but
links are menus and go.

Names of classes and ids mark something else only by a part of their own: `has-sidebar` and `notice-article` do
not. Where a page without article or main text has most of its text in elements marked by such names, or in
forms, these are wrappers: it is read again, and of them only the controls go.

Defined cases: a null or empty page, or one without text, gives an empty text; unclosed and stray tags
are tolerated, and omitted end tags (p, li, dt, dd, option, table parts) are put where HTML puts them; a page without any text outside marked parts is empty; equal pages give equal texts.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td "
    "tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset(
    "script style noscript template head title nav header footer aside form menu button select option textarea label "
    "fieldset datalist dialog iframe object embed applet svg math canvas audio video map search".split()
)
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form menu menubar alert alertdialog dialog status toolbar tablist".split()
)
#: Parts of class and id names, split at anything but letters, that mark something other than the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar aside menu nav navbar "
    "navigation breadcrumb breadcrumbs footer cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe subscription signup login share sharing social related recommended recommendations widget pagination pager "
    "toolbar masthead topbar skip disclaimer copyright".split()
)
#: Parts of a name that say it is about the content, and those that say of the next part that it is not meant.
CONTENT_PARTS = frozenset("article content main body post entry story text wrapper page container layout".split())
NEGATIONS = frozenset("has no with without not non".split())
COMMENT_MARKS = frozenset("comment comments commentlist reply replies disqus discussion respond".split())
#: Elements that can hold the content region.
REGIONS = frozenset("article main section div td body html details blockquote".split())
#: Elements that are content as a whole.
WHOLE = frozenset(("article", "main"))
#: Elements that a start tag closes, and those it does not look beyond.
_P_BOUNDS = frozenset("table td th caption button object applet template".split())
_ITEM_BOUNDS = BLOCKS - frozenset("address div p li dt dd".split()) | frozenset("select button object applet template".split())
_TABLE = frozenset(("table", "template"))
SIBLINGS: dict[str, tuple[frozenset[str], frozenset[str]]] = {
    "body": (frozenset(("head",)), frozenset()),
    "li": (frozenset(("li",)), _ITEM_BOUNDS),
    "dt": (frozenset(("dt", "dd")), _ITEM_BOUNDS),
    "dd": (frozenset(("dt", "dd")), _ITEM_BOUNDS),
    "option": (frozenset(("option",)), frozenset(("select", "datalist"))),
    "optgroup": (frozenset(("option", "optgroup")), frozenset(("select", "datalist"))),
    "td": (frozenset(("td", "th")), _TABLE | {"tr"}),
    "th": (frozenset(("td", "th")), _TABLE | {"tr"}),
    "tr": (frozenset(("tr", "td", "th")), _TABLE),
    "tbody": (frozenset("tbody thead tfoot tr td th caption".split()), _TABLE),
    "thead": (frozenset("tbody thead tfoot tr td th caption".split()), _TABLE),
    "tfoot": (frozenset("tbody thead tfoot tr td th caption".split()), _TABLE),
}
#: Blocks that may stand inside a p as far as HTML's parser is concerned.
_IN_P = frozenset("body caption legend tbody td tfoot th thead tr".split())
SIGMA = 1.5
MOST = 0.7
#: Reasons that a wrapper of the whole article may give by mistake.
SOFT = ("mark", "form")
#: So many lines in a row that are nothing but links make a menu.
MENU = 3


def marked(name: str) -> str:
    """Why a class or id name marks something else than content, empty if it does not."""
    parts = "".join(c if c.isalpha() else " " for c in name.lower()).split()
    if COMMENT_MARKS.intersection(parts):
        return "comments"
    if CONTENT_PARTS.intersection(parts):
        return ""
    return "mark" if any(p in MARKS and (not i or parts[i - 1] not in NEGATIONS) for i, p in enumerate(parts)) else ""


class LineReader(HTMLParser):
    """Lines of a page: text, characters in links, tags, and the number of the region they lie in.

    Regions are numbered as they begin, 0 is the page; `parents` has the region around each. With `wrappers`,
    names and forms drop nothing.
    """

    def __init__(self, wrappers: bool = False) -> None:
        super().__init__(convert_charrefs=True)
        self.wrappers = wrappers
        self.lines: list[tuple[str, int, int, int]] = []
        self.parents = [0]
        self.region = 0
        self.soft = 0  # characters dropped for a name or a form alone
        self.stack: list[tuple[str, int, str]] = []  # tag, region number or 0, why it is dropped
        self.places: dict[str, list[int]] = {}  # by tag, where in the stack it is open
        self.blocks: list[int] = []  # where in the stack a block is open
        self.dropping = self.hard = self.links = 0
        self.wholes: set[int] = set()  # region numbers of articles and main elements
        self.parts: list[str] = []
        self.linked: list[int] = []
        self.tags = 0

    def _why(self, tag: str, attrs: list[tuple[str, str | None]]) -> str:
        if tag == "form":
            return "" if self.wrappers else "form"
        if tag in DROPPED:
            return tag
        if tag in ("html", "body", "article", "main"):
            return ""
        for name, value in attrs:
            if name == "hidden":
                return "hidden"
            if value and name == "role" and value.strip().lower() in DROPPED_ROLES:
                return "role"
            if value and name in ("class", "id"):
                why = {marked(x) for x in value.split()} - ({"", "mark"} if self.wrappers else {""})
                if why:
                    return min(why)  # comments before a mark
        return ""

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append((text, sum(self.linked), self.tags, self.region))
            self.tags = 0
        self.parts, self.linked = [], []

    def _innermost(self, tags: frozenset[str]) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def _close_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            self._pop()

    def _close_implied(self, tag: str) -> None:
        """Closes what HTML lets authors leave open in front of a start tag."""
        if self.places.get("p") and tag in BLOCKS and tag not in _IN_P:
            open_p = self.places["p"][-1]
            if open_p > self._innermost(_P_BOUNDS):
                self._close_to(open_p)
        if tag in SIBLINGS:
            closed, bounds = SIBLINGS[tag]
            bound = self._innermost(bounds)
            found = [self.places[t] for t in closed if self.places.get(t) and self.places[t][-1] > bound]
            if found:  # the outermost of them beyond the bound
                self._close_to(min(places[bisect_right(places, bound)] for places in found))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.end_line()
        self._close_implied(tag)
        if tag in ("article", "main") and self.dropping and all(w not in ("comments", "footer") for _, _, w in self.stack):
            while self.dropping:  # an unclosed menu or advert does not swallow the article
                self._pop()
        if not self.dropping:
            self.tags += 1
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        region = 0
        if tag in REGIONS and not self.dropping:
            region = len(self.parents)
            self.parents.append(self.region)
            self.region = region
            if tag in WHOLE:
                self.wholes.add(region)
        why = self._why(tag, attrs)
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag in BLOCKS or tag == "html":
            self.blocks.append(len(self.stack))
        self.stack.append((tag, region, why))
        self.dropping += bool(why)
        self.hard += bool(why) and why not in SOFT
        self.links += tag == "a"

    def _pop(self) -> str:
        tag, region, why = self.stack.pop()
        if tag:
            self.places[tag].pop()
        if self.blocks and self.blocks[-1] == len(self.stack):
            self.blocks.pop()
        self.dropping -= bool(why)
        self.hard -= bool(why) and why not in SOFT
        self.links -= tag == "a"
        if region:
            self.region = self.parents[region]
        return tag

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.end_line()
        if not self.dropping:
            self.tags += 1
        places = self.places.get(tag)
        if not places:
            return
        depth = places[-1]
        if self.blocks and depth < self.blocks[-1] and tag not in BLOCKS and tag != "html":
            # An inline element ends, the blocks opened in it do not.
            why = self.stack[depth][2]
            self.dropping -= bool(why)
            self.hard -= bool(why) and why not in SOFT
            self.links -= tag == "a"
            places.pop()
            self.stack[depth] = ("", 0, "")
        else:
            self._close_to(depth)

    def handle_data(self, data: str) -> None:
        if not self.dropping:
            self.parts.append(data)
            if self.links:
                self.linked.append(sum(map(len, data.split())))
        elif not self.hard and not self.links:
            self.soft += sum(map(len, data.split()))

    def close(self) -> None:
        super().close()
        self.end_line()


def smooth(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(np.pad(ratios, reach, mode="edge"), kernel / kernel.sum(), mode="valid")


def content_lines(lines: list[tuple[str, int, int, int]], wholes: set[int], parents: list[int]) -> list[bool]:
    """Which lines are content; `wholes`: the regions that are never kept in part; `parents`: the region around each."""
    sizes = np.array([len(text) for text, _, _, _ in lines], float)
    regions = [r for _, _, _, r in lines]
    own = sizes / np.array([max(1, tags) for _, _, tags, _ in lines])
    ratios = smooth(own)
    least = min(ratios.std(), ratios.max())
    dense = ratios >= least
    core = own >= least  # dense by itself, not by its neighbours

    # A region's number is above its parent's and below those of all that follow it, so a subtree is a range.
    count = len(parents)
    depth, top, last, held = [0] * count, [0] * count, list(range(count)), [0.0] * count
    for r in range(1, count):
        depth[r] = depth[parents[r]] + 1
        top[r] = top[parents[r]] or (r if r in wholes else 0)
    for r, size, is_dense in zip(regions, sizes, dense):
        held[r] += size * is_dense
    for r in range(count - 1, 0, -1):
        held[parents[r]] += held[r]
        last[parents[r]] = max(last[parents[r]], last[r])
    most = MOST * sizes[dense].sum()
    region = max((r for r in range(count) if held[r] >= most), key=depth.__getitem__, default=0)

    if top[region]:
        found = {top[r] for r, is_core in zip(regions, core) if is_core} | {top[region]}
        return [top[r] in found and top[r] != 0 for r in regions]

    above = region  # common ancestor of the region and all dense text
    for r, is_core in zip(regions, core):
        while is_core and not above <= r <= last[above]:
            above = parents[above]
    children = [r for r in range(1, count) if parents[r] == above]

    def part(r: int) -> int:
        return children[bisect_right(children, r) - 1]

    inside = [above <= r <= last[above] for r in regions]
    places = [i for i, (x, y) in enumerate(zip(inside, dense | core)) if x and y]
    first, final = (places[0], places[-1]) if places else (0, -1)
    parts = {part(regions[i]) for i in places if regions[i] != above}
    return [
        region <= r <= last[region] or x and (first <= i <= final or r == above or part(r) in parts)
        for i, (r, x) in enumerate(zip(regions, inside))
    ]


def _read(html: str, wrappers: bool) -> LineReader:
    reader = LineReader(wrappers)
    reader.feed(html)
    reader.close()
    return reader


def main_text(html: str | None) -> str:
    reader = _read(html or "", wrappers=False)
    kept = sum(len(text) for text, _, _, _ in reader.lines)
    if not reader.wholes and reader.soft > MOST * (reader.soft + kept):
        reader = _read(html or "", wrappers=True)
    links = [linked >= 0.9 * len("".join(text.split())) and linked > 0 for text, linked, _, _ in reader.lines]
    menu = [False] * len(links)
    at = 0
    while at < len(links):
        end = at
        while end < len(links) and links[end]:
            end += 1
        if end - at >= MENU:
            menu[at:end] = [True] * (end - at)
        at = max(end, at + 1)
    lines = [line for line, drop in zip(reader.lines, menu) if not drop]
    if not lines:
        return ""
    return " ".join(line[0] for line, kept in zip(lines, content_lines(lines, reader.wholes, reader.parents)) if kept)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """Replaces the html column by `text`; all other columns are kept."""
    kept = [c for c in pages.columns if c not in (html, "text")]
    schema = pages.select(kept).schema.add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(h.as_py()) for h in batch.column(len(kept))], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], [*kept, "text"])

    return pages.select(*kept, html).mapInArrow(run, schema)
