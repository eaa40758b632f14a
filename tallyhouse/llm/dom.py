"""A page as a tree of elements and runs of text."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

# Fixed values of the HTML standard: elements without an end tag, without text of the page, that
# do not begin a block, of other languages, and those whose start ends an open paragraph's sibling.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
NO_TEXT = frozenset("head script style template noscript svg iframe object select textarea".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rp rt "
    "s samp small span strike strong sub sup time tt u var".split()
)
FOREIGN = frozenset("svg math".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SIBLINGS = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_SPACE = re.compile(r"\s")


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    names: list[str] = field(default_factory=list)
    chars: int = 0
    link_chars: int = 0
    children: int = 0


@dataclass
class Page:
    """Nodes in page order, parents first; text runs as (block number, node, text)."""

    nodes: list[Node]
    runs: list[tuple[int, int, str]]


class _Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes = [Node("#page", -1, 0)]
        self.runs: list[tuple[int, int, str]] = []
        self.open: list[tuple[str, int]] = [("#page", 0)]
        # Where in `open` the blocks are, and the elements of each name.
        self.blocks, self.places = [0], {"#page": [0]}
        self.block = 0
        self.links = 0
        self.skipped = ""
        self.skip_depth = 0
        self.endless = False

    def parse_comment(self, i: int, report: bool = True) -> int:
        # What has no end from one place on has none from a later one: it is looked for once.
        if self.endless:
            return -1
        end = super().parse_comment(i, report)
        self.endless = end < 0
        return end

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.skipped:
            if self.skipped == "head" and tag not in _IN_HEAD:
                self.skipped = ""
            else:
                self.skip_depth += tag == self.skipped
                return
        if tag in NO_TEXT:
            self.skipped, self.skip_depth = tag, 1
            return
        if tag in VOID:
            if tag == "br":
                self._run(" ")
            elif tag == "hr":
                self.block += 1
            return
        inline = tag in INLINE
        if not inline:
            self._end_siblings(tag)
            self.block += 1
        self.links += tag == "a"
        names = []
        for name, value in attrs:
            if name in ("class", "id", "role", "itemprop", "aria-label") and value:
                names += [x.lower() for x in _NAMES.findall(value)]
            elif name == "hidden" or name == "aria-hidden" and value == "true":
                names.append("hidden")
            elif name == "style" and value and "display:none" in _SPACE.sub("", value.lower()):
                names.append("hidden")
        owner = self.open[-1][1]
        if not inline or names and tag != "a":
            self.nodes[owner].children += 1
            self.nodes.append(Node(tag, owner, self.nodes[owner].depth + 1, names))
            owner = len(self.nodes) - 1
        self._push(tag, owner)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # Only foreign elements end themselves; elsewhere the slash means nothing.
        if tag in FOREIGN:
            if self.skipped == "head":
                self.skipped = ""
            return
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if self.skipped:
            self.skip_depth -= tag == self.skipped
            if not self.skip_depth:
                self.skipped = ""
            return
        if tag == "br":
            self._run(" ")
            return
        # The nearest open element that the tag ends; an inline one only inside its block.
        places = self.places.get(_kind(tag))
        if tag in INLINE:
            if places and places[-1] > self.blocks[-1]:
                self._close(places[-1])
            return
        if places:
            self._close(places[-1])
        self.block += 1

    def handle_data(self, data: str) -> None:
        if not self.skipped:
            self._run(data)

    def _run(self, text: str) -> None:
        node = self.open[-1][1]
        self.runs.append((self.block, node, text))
        letters = len(text.strip())
        self.nodes[node].chars += letters
        if self.links:
            self.nodes[node].link_chars += letters

    def _end_siblings(self, tag: str) -> None:
        """A block ends an open paragraph; an item ends the item before it."""
        ends = SIBLINGS.get(tag, frozenset())
        turn = len(self.blocks) - 1
        while turn > 0:
            at = self.blocks[turn]
            name = self.open[at][0]
            if name == "p" or name in ends:
                self._close(at)
                if not ends or name != "p":
                    return
            elif not (ends and name in _INSIDE.get(tag, ())):
                return
            turn -= 1

    def _push(self, tag: str, owner: int) -> None:
        at = len(self.open)
        self.open.append((tag, owner))
        self.places.setdefault(_kind(tag), []).append(at)
        if tag not in INLINE:
            self.blocks.append(at)

    def _close(self, at: int) -> None:
        """End an element and all that are open inside it."""
        for name, _ in reversed(self.open[at:]):
            self.links -= name == "a"
            self.places[_kind(name)].pop()
            if name not in INLINE:
                self.blocks.pop()
        del self.open[at:]


def _kind(tag: str) -> str:
    """Headings of all levels end each other."""
    return "h" if tag in HEADINGS else tag


_IN_HEAD = frozenset("title meta link base style script noscript template".split())
_INSIDE = {"tr": ("td", "th"), "dt": (), "dd": (), "li": (), "td": (), "th": ()}


def read_page(html: str | None) -> Page:
    reader = _Reader()
    reader.feed(html or "")
    reader.close()
    return Page(reader.nodes, reader.runs)


def block_texts(page: Page, wanted: list[bool]) -> list[str]:
    """The texts of the blocks in page order, from the runs whose node is wanted."""
    out: list[str] = []
    parts: list[str] = []
    current = -1
    for block, node, text in page.runs:
        if block != current:
            out.append("".join(parts))
            parts, current = [], block
        if wanted[node]:
            parts.append(text)
    out.append("".join(parts))
    return [text for text in (" ".join(x.split()) for x in out) if text]
