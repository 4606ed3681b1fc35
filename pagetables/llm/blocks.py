"""Leaf blocks of a page: runs of text between block-level tags, with what is above them.

A page is read once, in time linear in its length however its markup is broken: the end of a
tag is decided once, open elements are a chain whose links share the sets of what is above them,
and what an opening or closing tag ends is looked up instead of searched for.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from html import unescape

# Block-level elements, which end a block; all others, known or not, are part of
# running text.  Elements without content; elements whose content isn't text of the page, and
# those of them that are read up to their end tag; those that may stand in a head, which any
# other tag ends.
BLOCK = frozenset(
    "address article aside blockquote body caption center colgroup dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p "
    "pre search section select summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template iframe svg head title textarea object canvas".split())
RAW = frozenset("script style textarea title iframe noscript".split())
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
# What an opening tag ends, up to an element that this doesn't reach beyond: the
# nearest item, term or option, but all of a row or a cell.
ITEMS = (({"li"}, {"ul", "ol", "menu"}), ({"dt", "dd"}, {"dl"}), ({"option"}, {"select"}))
ROWS = (({"tr", "td", "th"}, {"table"}), ({"td", "th"}, {"table"}))
ENDS = {"li": 0, "dt": 1, "dd": 1, "option": 2, "tr": 3, "td": 4, "th": 4}

NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
WORDS = re.compile(r"[a-z]+")
TAG_NAME = re.compile(r"[^\s/>]+")
STOP = re.compile(r"[>=]")
QUOTE = re.compile(r"=\s*+([\"'])")


class _Open:
    """An open element, the one around it, and what both are inside of."""

    __slots__ = ("tag", "around", "depth", "above", "names", "ends")

    def __init__(self, tag: str, around: _Open | None, names: frozenset[str]):
        self.tag, self.around = tag, around
        self.depth = around.depth + 1 if around else 0
        above = around.above if around else frozenset()
        self.above = above if tag in above else above | {tag}
        outer = around.names if around else frozenset()
        self.names = outer if names <= outer else outer | names
        # The depth of what each kind of tag would end, or -1.
        ends = around.ends if around else (-1,) * len(ITEMS + ROWS)
        self.ends = tuple(
            -1 if tag in scope
            else self.depth if tag in tags and (kind < len(ITEMS) or ends[kind] < 0)
            else ends[kind]
            for kind, (tags, scope) in enumerate(ITEMS + ROWS)
        )


@dataclass
class Block:
    """A leaf block: its text, the element it is in, and the number of its characters that are
    in links."""

    text: str
    place: _Open | None
    linked: int

    @property
    def tags(self) -> tuple[str, ...]:
        """The tags above the block, outermost first."""
        out, place = [], self.place
        while place is not None:
            out.append(place.tag)
            place = place.around
        return tuple(reversed(out))

    @property
    def own(self) -> str:
        return self.place.tag if self.place else "none"

    @property
    def above(self) -> frozenset[str]:
        return self.place.above if self.place else frozenset()

    @property
    def names(self) -> frozenset[str]:
        """The words in classes, ids and roles above the block."""
        return self.place.names if self.place else frozenset()


class _Reader:
    """Keeps the open elements and the block being read."""

    def __init__(self, known: frozenset[str] | None):
        self.known = known
        self.top: _Open | None = None
        self.count: Counter = Counter()
        self.held: list[str] = []
        self.linked = self.links = self.hidden = self.drawings = 0
        self.blocks: list[Block] = []

    def text(self, raw: str) -> None:
        if raw and not raw.isspace():
            self.end_head()
        if raw and not self.hidden:
            text = unescape(raw) if "&" in raw else raw
            self.held.append(text)
            if self.links:
                self.linked += len(text.strip())

    def flush(self) -> None:
        if not self.held:
            return
        text = " ".join("".join(self.held).split())
        if text:
            place = self.top
            while place is not None and place.tag not in BLOCK:  # hidden elements that have ended nothing
                place = place.around
            self.blocks.append(Block(text, place, min(self.linked, len(text))))
        self.held.clear()
        self.linked = 0

    def end_head(self) -> None:
        """Text and tags that may not stand in a head end it: its end tag may be left out."""
        if self.top is not None and self.top.tag == "head":
            self.pop()

    def self_closed(self, tag: str, attributes: str) -> bool:
        """Whether a tag is its own end tag, as only those of drawings may be."""
        return attributes.endswith("/") and (tag == "svg" or self.drawings > 0)

    def open(self, tag: str, attributes: str) -> None:
        if tag not in IN_HEAD:
            self.end_head()
        if tag in BLOCK:
            self.flush()
            self.links = 0
            if tag in ENDS and self.top is not None:
                self.cut(self.top.ends[ENDS[tag]])
            # A block-level element ends an open paragraph.
            if self.top is not None and self.top.tag == "p":
                self.pop()
        elif tag not in HIDDEN:
            if tag == "a":
                self.links = 1
            elif tag == "br":
                self.held.append(" ")
            return
        if tag in VOID or self.self_closed(tag, attributes):
            return
        found = frozenset()
        if attributes and tag in BLOCK:
            found = frozenset(w for groups in NAMES.findall(attributes) for g in groups for w in WORDS.findall(g.lower()))
            found = found if self.known is None else found & self.known
        self.top = _Open(tag, self.top, found)
        self.count[tag] += 1
        self.hidden += tag in HIDDEN
        self.drawings += tag == "svg"

    def pop(self) -> None:
        tag = self.top.tag
        self.top = self.top.around
        self.count[tag] -= 1
        self.hidden -= tag in HIDDEN
        self.drawings -= tag == "svg"

    def cut(self, depth: int) -> None:
        while depth >= 0 and self.top is not None and self.top.depth >= depth:
            self.pop()

    def close(self, tag: str) -> None:
        if tag not in BLOCK and tag not in HIDDEN:
            if tag == "a":
                self.links = 0
            return
        if tag in BLOCK:
            self.flush()
        while self.count[tag]:
            last = self.top.tag
            self.pop()
            if last == tag:
                return


class _Tags:
    """Finds tags; remembers that a quote has no end, so as to look for it once."""

    def __init__(self, html: str):
        self.html, self.unended = html, set()

    def end(self, at: int) -> int:
        """Where the tag whose attributes begin here ends: its ``>``, or the end of the page.
        Between quotes after ``=`` there may be a ``>``; a quote that never ends is a letter."""
        html = self.html
        while True:
            stop = STOP.search(html, at)
            if stop is None:
                return len(html)
            if stop[0] == ">":
                return stop.start()
            quoted = QUOTE.match(html, stop.start())
            at = stop.end()
            if quoted and quoted[1] not in self.unended:
                close = html.find(quoted[1], quoted.end())
                if close < 0:
                    self.unended.add(quoted[1])
                else:
                    at = close + 1


def leaf_blocks(html: str, known: frozenset[str] | None = None) -> list[Block]:
    """The leaf blocks of a page in page order; hidden elements have none.

    ``known`` bounds the words of classes, ids and roles that blocks keep."""
    reader, tags = _Reader(known), _Tags(html)
    at, n = 0, len(html)
    ends: dict[str, re.Pattern] = {}
    begin = 0  # of text not yet given to the reader
    while (start := html.find("<", at)) >= 0:
        if html.startswith("<!--", start):
            end = html.find("-->", start + 4)
            after = n if end < 0 else end + 3
            name = None
        elif html[start + 1 : start + 2] in ("!", "?"):
            end = html.find(">", start)
            after = n if end < 0 else end + 1
            name = None
        else:
            closing = html.startswith("/", start + 1)
            letter = html[start + 1 + closing : start + 2 + closing]
            if not (letter.isascii() and letter.isalpha()):
                at = start + 1
                continue
            name = TAG_NAME.match(html, start + 1 + closing)
            end = tags.end(name.end())
            after = min(n, end + 1)
        reader.text(html[begin:start])
        begin = at = after
        if name is None:
            continue
        tag, attributes = name[0].lower(), html[name.end() : end]
        if closing:
            reader.close(tag)
            continue
        reader.open(tag, attributes)
        if tag in RAW and not reader.self_closed(tag, attributes):
            if tag not in ends:
                ends[tag] = re.compile(rf"</{tag}\s*+>", re.IGNORECASE)
            found = ends[tag].search(html, at)
            begin = at = n if found is None else found.end()
            reader.close(tag)
    reader.text(html[begin:])
    reader.flush()
    return reader.blocks
