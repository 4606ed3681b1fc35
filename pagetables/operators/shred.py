"""Markup to nodes: the one stage that needs a parser.

``shred`` turns the markup column into ``nodes``, an array in document order, and
``page_text``, the UTF-8 bytes of the text inside cells, captions and headings, stripped text
by stripped text.  Only elements that table extraction can ask about are nodes:

* ``id`` is the node's position in the array and ``last`` the position of its last
  descendant, so the descendants of an element are one ``slice`` of the array;
* ``head`` is the heading in force: the last ``h1`` so far, else the last ``h2``, else the
  last ``h3``, else -1;
* ``cls`` is the lower-cased class attribute;
* ``start`` and ``end`` are where the element's text is in ``page_text``, so that a text is one
  ``substring`` however many elements it spans;
* ``cells`` is the number of ``td`` and ``th`` elements inside.

``places`` has the ids of the elements that say how tables are built, by tag and in order, so that
finding those inside an element compares a few numbers and reads no node.

The tree rules are those of the standard library's event parser without any repair: no end
tag is implied, an end tag closes everything up to its nearest open start tag and is
ignored when there is none, void elements never stay open.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from html.entities import html5
from html.parser import HTMLParser
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetables.functions.rows import by_bytes
from pagetables.operators.plain import TAGS, Plain, plain_pages

# Element names.
VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen "
    "link menuitem meta nextid param source spacer track wbr".split()
)
STRUCTURE = frozenset("table thead tr td th caption h1 h2 h3".split())
READABLE = frozenset("td th caption h1 h2 h3".split())
SILENT = frozenset("script style template rt rp".split())
# The texts of a page's cells may repeat one another where cells are left open; a page in which
# they add up to more than this could not be a row, and gets an error status.
MOST_CELL_BYTES = 256 * 1024 * 1024
# Markup that is read at once: the numbers of its tags stay in a core's cache.
BATCH_BYTES = 512 * 1024
RAW_TEXT = frozenset(
    "script style textarea title iframe noembed noframes noscript xmp plaintext".split()
)
_NAME = "[a-zA-Z][a-zA-Z0-9]*"
_SIMPLE = re.compile(
    f"([^<&]+|&(?=[^a-zA-Z#]))|<({_NAME})>|</({_NAME})>|&({_NAME});|&#([0-9]+|[xX][0-9a-fA-F]+);"
)
_OPENING = re.compile("<[a-zA-Z]")
# Text up to one of: a row of nothing but cells of text, a run of such cells, a tag that is bare or
# has a class alone (an element that holds nothing but text as one), an end tag.
_CELLS = "(<(t[dh])>[^<&]*+</\\{0}>(?:<\\{0}>[^<&]*+</\\{0}>)*+)"
_BARE = re.compile(
    f"([^<&]*+)(?:<tr>{_CELLS.format(3)}</tr>|{_CELLS.format(5)}"
    f"|<({_NAME})(?: class=\"([^\"<>&]*)\")?>(?:([^<&]*+)</\\6>)?|</({_NAME})>)"
)
_ROW, _RUN, _CLASS, _LEAF, _CLOSING = 2, 4, 7, 8, 9
READABLE_CLASS = re.compile("header|cell|col")

NODE_TYPE = T.StructType(
    [
        T.StructField("id", T.IntegerType(), False),
        T.StructField("last", T.IntegerType(), False),
        T.StructField("head", T.IntegerType(), False),
        T.StructField("tag", T.StringType(), False),
        T.StructField("cls", T.StringType()),
        T.StructField("start", T.IntegerType(), False),
        T.StructField("end", T.IntegerType(), False),
        T.StructField("cells", T.IntegerType(), False),
    ]
)
NODES_TYPE = T.ArrayType(NODE_TYPE, False)
PLACED = "table thead tr th caption div".split()
PLACES_TYPE = T.StructType([T.StructField(tag, T.ArrayType(T.IntegerType(), False), False) for tag in PLACED])

_ARROW_NODE = pa.struct(
    [
        pa.field("id", pa.int32(), False),
        pa.field("last", pa.int32(), False),
        pa.field("head", pa.int32(), False),
        pa.field("tag", pa.string(), False),
        pa.field("cls", pa.string()),
        pa.field("start", pa.int32(), False),
        pa.field("end", pa.int32(), False),
    ]
)
_ARROW_NODES = pa.list_(pa.field("element", _ARROW_NODE, False))
_ARROW_COUNTED = pa.struct([*_ARROW_NODE, pa.field("cells", pa.int32(), False)])
_ARROW_PLACE = pa.list_(pa.field("element", pa.int32(), False))
_KNOWN = pa.array([*PLACED, "td"])


class _Events(HTMLParser):
    """The nodes of one document: ``nodes`` of (head, tag, cls), ``last``, ``start`` and ``end`` by
    node, and the document's ``texts``."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.last: list[int] = []
        self.start: list[int] = []
        self.end: list[int] = []
        self.heads: list[int] = []
        self.tags: list[str] = []
        self.classes: list[str | None] = []
        self.texts: list[bytes] = []
        self.at = 0  # bytes of all texts so far
        self.path: list[tuple[str, int, bool]] = []  # name, node id or -1, readable
        self.open: dict[str, int] = {}
        self.silent = self.readable = 0
        self.headings = {"h1": -1, "h2": -1, "h3": -1}
        self.head = -1
        self.pending: list[str] = []

    def read(self, markup: str) -> None:
        """All events of a document.

        Runs of text and plain tags are taken by ``_bare``, whole character references and what ends
        a run here, tags with other attributes, comments and declarations by the parser's own methods; from
        the first thing that is none of these on, the parser reads by itself.
        """
        self.rawdata = markup
        match, i, end = _SIMPLE.match, 0, len(markup)
        while i < end:
            if self.cdata_elem is None:
                i = self._bare(markup, i)
                if i >= end:
                    break
            if self.cdata_elem is not None:
                closing = self.interesting.search(markup, i)
                if closing is None:
                    break
                self.pending.append(markup[i : closing.start()])
                k = i = closing.start()
                if markup.startswith("</", i):
                    k = self.parse_endtag(i)
            else:
                token = match(markup, i)
                if token is not None:
                    k, kind = token.end(), token.lastindex
                    if kind == 1:
                        self.pending.append(token.group(1))
                    elif kind == 2:
                        tag = token.group(2).lower()
                        if tag in RAW_TEXT:
                            k = self.parse_starttag(i)
                        else:
                            self.handle_starttag(tag, ())
                    elif kind == 3:
                        self.handle_endtag(token.group(3).lower())
                    elif kind == 4:
                        self.handle_entityref(token.group(4))
                    else:
                        self.handle_charref(token.group(5))
                elif _OPENING.match(markup, i):
                    k = self.parse_starttag(i)
                elif markup.startswith("<!--", i):
                    k = self.parse_comment(i)
                elif markup.startswith("<!", i):
                    k = self.parse_html_declaration(i)
                else:
                    k = -1
            if k <= i:
                break
            i = k
        self.rawdata = ""
        if i < end:
            self.feed(markup[i:])
        self.close()
        self._end_text()
        while self.path:
            self._pop()

    def _bare(self, markup: str, i: int) -> int:
        """Text and plain tags from ``i`` on, up to anything else; returns where that is.

        The same as ``handle_starttag``, ``handle_endtag`` and ``_end_text`` one by one, on local
        names.  An element of text only is not opened: its node is added as it is closed, those of
        cells next to each other at once.
        """
        match, done = _BARE.scanner(markup, i).match, None
        path, opened, pending, add_text = self.path, self.open, self.pending, self.texts.append
        lasts, starts, ends, heads, tags = self.last, self.start, self.end, self.heads, self.tags
        classes = self.classes
        at, readable, silent = self.at, self.readable, self.silent
        while (token := match()) is not None:
            kind, text = token.lastindex, token.group(1)
            if kind > _RUN:
                tag = token.group(_CLOSING if kind == _CLOSING else 6).lower()
                if kind != _CLOSING and tag in RAW_TEXT:
                    break
            done = token
            if pending:
                pending.append(text)
                text = "".join(pending)
                pending.clear()
            if text and readable and not silent and (text := text.strip()):
                add_text(text := text.encode())
                at += len(text)
            if kind <= _RUN:
                run, tag = token.group(kind, kind + 1)
                cells = run[4:-5].split(f"</{tag}><{tag}>")
                if silent:
                    sizes = [0] * len(cells)
                else:
                    cells = [cell.strip() for cell in cells]
                    whole = "".join(cells)
                    add_text(text := whole.encode())
                    sizes = map(len, cells if len(text) == len(whole) else map(str.encode, cells))
                bounds = [*accumulate(sizes, initial=at)]
                count, first = len(cells), len(lasts)
                if kind == _ROW:
                    lasts.append(first + count)
                    starts.append(at)
                    ends.append(bounds[-1])
                    tags.append("tr")
                    heads.append(self.head)
                    classes.append(None)
                    first += 1
                at = bounds[-1]
                lasts.extend(range(first, first + count))
                starts.extend(bounds[:-1])
                ends.extend(bounds[1:])
                tags.extend([tag] * count)
                heads.extend([self.head] * count)
                classes.extend([None] * count)
                continue
            if kind == _CLOSING:
                if opened.get(tag):
                    last, inner = len(lasts) - 1, ""
                    while inner != tag:
                        inner, node_id, was_readable = path.pop()
                        opened[inner] -= 1
                        if was_readable:
                            readable -= 1
                        if inner in SILENT:
                            silent -= 1
                        if node_id >= 0:
                            lasts[node_id] = last
                            ends[node_id] = at
                continue
            node_id, reads, cls = -1, tag in READABLE, None
            if tag == "div" and (cls := token.group(_CLASS)):
                cls = " ".join(cls.split()).lower()
                reads = READABLE_CLASS.search(cls) is not None
            if cls or tag in STRUCTURE:
                node_id = len(lasts)
                lasts.append(node_id)
                starts.append(at)
                ends.append(at)
                heads.append(self.head)
                tags.append(tag)
                classes.append(cls)
                if tag in self.headings:
                    self._heading(tag, node_id)
            elif tag in VOID and kind != _LEAF:
                continue
            if kind != _LEAF:
                path.append((tag, node_id, reads))
                opened[tag] = opened.get(tag, 0) + 1
                if reads:
                    readable += 1
                if tag in SILENT:
                    silent += 1
            elif (
                (content := token.group(_LEAF))
                and (reads or readable)
                and not silent
                and tag not in SILENT
                and (content := content.strip())
            ):
                add_text(content := content.encode())
                at += len(content)
                if node_id >= 0:
                    ends[node_id] = at
        if token is not None and token.group(1):
            pending.append(token.group(1))
        self.at, self.readable, self.silent = at, readable, silent
        if token is not None:
            return token.end(1)
        return i if done is None else done.end()

    @property
    def nodes(self) -> Iterator[tuple[int, str, str | None]]:
        return zip(self.heads, self.tags, self.classes)

    def updatepos(self, i, j):
        return j  # line numbers are not kept

    def _node(self, tag, cls=None) -> int:
        node_id = len(self.last)
        self.last.append(node_id)
        self.start.append(self.at)
        self.end.append(self.at)
        self.heads.append(self.head)
        self.tags.append(tag)
        self.classes.append(cls)
        return node_id

    def _heading(self, tag, node_id):
        self.headings[tag] = node_id
        self.head = next(h for h in self.headings.values() if h >= 0)

    def _end_text(self):
        if self.readable and not self.silent:
            text = "".join(self.pending).strip()
            if text:
                self.texts.append(text.encode())
                self.at += len(self.texts[-1])
        self.pending.clear()

    def handle_starttag(self, tag, attrs):
        if self.pending:
            self._end_text()
        if tag in VOID:
            return
        node_id, readable = -1, tag in READABLE
        if tag in STRUCTURE:
            node_id = self._node(tag)
            if tag in self.headings:
                self._heading(tag, node_id)
        elif attrs and tag == "div":
            cls = " ".join((dict(attrs).get("class") or "").split()).lower()
            if cls:
                node_id = self._node(tag, cls)
                readable = READABLE_CLASS.search(cls) is not None
        self.path.append((tag, node_id, readable))
        self.open[tag] = self.open.get(tag, 0) + 1
        if readable:
            self.readable += 1
        if tag in SILENT:
            self.silent += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._pop()

    def _pop(self) -> str:
        tag, node_id, readable = self.path.pop()
        self.open[tag] -= 1
        if readable:
            self.readable -= 1
        if tag in SILENT:
            self.silent -= 1
        if node_id >= 0:
            self.last[node_id] = len(self.last) - 1
            self.end[node_id] = self.at
        return tag

    def handle_endtag(self, tag):
        if self.pending:
            self._end_text()
        if self.open.get(tag):
            while self._pop() != tag:
                pass

    def handle_data(self, data):
        self.pending.append(data)

    def handle_charref(self, name):
        code = int(name[1:], 16) if name[0] in "xX" else int(name)
        if 0x80 <= code <= 0x9F:
            self.pending.append(bytes([code]).decode("cp1252", "replace"))
        elif code > 0x10FFFF or 0xD800 <= code <= 0xDFFF:
            self.pending.append("\N{REPLACEMENT CHARACTER}")
        else:
            self.pending.append(chr(code))

    def handle_entityref(self, name):
        self.pending.append(html5.get(name + ";", "&" + name))

    def handle_comment(self, data):
        if self.pending:
            self._end_text()

    handle_decl = handle_pi = handle_comment

    def unknown_decl(self, data):
        self.handle_comment(data)
        if data.upper().startswith("CDATA["):
            self.pending.append(data[6:])
            self._end_text()


_CHARSET = re.compile(rb"""<meta[^>]+charset\s*=\s*["']?([\w.:-]+)""", re.I)
_XML_CHARSET = re.compile(rb"""\A\s*<\?xml[^>]+encoding\s*=\s*["']([\w.:-]+)""", re.I)


def decode_markup(content: bytes) -> str:
    """Bytes to text: byte order mark, declared charset (of the XML declaration, then of the
    first such element), UTF-8, then Windows-1252."""
    for mark, name in (
        (codecs.BOM_UTF8, "utf-8"),
        (codecs.BOM_UTF16_LE, "utf-16-le"),
        (codecs.BOM_UTF16_BE, "utf-16-be"),
    ):
        if content.startswith(mark):
            return content[len(mark):].decode(name, "replace")
    declared = [_XML_CHARSET.search(content), _CHARSET.search(content)]
    names = [found.group(1).decode("ascii") for found in declared if found]
    for name in (*names, "utf-8"):
        try:
            return content.decode(name)
        except (LookupError, UnicodeDecodeError):
            continue
    return content.decode("cp1252", "replace")


def cell_bytes(events: _Events) -> int:
    """Length of all cells' texts; a text counts for every cell around it."""
    return sum(
        end - start
        for tag, start, end in zip(events.tags, events.start, events.end)
        if tag in ("td", "th")
    )


def shred_batch(markup: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Node lists, texts and error messages for one Arrow array of markup: pages of plain markup
    all at once, the others one by one."""
    if pa.types.is_binary(markup.type) or pa.types.is_large_binary(markup.type):
        return parsed(markup)
    pages = plain_pages(markup, MOST_CELL_BYTES)
    found = plain_columns(pages)
    others = np.flatnonzero(~pages.plain)
    if not len(others):
        return found
    read = parsed(markup.take(pa.array(others)))
    if len(others) == len(markup):
        return read
    places = np.arange(len(markup))
    places[others] = len(markup) + np.arange(len(others))
    return tuple(pa.concat_arrays(pair).take(pa.array(places)) for pair in zip(found, read))


def plain_columns(pages: Plain) -> tuple[pa.Array, pa.Array, pa.Array]:
    """What ``shred_batch`` returns, of the plain pages; the rows of others are empty."""
    id_, last, head, start, end = (
        pa.array(values.astype(np.int32)) for values in (pages.id, pages.last, pages.head, pages.start, pages.end)
    )
    tags, count = TAGS.take(pa.array(pages.tag)), len(pages.plain)
    structs = pa.StructArray.from_arrays(
        [id_, last, head, tags, pa.nulls(len(tags), pa.string()), start, end], fields=list(_ARROW_NODE)
    )
    lists = pa.ListArray.from_arrays(pa.array(pages.offsets.astype(np.int32)), structs, type=_ARROW_NODES)
    places = pa.py_buffer(pages.text_offsets.astype(np.int32))
    texts = pa.Array.from_buffers(pa.binary(), count, [None, places, pa.py_buffer(pages.text)])
    return lists, texts, pa.nulls(count, pa.string())


def parsed(markup: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """What ``shred_batch`` returns, page by page."""
    ids, lasts, heads, tags, classes, starts, ends = columns = [[] for _ in _ARROW_NODE]
    offsets, texts, errors = [0], [], []
    for content in markup.to_pylist():
        text, error = None, None
        if content is not None:
            events = _Events()
            try:
                events.read(content if isinstance(content, str) else decode_markup(content))
                # No cell is longer than the page's text, so few pages need the exact sum.
                if events.at * len(events.last) > MOST_CELL_BYTES and (size := cell_bytes(events)) > MOST_CELL_BYTES:
                    raise ValueError(f"Cells left open repeat {size} bytes of text")
                text = b"".join(events.texts)
                ids.extend(range(len(events.last)))
                lasts.extend(events.last)
                heads.extend(events.heads)
                tags.extend(events.tags)
                classes.extend(events.classes)
                starts.extend(events.start)
                ends.extend(events.end)
            except Exception as problem:  # a bad page becomes a status, never a failed job
                error = f"Error: {problem}"
        offsets.append(len(ids))
        texts.append(text)
        errors.append(error)
    structs = pa.StructArray.from_arrays(
        [pa.array(values, field.type) for values, field in zip(columns, _ARROW_NODE)],
        fields=list(_ARROW_NODE),
    )
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs, type=_ARROW_NODES)
    return lists, pa.array(texts, pa.binary()), pa.array(errors, pa.string())


def placed(nodes: pa.ListArray) -> tuple[pa.Array, pa.Array]:
    """Node lists with the number of cells inside each node, and the ids of nodes by tag."""
    held, bounds = nodes.flatten(), nodes.offsets.to_numpy() - nodes.offsets[0].as_py()
    fields = held.flatten()
    ids, last = (fields[i].to_numpy() for i in (0, 1))
    code = pc.fill_null(pc.index_in(fields[3], _KNOWN), len(_KNOWN)).to_numpy()
    before = np.zeros(len(code) + 1, np.int32)
    np.cumsum((code == PLACED.index("th")) | (code == len(PLACED)), out=before[1:])
    after = np.arange(1, len(code) + 1)
    cells = before[after + last - ids] - before[after]
    structs = pa.StructArray.from_arrays([*fields, pa.array(cells)], fields=list(_ARROW_COUNTED))
    places = []
    for i in range(len(PLACED)):
        found = np.flatnonzero(code == i)
        offsets = np.searchsorted(found, bounds).astype(np.int32)
        places.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids[found]), type=_ARROW_PLACE))
    lists = pa.ListArray.from_arrays(
        pa.array(bounds.astype(np.int32)), structs, type=pa.list_(pa.field("element", _ARROW_COUNTED, False))
    )
    fields = [pa.field(tag, _ARROW_PLACE, False) for tag in PLACED]
    return lists, pa.StructArray.from_arrays(places, fields=fields)


def may_hold_table(markup: Column) -> Column:
    """False only for pages that cannot contain a table, so that they skip the parser.

    A class attribute can spell its letters as numeric character references, hence ``&#``.
    """
    return markup.rlike(r"(?i)<table") | (
        markup.rlike(r"(?i)<div[\s/]") & (markup.rlike(r"(?i)table|grid") | markup.contains("&#"))
    )


def shred(pages: DataFrame, content: str = "html", prefilter: bool = False) -> DataFrame:
    """``pages(…, html)`` to ``(…, status, nodes, places, page_text)``; every page keeps its row.

    Rows that already have a ``status`` (rejected by an earlier guard) are not parsed.
    With ``prefilter`` neither are pages that cannot hold a table.
    """
    if "status" not in pages.columns:
        pages = pages.withColumn("status", F.lit(None).cast("string"))
    keep = [c for c in pages.columns if c not in (content, "status")]
    wanted = F.col("status").isNull()
    if prefilter:
        if isinstance(pages.schema[content].dataType, T.BinaryType):
            wide = F.hex(F.substring(content, 1, 2)).isin("FFFE", "FEFF")  # UTF-16
            wanted = wanted & (wide | may_hold_table(F.decode(content, "ISO-8859-1")))
        else:
            wanted = wanted & may_hold_table(F.col(content))
    feed = pages.select(*keep, "status", F.when(wanted, F.col(content)).alias(content))
    schema = T.StructType([pages.schema[c] for c in keep])
    schema = schema.add("status", T.StringType()).add("nodes", NODES_TYPE)
    schema = schema.add("places", PLACES_TYPE).add("page_text", T.BinaryType())
    names = schema.names

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, len(keep) + 1, BATCH_BYTES):
            nodes, texts, errors = shred_batch(batch.column(len(keep) + 1))
            status = pc.coalesce(batch.column(len(keep)).cast(pa.string()), errors)
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, status, *placed(nodes), texts], names=names)

    return feed.mapInArrow(parse, schema)
