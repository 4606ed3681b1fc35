"""Nodes of many pages at once, where their markup is plain.

Plain markup has no character references and only bare tags of known names, each closed in order,
whatever stands between them; a document type may come first and titles hold text alone.  For such
pages the rules of ``shred`` come down to counting: an element's descendants are the nodes up to its
end tag, its text is what the readable gaps between tags hold up to there.  So all tags of a batch are
columns of numbers, and a page costs no call of its own.  Every other page is left to the parser.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Element names.
NODES = "table thead tr td th caption h1 h2 h3".split()  # from ``td`` on, their text is kept
OTHERS = (
    "html head body title main header footer nav section article aside div p span a b i u s em strong small big sub sup "
    "font center code pre tt kbd samp var cite q abbr dfn mark time data del ins ul ol li dl dt dd tbody tfoot form label "
    "fieldset legend button figure address h4 h5 h6"
).split()
VOID = "br hr img wbr input meta link col area base".split()
DOCTYPE = "!doctype"
DEEPEST = 30_000

_WORD = 8  # bytes of the longest name
_NAMES = sorted(
    (name for name in (*NODES, *OTHERS, *VOID, DOCTYPE) if len(name) <= _WORD),
    key=lambda name: int.from_bytes(name.encode(), "little"),
)
_KEYS = np.array([int.from_bytes(name.encode(), "little") for name in _NAMES], np.uint64)
_IS_NODE = np.array([name in NODES for name in _NAMES])
_READS = np.array([name in NODES[3:] for name in _NAMES])
_IS_VOID = np.array([name in VOID or name == DOCTYPE for name in _NAMES])
_CODE = {name: code for code, name in enumerate(_NAMES)}
_MASKS = np.array([(1 << 8 * size) - 1 for size in range(_WORD + 1)] + [0], np.uint64)
_CAPITAL = np.uint64(0x4040404040404040)
# Bytes that a stripped text may lose at its ends: white space, and what may be part of one.
_EDGE = np.zeros(256, bool)
_EDGE[[*range(0x09, 0x0E), *range(0x1C, 0x21), *range(0x80, 0x100)]] = True

TAGS = pa.array(_NAMES, pa.string())


@dataclass
class Plain:
    """Nodes by page of the pages that are ``plain``; other pages have none."""

    plain: np.ndarray
    offsets: np.ndarray  # of the first node of each page
    last: np.ndarray
    head: np.ndarray
    tag: np.ndarray  # positions in TAGS
    start: np.ndarray
    end: np.ndarray
    text_offsets: np.ndarray
    text: np.ndarray

    @property
    def id(self) -> np.ndarray:
        return np.arange(len(self.last)) - np.repeat(self.offsets[:-1], np.diff(self.offsets))


def contents(markup: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts, eight more after them, and where each text begins."""
    wide = np.int64 if pa.types.is_large_string(markup.type) else np.int32
    _, places, held = markup.buffers()
    bounds = np.frombuffer(places, wide)[markup.offset : markup.offset + len(markup) + 1].astype(np.int64)
    data = np.zeros(bounds[-1] - bounds[0] + _WORD + 1, np.uint8)
    if held is not None:
        data[: bounds[-1] - bounds[0]] = np.frombuffer(held, np.uint8)[bounds[0] : bounds[-1]]
    return data, bounds - bounds[0]


def stripped(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> None:
    """Move the ends of texts inwards over white space."""
    for i in np.flatnonzero(_EDGE[data[begin]] | _EDGE[data[end - 1]]):
        text = data[begin[i] : end[i]].tobytes().decode()
        right = text.lstrip()
        begin[i] += len(text[: len(text) - len(right)].encode())
        end[i] = begin[i] + len(right.rstrip().encode())


def plain_pages(markup: pa.Array, most_cell_bytes: int) -> Plain:
    """The nodes of plain pages; those whose cells may hold over ``most_cell_bytes`` are left out."""
    data, bounds = contents(markup)
    chars = data[: bounds[-1]]
    plain = markup.is_valid().to_numpy(zero_copy_only=False).copy()
    lt, gt, amp = (np.flatnonzero(chars == ord(c)) for c in "<>&")
    if len(amp):
        plain[np.searchsorted(bounds, amp, "right") - 1] = False
    counts, closers = np.diff(np.searchsorted(lt, bounds)), np.diff(np.searchsorted(gt, bounds))
    plain &= counts == closers
    if not plain.all():
        lt, gt = lt[np.repeat(plain, counts)], gt[np.repeat(plain, closers)]
    counts = np.where(plain, counts, 0)
    page = np.repeat(np.arange(len(markup)), counts)

    # Names: up to eight bytes as one number, small letters.
    words = np.ndarray(len(chars) + 1, np.dtype("<u8"), data, strides=(1,))
    second = data[lt + 1]
    closing = second == ord("/")
    begin = lt + 1 + closing
    size = gt - begin
    declared = second == ord("!")
    if declared.any():
        size = np.where(declared, np.minimum(size, _WORD), size)
    key = words[begin] & _MASKS[np.clip(size, 0, _WORD + 1)]
    key |= (key & _CAPITAL) >> np.uint64(1)
    code = np.minimum(np.searchsorted(_KEYS, key), len(_KEYS) - 1)
    wrong = _KEYS[code] != key
    wrong |= closing & (code == _CODE[DOCTYPE])
    # A tag ends before the next one begins; text may not hold what ends a tag.
    wrong[1:] |= (gt[:-1] > lt[1:]) & (page[:-1] == page[1:])
    wrong |= gt < lt
    titles = np.flatnonzero((code == _CODE["title"]) & ~closing)
    after = np.minimum(titles + 1, len(code) - 1)
    wrong[titles] |= ~closing[after] | (code[after] != code[titles])

    # Depth by page: never below none, and none at the end.
    void = _IS_VOID[code]
    step = np.where(void, 0, np.where(closing, -1, 1))
    depth = np.concatenate(([0], np.cumsum(step)))
    firsts = np.concatenate(([0], np.cumsum(counts)))
    base = depth[firsts[:-1]]
    level = depth[1:] - np.repeat(base, counts) + (closing & ~void)
    wrong |= ~void & ((level < 1) | (level > DEEPEST))
    bad = depth[firsts[1:]] != base
    bad[page[wrong]] = True
    if bad.any():
        plain &= ~bad
        stays = plain[page]
        lt, gt, page, code, closing, void, level = (v[stays] for v in (lt, gt, page, code, closing, void, level))
        counts = np.where(plain, counts, 0)

    # At one depth, a tag that opens is followed by the one that closes it.
    solid = np.flatnonzero(~void)
    paired = solid[np.argsort(level[solid].astype(np.int16), kind="stable")]
    opens, closes = paired[0::2], paired[1::2]
    crossed = code[opens] != code[closes]
    mate = np.zeros(len(lt), np.int64)
    mate[opens] = closes
    if crossed.any():
        plain[page[opens[crossed]]] = False
        stays = plain[page]
        moved = np.cumsum(stays) - 1
        mate = moved[mate[stays]]
        lt, gt, page, code, closing, void = (v[stays] for v in (lt, gt, page, code, closing, void))
        counts = np.where(plain, counts, 0)

    # Texts: the gaps after tags inside readable elements.
    firsts = np.concatenate(([0], np.cumsum(counts)))
    readable = np.cumsum(np.where(_READS[code], np.where(closing, -1, 1), 0)) > 0
    following = np.append(lt[1:], len(chars))
    gaps = np.flatnonzero(readable & (following > gt + 1))
    begin, end = gt[gaps] + 1, following[gaps]
    stripped(data, begin, end)
    total = np.zeros(len(lt) + 1, np.int64)
    total[gaps + 1] = end - begin
    total = np.cumsum(total)
    inside = np.zeros(len(chars) + 1, np.int8)
    filled = end > begin
    inside[begin[filled]] = 1
    inside[end[filled]] = -1
    text = chars[np.cumsum(inside[:-1], dtype=np.int8).view(bool)]

    is_node = _IS_NODE[code] & ~closing
    at = np.flatnonzero(is_node)
    upto = np.cumsum(is_node)
    on = page[at]
    offsets = np.concatenate(([0], np.cumsum(np.bincount(on, minlength=len(markup)))))
    origin, text_origin = offsets[on], total[firsts[on]]
    tag, ends = code[at], mate[at]
    head, places = np.full(len(at), -1), np.arange(len(at))
    for name in ("h3", "h2", "h1"):
        if (found := tag == _CODE[name]).any():
            before = np.concatenate(([-1], np.maximum.accumulate(np.where(found, places, -1))[:-1]))
            head = np.where(before >= origin, before - origin, head)
    pages = Plain(
        plain, offsets, upto[ends] - 1 - origin, head, tag, total[at] - text_origin, total[ends] - text_origin,
        total[firsts], text,
    )
    large = plain & (np.diff(pages.text_offsets) * np.diff(offsets) > most_cell_bytes)
    if large.any():
        return plain_pages(pc.if_else(pa.array(large), pa.scalar(None, markup.type), markup), most_cell_bytes)
    return pages
