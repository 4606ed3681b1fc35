"""Best-fit packing of token sequences with a swap-based local search.

Documents become token ids and an end id; only longer ones than a sequence are cut, into full
pieces after a first that may be shorter.  Pieces are dealt at random into groups of a bounded
number, and each group is packed by itself: pieces by falling length into the fullest sequence
they fit; then, while there are more sequences than the tokens need, documents of underfull
sequences are moved, exchanged one for one or two for one.  An exchange is made only if it
raises the sum of squared fills, which empties the least filled sequences and ends the search.
A group's tokens fill all of its sequences but few, so groups cost next to nothing.

Defined cases: NULL text is empty and is one piece, the end id; repeated rows are pieces of
their own; an empty table gives no rows; columns of the input other than key and text are not
read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetables.functions.rows import by_bytes
from pagetables.llm.common import once_a_worker, stored

CAPACITY = 1024
END = 2
GROUP = 8_192
BATCH_BYTES = 1024 * 1024
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids binary"
PLACES = "row bigint, sequence_id bigint, offset bigint"
# Fixed value: how a byte-level BPE of this kind parts a text before it merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# ``tiktoken`` panics where it has to go back over a million white spaces in a row.
LONG_SPACE = re.compile(r"(?<!\s)\s{100000}")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def merges_of(tokenizer):
    """The tokenizer's vocabulary as ``tiktoken`` ranks, which encode a short text at once.

    A token's bytes are written as one letter each: printable bytes of Latin-1 as themselves,
    the others in order from U+0100.
    """
    import tiktoken

    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    special = {token.content for token in tokenizer.get_added_tokens_decoder().values()}
    ranks = {
        bytes(letters[c] for c in token): number
        for token, number in tokenizer.get_vocab().items()
        if token not in special
    }
    return tiktoken.Encoding("parts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Token ids of a tokenizer's file.  Merging is done by ``tiktoken``, which gives the same
    ids in a fraction of the time; texts that name a special token or have very long runs of
    white space go to the tokenizer."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = merges_of(self.tokenizer)
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text, then the end id."""
        if any(name in text for name in self.special) or LONG_SPACE.search(text):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.merges.encode_ordinary(text)
        ids.append(END)
        return np.array(ids, dtype="<u4")


def pieces(docs: DataFrame, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY,
           tokenizer: str | None = None) -> DataFrame:
    """``(doc_id, piece, start, length, ids)``; ids are little-endian unsigned 32-bit.  Narrow."""
    path = tokenizer or default_tokenizer()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = once_a_worker(f"encoder {path}", lambda: Encoder(path))
        for batch in by_bytes(batches, 1, BATCH_BYTES):
            out: list[tuple] = []
            texts = batch.column(1).fill_null("").to_pylist()
            for doc_id, text_ in zip(batch.column(0).to_pylist(), texts):
                ids = encoder.encode(text_)
                first = len(ids) if len(ids) <= capacity else len(ids) % capacity or capacity
                ends = range(first, len(ids) + 1, capacity)
                starts = [0, *ends][: len(ends)]
                out.extend(
                    (doc_id, i, s, e - s, ids[s:e].tobytes()) for i, (s, e) in enumerate(zip(starts, ends))
                )
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            columns = [pa.array(c, t) for c, t in zip(zip(*out), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(cut, PIECES)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Items by falling length, each into the fullest bin it fits; bins of item numbers."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r is set if a bin has room r
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        size = lengths[item]
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[at].append(item)
        else:
            room, at = capacity, len(bins)
            bins.append([item])
        if room - size:
            by_room.setdefault(room - size, []).append(at)
            rooms |= 1 << (room - size)
    return bins


class Search:
    """Moves and exchanges between underfull bins, each raising the sum of squared fills.

    The least filled bin gives: one or two of its items go to a bin filled as much or more,
    against one smaller item or none.  It gives as long as something raises the sum; then the
    next one does.  Where a bin has more room than before, less filled ones try again; a bin
    that ran empty lets all others try again.
    """

    def __init__(self, lengths: list[int], bins: list[list[int]], capacity: int):
        self.size = np.array(lengths, dtype=np.int64)
        self.bins = [list(b) for b in bins]
        self.capacity = capacity
        self.fill = np.array([sum(lengths[i] for i in b) for b in bins], dtype=np.int64)
        self.owner = np.empty(len(lengths), dtype=np.int64)
        for number, members in enumerate(bins):
            self.owner[members] = number
        self.least = -(-int(self.size.sum()) // capacity)
        self.count = len(bins)

    def run(self) -> list[list[int]]:
        stuck = np.zeros(len(self.bins), dtype=bool)
        while self.count > self.least:
            trying = np.flatnonzero((self.fill > 0) & (self.fill < self.capacity) & ~stuck)
            if not len(trying):
                break
            low = int(trying[self.fill[trying].argmin()])
            before = self.fill[low]
            while self.fill[low] and self.improve(low):
                pass
            if not self.fill[low]:
                self.count -= 1
                stuck[:] = False
            else:
                if self.fill[low] < before:  # less filled ones may have found room here
                    stuck[self.fill <= self.fill[low]] = False
                stuck[low] = True
        for members in self.bins:
            members.sort(key=lambda i: (-self.size[i], i))
        return [b for b in self.bins if b]

    def given(self, low: int) -> dict[int, tuple[int, ...]]:
        """One or two items of a bin for each sum they have."""
        own = self.bins[low]
        sums = {int(self.size[a]) + int(self.size[b]): (a, b) for k, a in enumerate(own) for b in own[:k]}
        return sums | {int(self.size[a]): (a,) for a in own}

    def improve(self, low: int) -> bool:
        """Makes the change that raises the sum most; False if there is none."""
        others = np.flatnonzero((self.fill >= self.fill[low]) & (self.fill < self.capacity))
        others = others[others != low]
        open_bin = np.zeros(len(self.fill), dtype=bool)
        open_bin[others] = True
        items = np.flatnonzero(open_bin[self.owner])
        # What may come back, an item or nothing, and from which bin.
        back = np.concatenate([self.size[items], np.zeros(len(others), dtype=np.int64)])
        at = np.concatenate([self.owner[items], others])
        room, ahead = self.capacity - self.fill[at], self.fill[at] - self.fill[low]
        best, change = 0, None
        for size, giving in self.given(low).items():
            gain = size - back
            raised = np.where((gain > 0) & (gain <= room), gain * (ahead + gain), 0)
            k = int(raised.argmax()) if len(raised) else 0
            if len(raised) and raised[k] > best:
                best, change = int(raised[k]), (giving, k)
        if change is None:
            return False
        giving, k = change
        to = int(at[k])
        for item in giving:
            self.move(item, to)
        if k < len(items):
            self.move(int(items[k]), low)
        return True

    def move(self, item: int, to: int) -> None:
        here = int(self.owner[item])
        self.bins[here].remove(item)
        self.bins[to].append(item)
        self.owner[item] = to
        self.fill[here] -= self.size[item]
        self.fill[to] += self.size[item]


def pack_lengths(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of item numbers; every length is in 1 to ``capacity``."""
    return Search(lengths, best_fit(lengths, capacity), capacity).run()


def placed(rows: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``rows(row, length)`` to ``(row, sequence_id, offset)``."""
    n = max(1, -(-rows.count() // group))
    dealt = rows.select("row", "length", F.pmod(F.xxhash64("row"), F.lit(n)).cast("long").alias("group"))

    def pack(key, found):
        found = found.sort_by("row")  # the order rows arrive in doesn't matter
        ids, lengths = (found.column(c).to_pylist() for c in ("row", "length"))
        at: list[tuple[int, int, int]] = []
        for number, members in enumerate(pack_lengths(lengths, capacity)):
            offset = 0
            for item in members:
                at.append((ids[item], (key[0].as_py() << 32) + number, offset))
                offset += lengths[item]
        return pa.table([pa.array(c, pa.int64()) for c in zip(*at)], names=["row", "sequence_id", "offset"])

    return dealt.groupBy("group").applyInArrow(pack, PLACES)


def packed(docs: DataFrame, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY,
           tokenizer: str | None = None, ids: bool = True) -> DataFrame:
    """All pieces with ``ids_crc32``, ``sequence_id`` and ``offset``; with their ids if asked."""
    cut = pieces(docs, text, key, capacity, tokenizer).withColumn("ids_crc32", F.crc32("ids"))
    cut = cut.withColumn("row", F.monotonically_increasing_id())
    cut = stored(cut if ids else cut.drop("ids"), "pieces", 4 * BATCH_BYTES)
    return cut.join(placed(cut.select("row", "length"), capacity), "row").drop("row")


def sequences(packed_pieces: DataFrame) -> DataFrame:
    """``(sequence_id, length, ids)``: the ids of a sequence's pieces one after the other.

    A sequence holds at most its capacity, so what is gathered is bounded.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(F.transform(parts, lambda p: F.hex(p["ids"])), F.lit(""), lambda s, p: F.concat(s, p))
    return packed_pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.unhex(joined).alias("ids"))
