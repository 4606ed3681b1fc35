"""Near-duplicate groups: MinHash bands, odd sketches, and confirmation on whole sets.

A document's set holds the 64-bit hashes of its distinct five-word shingles.  Every set gets
``BANDS * ROWS`` MinHash samples.  ``ROWS`` samples make a band's key; sets that share a key
are candidates.  All samples are folded into one parity bitmap (each sample flips one of
``SKETCH_BITS`` bits); for similarities near the threshold the XOR of two bitmaps has a bit
count that gives the similarity closely, so candidates that cannot be similar enough are left
out after reading 64 bytes of each.  The rest are confirmed on their whole sets.

Bands miss a pair at similarity 0.75 with probability (1 - 0.75^6)^64 < 4e-6; the bitmaps keep
candidates down to an estimate of 0.55, five deviations under the threshold.

Equal sets are one class from the start, represented by its smallest key.  The members of a
bucket are not written out as pairs.  They are tested against the bucket's smallest member
first; those that are still in another component than it, the strays, against three more
members; and strays that are left against all members outside their own component.  Buckets of
over ``SMALL`` members do this last step in blocks of bounded numbers of sets, which give out
links only.  What all of this leaves out are pairs inside a component, so components are those
of all confirmed links.

The sets of the documents in question are made from their texts where those are read: a bitmap
of fixed size, of hashes of the wanted keys, says which texts to pass over.

Defined cases: sets of NULL, empty or blank texts are empty and linked with nothing; fewer
than five words are one shingle; rows without a key are never linked (component NULL, kept);
rows that share a key are one document; an empty table gives no rows; columns of the input
stay, those that are named as the result's are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.functions.rows import by_bytes
from pagetables.llm.common import Tucked, stored
from pagetables.llm.components import components

WORDS = 5
BANDS, ROWS = 64, 6
SAMPLES = BANDS * ROWS
SKETCH_BITS = 512
LEAST, OF = 75, 100
ESTIMATE = 0.55
BATCH_BYTES = 256 * 1024  # texts hashed at once; longer ones are hashed in pieces of that size
BATCH_ROWS = 1024
ARROW_BYTES = 4 * 1024 * 1024
SMALL = 16  # members of a bucket whose strays meet the others as pairs
BLOCK = 256  # strays, or members, of one block of a larger bucket
FILTER_BITS = 1 << 26
SIGNATURE = "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, keys array<bigint>, odd array<bigint>"

_rng = np.random.default_rng(20)
_LETTER = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_LETTER[65:91] = _LETTER[97:123]  # A-Z count as a-z
_STEP = np.uint64(0x9E3779B97F4A7C15)
_STEP_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_PLACE = _rng.integers(1, 1 << 63, WORDS + 1, dtype=np.uint64) | np.uint64(1)
_FACTORS = (_rng.integers(1, 1 << 31, SAMPLES, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_BAND = _rng.integers(1, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
_SALT = _rng.integers(1, 1 << 63, SAMPLES, dtype=np.uint64)
_CENTRES = tuple(int(x) for x in _rng.integers(1, 1 << 62, 2))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(step: np.uint64, n: int) -> np.ndarray:
    """1, step, step^2, … modulo 2^64."""
    out = np.ones(max(n, 1), dtype=np.uint64)
    done = 1
    while done < n:
        more = min(done, n - done)
        next_power = np.uint64(int(out[done - 1]) * int(step) % (1 << 64))
        out[done : done + more] = out[:more] * next_power
        done += more
    return out


_tables: dict[str, np.ndarray] = {}


def powers(step: np.uint64, n: int) -> np.ndarray:
    """The first powers of a step; ``n`` is bounded by what is hashed at once."""
    held = _tables.get(str(step))
    if held is None or len(held) < n:
        held = _tables[str(step)] = _powers(step, max(n, 1 << 16))
    return held[:n]


def _words_at(data: np.ndarray, border: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, length and polynomial hash of the words in a stretch of bytes.

    Prefix sums of letters times powers of a step give each word's hash as a difference, times
    the inverse power of its place.
    """
    n = len(data)
    solid = (data != 0x20) & ((data < 0x09) | (data > 0x0D))
    before, after = np.r_[False, solid[:-1]], np.r_[solid[1:], False]
    if border is not None:
        before, after = before & ~border[:-1], after & ~border[1:]
    starts, ends = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_LETTER[data] * powers(_STEP, n), out=sums[1:])
    return starts, ends - starts, (sums[ends] - sums[starts]) * powers(_STEP_BACK, n)[starts]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word of several texts that lie one after the other."""
    if not len(data):
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    border = np.zeros(len(data) + 1, dtype=bool)
    border[offsets] = True
    starts, lengths, raw = _words_at(data, border)
    return mixed(raw + lengths.astype(np.uint64)), np.searchsorted(offsets, starts, side="right") - 1


def word_hashes_in_pieces(data: np.ndarray, size: int = BATCH_BYTES) -> Iterator[np.ndarray]:
    """The words' hashes of one long text, piece by piece; a word may lie across pieces."""
    open_raw, open_length = 0, 0
    for at in range(0, len(data), size):
        starts, lengths, raw = _words_at(data[at : at + size])
        lengths = lengths.astype(np.uint64)
        if open_length:
            if len(starts) and starts[0] == 0:
                raw[0] = np.uint64((open_raw + pow(int(_STEP), open_length, 1 << 64) * int(raw[0])) % (1 << 64))
                lengths[0] += np.uint64(open_length)
            else:
                raw, lengths = np.r_[np.uint64(open_raw), raw], np.r_[np.uint64(open_length), lengths]
            open_length = 0
        here = min(size, len(data) - at)
        if at + size < len(data) and len(starts) and data[at + here - 1] != 0x20 and not 0x09 <= data[at + here - 1] <= 0x0D:
            open_raw, open_length = int(raw[-1]), int(lengths[-1])
            raw, lengths = raw[:-1], lengths[:-1]
        yield mixed(raw + lengths)
    if open_length:
        yield mixed(np.array([(open_raw + open_length) % (1 << 64)], dtype=np.uint64))


def shingled(words: np.ndarray) -> np.ndarray:
    long = len(words) - WORDS + 1
    return mixed(reduce(add, (words[i : i + long] * _PLACE[i] for i in range(WORDS))))


def shingled_whole(words: np.ndarray) -> np.ndarray:
    """The one shingle of a text of fewer words than a shingle has."""
    n = len(words)
    if not n:
        return np.empty(0, dtype=np.uint64)
    return mixed((words * _PLACE[:n]).sum(keepdims=True) + _PLACE[WORDS:] * np.uint64(n))


def set_of_long_text(data: np.ndarray) -> np.ndarray:
    """Sorted distinct shingle hashes of a text that is hashed in pieces."""
    last = np.empty(0, dtype=np.uint64)
    merged, fresh = np.empty(0, dtype=np.uint64), []
    for words in word_hashes_in_pieces(data):
        words = np.concatenate([last, words])
        if len(words) >= WORDS:
            fresh.append(shingled(words))
            last = words[len(words) - WORDS + 1 :].copy()
        else:
            last = words
        if sum(map(len, fresh)) > max(1 << 18, len(merged) // 2):  # so that copies don't pile up
            merged, fresh = np.unique(np.concatenate([merged, *fresh])), []
    merged = np.unique(np.concatenate([merged, *fresh]))
    return merged if len(merged) else shingled_whole(last)


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    texts = pa.chunked_array([column]).combine_chunks().fill_null("")
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64, count=len(texts) + 1 + texts.offset)[texts.offset :]
    data = np.frombuffer(buffers[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if len(data) > BATCH_BYTES:
        return [set_of_long_text(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
    words, owners = word_hashes(data, offsets)
    bounds = np.searchsorted(owners, np.arange(len(texts) + 1))
    shingles = shingled(words) if len(words) >= WORDS else words
    sets = []
    for begin, end in zip(bounds[:-1], bounds[1:]):
        if end - begin >= WORDS:
            sets.append(np.unique(shingles[begin : end - WORDS + 1]))
        else:
            sets.append(shingled_whole(words[begin:end]))
    return sets


def _cut(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    for batch in by_bytes(batches, column, BATCH_BYTES):
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


def samples_of(hashes: np.ndarray, space: np.ndarray) -> np.ndarray:
    """The minimum of the hashes under each of ``SAMPLES`` permutations of 32-bit numbers."""
    low = np.full(SAMPLES, 0xFFFFFFFF, dtype=np.uint32)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), space.shape[1]):
        part = short[at : at + space.shape[1]]
        out = space[:, : len(part)]
        np.multiply(_FACTORS[:, None], part[None, :], out=out)
        np.minimum(low, out.min(axis=1), out=low)
    return low


def sketches(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band keys and parity bitmaps of rows of samples."""
    wide = samples.astype(np.uint64)
    keys = mixed((wide.reshape(-1, BANDS, ROWS) * _BAND).sum(axis=2, dtype=np.uint64) + _BAND[:, 0])
    bit = (mixed(wide + _SALT) % np.uint64(SKETCH_BITS)).astype(np.int64)
    at = np.arange(len(samples))[:, None] * SKETCH_BITS + bit
    parity = np.bincount(at.ravel(), minlength=len(samples) * SKETCH_BITS).astype(np.uint8) & 1
    odd = np.packbits(parity.reshape(len(samples), SKETCH_BITS), axis=1).view(np.int64)
    return keys.view(np.int64), odd


def _lists(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1]
    offsets = np.arange(0, rows.size + 1, width, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()))


def signatures(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(doc_id, n_shingles, d1, d2, keys, odd)``; d1 and d2 identify a set.  Narrow."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = np.empty((SAMPLES, 512), dtype=np.uint32)
        for batch in _cut(batches, 1):
            sets = shingle_sets(batch.column(1))
            samples = np.stack([samples_of(s, space) for s in sets])
            keys, odd = sketches(samples)
            d1 = np.array([s.sum(dtype=np.uint64) for s in sets], dtype=np.uint64).view(np.int64)
            d2 = np.array([mixed(s + _STEP).sum(dtype=np.uint64) for s in sets], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(d1), pa.array(d2), _lists(keys), _lists(odd)],
                names=["doc_id", "n_shingles", "d1", "d2", "keys", "odd"],
            )

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(sign, SIGNATURE)


def wanted_bits(ids: DataFrame) -> dict[int, bytes]:
    """A bitmap of the keys' hashes, in parts of 4 KB: at most ``FILTER_BITS / 8`` bytes."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    parts = ids.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    return {r["part"]: bytes(r["bits"]) for r in parts.collect()}


def whole_sets(docs: DataFrame, text: str, key: str, ids: DataFrame) -> DataFrame:
    """``(doc_id, hashes)`` of the documents with one of the ``ids``, and of few others."""
    bits = wanted_bits(ids)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))

    def hash_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((FILTER_BITS // 32768 + 2, 4096), dtype=np.uint8)
        for part, some_bits in bits.items():
            table[part] = np.frombuffer(some_bits, dtype=np.uint8)
        for batch in _cut(batches, 1):
            parts, positions = (batch.column(c).to_numpy() for c in (2, 3))
            wanted = (table[parts, positions >> 3] >> (positions & 7).astype(np.uint8)) & 1
            some = batch.filter(pa.array(wanted.astype(bool)))
            if some.num_rows:
                sets = [s.view(np.int64) for s in shingle_sets(some.column(1))]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["doc_id", "hashes"]
                )

    named = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = named.filter("doc_id is not null").select(
        "*", F.bitmap_bucket_number(place).alias("part"), F.bitmap_bit_position(place).alias("at")
    )
    return rows.mapInArrow(hash_all, "doc_id bigint, hashes array<bigint>")


def links_of_block(key, strays, members):
    """``(a, b)`` of the strays and members of a block that are similar enough, and not in one
    component already.

    Common hashes are counted by products of membership matrices, some hashes at a time.
    """
    names = ["a", "b"]
    none = pa.table([pa.array([], pa.int64())] * 2, names=names)
    if not strays.num_rows or not members.num_rows:
        return none
    sets = [t.column("hashes").combine_chunks() for t in (strays, members)]
    values = [np.asarray(c.flatten()) for c in sets]
    sizes = [np.diff(np.asarray(c.offsets)) for c in sets]
    common = np.intersect1d(*values)
    both = np.zeros((len(sizes[0]), len(sizes[1])), dtype=np.float64)
    owners = [np.repeat(np.arange(len(n)), n) for n in sizes]
    at = [np.searchsorted(common, v) for v in values]
    known = [(a < len(common)) & (common[np.minimum(a, len(common) - 1)] == v) if len(common) else np.zeros(len(v), bool) for a, v in zip(at, values)]
    for begin in range(0, len(common), 4096):
        rows = []
        for n, owner, a, ok in zip(sizes, owners, at, known):
            here = ok & (a >= begin) & (a < begin + 4096)
            matrix = np.zeros((len(n), min(4096, len(common) - begin)), dtype=np.float32)
            matrix[owner[here], a[here] - begin] = 1
            rows.append(matrix)
        both += rows[0] @ rows[1].T
    either = sizes[0][:, None] + sizes[1][None, :] - both
    left, right = (t.column("rep").to_numpy() for t in (strays, members))
    apart = strays.column("own").to_numpy()[:, None] != members.column("own").to_numpy()[None, :]
    i, j = np.nonzero((both * OF >= either * LEAST) & apart)
    if not len(i):
        return none
    ends = np.stack([left[i], right[j]])
    return pa.table([pa.array(ends.min(axis=0)), pa.array(ends.max(axis=0))], names=names)


def most_odd(estimate: float = ESTIMATE) -> int:
    """The largest XOR bit count at which the estimated similarity is not under ``estimate``."""
    return int(SKETCH_BITS / 2 * (1 - math.exp(-4 * SAMPLES * (1 - estimate) / SKETCH_BITS)))


def odd_bits(a: Column, b: Column) -> Column:
    """Bit count of the XOR of two bitmaps."""
    words = [F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(SKETCH_BITS // 64)]
    return reduce(add, words)


class _Linker:
    """Confirms candidate pairs of representatives."""

    def __init__(self, docs: DataFrame, reps: DataFrame, text: str, key: str):
        self.docs, self.reps, self.text, self.key = docs, reps, text, key

    def sets(self, ids: DataFrame, name: str) -> DataFrame:
        return stored(whole_sets(self.docs, self.text, self.key, ids), f"{name}-sets", ARROW_BYTES)

    def confirmed_in_blocks(self, strays: DataFrame, members: DataFrame, name: str) -> DataFrame:
        """Links of ``strays(key, rep, own)`` with the ``members`` of their buckets."""
        counts = strays.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("stray_blocks")).join(
            members.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("member_blocks")), "key"
        )
        sets = self.sets(members.select(F.col("rep").alias("doc_id")).distinct(), name)
        hashed = sets.withColumnRenamed("doc_id", "rep")
        own, other = F.col("stray_blocks"), F.col("member_blocks")

        def dealt(rows: DataFrame, mine: str, n: Column, theirs: str, m: Column) -> DataFrame:
            block = F.pmod(F.xxhash64("rep"), n).cast("int")
            return rows.join(counts, "key").select(
                "key", "rep", "own", block.alias(mine), F.explode(F.sequence(F.lit(0), m - 1)).alias(theirs)
            ).join(hashed, "rep").select(*[F.col(c).alias(c) for c in ("key", "i", "j", "rep", "own", "hashes")])

        by = ["key", "i", "j"]
        left = dealt(strays, "i", own, "j", other).groupBy(by)
        right = dealt(members, "j", other, "i", own).groupBy(by)
        return stored(left.cogroup(right).applyInArrow(links_of_block, "a bigint, b bigint").distinct(), name)

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Pairs ``(a, b)`` whose sizes and bitmaps allow the similarity."""
        sized = self.reps.select("rep", "n_shingles", "odd")
        left = sized.select(F.col("rep").alias("a"), F.col("n_shingles").alias("na"), F.col("odd").alias("oa"))
        right = sized.select(F.col("rep").alias("b"), F.col("n_shingles").alias("nb"), F.col("odd").alias("ob"))
        small, large = F.least("na", "nb"), F.greatest("na", "nb")
        return (
            pairs.join(left, "a").join(right, "b")
            .filter((small * OF >= large * LEAST) & (odd_bits(F.col("oa"), F.col("ob")) <= most_odd()))
            .select("a", "b").distinct()
        )

    def confirmed(self, pairs: DataFrame, name: str) -> DataFrame:
        """Pairs that are similar enough on their whole sets."""
        pairs = stored(self.likely(pairs), f"{name}-likely")
        wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
        sets = self.sets(wanted, name)
        left = sets.select(F.col("doc_id").alias("a"), F.col("hashes").alias("ha"))
        right = sets.select(F.col("doc_id").alias("b"), F.col("hashes").alias("hb"))
        both = F.size(F.array_intersect("ha", "hb"))
        either = F.size("ha") + F.size("hb") - both
        return stored(
            pairs.join(left, "a").join(right, "b").filter(both * OF >= either * LEAST).select("a", "b").distinct(), name
        )


def _pairs(rows: DataFrame, other: str) -> DataFrame:
    return rows.select(F.least("rep", other).alias("a"), F.greatest("rep", other).alias("b")).filter("a <> b").distinct()


def groups(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of every row."""
    signed = stored(signatures(docs, text, key), "signatures", ARROW_BYTES)
    named = signed.filter("n_shingles > 0 and doc_id is not null")
    classes = stored(named.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep")), "classes")
    mine = (F.col("d1") == F.col("e1")) & (F.col("d2") == F.col("e2"))
    renamed = classes.withColumnsRenamed({"d1": "e1", "d2": "e2"})
    reps = stored(
        named.join(renamed, mine & (F.col("doc_id") == F.col("rep"))).select("rep", "n_shingles", "keys", "odd"), "reps"
    )
    bands = reps.select("rep", F.explode("keys").alias("key"))
    turned = [F.col("rep").bitwiseXOR(F.lit(c)) for c in _CENTRES]
    heads = bands.groupBy("key").agg(
        F.min("rep").alias("head"), F.max("rep").alias("tail"), F.count("*").alias("n_members"),
        *[F.min(t).bitwiseXOR(F.lit(c)).alias(f"head{i}") for i, (t, c) in enumerate(zip(turned, _CENTRES))],
    ).filter("head < tail")
    members = stored(bands.join(heads, "key"), "members")
    linker = _Linker(docs, reps, text, key)

    links = linker.confirmed(_pairs(members.filter("rep <> head"), "head"), "links")
    found = components(links)
    for name in ("more", "rest"):
        places = stored(found, "places")

        def placed(rows: DataFrame, node: str, to: str) -> DataFrame:
            held = places.select(F.col("node").alias("_n"), F.col("component").alias(to))
            return rows.join(held, F.col(node) == F.col("_n"), "left").drop("_n").withColumn(to, F.coalesce(to, node))

        apart = placed(placed(members, "rep", "own"), "head", "main")
        strays = stored(apart.filter("own <> main"), "strays")
        if strays.isEmpty():
            break
        if name == "more":
            others = F.explode(F.array("tail", *[f"head{i}" for i in range(len(_CENTRES))])).alias("other")
            pairs = _pairs(strays.select("rep", others), "other")
        else:
            held = strays.filter(F.col("n_members") <= SMALL).select("key", "rep", "own", "head")
            against = apart.select("key", F.col("rep").alias("other"), F.col("own").alias("there"))
            pairs = _pairs(held.join(against, "key").filter("own <> there and other <> head"), "other")
        more = linker.confirmed(pairs, name)
        hot = strays.filter(F.col("n_members") > SMALL).select("key", "rep", "own")
        if name == "rest" and not hot.isEmpty():
            around = apart.select("key", "rep", "own").join(hot.select("key").distinct(), "key", "left_semi")
            more = more.union(linker.confirmed_in_blocks(hot, stored(around, "around"), "blocks"))
        if not more.isEmpty():
            links = stored(links.union(more).distinct(), "links")
            found = components(links)

    joined = classes.join(found, F.col("rep") == F.col("node"), "left").select(
        F.col("d1").alias("e1"), F.col("d2").alias("e2"), F.coalesce("component", "rep").alias("component_id")
    )
    # NULL keys and empty sets meet no class: they are their own component.
    linked = F.col("n_shingles") > 0
    rows = signed.select("doc_id", "n_shingles", "d1", "d2").join(joined, mine, "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.when(linked, F.col("component_id")).otherwise(F.col("doc_id"))).alias("component_id"),
    )
    return rows.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicated(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows that stay: one document of each group, with the columns of the input."""
    gone = groups(docs, text, key).filter(~F.col("kept")).select(F.col("doc_id").alias("gone"))
    tucked = Tucked(docs)
    return tucked.frame.join(gone, tucked[key] == F.col("gone"), "left_anti").select(*tucked.back())
