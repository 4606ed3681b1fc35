"""Vector codes: product quantisation by integer k-means with adaptive distance bounds.

Components become whole numbers, vectors are cut into ``PARTS`` parts, and each part position
has a codebook of ``ENTRIES`` entries.  A round assigns every part to its nearest entry and
then moves each entry to the floored mean of its parts.

Assignment follows Drake and Hamerly.  From round to round each part keeps its entry with an
upper bound of the distance, its ``b`` closest other entries with lower bounds in order, and
one outer bound for all the rest.  Entries move by known distances, so bounds are widened
instead of distances computed: a part whose upper bound is under its first lower bound stays,
one whose upper bound is under its j-th reads j entries, and only one whose upper bound reaches
the outer bound reads the whole codebook.  ``b`` starts at a quarter of the codebook and shrinks
to what the last round needed, never under an eighth.  Bounds are rounded outwards and compared
strictly; whatever they leave open is decided by whole-number distances, ties by lower index.

The state of a round is a table in the shared folder, written beside the vectors in one narrow
pass; its tasks add one row of partial sums each.  What reaches the driver is the 16 first
vectors and at most ``PARTS * ENTRIES`` sums a round, whatever the number of rows.  The table of
the round before is emptied as soon as the next one stands.

Defined cases: a vector that is NULL, or has a NULL, NaN or infinite component, or one beyond
2^50 when scaled, takes no part; the dimension is that of the first vector (smallest id, then
smallest components, NULL ids last), and vectors of another one, or of one that the parts don't
divide, keep their row with code and error NULL; rows that share an id are vectors of their own;
fewer vectors than entries make a smaller codebook; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.llm.common import released, stored
from pagetables.llm.topk import usable

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
LARGEST = 1 << 50  # scaled components, so that doubles hold them exactly
NARROW = 1 << 24  # components whose squared distances stay far within 64 bits
SUMS = "array<struct<part:int,entry:int,count:bigint,sums:array<string>>>"
STATE = f"vec_id bigint, label string, v binary, b int, state binary, sums {SUMS}, most int, full bigint"
CODED = "vec_id bigint, label string, code string, error bigint"
HOT_SHARE = 1000  # labels with a thousandth of all rows: there are at most that many


def bounds_type(b: int) -> np.dtype:
    """What is kept of a part: its entry, ``b`` closest others, and bounds."""
    return np.dtype([
        ("own", "u1"), ("near", "u1", (b,)), ("upper", "<f4"), ("lower", "<f4", (b,)), ("outer", "<f4"),
    ])


def raised(x: np.ndarray) -> np.ndarray:
    """32-bit numbers not under the given distances."""
    x = x * (1 + 1e-12)
    y = x.astype(np.float32)
    return np.where(y < x, np.nextafter(y, np.float32(np.inf)), y)


def lowered(x: np.ndarray) -> np.ndarray:
    """32-bit numbers not over the given distances."""
    x = x * (1 - 1e-12)
    y = x.astype(np.float32)
    return np.where(y > x, np.nextafter(y, np.float32(-np.inf)), y)


def squares(vectors: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows (n, d) to entries (m, d) or, row by row, (n, m, d)."""
    entries = entries[None] if entries.ndim == 2 else entries
    largest = max((int(np.abs(a).max()) for a in (vectors, entries) if a.size), default=0)
    if largest >= NARROW:
        vectors, entries = vectors.astype(object), entries.astype(object)
    apart = vectors[:, None, :] - entries
    return (apart * apart).sum(axis=2)


def root(square: np.ndarray) -> np.ndarray:
    return np.sqrt(square.astype(np.float64))


def nearest_first(square: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Order of each row by distance, then by entry."""
    by_name = np.argsort(names, axis=1, kind="stable")
    by_square = np.argsort(np.take_along_axis(square, by_name, axis=1), axis=1, kind="stable")
    return np.take_along_axis(by_name, by_square, axis=1)


class Assigner:
    """Keeps the bounds of one part position while its codebook moves."""

    def __init__(self, entries: np.ndarray, before: np.ndarray | None, b: int):
        self.entries, self.b = entries, min(b, len(entries) - 1)
        if before is not None:
            square = ((entries.astype(object) - before.astype(object)) ** 2).sum(axis=1)
            self.moved = raised(root(square)).astype(np.float64)

    def first(self, vectors: np.ndarray) -> np.ndarray:
        """Bounds of vectors that have none yet, from all distances."""
        b, k = self.b, len(self.entries)
        square = squares(vectors, self.entries)
        order = nearest_first(square, np.broadcast_to(np.arange(k), square.shape))
        far = root(np.take_along_axis(square, order, axis=1))
        held = np.empty(len(vectors), dtype=bounds_type(b))
        held["own"], held["near"] = order[:, 0], order[:, 1 : b + 1]
        held["upper"], held["lower"] = raised(far[:, 0]), lowered(far[:, 1 : b + 1])
        held["outer"] = lowered(far[:, b + 1]) if k > b + 1 else np.float32(np.inf)
        return held

    def widened(self, held: np.ndarray) -> np.ndarray:
        """Bounds after the entries have moved, with no more than ``b`` closest ones."""
        old, out = held["near"].shape[1], np.empty(len(held), dtype=bounds_type(self.b))
        outer = held["outer"].astype(np.float64)
        if old > self.b:  # what is no longer kept is at least as far as its own bound
            outer = np.minimum(outer, held["lower"][:, self.b])
        near = held["near"][:, : self.b]
        outer = outer - self.moved.max()
        lower = held["lower"][:, : self.b].astype(np.float64) - self.moved[near]
        out["own"], out["near"] = held["own"], near
        out["upper"] = raised(held["upper"].astype(np.float64) + self.moved[held["own"]])
        ordered = np.minimum.accumulate(np.concatenate([lower, outer[:, None]], axis=1)[:, ::-1], axis=1)[:, ::-1]
        out["lower"], out["outer"] = lowered_any(ordered[:, :-1]), lowered_any(ordered[:, -1])
        return out

    def assign(self, vectors: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, int, int]:
        """New bounds; how many closest entries were needed at most; how many full scans."""
        out = self.widened(held)
        bounds = np.concatenate([out["lower"], out["outer"][:, None]], axis=1)
        unsure = np.flatnonzero(out["upper"] >= bounds[:, 0])
        if len(unsure):  # the exact distance to its own entry decides most of them
            own = self.entries[out["own"][unsure]][:, None, :]
            out["upper"][unsure] = raised(root(squares(vectors[unsure], own)[:, 0]))
        needed = np.zeros(len(out), dtype=np.int64)
        needed[unsure] = (out["upper"][unsure, None] >= bounds[unsure]).sum(axis=1)
        whole = np.flatnonzero(needed > self.b)
        if len(whole):
            out[whole] = self.first(vectors[whole])
        for j in range(1, self.b + 1):
            rows = np.flatnonzero(needed == j)
            if not len(rows):
                continue
            names = np.concatenate([out["own"][rows, None], out["near"][rows, :j]], axis=1)
            square = squares(vectors[rows], self.entries[names])
            order = nearest_first(square, names)
            far = root(np.take_along_axis(square, order, axis=1))
            names = np.take_along_axis(names, order, axis=1)
            out["own"][rows], out["upper"][rows] = names[:, 0], raised(far[:, 0])
            near, lower = out["near"][rows], bounds[rows].copy()
            near[:, :j], lower[:, :j] = names[:, 1:], lowered(far[:, 1:])
            lower = np.minimum.accumulate(lower[:, ::-1], axis=1)[:, ::-1]
            out["near"][rows], out["lower"][rows] = near, lower[:, :-1]
        most = int(needed[needed <= self.b].max()) if (needed <= self.b).any() else 0
        return out, most, len(whole)


def lowered_any(x: np.ndarray) -> np.ndarray:
    """32-bit numbers not over the given ones, which may be under zero: then zero will do."""
    return lowered(np.maximum(x, 0.0))


def scaled(column: pa.Array, scale: int) -> np.ndarray:
    """Whole components of a batch of vectors of one length, row by row."""
    flat = np.asarray(column.flatten(), dtype=np.float64)
    return np.floor(flat * scale).astype(np.int64).reshape(len(column), -1)


class _Sums:
    """Counts and componentwise sums of the parts of each entry, of one task."""

    def __init__(self, codebooks: np.ndarray):
        parts, k, d = codebooks.shape
        self.count = np.zeros((parts, k), dtype=np.int64)
        self.sum = np.zeros((parts, k, d), dtype=object)
        self.most = self.full = 0

    def add(self, part: int, own: np.ndarray, vectors: np.ndarray) -> None:
        k = self.count.shape[1]
        self.count[part] += np.bincount(own, minlength=k)
        batch = np.zeros((k, vectors.shape[1]), dtype=np.int64)  # under 2^50 times the rows of a batch
        np.add.at(batch, own, vectors)
        self.sum[part] += batch.astype(object)

    def row(self) -> pa.RecordBatch:
        parts, k = self.count.shape
        sums = [
            {"part": p, "entry": e, "count": int(self.count[p, e]), "sums": [str(x) for x in self.sum[p, e]]}
            for p in range(parts) for e in range(k) if self.count[p, e]
        ]
        return _state_batch([None], [None], [None], None, [None], sums=[sums], most=[self.most], full=[self.full])


def _state_batch(ids, labels, vectors, b, states, sums=None, most=None, full=None) -> pa.RecordBatch:
    n = len(states)
    sum_type = pa.list_(pa.struct([
        pa.field("part", pa.int32()), pa.field("entry", pa.int32()), pa.field("count", pa.int64()),
        pa.field("sums", pa.list_(pa.string())),
    ]))
    columns = [
        pa.array(ids, pa.int64()), pa.array(labels, pa.string()), pa.array(vectors, pa.binary()),
        pa.array([b] * n, pa.int32()), pa.array(states, pa.binary()), pa.array(sums or [None] * n, sum_type),
        pa.array(most or [None] * n, pa.int32()), pa.array(full or [None] * n, pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "v", "b", "state", "sums", "most", "full"])


def _small(batches: Iterator[pa.RecordBatch], rows: int = 2048) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _vectors(column: pa.Array, dimension: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<i8").reshape(len(column), dimension)


def _first_pass(codebooks: np.ndarray, scale: int, b: int):
    parts, k, d = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assigners = [Assigner(entries, None, b) for entries in codebooks]
        sums = _Sums(codebooks)
        for batch in _small(batches):
            vectors = scaled(batch.column(2), scale)
            held = []
            for p, assigner in enumerate(assigners):
                mine = vectors[:, p * d : (p + 1) * d]
                held.append(assigner.first(mine))
                sums.add(p, held[-1]["own"], mine)
            states = np.stack(held, axis=1)
            yield _state_batch(
                batch.column(0), batch.column(1), [v.astype("<i8").tobytes() for v in vectors], assigners[0].b,
                [s.tobytes() for s in states],
            )
        yield sums.row()

    return run


def _next_pass(codebooks: np.ndarray, before: np.ndarray, b: int, last: bool):
    parts, k, d = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assigners = [Assigner(*pair, b) for pair in zip(codebooks, before)]
        sums = _Sums(codebooks)
        for batch in _small(batches):
            vectors = _vectors(batch.column(2), parts * d)
            kind = bounds_type(batch.column(3)[0].as_py())
            old = np.frombuffer(b"".join(batch.column(4).to_pylist()), dtype=kind).reshape(-1, parts)
            held, error = [], np.zeros(len(vectors), dtype=object)
            for p, assigner in enumerate(assigners):
                mine = vectors[:, p * d : (p + 1) * d]
                new, most, full = assigner.assign(mine, old[:, p])
                held.append(new)
                if last:
                    error = error + squares(mine, codebooks[p][new["own"]][:, None, :])[:, 0]
                else:
                    sums.add(p, new["own"], mine)
                    sums.most, sums.full = max(sums.most, most), sums.full + full
            states = np.stack(held, axis=1)
            if last:
                codes = [bytes(row).hex() for row in states["own"]]
                errors = pa.array([min(int(e), (1 << 63) - 1) for e in error], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(codes), errors], names=["vec_id", "label", "code", "error"]
                )
            else:
                yield _state_batch(
                    batch.column(0), batch.column(1), batch.column(2), assigners[0].b, [s.tobytes() for s in states]
                )
        if not last:
            yield sums.row()

    return run


def moved(codebooks: np.ndarray, state: DataFrame) -> tuple[np.ndarray, int]:
    """The codebooks after a round, and the most closest entries that one of its parts needed."""
    rows = state.filter("sums is not null").select(F.explode("sums").alias("s")).select("s.*")
    totals = (
        rows.select("part", "entry", "count", F.posexplode("sums").alias("at", "x"))
        .groupBy("part", "entry", "at")
        .agg(F.sum("count").alias("count"), F.sum(F.col("x").cast("decimal(38,0)")).alias("total"))
    )
    out = codebooks.copy()
    for r in totals.collect():  # one row a component of a codebook
        out[r["part"], r["entry"], r["at"]] = int(Decimal(r["total"])) // r["count"]
    return out, state.agg(F.max("most").alias("m")).first()["m"] or 0


def first_codebooks(vectors: DataFrame, parts: int, entries: int, scale: int) -> np.ndarray | None:
    """The parts of the first vectors, as (part, entry, component); None if there are none."""
    order = [F.col("vec_id").asc_nulls_last(), "embedding"]
    one = vectors.orderBy(*order).limit(1).collect()
    if not one:
        return None
    n = len(one[0]["embedding"])
    if not n or n % parts:
        return None
    rows = vectors.filter(F.size("embedding") == n).orderBy(*order).limit(entries).collect()
    whole = np.floor(np.array([r["embedding"] for r in rows], dtype=np.float64) * scale).astype(np.int64)
    return whole.reshape(len(rows), parts, n // parts).transpose(1, 0, 2).copy()


def digest(codebooks: np.ndarray | None) -> str:
    numbers = [] if codebooks is None else codebooks.ravel()
    return hashlib.sha256(",".join(str(int(x)) for x in numbers).encode()).hexdigest()


def with_label_sums(coded: DataFrame) -> DataFrame:
    """Adds ``label_error``.  Labels of a thousandth of all rows or more, a thousand at most, are
    broadcast; the others are too small to make a join uneven."""
    sums = stored(coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total"), F.count("*").alias("n")), "labels")
    rows = sums.agg(F.sum("n")).first()[0] or 0
    total = F.least(F.col("total"), F.lit((1 << 63) - 1).cast("decimal(38,0)")).cast("long").alias("label_error")
    named = sums.select(F.col("label").alias("_label"), total, F.col("n"))
    same = F.col("label").eqNullSafe(F.col("_label"))
    is_hot = F.col("n") * HOT_SHARE >= F.lit(rows)
    hot = F.broadcast(named.filter(is_hot).drop("n"))
    common = coded.join(hot, same).drop("_label")
    rare = coded.join(hot, same, "left_anti").join(named.filter(~is_hot).drop("n"), same).drop("_label")
    return common.unionByName(rare)


def compress(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
             scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)`` of every usable row."""
    x = F.col(vector)
    small = F.forall(x, lambda c: F.abs(c.cast("double")) * scale <= F.lit(float(LARGEST)))
    kept = rows.filter(usable(x) & small).select(
        F.col(key).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"),
        x.cast("array<double>").alias("embedding"),
    )
    codebooks = first_codebooks(kept, parts, entries, scale)
    if codebooks is None:
        coded = kept.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    else:
        n = parts * codebooks.shape[2]
        fitting = kept.filter(F.size("embedding") == n)
        b, least = -(-entries // 4), -(-entries // 8)
        state = stored(fitting.select("vec_id", "label", "embedding").mapInArrow(_first_pass(codebooks, scale, b), STATE), "bounds")
        for number in range(1, rounds + 1):
            before = codebooks
            codebooks, most = moved(codebooks, state)
            if number > 1:  # the first round computes all distances, so it says nothing of b
                b = min(b, max(least, most))
            last = number == rounds
            read = state.filter("sums is null").select("vec_id", "label", "v", "b", "state")
            result = read.mapInArrow(_next_pass(codebooks, before, b, last), CODED if last else STATE)
            result = stored(result, "codes" if last else "bounds")
            released(state)
            state = result
        coded = state.unionByName(
            kept.filter(F.size("embedding") != n).select(
                "vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")
            )
        )
    summed = with_label_sums(coded)
    return summed.select("vec_id", "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256"))


def decoded(code: Column, codebooks: np.ndarray) -> Column:
    """The approximated components of a code."""
    parts = []
    for p, entries in enumerate(codebooks):
        number = F.conv(F.substring(code, 2 * p + 1, 2), 16, 10).cast("int")
        table = F.array(*[F.array(*[F.lit(int(x)) for x in entry]) for entry in entries])
        parts.append(F.get(table, number))
    return F.concat(*parts)
