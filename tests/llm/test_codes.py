"""Vector codes against plain integer k-means."""

import math

import numpy as np

from pagetables.llm import codes

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Codes, errors and codebooks by computing all distances with Python's integers."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [[math.floor(float(np.float32(x)) * scale) for x in r[1]] for r in kept]
    d = len(whole[0]) // parts
    cut = [[tuple(v[p * d : (p + 1) * d]) for p in range(parts)] for v in whole]
    books = [[cut[i][p] for i in range(min(entries, len(cut)))] for p in range(parts)]

    def assign():
        return [
            [min((sum((x - y) ** 2 for x, y in zip(v[p], e)), i) for i, e in enumerate(books[p])) for p in range(parts)]
            for v in cut
        ]

    for _ in range(rounds):
        held = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [v[p] for v, h in zip(cut, held) if h[p][1] == e]
                if mine:
                    books[p][e] = tuple(sum(c) // len(mine) for c in zip(*mine))
    held = assign()
    return sorted(
        (str(r[0]), "".join(f"{i:02x}" for _, i in h), sum(s for s, _ in h)) for r, h in zip(kept, held)
    ), books


def got(spark, rows, **options):
    frame = codes.compress(spark.createDataFrame(rows, SCHEMA), **options)
    return sorted((str(r["vec_id"]), r["code"], r["error"]) for r in frame.collect()), frame


def clustered(n, dimension, seed, spread=0.2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dimension))
    points = centres[rng.integers(0, 12, n)] + rng.normal(size=(n, dimension)) * spread
    return [(i, [float(np.float32(x)) for x in p], int(i) % 3) for i, p in enumerate(points)]


def test_codes_equal_plain_rounds(spark):
    rows = clustered(400, 16, 1)
    want, books = plain(rows)
    rows_got, frame = got(spark, rows)
    assert rows_got == want
    numbers = np.array([[e for e in book] for book in books])
    assert frame.first()["codebooks_sha256"] == codes.digest(numbers)


def test_label_errors(spark):
    rows = clustered(60, 8, 3)
    rows = [(i, v, None if i % 4 == 0 else i % 3) for i, v, _ in rows]
    frame = codes.compress(spark.createDataFrame(rows, SCHEMA)).collect()
    label = {i: name for i, _, name in rows}
    for r in frame:
        assert r["label_error"] == sum(x["error"] for x in frame if label[x["vec_id"]] == label[r["vec_id"]])


def test_ties_copies_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    even = [(i, [float(i % 3)] * 8, 1) for i in range(50)]  # copies: equal entries, lower index wins
    bad = [(90, None, 1), (91, [nan] * 8, 1), (92, [inf] * 8, 1), (93, [0.0] * 7 + [None], 1)]
    rows = even + bad + [(None, [1.0] * 8, None), (7, [1.0] * 8, 2), (7, [1.0] * 8, 2)]
    want, _ = plain(rows)
    assert got(spark, rows)[0] == want


def test_other_dimensions_keep_their_rows(spark):
    rows = clustered(20, 8, 5) + [(100, [1.0] * 16, 1), (101, [1.0] * 3, 1), (102, [], 1), (103, [1e30] * 8, 1)]
    result = {r[0]: r for r in got(spark, rows)[0]}
    assert len(result) == 23 and all(result[k][1:] == (None, None) for k in ("100", "101", "102"))
    none = got(spark, [(1, [1.0] * 3, 1)])[0]
    assert none == [("1", None, None)]
    assert got(spark, [])[0] == []


def test_large_and_few_vectors(spark):
    rows = [(i, [float(np.float32(x)) for x in np.random.default_rng(i).normal(size=8) * 1e7], 1) for i in range(6)]
    want, _ = plain(rows)
    assert got(spark, rows)[0] == want


def test_bounds_hold_and_spare_distances():
    rng = np.random.default_rng(4)
    points = np.round(rng.normal(size=(3000, 8)) * 4096).astype(np.int64)
    entries = points[:16].copy()
    held, b, spared = codes.Assigner(entries, None, 4).first(points), 4, 0
    for _ in range(6):
        before = entries
        entries = np.array([points[held["own"] == e].sum(axis=0) // max(1, (held["own"] == e).sum()) for e in range(16)])
        held, most, full = codes.Assigner(entries, before, b).assign(points, held)
        far = np.sqrt(codes.squares(points, entries).astype(float))
        own = far[np.arange(len(points)), held["own"]]
        assert (held["own"] == codes.squares(points, entries).argmin(axis=1)).all()
        assert (held["upper"] >= own).all()
        others = far.copy()
        others[np.arange(len(points)), held["own"]] = np.inf
        for j in range(held["near"].shape[1]):  # each bound holds for all entries from its place on
            assert (held["lower"][:, j] <= others.min(axis=1) + 1e-9).all()
            others[np.arange(len(points)), held["near"][:, j]] = np.inf
        assert (held["outer"] <= others.min(axis=1) + 1e-9).all()
        spared += len(points) - full
        b = min(b, max(2, most))
    assert spared > 6 * len(points) * 0.5


def test_extra_columns(spark):
    from pyspark.sql import functions as F

    rows = clustered(30, 8, 6)
    frame = spark.createDataFrame(rows, SCHEMA).select("*", F.lit("own").alias("code"), F.lit("own").alias("state"))
    assert sorted((str(r["vec_id"]), r["code"], r["error"]) for r in codes.compress(frame).collect()) == plain(rows)[0]
