"""Votes kept by parts equal votes of the whole."""

import random

import pytest
from pyspark.sql import functions as F

from pagetables.operators.infer import profile, profile_votes
from pagetables.operators.votes import add_parts, merge, remove_parts, stored_profile

VALUES = ["1", "-7", "2.5", "", None, "true", "2024-01-31", "2024-01-31 10:11:12", "31/01/2024", '{"a": 1}', "[1]", "Ab 12", "x-y", "99999999999999999999"]
SCHEMA = "file string, group string, a string, b string, c string"


def rows(seed, n=400):
    rng = random.Random(seed)
    kinds = {f: rng.sample(VALUES, 4) for f in "abc"}
    return [
        (rng.choice(["f1", "f2", "f3", None]), rng.choice("xy"), *[rng.choice(kinds[f]) for f in "abc"]) for _ in range(n)
    ]


def said(frame):
    return sorted(map(str, frame.select("group", "pos", "name", "type", "nullable", "confidence", "format", "minimum", "maximum", "least", "most", "pattern").collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_merged_halves_equal_the_whole(spark, seed):
    frame = spark.createDataFrame(rows(seed), SCHEMA).drop("file")
    half = F.pmod(F.xxhash64("a", "b", "c"), F.lit(2))
    halves = [profile_votes(frame.filter(half == i), ["group"]) for i in (0, 1)]
    got = merge(halves[0].unionByName(halves[1]), ["group"])
    want = profile_votes(frame, ["group"])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_parts_come_change_and_leave(spark, tmp_path):
    store, frame = str(tmp_path / "votes"), spark.createDataFrame(rows(3), SCHEMA)
    first, second = frame.filter("file = 'f1'"), frame.filter("file is null or file = 'f2'")
    add_parts(first, store, "file", ["group"])
    assert said(stored_profile(spark, store, ["group"])) == said(profile(first.drop("file"), ["group"]))
    add_parts(first.union(second), store, "file", ["group"])  # f1 is known: it isn't counted twice
    assert said(stored_profile(spark, store, ["group"])) == said(profile(first.union(second).drop("file"), ["group"]))
    changed = second.filter("file = 'f2'").withColumn("a", F.lit("odd"))
    add_parts(changed, store, "file", ["group"], again=True)
    now = first.union(second.filter("file is null")).union(changed)
    assert said(stored_profile(spark, store, ["group"])) == said(profile(now.drop("file"), ["group"]))
    gone = spark.createDataFrame([("f2",), ("unknown",), (None,)], "part string")
    remove_parts(gone, store)
    assert said(stored_profile(spark, store, ["group"])) == said(profile(first.drop("file"), ["group"]))
    add_parts(changed, store, "file", ["group"])
    assert said(stored_profile(spark, store, ["group"])) == said(profile(first.union(changed).drop("file"), ["group"]))


def test_known_parts_are_not_read_and_empty_stores_are_empty(spark, tmp_path):
    store, frame = str(tmp_path / "votes"), spark.createDataFrame(rows(4), SCHEMA)
    add_parts(frame.limit(0), store, "file", ["group"])
    assert stored_profile(spark, store, ["group"]).count() == 0
    add_parts(frame, store, "file", ["group"])
    fails = F.when(F.col("file").isNotNull() | F.col("file").isNull(), F.raise_error(F.lit("read again")))
    add_parts(frame.withColumn("a", F.coalesce(fails.cast("string"), "a")), store, "file", ["group"])
    assert stored_profile(spark, store, ["group"]).count() == 6
