"""Conversation repair against an exhaustive search."""

import hashlib
import heapq
import random
import re
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagetables.llm import repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?")


def cheapest(rows):
    """(cost, audit) by best-first search over whole edit strings; rows are (initial, fault)."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, at, roles = heapq.heappop(heap)
        if at == len(rows) and GRAMMAR.fullmatch(roles):
            return cost, audit
        if (at, roles, audit) in done:
            continue
        done.add((at, roles, audit))
        if not re.fullmatch(r"s?(ua)*u?", roles):
            continue
        for letter in "ua":
            if audit[-4:] != "IIII":
                heapq.heappush(heap, (cost + 3, audit + "I", at, roles + letter))
        if at < len(rows):
            initial, fault = rows[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, roles))
            if fault not in (1, 2):
                more = cost + (3 if fault == 3 else 0)
                heapq.heappush(heap, (more, audit + "K", at + 1, roles + (initial or "-")))
                for letter in "ua":
                    heapq.heappush(heap, (more + 3, audit + "R", at + 1, roles + letter))


def test_edits_against_an_exhaustive_search():
    rng = random.Random(7)
    for _ in range(400):
        rows = [(rng.choice("suuaat"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randrange(0, 7))]
        assert repair.repaired([(i, f, 1) for i, f in rows]) == cheapest(rows), rows


def test_stretches_fold_to_the_whole(spark):
    """Any cut into stretches gives the same cost and audit as one."""
    rng, stacks = random.Random(8), repair.Stacks()
    assert len(stacks.all) == 8
    for _ in range(200):
        marks = [(rng.choice("suuaat"), rng.choice([0, 0, 0, 1, 2, 3]), rng.choice([1, 1, 2])) for _ in range(rng.randrange(1, 30))]
        rows, at = [], 0
        while at < len(marks):
            size = rng.randrange(1, 6)
            held = [{"initial": i, "fault": f, "n": n, "turn": at, "place": at, "uid": "x"} for i, f, n in marks[at : at + size]]
            rows.append(repair._record(stacks, 1, held, False))
            at += size
        keep = ("conv_id", "stretch", "first_initial", "last_initial", "least_turn", "most_turn", "ways")
        folded = repair.fold((1,), pa.Table.from_pylist([{k: r[k] for k in keep} for r in rows])).to_pylist()
        chosen = {r["stretch"]: r for r in folded}
        audit, cost = "", 0
        for r in rows:
            c = chosen[r["stretch"]]
            way = next(w for w in r["ways"] if (w["entry"], w["exit"]) == (c["entry"], c["exit"]))
            audit, cost = audit + way["audit"] + c["tail"], cost + way["cost"] + 3 * len(c["tail"])
        assert (cost, audit) == repair.repaired(marks, stacks), marks


def plain(rows):
    """What ``repair`` returns of a small table, row by row."""
    found = {}
    conversations = defaultdict(list)
    for conv, turn, role, text in rows:
        conversations[conv].append((turn, " " if role is None else role, " " if text is None else text))
    for conv, turns in conversations.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
        seen, marks = set(), []
        for _, role, text in turns:
            solid = re.sub(r"[\x20\x09-\x0D]+", "", text)
            fault = 1 if not solid else 2 if (role, text) in seen else 3 if solid[-1] not in ".!?" else 0
            seen.add((role, text))
            marks.append((role[:1], fault))
        numbers = [t for t, _, _ in turns if t is not None]
        cost, audit = cheapest(marks)
        lines, at, sequence = [], 0, []
        for edit in audit:
            if edit == "D":
                at += 1
                continue
            shift = bool(sequence) and sequence[0] == "s"
            role = "assistant" if (len(sequence) - shift) % 2 else "user"
            text = ""
            if edit != "I":
                text = turns[at][2]
                role = turns[at][1] if edit == "K" else role
                at += 1
            sequence.append(role[:1])
            lines.append(f"{role}:{text}")
        found[conv] = (
            max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            *[sum(f == k for _, f in marks) for k in (1, 2, 3)],
            sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marks, marks[1:])),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return found


def tables():
    rng = random.Random(9)
    rows = []
    for conv in [*range(40), None]:
        for turn in range(rng.randrange(1, 7)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = rng.choice(["Ja.", "Yes!", "so", "é?\n", "", " \t", None, "no.", f"{conv} {turn}."])
            rows.append((conv, rng.choice([turn, turn, turn + 2, None]), role, text))
    return rows + rows[:15]


@pytest.mark.parametrize("stretch", [2, 4096])
def test_a_table_against_plain_reading(spark, stretch):
    rows = tables()
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("audit", F.lit("own")).withColumn("uid", F.lit("own"))
    got = {r["conv_id"]: tuple(r)[1:] for r in repair.repair(frame, stretch).collect()}
    want = plain(rows)
    assert got == want


def test_damage(spark):
    import zlib

    rows = [(c, t, r, x) for c, t, r, x in tables()] + [(None, None, "user", "a.b!c?")]
    frame = spark.createDataFrame(rows, SCHEMA)
    want = []
    for c, t, r, x in rows:
        part = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if part == 1 else re.sub("[.!?]", "", x) if part == 2 else x
        want += [(c, t, "user" if part == 4 else r, x)] * {0: 0, 3: 2}.get(part, 1)
    assert sorted(map(str, (tuple(r) for r in repair.damaged(frame).collect()))) == sorted(map(str, want))
    every = repair.repair_all(repair.damaged(frame), frame).collect()
    assert {r["conv_id"] for r in every} == {r[0] for r in rows}


def test_a_hot_conversation_and_hot_rows(spark):
    """One conversation of most rows, with one text of most of those: the same as in one piece."""
    spoken = spark.range(6000).select(
        F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.when(F.col("id") % 3 == 0, F.lit("the same.")).otherwise(F.concat(F.lit("t"), "id", F.lit("."))).alias("text"),
    )
    copies = spark.range(3000).select(F.lit(1).cast("long"), F.lit(6000).cast("long"), F.lit("user"), F.lit("again."))
    frame = spoken.union(copies)
    rows = sorted((tuple(r) for r in frame.distinct().collect()), key=lambda r: r[1])
    seen, marks = set(), []
    for _, turn, role, text in rows:
        marks.append((role[0], 2 if (role, text) in seen else 0, 3000 if turn == 6000 else 1))
        seen.add((role, text))
    r = repair.repair(frame, stretch=500).collect()[0]
    assert (r["cost"], r["audit"]) == repair.repaired(marks)
    assert r["duplicate"] == sum(f == 2 for _, f, _ in marks) + 2999
    assert len(r["audit"].replace("I", "")) == 9000


def test_empty_and_emptied(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.repair(none).count() == 0 and repair.repair_all(none, none).count() == 0
    left = repair.repair_all(none, spark.createDataFrame([(5, 0, "user", "x.")], SCHEMA)).collect()
    assert [tuple(r) for r in left] == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    blank = spark.createDataFrame([(1, 0, "user", "  ")], SCHEMA)
    assert tuple(repair.repair(blank).collect()[0]) == (1, 0, 1, 0, 0, 0, 4, "D", hashlib.sha256(b"").hexdigest())


def test_very_long_texts(spark):
    long = "wort " * 400_000 + "."
    frame = spark.createDataFrame([(1, 0, "user", long), (1, 1, "assistant", "ok.")], SCHEMA)
    r = repair.repair(frame).collect()[0]
    assert r["audit"] == "KK" and r["repaired_sha256"] == hashlib.sha256(f"user:{long}\nassistant:ok.".encode()).hexdigest()
