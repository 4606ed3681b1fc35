"""Conversation structure repair: generalised LR parsing over the role grammar, with edits.

The initials of a conversation's roles should be in the grammar ``(s?(ua)+)?``.  The grammar's
LR automaton is run on all cheapest repairs at once.  Stacks share what lies under their tops
(a graph of nodes, each a state over the node below it), and tops with equal stacks merge into
the one of least (cost, audit).  At a row, every stack may keep it (shift its initial), rerole
it (shift ``u`` or ``a``), or delete it (stay); before a row and at the end it may insert (shift
``u`` or ``a`` without a row).  The rules recurse to the left, so there is a small fixed number
of stacks, whatever the length of a conversation.

Audits are compared without being spelled out: after a row, no audit of a live stack can begin
another one, so their order is kept as ranks, and each stack remembers only what it did last and
where it came from.

A conversation is split where it is long.  Rows without their texts are sorted by conversation
and turn over all tasks; a task reads its rows as stretches of at most ``STRETCH`` rows.  A
conversation that lies within one stretch is repaired there.  Of any other, each stretch gives
the cheapest way from every stack it could begin with to every stack it can end with; folding
those (a few numbers a stretch) picks the ways of the conversation.  Equal rows of a turn are one
row with a count before they are sorted, and the first of equal texts is found by partial minima,
so neither a conversation nor a text that a third of all rows share is gathered anywhere.  What
a conversation's result is by definition, one audit and one hash of all its texts in order, is
made by one task, from rows that stream through it.

Faults of a row, the first that fits: blank (nothing but white space), duplicate (role and text
seen earlier in the conversation), truncated (the last character that isn't white space is none
of ``.!?``).

Defined cases: NULL role or text counts as one space; rows are taken by turn, NULLs first, then
by role and by the SHA-256 of the text; rows without a conversation form the conversation NULL;
roles that begin with no letter of the grammar can't be kept; an empty table gives no rows; a
text of any length crosses the network for its hash only; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetables.llm.common import stored

# The role grammar, its legal neighbours, and the costs of edits.
RULES = (("C", ""), ("C", "P"), ("C", "sP"), ("P", "ua"), ("P", "Pua"))
LEGAL = ("su", "ua", "au")
ROLES = {"u": "user", "a": "assistant"}
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
BLANK, REPEATED, CUT = 1, 2, 3  # faults
STRETCH = 4096
WAYS = "ways array<struct<entry:int,exit:int,cost:bigint,rank:int,audit:string>>"
STRETCHES = (
    "conv_id bigint, stretch bigint, whole boolean, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "first_initial string, last_initial string, least_turn bigint, most_turn bigint, turns bigint, "
    f"held array<struct<uid:string,initial:string,n:bigint>>, {WAYS}"
)
CHOSEN = "conv_id bigint, stretch bigint, entry int, exit int, tail string, illegal_before bigint, turns_before bigint"
OUTPUT = "conv_id bigint, stretch bigint, seq bigint, uid string, role string"


class Node:
    """The top of a stack: a state over the node below."""

    __slots__ = ("state", "below", "number", "after", "accepts")

    def __init__(self, state: int, below: Node | None):
        self.state, self.below, self.number = state, below, -1
        self.after: dict[str, tuple[Node, ...]] = {}
        self.accepts = False


class Stacks:
    """The LR automaton of a grammar and the graph of its stacks."""

    def __init__(self, rules: tuple[tuple[str, str], ...] = RULES, most: int = 1000):
        self.rules, self.start = rules, rules[0][0]
        self.names = {lhs for lhs, _ in rules}
        self.states: list[frozenset] = [self._closed({(r, 0) for r, (lhs, _) in enumerate(rules) if lhs == self.start})]
        self.goto: dict[tuple[int, str], int] = {}
        for number, state in enumerate(self.states):  # grows while it is read
            for symbol in sorted({rules[r][1][dot] for r, dot in state if dot < len(rules[r][1])}):
                moved = self._closed({(r, d + 1) for r, d in state if rules[r][1][d : d + 1] == symbol})
                if moved not in self.states:
                    self.states.append(moved)
                self.goto[number, symbol] = self.states.index(moved)
        self._nodes: dict[tuple[int, int], Node] = {}
        self.bottom = self._node(0, None)
        self.all = [self.bottom]
        letters = sorted({c for _, rhs in rules for c in rhs if c not in self.names})
        for node in self.all:
            node.number = self.all.index(node)
            node.accepts = self._accepts(node)
            for letter in letters:
                node.after[letter] = tuple(self._pushed(node, letter))
                self.all += [n for n in node.after[letter] if n not in self.all]
            if len(self.all) > most:
                raise ValueError("the grammar has no bound on its stacks: let its rules recurse to the left")

    def _closed(self, items: set) -> frozenset:
        items, todo = set(items), list(items)
        while todo:
            r, dot = todo.pop()
            for other, (lhs, _) in enumerate(self.rules):
                if self.rules[r][1][dot : dot + 1] == lhs and (other, 0) not in items:
                    items.add((other, 0))
                    todo.append((other, 0))
        return frozenset(items)

    def _node(self, state: int, below: Node | None) -> Node:
        return self._nodes.setdefault((state, id(below)), Node(state, below))

    def _pushed(self, node: Node, symbol: str) -> Iterator[Node]:
        """The stacks after a symbol: as shifted, and as reduced."""
        state = self.goto.get((node.state, symbol))
        if state is None:
            return
        top = self._node(state, node)
        done = [r for r, dot in self.states[state] if dot == len(self.rules[r][1])]
        reduced = [r for r in done if self.rules[r][0] != self.start]
        if len(reduced) < len(self.states[state]):
            yield top
        for r in reduced:
            lhs, rhs = self.rules[r]
            under = top
            for _ in rhs:
                under = under.below
            yield from self._pushed(under, lhs)

    def _accepts(self, node: Node) -> bool:
        for r, dot in self.states[node.state]:
            lhs, rhs = self.rules[r]
            if lhs == self.start and dot == len(rhs):
                under = node
                for _ in rhs:
                    under = under.below
                if under is self.bottom:
                    return True
        return False


class Live:
    """A live stack: its cost, the rank of its audit up to the last row, the insertions since
    then, and the audit as a chain of what was done."""

    __slots__ = ("cost", "rank", "pending", "trail")

    def __init__(self, cost: int, rank: int, pending: int, trail: tuple | None):
        self.cost, self.rank, self.pending, self.trail = cost, rank, pending, trail

    def key(self) -> tuple[int, int, int]:
        return self.cost, self.rank, self.pending


def with_insertions(tops: dict[Node, Live]) -> dict[Node, Live]:
    """All stacks that insertions lead to, each by the least (cost, audit)."""
    out, todo = dict(tops), list(tops)
    while todo:
        node = todo.pop()
        live = out[node]
        for letter in ROLES:
            for after in node.after[letter]:
                more = Live(live.cost + INSERT, live.rank, live.pending + 1, live.trail)
                if after not in out or more.key() < out[after].key():
                    out[after] = more
                    todo.append(after)
    return out


def step(tops: dict[Node, Live], initial: str, fault: int, copies: int) -> dict[Node, Live]:
    """The stacks after a row and its copies, which are to be deleted."""
    found: dict[Node, tuple[int, int, str, Live]] = {}
    extra = "D" * (copies - 1)
    price = DELETE * (copies - 1)

    def offer(node: Node, cost: int, live: Live, edit: str) -> None:
        way = (cost + price, live.rank, "I" * live.pending + edit + extra, live)
        if node not in found or way[:3] < found[node][:3]:
            found[node] = way

    for node, live in with_insertions(tops).items():
        offer(node, live.cost + DELETE, live, "D")
        if fault not in (BLANK, REPEATED):
            cost = live.cost + (TRUNCATED if fault == CUT else 0)
            for after in node.after.get(initial, ()):
                offer(after, cost, live, "K")
            for letter in ROLES:
                for after in node.after[letter]:
                    offer(after, cost + REROLE, live, "R")
    ranks = {pair: i for i, pair in enumerate(sorted({(rank, edits) for _, rank, edits, _ in found.values()}))}
    return {
        node: Live(cost, ranks[rank, edits], 0, (live.trail, edits)) for node, (cost, rank, edits, live) in found.items()
    }


def finished(tops: dict[Node, Live]) -> tuple[Node, Live]:
    """The best stack that is a whole conversation, and what it began this end with."""
    ended = [(live.key(), node.number, node) for node, live in with_insertions(tops).items() if node.accepts]
    _, _, node = min(ended)
    return node, with_insertions(tops)[node]


def spelled(trail: tuple | None) -> str:
    parts = []
    while trail is not None:
        trail, edits = trail
        parts.append(edits)
    return "".join(reversed(parts))


def ways_through(stacks: Stacks, entry: Node, rows: Iterable[tuple[str, int, int]]) -> dict[Node, Live]:
    tops = {entry: Live(0, 0, 0, None)}
    for initial, fault, copies in rows:
        tops = step(tops, initial, fault, copies)
    return tops


def repaired(rows: list[tuple[str, int, int]], stacks: Stacks | None = None) -> tuple[int, str]:
    """(cost, audit) of one conversation's rows ``(initial, fault, copies)``."""
    stacks = stacks or Stacks()
    _, live = finished(ways_through(stacks, stacks.bottom, rows))
    return live.cost, spelled(live.trail) + "I" * live.pending


def illegal(before: str | None, after: str | None) -> int:
    return int(before is not None and after is not None and before + after not in LEGAL)


def _record(stacks: Stacks, conv_id, rows: list[dict], whole: bool) -> dict:
    """What a stretch says of itself, see ``STRETCHES``."""
    marks = [(r["initial"], r["fault"], r["n"]) for r in rows]
    turns = [r["turn"] for r in rows if r["turn"] is not None]
    counts = dict.fromkeys((0, BLANK, REPEATED, CUT), 0)
    wrong, last = 0, None
    for initial, fault, n in marks:
        counts[fault] += 1
        counts[BLANK if fault == BLANK else REPEATED] += n - 1
        wrong += illegal(last, initial) + (n - 1) * illegal(initial, initial)
        last = initial
    if whole:
        cost, audit = repaired(marks, stacks)
        ways = [{"entry": 0, "exit": -1, "cost": cost, "rank": 0, "audit": audit}]
    else:
        ways = [
            {"entry": entry.number, "exit": node.number, "cost": live.cost, "audit": spelled(live.trail)}
            for entry in stacks.all
            for node, live in ways_through(stacks, entry, marks).items()
        ]
        ranks = {audit: i for i, audit in enumerate(sorted({w["audit"] for w in ways}))}
        for way in ways:
            way["rank"] = ranks[way["audit"]]
    return {
        "conv_id": conv_id, "stretch": rows[0]["place"], "whole": whole, "blank": counts[BLANK],
        "duplicate": counts[REPEATED], "truncated": counts[CUT], "illegal": wrong, "first_initial": marks[0][0],
        "last_initial": last, "least_turn": turns[0] if turns else None, "most_turn": turns[-1] if turns else None,
        "turns": len(set(turns)), "held": [{k: r[k] for k in ("uid", "initial", "n")} for r in rows], "ways": ways,
    }


def _stretch_schema() -> pa.Schema:
    whole, text = pa.int64(), pa.string()
    way = pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", whole), ("rank", pa.int32()), ("audit", text)])
    numbers = ["blank", "duplicate", "truncated", "illegal"]
    return pa.schema(
        [("conv_id", whole), ("stretch", whole), ("whole", pa.bool_()), *[(n, whole) for n in numbers],
         ("first_initial", text), ("last_initial", text), ("least_turn", whole), ("most_turn", whole), ("turns", whole),
         ("held", pa.list_(pa.struct([("uid", text), ("initial", text), ("n", whole)]))), ("ways", pa.list_(way))]
    )


def read_stretches(size: int):
    """Of a task's sorted rows: only the conversations that it holds between its first and its
    last one are whole for certain."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stacks, schema, held, inner = Stacks(), _stretch_schema(), [], False
        records: list[dict] = []
        letters = 0
        for batch in batches:
            for row in batch.to_pylist():
                if held and (row["conv_id"] != held[0]["conv_id"] or len(held) == size):
                    same = row["conv_id"] == held[0]["conv_id"]
                    records.append(_record(stacks, held[0]["conv_id"], held, inner and not same))
                    letters += 80 * len(held) + sum(len(w["audit"]) for w in records[-1]["ways"])
                    inner, held = not same, []
                held.append(row)
                if letters > 1 << 20:
                    yield pa.RecordBatch.from_pylist(records, schema=schema)
                    records, letters = [], 0
        if held:
            records.append(_record(stacks, held[0]["conv_id"], held, False))
        if records:
            yield pa.RecordBatch.from_pylist(records, schema=schema)

    return run


def fold(key, found):
    """The ways that the stretches of one conversation take; a few numbers a stretch."""
    stacks = Stacks()
    rows = found.sort_by("stretch").to_pylist()
    live = {0: (0, 0)}  # cost and rank of the audit of each stack
    froms: list[dict[int, int]] = []
    for row in rows:
        best: dict[int, tuple[int, int, int, int]] = {}
        for way in row["ways"]:
            if way["entry"] in live:
                cost, rank = live[way["entry"]]
                offer = (cost + way["cost"], rank, way["rank"], way["entry"])
                if way["exit"] not in best or offer < best[way["exit"]]:
                    best[way["exit"]] = offer
        ranks = {pair: i for i, pair in enumerate(sorted({b[1:3] for b in best.values()}))}
        live = {node: (b[0], ranks[b[1:3]]) for node, b in best.items()}
        froms.append({node: b[3] for node, b in best.items()})
    ends = []
    for number, (cost, rank) in live.items():
        node, last = finished({stacks.all[number]: Live(cost, rank, 0, None)})
        ends.append((*last.key(), number))
    _, _, pending, at = min(ends)
    out = []
    for i in range(len(rows) - 1, -1, -1):
        row, before = rows[i], rows[i - 1] if i else None
        entry = froms[i][at]
        seen = before is not None and row["least_turn"] is not None and row["least_turn"] == before["most_turn"]
        out.append({
            "conv_id": row["conv_id"], "stretch": row["stretch"], "entry": entry, "exit": at,
            "tail": "I" * pending if i == len(rows) - 1 else "",
            "illegal_before": illegal(before["last_initial"], row["first_initial"]) if before else 0,
            "turns_before": -int(seen),
        })
        at = entry
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
    names = [c.split(" ")[0] for c in CHOSEN.split(", ")]
    return pa.table([pa.array([r[n] for r in out], t) for n, t in zip(names, kinds)], names=names)


def output_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the repaired conversations, in order; ``role`` is NULL where it is kept."""
    stacks = Stacks()
    kinds = [pa.int64()] * 3 + [pa.string()] * 2
    names = [c.split(" ")[0] for c in OUTPUT.split(", ")]
    for batch in batches:
        for conv_id, stretch, entry, audit, held in zip(*[batch.column(c).to_pylist() for c in range(5)]):
            out, at, row = [], 0, 0
            node = stacks.all[entry]
            while at < len(audit):
                edit, uid = audit[at], None
                letter = next(c for c in ROLES if node.after[c])
                role = None if edit == "K" else ROLES[letter]
                if edit == "I":
                    at += 1
                else:
                    uid, initial = held[row]["uid"], held[row]["initial"]
                    letter = initial if edit == "K" else letter
                    at, row = at + held[row]["n"], row + 1
                if edit != "D":
                    node = node.after[letter][0]
                    out.append((conv_id, stretch, len(out), uid, role))
            columns = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def hash_conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the lines of each conversation, which come sorted; they are not kept."""
    names, kinds = ["conv_id", "repaired_sha256"], [pa.int64(), pa.string()]
    done: list[tuple] = []
    own, digest = None, None
    for batch in batches:
        ids, lines = batch.column(0).to_pylist(), batch.column(1)
        for conv_id, line in zip(ids, lines):
            if digest is not None and conv_id == own:
                digest.update(b"\n")
            else:
                if digest is not None:
                    done.append((own, digest.hexdigest()))
                own, digest = conv_id, hashlib.sha256()
            digest.update(line.as_py().encode())
        if len(done) > 4096:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), kinds)], names=names)
            done = []
    if digest is not None:
        done.append((own, digest.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), kinds)], names=names)


def uid_of(conv_id: Column, turn: Column, role: Column, digest: Column) -> Column:
    """One text for each row that differs: numbers have no colon, digests one length."""
    none = F.lit("-")
    return F.sha2(
        F.concat(F.coalesce(conv_id.cast("string"), none), F.lit(":"), F.coalesce(turn.cast("string"), none), F.lit(":"), digest, role), 256
    )


def marked(rows: DataFrame) -> DataFrame:
    """``(conv_id, turn, place, initial, fault, n, uid)`` of the rows that differ, in order of
    ``place``; no texts."""
    text = F.col("text")
    light = rows.select(
        "conv_id", "turn", "role", F.sha2(text, 256).alias("digest"),
        F.when(~F.rlike(text, F.lit(r"[^\x20\x09-\x0D]")), BLANK)
        .when(~F.rlike(text, F.lit(r"[.!?][\x20\x09-\x0D]*\z")), CUT).otherwise(0).alias("own_fault"),
    )
    order = ["conv_id", "turn", "role", "digest"]
    counted = light.groupBy(*order, "own_fault").agg(F.count("*").alias("n"))
    placed = stored(
        counted.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()), "turns"
    )
    firsts = placed.groupBy("conv_id", "role", "digest").agg(F.min("place").alias("first_place"))
    return placed.join(firsts.select("first_place"), F.col("place") == F.col("first_place"), "left").select(
        "conv_id", "turn", "place", F.substring("role", 1, 1).alias("initial"),
        F.when((F.col("own_fault") != BLANK) & F.col("first_place").isNull(), REPEATED).otherwise(F.col("own_fault")).alias("fault"),
        "n", uid_of(F.col("conv_id"), F.col("turn"), F.col("role"), F.col("digest")).alias("uid"),
    )


def pieces(rows: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """Every stretch with the way it takes: ``entry``, ``audit`` and ``cost``."""
    sorted_rows = marked(rows).repartitionByRange("place").sortWithinPartitions("place")
    stretches = stored(sorted_rows.mapInArrow(read_stretches(stretch), STRETCHES), "stretches")
    numbers = ["blank", "duplicate", "truncated", "least_turn", "most_turn"]
    way = F.col("ways")[0]
    whole = stretches.filter("whole").select(
        "conv_id", "stretch", "held", *numbers, "illegal", "turns", F.lit(0).alias("entry"), way["cost"].alias("cost"),
        way["audit"].alias("audit"),
    )
    parts = stretches.filter("not whole")
    bare = F.transform("ways", lambda w: F.struct(w["entry"].alias("entry"), w["exit"].alias("exit"), w["cost"].alias("cost"), w["rank"].alias("rank")))
    chosen = parts.select(
        "conv_id", "stretch", "first_initial", "last_initial", "least_turn", "most_turn", bare.alias("ways")
    ).groupBy("conv_id").applyInArrow(fold, CHOSEN)
    mine = F.filter("ways", lambda w: (w["entry"] == F.col("_entry")) & (w["exit"] == F.col("_exit")))[0]
    renamed = chosen.select(
        F.col("stretch").alias("_stretch"), F.col("entry").alias("_entry"), F.col("exit").alias("_exit"), "tail",
        "illegal_before", "turns_before",
    )
    open_ones = parts.join(renamed, F.col("stretch") == F.col("_stretch")).select(
        "conv_id", "stretch", "held", *numbers, (F.col("illegal") + F.col("illegal_before")).alias("illegal"),
        (F.col("turns") + F.col("turns_before")).alias("turns"), F.col("_entry").alias("entry"),
        (mine["cost"] + INSERT * F.length("tail")).alias("cost"), F.concat(mine["audit"], "tail").alias("audit"),
    )
    return stored(whole.unionByName(open_ones), "pieces")


def cleaned(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    return rows.select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )


def output(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired conversations ``(conv_id, stretch, seq, role, text)``, of cleaned rows and
    their ``pieces``; in order of stretch and seq."""
    made = found.select("conv_id", "stretch", "entry", "audit", "held").mapInArrow(output_rows, OUTPUT)
    digest = F.sha2("text", 256)
    texts = rows.select(
        uid_of(F.col("conv_id"), F.col("turn"), F.col("role"), digest).alias("_uid"), F.col("role").alias("_role"), "text"
    ).withColumn("_copy", F.row_number().over(Window.partitionBy("_uid").orderBy("_role"))).filter("_copy = 1")
    return made.filter("uid is not null").join(texts, F.col("uid") == F.col("_uid")).select(
        "conv_id", "stretch", "seq", F.coalesce("role", "_role").alias("role"), "text"
    ).unionByName(made.filter("uid is null").select("conv_id", "stretch", "seq", "role", F.lit("").alias("text")))


def repair(rows: DataFrame, stretch: int = STRETCH, **columns) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)`` of
    every conversation that has rows."""
    rows = cleaned(rows, **columns)
    found = pieces(rows, stretch)
    spelled_out = F.transform(F.array_sort(F.collect_list(F.struct("stretch", "audit"))), lambda p: p["audit"])
    gaps = F.max("most_turn") - F.min("least_turn") + 1 - F.sum("turns")
    totals = found.groupBy("conv_id").agg(
        F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"),
        *[F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.array_join(spelled_out, "").alias("audit"),
    )
    lines = output(rows, found).select("conv_id", "stretch", "seq", F.concat("role", F.lit(":"), "text").alias("line"))
    by = ["conv_id", "stretch", "seq"]
    hashes = (
        lines.repartition("conv_id").sortWithinPartitions(*by).select("conv_id", "line")
        .mapInArrow(hash_conversations, "_conv bigint, repaired_sha256 string")
    )
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return totals.join(hashes, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv").withColumn(
        "repaired_sha256", F.coalesce("repaired_sha256", nothing)
    )


def repair_all(rows: DataFrame, every: DataFrame, stretch: int = STRETCH, **columns) -> DataFrame:
    """``repair`` with a row for each ``conv_id`` of ``every``, also where no rows are left."""
    done = repair(rows, stretch, **columns).withColumnRenamed("conv_id", "_conv")
    ids = every.select(F.col("conv_id").cast("long")).distinct()
    joined = ids.join(done, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    zero = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return joined.withColumns({
        **zero, "audit": F.coalesce("audit", F.lit("")),
        "repaired_sha256": F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())),
    })


def damaged(rows: DataFrame) -> DataFrame:
    """Faults made on purpose, by the CRC-32 of ``conv_id:turn`` modulo 20: rows dropped,
    emptied, without their stops, repeated, or said by the user."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    part = F.crc32(name) % 20
    text = F.coalesce("text", space)
    changed = rows.select(
        "conv_id", "turn", F.when(part == 4, F.lit("user")).otherwise(F.coalesce("role", space)).alias("role"),
        F.when(part == 1, F.lit("")).when(part == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(part == 0, 0).when(part == 3, 2).otherwise(1).alias("copies"),
    ).filter("copies > 0")
    return changed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies", "copy")
