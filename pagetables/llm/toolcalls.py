"""Tool-call linking: calls and results joined by identifier, ordered, validated, serialised.

DataFrame functions only.  A call is ``(conv_id, call_id, parent_id, turn, name, arguments)``,
a result ``(conv_id, call_id, turn, content)``.  Copies of an identifier are reduced to the
first by partial aggregates before the hash join, so a link is made once however often an
identifier repeats.  A call follows its parent: its depth is found by pointer doubling (each
round a join of the calls with themselves by identifier, twice as far up as the last one), so
a chain of n calls takes about log2 n rounds.  ``depth, turn, call_id`` is then a topological
order of a conversation.  Arguments are parsed as JSON and checked against the tool's fields;
canonical JSON has its members sorted, no white space and one spelling of each number.

A field's name is its path: ``where/city`` is a member of the member ``where``, ``tags/*`` every
item of the array ``tags``, ``legs/*/km`` a member of every item, up to 16 parts; ``~0``, ``~1`` and
``~2`` stand for ``~``, ``/`` and ``*`` in a member's name.  A field that is required must be in every
object that may hold it.  Objects and arrays with no fields below them may hold anything.

Statuses, the first that fits: ``no_result``, ``no_call`` (a result of an unknown call),
``cycle`` (its parents never end; depth NULL), ``bad_json``, ``unknown_tool``, ``invalid``,
``ok``.  ``errors`` lists every breach as ``place: what``, sorted; items have their number in it.

Defined cases: calls without a conversation or an identifier can't be linked and keep their
row as ``no_result``, as such results keep theirs as ``no_call``; of calls with the same
identifier the first by turn counts, of one turn the least by parent, name and arguments, of results
by content; the number of copies is kept; an unknown parent is none; NULL arguments are ``bad_json``,
as are those that the variant type finds too long (16 MB); empty tables give no rows; columns beyond
the named ones are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.llm.common import stored
from pagetables.llm.jsonform import MOST_DEPTH, breaches, guarded, marked, plain

FIELDS = "name string, type string, required boolean, least double, most double, most_length int, choices array<string>"
MOST_ROUNDS = 40


def schema_table(spark: SparkSession, tools: dict[str, list[dict]]) -> DataFrame:
    """One row a tool: ``(tool, fields)``.  A field is a dict with the members of ``FIELDS``."""
    for field in (f for fields in tools.values() for f in fields):
        if field["name"].count("/") >= MOST_DEPTH:
            raise ValueError(f"a field of more than {MOST_DEPTH} parts: {field['name']}")
    names = [f.split(" ")[0] for f in FIELDS.split(", ")]
    rows = [(tool, [tuple(field.get(n) for n in names) for field in fields]) for tool, fields in tools.items()]
    return spark.createDataFrame(rows, f"tool string, fields array<struct<{FIELDS}>>")


def _firsts(rows: DataFrame, *columns: str) -> DataFrame:
    """The first row of each identifier by turn, with the number of copies."""
    best = F.min(F.struct("turn", *columns)).alias("best")
    named = rows.filter(F.col("conv_id").isNotNull() & F.col("call_id").isNotNull())
    return named.groupBy("conv_id", "call_id").agg(best, F.count("*").alias("copies")).select(
        "conv_id", "call_id", "best.*", "copies"
    )


def depths(calls: DataFrame) -> DataFrame:
    """``(conv_id, call_id, depth)``: the number of calls above one; NULL on or below a cycle."""
    known = calls.select("conv_id", F.col("call_id").alias("up"))
    here = calls.select("conv_id", "call_id", F.col("parent_id").alias("up"))
    # An unknown parent is none: it is dropped by the semi-join.
    linked = here.join(known, ["conv_id", "up"], "left_semi").select("conv_id", "call_id", "up")
    steps = stored(
        here.select("conv_id", "call_id").join(linked, ["conv_id", "call_id"], "left")
        .withColumn("depth", F.when(F.col("up").isNull(), 0).otherwise(1).cast("long")),
        "depths",
    )
    n = steps.count()
    for k in range(MOST_ROUNDS):
        if steps.filter("up is not null").isEmpty():
            return steps.select("conv_id", "call_id", "depth")
        if 1 << k > n:
            break
        above = steps.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("depth2"))
        open_ = steps.filter("up is not null").join(above, ["conv_id", "up"]).select(
            "conv_id", "call_id", F.col("up2").alias("up"), (F.col("depth") + F.col("depth2")).alias("depth")
        )
        steps = stored(steps.filter("up is null").select("conv_id", "call_id", "up", "depth").unionByName(open_), "depths")
    return steps.select("conv_id", "call_id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def link(calls: DataFrame, results: DataFrame, tools: DataFrame) -> DataFrame:
    """One row a call or unmatched result, with its place, its arguments' validity and JSON."""
    first_calls = stored(_firsts(calls, "parent_id", "name", "arguments"), "calls")
    answers = _firsts(results, "content").select(
        "conv_id", "call_id", F.col("turn").alias("result_turn"), "content", F.col("copies").alias("result_copies")
    )
    linked = (
        first_calls.join(depths(first_calls), ["conv_id", "call_id"])
        .withColumn("called", F.lit(True))
        .join(answers.hint("shuffle_hash"), ["conv_id", "call_id"], "full")
    )
    lost = calls.filter(F.col("conv_id").isNull() | F.col("call_id").isNull()).select(
        "conv_id", "call_id", "turn", "parent_id", "name", "arguments", F.lit(1).cast("long").alias("copies"),
        F.lit(0).cast("long").alias("depth"), F.lit(True).alias("called"),
    )
    rows = linked.unionByName(lost, allowMissingColumns=True)
    checked = (
        rows.join(tools, F.col("name") == F.col("tool"), "left")
        .withColumn("marked", marked(F.col("arguments")))
        .withColumn("arguments", plain(F.col("marked")))
        .withColumn("errors", F.when(F.col("marked").startswith("{") & F.col("fields").isNotNull(), breaches(F.col("marked"), F.col("fields"))))
    )
    status = (
        F.when(F.col("called").isNull(), "no_call")
        .when(F.col("result_turn").isNull() & F.col("result_copies").isNull(), "no_result")
        .when(F.col("depth").isNull(), "cycle")
        .when(~F.coalesce(F.col("marked").startswith("{"), F.lit(False)), "bad_json")
        .when(F.col("tool").isNull(), "unknown_tool")
        .when(F.size("errors") > 0, "invalid")
        .otherwise("ok")
    )
    call = F.when(F.col("called"), plain(F.to_json(F.struct(
        F.try_parse_json("marked").alias("arguments"), guarded(F.col("call_id")).alias("id"), guarded(F.col("name")).alias("name"),
        guarded(F.col("content")).alias("result"),
    ))))
    found = checked.select(
        "conv_id", "call_id", "depth", "turn", "result_turn", "copies", "result_copies", "name", status.alias("status"),
        F.array_join("errors", "; ").alias("errors"), "arguments", "content", call.alias("call_json"),
    )
    stray = results.filter(F.col("conv_id").isNull() | F.col("call_id").isNull()).select(
        "conv_id", "call_id", F.col("turn").alias("result_turn"), "content", F.lit(1).cast("long").alias("result_copies"),
        F.lit("no_call").alias("status"),
    )
    return stray.unionByName(found, allowMissingColumns=True).select(*found.columns)
