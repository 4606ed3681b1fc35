"""Queries over column inference."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.functions.shared import new_path
from pagetables.operators.extract import aligned_cells, extract_tables, headers_of, tables_of
from pagetables.operators.infer import (
    infer_from_names,
    infer_tables,
    normalise_types,
    profile,
    type_votes,
)
from pagetables.operators.shred import shred
from pagetables.operators.votes import add_parts, remove_parts, stored_profile
from pagetables.plans import render
from pagetables.plans.registry import day, money, query

# The rules in SQL, written apart from the engine's.
SQL_INT = "^[+-]?\\d+$"
SQL_NUMBER = "^[+-]?(\\d+(\\.\\d*)?|\\.\\d+)([eE][+-]?\\d+)?$"
SQL_BOOLEAN = "^(true|false|True|False|TRUE|FALSE)$"
SQL_DAY = "^\\d{4}-\\d{2}-\\d{2}$"
SQL_SECOND = "^\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2}$"
CONTROL = "[\\x00-\\x1F]"
MARKED = "\u0001\u0002\u0003"


def second(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def seconds(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss")


SQL_OF: dict[Callable, Callable[[str], str]] = {
    render.text: lambda c: f"CAST({c} AS VARCHAR)",
    render.money: money,
    render.day: day,
    seconds: second,
}


def strings(spark: SparkSession, sf_dir: str, table: str, fields: dict[str, Callable]) -> DataFrame:
    return render.load(spark, sf_dir, table).select(*[f(name).alias(name) for name, f in fields.items()])


def shape_sql(v: str) -> str:
    escaped = rf"regexp_replace({v}, '([\\.^$|?*+()\[\]{{}}])', '\\\1', 'g')"
    for run, mark in (("[A-Z]+", 1), ("[a-z]+", 2), ("[0-9]+", 3)):
        escaped = f"regexp_replace({escaped}, '{run}', chr({mark}), 'g')"
    for mark, run in ((1, "[A-Z]+"), (2, "[a-z]+"), (3, r"\d+")):
        escaped = f"replace({escaped}, chr({mark}), '{run}')"
    return f"'^' || {escaped} || '$'"


def profile_sql(table: str, fields: dict[str, Callable], group: str | None = None) -> str:
    """The profile of a table whose dates are ISO days or seconds."""
    columns = [c for c in fields if c != group]
    values = ", ".join(f"trim({SQL_OF[fields[c]](c)})" for c in columns)
    by = f"{group}, " if group else ""
    key = f"{SQL_OF[fields[group]](group)} AS {group}, " if group else ""
    return f"""
  WITH cells AS (
    SELECT {key}unnest([{', '.join(str(i) for i in range(len(columns)))}]) AS pos,
           unnest([{', '.join(f"'{c}'" for c in columns)}]) AS name, unnest([{values}]) AS v
    FROM {table}),
  facts AS (
    SELECT {by}pos, name, v, CASE WHEN v IS NULL OR v = '' THEN NULL
      WHEN regexp_matches(v, '{SQL_INT}') THEN 'int' WHEN regexp_matches(v, '{SQL_NUMBER}') THEN 'float'
      WHEN regexp_matches(v, '{SQL_BOOLEAN}') THEN 'boolean'
      WHEN regexp_matches(v, '{SQL_DAY}') AND try_strptime(v, '%Y-%m-%d') IS NOT NULL THEN 'date'
      WHEN regexp_matches(v, '{SQL_SECOND}') AND try_strptime(v, '%Y-%m-%d %H:%M:%S') IS NOT NULL THEN 'date'
      WHEN v LIKE '{{%}}' AND json_valid(v) THEN 'object' WHEN v LIKE '[%]' AND json_valid(v) THEN 'array'
      ELSE 'string' END AS kind FROM cells),
  votes AS (
    SELECT {by}pos, name, count(*) AS total, count(*) - count(kind) AS blank,
           {', '.join(f"count(*) FILTER (kind = '{k}') AS {k}_n" for k in ('int', 'float', 'date', 'boolean', 'object', 'array', 'string'))},
           count(*) FILTER (kind = 'date' AND length(v) = 10) AS day_n,
           min(CASE WHEN kind IN ('int', 'float') THEN CAST(v AS DOUBLE) END) AS lo,
           max(CASE WHEN kind IN ('int', 'float') THEN CAST(v AS DOUBLE) END) AS hi,
           min(CASE WHEN kind = 'int' THEN CAST(v AS HUGEINT) END) AS whole_lo,
           max(CASE WHEN kind = 'int' THEN CAST(v AS HUGEINT) END) AS whole_hi,
           count(*) FILTER (kind = 'string' AND regexp_matches(v, '{CONTROL}')) AS odd_n,
           min(CASE WHEN kind = 'string' AND NOT regexp_matches(v, '{CONTROL}') THEN {shape_sql('v')} END) AS s1,
           max(CASE WHEN kind = 'string' AND NOT regexp_matches(v, '{CONTROL}') THEN {shape_sql('v')} END) AS s2
    FROM facts GROUP BY ALL),
  typed AS (
    SELECT *, total - blank AS filled, CASE WHEN total = blank THEN 'null' WHEN int_n = total - blank THEN 'int'
      WHEN int_n + float_n = total - blank THEN 'float' WHEN date_n = total - blank THEN 'date'
      WHEN boolean_n = total - blank THEN 'boolean' WHEN object_n = total - blank THEN 'object'
      WHEN array_n = total - blank THEN 'array' ELSE 'string' END AS type FROM votes)
  SELECT {by}CAST(pos AS INTEGER) AS pos, name, type, blank > 0 AS nullable,
         CASE WHEN filled = 0 THEN 1.0::DOUBLE WHEN type = 'string' THEN round(string_n::DOUBLE / filled, 3) ELSE 1.0::DOUBLE END AS confidence,
         CASE WHEN type <> 'date' THEN '' WHEN day_n >= date_n - day_n THEN 'yyyy-MM-dd' ELSE 'yyyy-MM-dd HH:mm:ss' END AS format,
         CASE WHEN type IN ('int', 'float') THEN lo END AS minimum,
         CASE WHEN type IN ('int', 'float') THEN hi END AS maximum,
         CASE WHEN type = 'int' THEN CAST(whole_lo AS VARCHAR) END AS least,
         CASE WHEN type = 'int' THEN CAST(whole_hi AS VARCHAR) END AS most,
         CASE WHEN type = 'string' AND string_n = filled AND odd_n = 0 AND s1 = s2 THEN s1 END AS pattern,
         'Column containing ' || name || ' data' AS description
  FROM typed"""


FIELDS: dict[str, dict[str, Callable]] = {
    "lineitem": render.LINE_FIELDS,
    "orders": render.ORDER_FIELDS,
    "customer": {
        "c_custkey": render.text, "c_name": render.text, "c_nationkey": render.text,
        "c_acctbal": render.money, "c_mktsegment": render.text,
    },
    "part": {
        "p_partkey": render.text, "p_name": render.text, "p_brand": render.text,
        "p_type": render.text, "p_size": render.text, "p_retailprice": render.money,
    },
    "events": {
        "event_id": render.text, "ts": seconds, "user_id": render.text, "event_type": render.text,
        "value": render.money, "props": render.text,
    },
    "documents": {
        "doc_id": render.text, "text": render.text, "lang": render.text, "source": render.text,
        "n_chars": render.text,
    },
}


def profiled(table: str, by: str | None = None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return profile(strings(spark, sf_dir, table, FIELDS[table]), [by] if by else [])

    run.__name__ = f"profile_{table}" + (f"_by_{by}" if by else "")
    run.__doc__ = f"Type, nullability, format, range and pattern of every column of {table}."
    return query(profile_sql(table, FIELDS[table], by))(run)


for _table in FIELDS:
    profiled(_table)
profiled("lineitem", "l_returnflag")
profiled("events", "event_type")


@query(profile_sql(
    "(SELECT CAST(CAST(l_orderkey AS HUGEINT) * 1000000000000000000000 + l_linenumber AS VARCHAR) AS long_key, "
    "'row ' || repeat(CAST(l_linenumber AS VARCHAR) || ' is ', 40) || 'long' AS long_text FROM lineitem)",
    {c: render.text for c in ("long_key", "long_text")}))
def profile_long_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers of over 18 digits with exact bounds, and a pattern of long values."""
    items = render.load(spark, sf_dir, "lineitem")
    key = F.col("l_orderkey").cast("decimal(16,0)") * F.lit("1" + "0" * 21).cast("decimal(22,0)") + F.col("l_linenumber")
    number = render.text("l_linenumber")
    return profile(
        items.select(
            key.cast("decimal(38,0)").cast("string").alias("long_key"),
            F.concat(F.lit("row "), F.repeat(F.concat(number, F.lit(" is ")), F.lit(40)), F.lit("long")).alias("long_text"),
        )
    )


@query(profile_sql(
    "(SELECT CASE WHEN e.event_id % 7 = 0 THEN '' ELSE CAST(e.event_id AS VARCHAR) END AS id, "
    "CASE WHEN e.event_id % 5 = 0 THEN '  ' WHEN e.value > 100 THEN 'high' ELSE CAST(CAST(e.value AS DECIMAL(18,2)) AS VARCHAR) END AS reading, "
    "CASE WHEN e.user_id % 2 = 0 THEN 'True' ELSE 'false' END AS flag, '' AS nothing, "
    "CASE WHEN e.event_id % 3 = 0 THEN strftime(e.ts, '%Y-%m-%d') ELSE strftime(e.ts, '%Y-%m-%d %H:%M:%S') END AS seen, "
    "'[' || e.user_id || ']' AS list FROM events e)",
    {c: render.text for c in ("id", "reading", "flag", "nothing", "seen", "list")}))
def profile_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns with blanks, mixed kinds, flags, two date formats, lists, and nothing."""
    events = render.load(spark, sf_dir, "events")
    number, value = F.col("event_id"), F.col("value").cast(render.MONEY)
    return profile(
        events.select(
            F.when(number % 7 == 0, "").otherwise(number.cast("string")).alias("id"),
            F.when(number % 5 == 0, "  ").when(F.col("value") > 100, "high")
            .otherwise(value.cast("string")).alias("reading"),
            F.when(F.col("user_id") % 2 == 0, "True").otherwise("false").alias("flag"),
            F.lit("").alias("nothing"),
            F.when(number % 3 == 0, render.day("ts")).otherwise(seconds("ts")).alias("seen"),
            F.concat(F.lit("["), render.text("user_id"), F.lit("]")).alias("list"),
        )
    )


@query(f"""
  SELECT CAST(unnest(range(3)) AS INTEGER) AS pos, unnest([5 * n, 5 * n, 5 * n]) AS total,
         unnest([0::BIGINT, 0, 0]) AS blank, unnest([5 * n, 0, 2 * n]) AS int_votes,
         unnest([0::BIGINT, 0, n]) AS float_votes, unnest([0::BIGINT, 0, n]) AS date_votes,
         unnest([0::BIGINT, 5 * n, n]) AS string_votes, unnest([0.0, NULL, lo]) AS minimum,
         unnest([4.0, NULL, hi]) AS maximum
  FROM (SELECT count(*) AS n, least(min(o_orderkey), min(o_custkey), min(CAST({money('o_totalprice')} AS DOUBLE))) AS lo,
               greatest(max(o_orderkey), max(o_custkey), max(CAST({money('o_totalprice')} AS DOUBLE))) AS hi FROM orders)""")
def cell_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes per column position over the cells of all order pages."""
    cells = aligned_cells(tables_of(extract_tables(shred(render.order_pages(spark, sf_dir)))))
    return type_votes(cells, ["pos"]).select(
        "pos", "total", "blank", "int_votes", "float_votes", "date_votes", "string_votes",
        "minimum", "maximum",
    )


@query(f"""
  SELECT o_orderkey AS doc_id, unnest([0, 1, 2]) AS pos, unnest(['Attr', 'Label', 'Attr_1']) AS name,
         unnest(['int', 'string', 'string']) AS type, unnest([false, false, false]) AS nullable,
         unnest([1.0, 1.0, 0.2]::DOUBLE[]) AS confidence,
         unnest(['{{"maximum":4,"minimum":0}}', '{{"pattern":"^[a-z]+_[a-z]+$"}}', NULL]) AS constraints,
         unnest(['0,1,2,3,4', 'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate',
                 o_orderkey || ',' || o_custkey || ',' || o_orderstatus || ',' || {money('o_totalprice')} || ',' || {day('o_orderdate')}]) AS samples
  FROM orders""")
def sample_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns inferred from each page's own sample rows, one per header."""
    found = infer_tables(tables_of(extract_tables(shred(render.order_pages(spark, sf_dir)))))
    return found.select("doc_id", F.posexplode("columns").alias("pos", "c")).select(
        "doc_id", "pos", "c.name", "c.type", "c.nullable", "c.confidence",
        F.to_json("c.constraints").alias("constraints"),
        F.array_join("c.sample_values", ",").alias("samples"),
    )


@query("""
  SELECT l_orderkey, name, type, confidence, true AS inferred, count(*) AS n
  FROM (SELECT l_orderkey, unnest(['l_orderkey', 'l_partkey', 'l_suppkey', 'l_linenumber', 'l_quantity',
                 'l_extendedprice', 'l_discount', 'l_tax', 'l_returnflag', 'l_linestatus', 'l_shipdate']) AS name,
               unnest(['int', 'int', 'int', 'string', 'int', 'float', 'float', 'float', 'string', 'string', 'date']) AS type,
               unnest([0.7, 0.7, 0.7, 0.5, 0.7, 0.7, 0.7, 0.7, 0.5, 0.5, 0.7]::DOUBLE[]) AS confidence
        FROM lineitem) GROUP BY ALL""")
def columns_from_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types judged by header names alone.

    Tables of an order meet as rows of all their headers and names are judged after they are counted, so
    that no row a header and page is moved or judged."""
    found = tables_of(extract_tables(shred(render.lineitem_pages(spark, sf_dir))))
    alike = found.groupBy("l_orderkey", "table_id", "headers").agg(F.count(F.lit(1)).alias("n"))
    heads = headers_of(alike, "l_orderkey", "n").groupBy("l_orderkey", "name").agg(F.sum("n").alias("n"))
    return infer_from_names(heads).select("l_orderkey", "name", "type", "confidence", "inferred", "n")


ALIASED = ["VARCHAR(20)", "str", "bigint", "decimal(10, 2)", "NoneType", "dict", "list", "Money"]


@query(f"""
  SELECT p_partkey AS schema_id,
         [{', '.join(f"'{t}'" for t in ('string', 'string', 'int', 'float', 'null', 'object', 'array', 'Money'))}][p_size % 8 + 1] AS type,
         ['varchar(20)', '', '', 'decimal(10, 2)', '', '', '', ''][p_size % 8 + 1] AS format
  FROM part""")
def type_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type names of other sources brought to one vocabulary."""
    names = F.array(*[F.lit(t) for t in ALIASED])
    parts = render.load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("schema_id"),
        F.get(names, F.col("p_size") % 8).alias("type"),
        F.lit("").alias("format"),
    )
    return normalise_types(parts)


@query(profile_sql("lineitem", FIELDS["lineitem"], "l_returnflag"))
def updated_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items profiled as they arrive: two deliveries, one of them made twice, and one that is
    taken out again; no delivery reads another one's rows."""
    store = new_path(spark, "votes")
    items = strings(spark, sf_dir, "lineitem", FIELDS["lineitem"])
    parts = items.withColumn("part", F.concat(F.lit("f"), F.pmod(F.xxhash64("l_orderkey"), F.lit(6))))
    early = F.col("part").isin("f0", "f1", "f2")
    wrong = parts.filter("part = 'f5'").withColumns({"part": F.lit("wrong"), "l_quantity": F.lit("none")})
    for arriving in (parts.filter(early), wrong, parts, parts.filter(early)):
        add_parts(arriving, store, "part", ["l_returnflag"])
    remove_parts(spark.createDataFrame([("wrong",)], "part string"), store)
    return stored_profile(spark, store, ["l_returnflag"])
