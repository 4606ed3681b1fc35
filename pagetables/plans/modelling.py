"""Queries over the model path: a stand-in model asked about extracted tables, its usage logged."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.corpus import advised_documents
from pagetables.corpus import model_schemas as modelled
from pagetables.corpus import revised_schemas as revised
from pagetables.functions.shared import new_path
from pagetables.operators.answers import answered
from pagetables.operators.extract import extract_tables
from pagetables.operators.metrics import metrics_of, phase_summary
from pagetables.operators.select import select_tables
from pagetables.operators.shred import shred
from pagetables.plans import render
from pagetables.plans.reading import raw_pages
from pagetables.plans.registry import query
from pagetables.plans.revising import part_schemas
from pagetables.streaming.revisions import ANSWER_SCHEMA, REQUEST_SCHEMA, arriving, outcomes, read_decided, write_decided


def describing_model(prompt: str, options: dict) -> object:
    """A stand-in that describes a table from its prompt.

    It knows the order a prompt is about, and by that fails, or replies without text, without
    columns or in a fence.
    """
    lines = prompt.split("\n")
    headers = json.loads(lines[1].removeprefix("Headers: "))
    key = int(json.loads(lines[3])[2])
    if key % 5 == 1:
        raise ConnectionError(f"order {key}")
    if key % 5 == 2:
        return {"content": None, "total_tokens": 3}
    if key % 5 == 3:
        return {"content": "I can't say.", "prompt_tokens": 7, "completion_tokens": 3, "total_tokens": 10}
    columns = [{"name": h, "type": "int" if i == 0 else "string", "nullable": False} for i, h in enumerate(headers)]
    text = json.dumps({"name": f"Order {key}", "columns": columns})
    content = f"```json\n{text}\n```" if key % 5 == 4 else text
    return {"content": content, "prompt_tokens": len(headers), "completion_tokens": 1, "total_tokens": len(headers) + 1}


def choosing_model(prompt: str, options: dict) -> dict:
    """A stand-in that recommends the first of the tables with most columns."""
    counts = [int(n) for n in re.findall(r"^Columns \((\d+)\):", prompt, re.MULTILINE)]
    return {"content": f"Main Table: {counts.index(max(counts)) + 1}\nReasoning: it is wide\nTable Type: data"}


@query("""
  SELECT doc_id, CAST(CASE WHEN n >= 6 THEN 0 ELSE 1 END AS INTEGER) AS table_index, CAST(greatest(n, 6) AS INTEGER) AS column_count
  FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 2 ELSE 1 + len(string_split(string_split(text, chr(10))[1], ' ')) END AS n
        FROM documents)
  UNION ALL SELECT page_id, NULL, NULL FROM pages""")
def advised_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model's choice of a table, in the row of its page."""
    pages = render.document_pages(spark, sf_dir).unionByName(raw_pages(spark, sf_dir).drop("source"))
    chosen = select_tables(advised_documents(extract_tables(shred(pages)), choosing_model))
    return chosen.select("doc_id", "table_index", F.col("table.column_count").alias("column_count"))


def order_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = render.order_pages(spark, sf_dir).unionByName(raw_pages(spark, sf_dir))
    return modelled(extract_tables(shred(pages, prefilter=True)), describing_model)


@query("""
  SELECT o_orderkey AS schema_id, 'Success' AS page,
         CASE k WHEN 1 THEN 'model_error' WHEN 2 THEN 'model_error' WHEN 3 THEN 'unparsed' ELSE 'Success' END AS status,
         CASE WHEN k IN (0, 4) THEN 'Attr:int:false|Label:string:false|Attr_1:string:false' WHEN k = 3 THEN ''
              ELSE 'Attr:string:true|Label:string:true|Attr_1:string:true' END AS columns,
         CASE WHEN k IN (0, 4) THEN 'Order ' || o_orderkey END AS name,
         CAST(CASE WHEN k = 3 THEN 10 WHEN k IN (0, 4) THEN 4 END AS BIGINT) AS total_tokens,
         'order/' || o_orderkey AS source_url
  FROM (SELECT *, o_orderkey % 5 AS k FROM orders)
  UNION ALL
  SELECT page_id, 'none', 'Error: No tables found', NULL, NULL, NULL, url FROM pages""")
def model_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages to schemas through a model in one narrow run; failures and bad replies keep a row."""
    line = F.transform(
        "columns", lambda c: F.concat_ws(":", c["name"], c["type"], c["nullable"].cast("string"))
    )
    return order_answers(spark, sf_dir).select(
        "schema_id",
        F.when(F.col("model").isNull(), "none").otherwise("Success").alias("page"),
        "status",
        F.array_join(line, "|").alias("columns"),
        F.when(F.col("status") == "Success", F.col("name")).alias("name"),
        "total_tokens",
        F.try_variant_get(F.try_element_at("metadata", F.lit("source_url")), "$", "string").alias("source_url"),
    )


@query("""
  SELECT run_id, phase, CAST(count(*) AS BIGINT) AS operations,
         CAST(sum(CASE WHEN k = 3 THEN 7 WHEN k IN (0, 4) THEN 3 ELSE 0 END) AS BIGINT) AS prompt_tokens,
         CAST(sum(CASE WHEN k = 3 THEN 3 WHEN k IN (0, 4) THEN 1 ELSE 0 END) AS BIGINT) AS completion_tokens,
         CAST(sum(CASE WHEN k = 3 THEN 10 WHEN k IN (0, 4) THEN 4 ELSE 0 END) AS BIGINT) AS total_tokens
  FROM (SELECT o_orderkey % 7 AS run_id, 'initial' AS phase, o_orderkey % 5 AS k FROM orders) GROUP BY ALL""")
def model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calls of the model as log rows, summed by run and phase; pages that weren't asked
    about are no operations."""
    log = metrics_of(order_answers(spark, sf_dir), F.col("schema_id") % 7, "describer", "initial", "schema_id")
    return phase_summary(log).select(
        "run_id", "phase", "operations", "prompt_tokens", "completion_tokens", "total_tokens"
    )


def revising_model(prompt: str, options: dict) -> dict:
    """A stand-in that renames a schema as the feedback asks, or answers with prose."""
    document, feedback = prompt.split("\n\nSchema:\n")[1].split("\n\nFeedback:\n")
    wish = json.loads(feedback.split("\n\n")[0])
    if wish.startswith("no"):
        return {"content": "That would not be right."}
    return {"content": json.dumps(json.loads(document) | {"name": wish})}


@query("""
  SELECT p_partkey AS schema_id,
         CASE WHEN p_size % 3 = 0 THEN 'second ' || p_brand WHEN p_size % 3 = 1 THEN 'first ' || p_brand ELSE p_name END AS name,
         CAST(CASE p_size % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS INTEGER) AS version
  FROM part""")
def feedback_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rounds of feedback, the second on the result of the first."""
    parts = render.load(spark, sf_dir, "part")
    number = F.col("p_size") % 3
    key = F.col("p_partkey").alias("schema_id")
    first = parts.filter(number < 2).select(key, F.concat(F.lit("first "), F.col("p_brand")).alias("text"))
    second = parts.filter(number != 2).select(
        key, F.concat(F.when(number == 0, "second ").otherwise("no "), F.col("p_brand")).alias("text")
    )
    schemas = revised(part_schemas(spark, sf_dir), first, revising_model)
    return revised(schemas, second, revising_model).select("schema_id", "name", "version")


def pricing_model(prompt: str, options: dict) -> dict:
    """A stand-in that answers each call differently, and has no answer for open orders."""
    if "status P" in prompt:
        raise LookupError("no price yet")
    return {"content": f"{len(prompt)} {uuid.uuid4().hex}", "total_tokens": len(prompt)}


def silent_model(prompt: str, options: dict) -> dict:
    raise RuntimeError("asked again")


@query("""
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'Error: no price yet' ELSE CAST(length(prompt) AS VARCHAR) END AS content,
         CASE WHEN o_orderstatus = 'P' THEN 'no price yet' END AS error,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(length(prompt) AS BIGINT) END AS total_tokens,
         CAST(CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END AS INTEGER) AS tries, true AS one_answer
  FROM (SELECT *, 'Price of ' || o_orderpriority || ' in status ' || o_orderstatus || ' of ' || strftime(o_orderdate, '%Y-%m') AS prompt
        FROM orders)""")
def stored_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order's prompt, which many share, answered through a store.  The second run asks
    failed ones once more; the third asks nothing, with a model that would fail."""
    orders = render.load(spark, sf_dir, "orders")
    prompt = F.concat(
        F.lit("Price of "), "o_orderpriority", F.lit(" in status "), "o_orderstatus", F.lit(" of "),
        F.date_format("o_orderdate", "yyyy-MM"),
    )
    prompts = orders.select("o_orderkey", "o_orderpriority", "o_orderstatus", prompt.alias("asked"), prompt.alias("prompt"))
    store = new_path(spark, "answers")
    for model_fn in (pricing_model, pricing_model, silent_model):
        found = answered(prompts, model_fn, store, calls_per_round=500, most_tries=2)
    contents = found.groupBy("asked").agg(F.min("content").alias("least"), F.max("content").alias("most"))
    same = contents.select("asked", (F.col("least") == F.col("most")).alias("one_answer"))
    return found.join(same, "asked").select(
        "o_orderkey",
        F.when(F.col("error").isNull(), F.substring_index("content", " ", 1)).otherwise(F.col("content")).alias("content"),
        "error", "total_tokens", "tries", "one_answer",
    )


@query("""
  SELECT o_orderkey AS schema_id, CAST(1 AS INTEGER) AS round,
         CASE WHEN o_orderkey % 5 < 2 THEN 'timed out' ELSE 'answered' END AS outcome,
         CASE WHEN o_orderkey % 5 >= 2 THEN 'about ' || o_orderpriority END AS content
  FROM orders
  UNION ALL SELECT o_orderkey, 1, 'stray', 'about ' || o_orderpriority FROM orders WHERE o_orderkey % 5 = 1""")
def streamed_feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request about every order and its answer as streams: in time, a day late, or lost."""
    orders = render.load(spark, sf_dir, "orders")
    key, asked = F.col("o_orderkey").alias("schema_id"), F.col("o_orderdate").cast("timestamp")
    kind = F.col("o_orderkey") % 5
    hours = F.when(kind == 1, 30).otherwise(kind)
    requests = orders.select(key, F.lit(1).alias("round"), F.col("o_orderpriority").alias("prompt"), asked.alias("asked_at"))
    answers = orders.filter(kind > 0).select(
        key, F.lit(1).alias("round"), F.concat(F.lit("about "), "o_orderpriority").alias("content"),
        (asked + F.make_interval(hours=hours.cast("int"))).alias("answered_at"),
    )
    clock = spark.range(1).selectExpr("cast(null as bigint)", "cast(null as int)", "cast(null as string)", "timestamp'2100-01-01'")
    asking, giving, found, progress = (new_path(spark, n) for n in ("requests", "answers", "decided", "progress"))
    for sent, given in ((requests, answers), (clock.toDF(*requests.columns), clock.toDF(*answers.columns))):
        sent.write.mode("append").parquet(asking)
        given.write.mode("append").parquet(giving)
        streams = arriving(spark, asking, REQUEST_SCHEMA), arriving(spark, giving, ANSWER_SCHEMA)
        write_decided(*streams, found, progress, wait="1 day").awaitTermination()
    decided = read_decided(spark, found)
    stray = decided.filter("outcome = 'stray'").select("schema_id", "round", "outcome", "content")
    return outcomes(requests, decided).unionByName(stray)
