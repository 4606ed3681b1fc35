"""Queries over prompts, model answers and their parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.functions.text import json_text
from pagetables.operators.csvschema import csv_tables
from pagetables.operators.extract import extract_tables, tables_of
from pagetables.operators.parse import (
    HEADER_NAME,
    HEADER_TEXT,
    UNPARSED_TEXT,
    fallback_schema,
    normalise_schema,
    parse_schema_text,
    repair_escapes,
    strip_fences,
)
from pagetables.operators.prompts import (
    ANSWER_SHAPE,
    NAME_RULES_TEXT,
    RULES,
    prompt_kind,
    refine_prompts,
    run_model,
    schema_prompts,
)
from pagetables.operators.schemas import schema_columns
from pagetables.operators.select import select_tables
from pagetables.operators.shred import shred
from pagetables.plans import render
from pagetables.plans.describing import part_rows
from pagetables.plans.reading import raw_pages
from pagetables.plans.registry import ORDER_ROWS, money, query, text_literal

FORM = f"chr(10) || 'Reply in this form:' || chr(10) || {text_literal(ANSWER_SHAPE)} || chr(10) || "
ATTR = '["Attr","Label","Attr_1"]'


def selected(pages: DataFrame) -> DataFrame:
    return select_tables(extract_tables(shred(pages)))


def bare_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region pages with a header row only, inside a single cell-less table for odd keys."""
    regions = render.load(spark, sf_dir, "supplier")
    head = F.when(F.col("s_suppkey") % 2 == 0, render.row("th", F.col("s_name"), "s_acctbal")).otherwise(
        F.lit("<tr></tr>")
    )
    return regions.select(
        F.col("s_suppkey").alias("doc_id"), render.element("table", head, "<tr></tr>").alias("html")
    )


@query("""
  SELECT o_orderkey AS doc_id, 'order' AS origin, 'Success' AS readiness, 'samples' AS kind FROM orders
  UNION ALL SELECT c_custkey, 'customer', 'Success', 'vertical' FROM customer
  UNION ALL SELECT p_partkey, 'part', 'Success', 'schema_csv' FROM part
  UNION ALL SELECT s_suppkey, 'supplier', 'No data found', CASE WHEN s_suppkey % 2 = 0 THEN 'names' END FROM supplier
  UNION ALL SELECT page_id, 'page', 'No data found', NULL FROM pages""")
def prompt_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readiness and kind of prompt for documents of every sort."""
    pages = (
        render.order_pages(spark, sf_dir).select("doc_id", "html", F.lit("order").alias("origin"))
        .unionByName(render.customer_pages(spark, sf_dir).withColumn("origin", F.lit("customer")))
        .unionByName(bare_pages(spark, sf_dir).withColumn("origin", F.lit("supplier")))
        .unionByName(raw_pages(spark, sf_dir).select("doc_id", "html", F.lit("page").alias("origin")))
    )
    texts = csv_tables(part_rows(spark, sf_dir)).withColumn("origin", F.lit("part")).drop("source")
    documents = extract_tables(shred(pages)).unionByName(texts)
    return prompt_kind(select_tables(documents)).select("doc_id", "origin", "readiness", "kind")


@query(f"""
  SELECT doc_id, 0 AS table_index, 'samples' AS kind,
         'Describe the columns of a table.' || chr(10) || 'Headers: {ATTR}' || chr(10) || 'Rows:' || chr(10) ||
         string_agg('["' || row_no || '","' || name || '","' || value || '"]', chr(10) ORDER BY row_no) || {FORM}
         {text_literal(RULES)} AS prompt
  FROM {ORDER_ROWS} WHERE row_no < 5 GROUP BY doc_id""")
def sample_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts with headers and sample rows."""
    return schema_prompts(selected(render.order_pages(spark, sf_dir)))


@query(f"""
  SELECT c_custkey AS doc_id, 0 AS table_index, 'vertical' AS kind,
         'Describe the entity given by these properties and their values.' || chr(10) ||
         'Name: ' || c_name || chr(10) || 'Key: ' || c_custkey || chr(10) || 'Nation: ' || c_nationkey || chr(10) ||
         'Balance: ' || {money('c_acctbal')} || chr(10) || 'Segment: ' || c_mktsegment || chr(10) ||
         'Segment: ' || c_mktsegment || {FORM} {text_literal(RULES)} AS prompt
  FROM customer""")
def vertical_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts with property-value lines."""
    return schema_prompts(selected(render.customer_pages(spark, sf_dir)))


@query(f"""
  SELECT p_partkey AS doc_id, 0 AS table_index, 'schema_csv' AS kind,
         'This file describes the columns of a database table.' || chr(10) ||
         'Headers: ["_1","Key","Name","Data type","Null","Attributes","References","Description"]' || chr(10) ||
         'Properties:' || chr(10) || array_to_string([
            'Column Name: p_partkey', 'Data Type: int', 'Key: PK', 'Nullable: No', 'Description: Key ' || p_partkey,
            'Column Name: ' || p_name, 'Data Type: varchar(20)', 'Nullable: Yes',
            'Column Name: ' || p_brand, 'Data Type: ' || lower(p_type), 'Key: FK',
            'Nullable: ' || CASE WHEN p_size % 2 = 0 THEN 'No' ELSE 'Yes' END, 'References: brand.id',
            '_1: 1', '_1: 2', 'Attributes: unique', '_1: 3', 'Attributes: skipped', '_1: 4', '_1: 5'], chr(10)) ||
         {FORM} 'Also give "primary_key" and "foreign_key" where stated. ' || {text_literal(RULES)} AS prompt
  FROM part""")
def schema_csv_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts for schema-describing CSV texts."""
    return schema_prompts(select_tables(csv_tables(part_rows(spark, sf_dir))))


@query(f"""
  SELECT s_suppkey AS doc_id, 0 AS table_index, 'names' AS kind,
         'Describe the columns of a table from its headers.' || chr(10) || 'Headers: ["' || s_name ||
         '","s_acctbal"]' || chr(10) || {FORM} {text_literal(NAME_RULES_TEXT)} AS prompt
  FROM supplier WHERE s_suppkey % 2 = 0""")
def name_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts with headers only; tables without headers are not asked about."""
    return schema_prompts(selected(bare_pages(spark, sf_dir)))


@query("""
  SELECT p_partkey AS schema_id, 'Revise this table schema as the feedback asks.' || chr(10) || chr(10) ||
         'Schema:' || chr(10) || '{"name":"' || p_name || '"}' || chr(10) || chr(10) || 'Feedback:' || chr(10) ||
         '"call it \\"' || p_brand || '\\""' || chr(10) || chr(10) ||
         'Use precise types, add formats and constraints where they are known, keep names and structure. ' ||
         'Reply with the whole revised schema as JSON only.' AS prompt
  FROM part WHERE p_size % 2 = 0""")
def refinement_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts with a schema and the feedback on it."""
    parts = render.load(spark, sf_dir, "part")
    docs = parts.select(
        F.col("p_partkey").alias("schema_id"),
        F.concat(F.lit('{"name":'), json_text(F.col("p_name")), F.lit("}")).alias("doc"),
    )
    feedback = parts.filter("p_size % 2 = 0").select(
        F.col("p_partkey").alias("schema_id"),
        F.concat(F.lit('call it "'), F.col("p_brand"), F.lit('"')).alias("text"),
    )
    return refine_prompts(docs, feedback)


def echo_model(prompt: str, options: dict) -> dict:
    """A stand-in for a model: the prompt backwards; it fails, or replies with nothing, where a
    mark at the front of the prompt says so."""
    if prompt.startswith("fail:"):
        raise ValueError(f"prompt of {len(prompt) - 5} characters")
    if prompt.startswith("none:"):
        return None
    return {
        "content": prompt[::-1], "prompt_tokens": len(prompt), "completion_tokens": 1,
        "total_tokens": len(prompt) + 1,
    }


@query("""
  SELECT doc_id, CASE doc_id % 5 WHEN 3 THEN 'Error: prompt of ' || length(text) || ' characters'
                      WHEN 4 THEN 'Error: ' ELSE lang || ':' || length(text) END AS content,
         CASE doc_id % 5 WHEN 3 THEN 'prompt of ' || length(text) || ' characters' WHEN 4 THEN '' END AS error,
         CASE WHEN doc_id % 5 < 3 THEN length(text) + 1 END AS total_tokens
  FROM documents""")
def model_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch call with a stand-in model: whole texts in, answers or errors out."""
    prompts = render.load(spark, sf_dir, "documents").select(
        "doc_id", "lang",
        F.concat(F.when(F.col("doc_id") % 5 == 3, "fail:").when(F.col("doc_id") % 5 == 4, "none:").otherwise(""), "text")
        .alias("prompt"),
    )
    answers = run_model(prompts, echo_model)
    # What the parser of a reply of nothing says is Python's own wording.
    told = F.regexp_replace(F.col("error"), r"^'NoneType' .*$", "")
    return answers.select(
        "doc_id",
        F.when(F.col("error").isNotNull(), F.concat(F.lit("Error: "), told))
        .otherwise(F.concat("lang", F.lit(":"), F.char_length("content").cast("string")))
        .alias("content"),
        told.alias("error"),
        "total_tokens",
    )


@query("""
  SELECT doc_id, trim(text, ' ' || chr(10)) AS body FROM documents""")
def fence_stripping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts in code fences, without them again."""
    docs = render.load(spark, sf_dir, "documents")
    opening = F.when(F.col("doc_id") % 2 == 0, "```json\n").otherwise(" ```")
    fenced = F.concat(opening, F.col("text"), F.lit("\n```\n"))
    return docs.select("doc_id", strip_fences(fenced).alias("body"))


@query(r"""
  SELECT p_partkey AS doc_id, '^\\d+ ' || p_name || ' \" \n \\w \\\\ \\u0041 \\/$' AS repaired FROM part""")
def escape_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backslashes that JSON does not know are doubled."""
    broken = F.concat(F.lit(r"^\d+ "), F.col("p_name"), F.lit(r' \" \n \w \\ \u0041 \/$'))
    return render.load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("doc_id"), repair_escapes(broken).alias("repaired")
    )


def part_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model answers of ten sorts, made from the parts."""
    parts = render.load(spark, sf_dir, "part")
    name, brand = json_text(F.col("p_name")), json_text(F.col("p_brand"))
    first = F.concat(
        F.lit('{"name":'), name, F.lit(r',"type":"string","nullable":false,"constraints":{"pattern":"^\d+$"}}')
    )
    second = F.concat(F.lit('{"column_name":'), brand, F.lit(',"confidence":0.25,"format":"f"}'))
    good = F.concat(
        F.lit('{"name":"Parts","description":"d","columns":['), first, F.lit(","), second, F.lit("]}")
    )
    legacy = F.concat(F.lit('{"schema":['), second, F.lit(',{"name":null},7,{"type":"int"}]}'))
    sorts: list[Column] = [
        good,
        F.concat(F.lit("```json\n"), good, F.lit("\n```")),
        F.concat(F.lit("Here it is: "), good, F.lit(" Anything else?")),
        F.concat(F.lit("```"), legacy, F.lit("```")),
        F.concat(F.lit('{"name":'), name, F.lit("}")),
        F.concat(F.lit("Error: "), F.col("p_name")),
        F.concat(F.lit("["), brand, F.lit("]")),
        F.concat(F.lit("no braces, "), F.col("p_name")),
        json_text(F.replace(good, F.lit(r"\d"), F.lit("d"))),
        F.concat(F.lit('{"title":'), name, F.lit("}")),
    ]
    return parts.select(
        F.col("p_partkey").alias("doc_id"),
        F.array("p_name", "p_brand").alias("headers"),
        F.get(F.array(*sorts), (F.col("p_partkey") % 10).cast("int")).alias("content"),
    )


STATUSES = (
    "['parsed','parsed','parsed','parsed','no_columns','model_error','not_a_schema','unparsed',"
    "'parsed','not_a_schema']"
)


@query(f"SELECT p_partkey AS doc_id, {STATUSES}[p_partkey % 10 + 1] AS status FROM part")
def answer_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each answer turned out to be."""
    return parse_schema_text(part_responses(spark, sf_dir)).select("doc_id", "status")


@query(f"""
  SELECT doc_id, CAST(pos AS INTEGER) AS pos, c[1] AS name, c[2] AS type,
         coalesce(c[7], 'Column containing ' || c[1] || ' data') AS description,
         c[3] = 'true' AS nullable, CAST(c[4] AS DOUBLE) AS confidence, c[5] = 'true' AS inferred, c[6] AS format, c[8] AS constraints
  FROM (
    SELECT p_partkey AS doc_id, unnest(range(len(cs))) AS pos, unnest(cs) AS c
    FROM (SELECT p_partkey, CASE
            WHEN k IN (0, 1, 2, 8) THEN [
              [p_name, 'string', 'false', '1.0', 'false', '', NULL, CASE WHEN k = 8 THEN '{{"pattern":"^d+$"}}' ELSE '{{"pattern":"^\\\\d+$"}}' END],
              [p_brand, 'string', 'true', '0.25', 'false', 'f', NULL, NULL]]
            WHEN k = 3 THEN [
              [p_brand, 'string', 'true', '0.25', 'false', 'f', NULL, NULL],
              ['Column_2', 'string', 'true', '1.0', 'false', '', NULL, NULL],
              ['Column_3', 'string', 'true', '0.5', 'true', '', 'Placeholder for column that failed to parse', NULL],
              ['', 'int', 'true', '1.0', 'false', '', NULL, NULL]] END AS cs
          FROM (SELECT *, p_partkey % 10 AS k FROM part)))""".replace("\\\\\\\\", "\\\\"))
def normalised_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of the answers with defaults for what they leave out."""
    schemas = normalise_schema(parse_schema_text(part_responses(spark, sf_dir)))
    return schema_columns(schemas, "doc_id").select(
        "doc_id", "pos", "name", "type", "description", "nullable", "confidence", "inferred", "format",
        F.to_json("constraints").alias("constraints"),
    )


@query(f"""
  SELECT p_partkey AS doc_id, {STATUSES}[k + 1] AS status,
         CASE WHEN k IN (0, 1, 2, 8) THEN 'Parts' WHEN k = 3 THEN 'Table Schema' WHEN k = 4 THEN p_name
              WHEN k = 7 THEN 'Table Schema' ELSE '{HEADER_NAME}' END AS name,
         CASE WHEN k IN (0, 1, 2, 8) THEN 'd' WHEN k IN (3, 4) THEN '' WHEN k = 7 THEN '{UNPARSED_TEXT}'
              ELSE '{HEADER_TEXT}' END AS description,
         CASE WHEN k IN (0, 1, 2, 8) THEN p_name || '|' || p_brand
              WHEN k = 3 THEN p_brand || '|Column_2|Column_3|' WHEN k IN (4, 7) THEN ''
              ELSE 'p_name|p_brand' END AS names
  FROM (SELECT *, p_partkey % 10 AS k FROM part)""".replace("'p_name|p_brand'", "p_name || '|' || p_brand"))
def fallback_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every answer as a schema; failed ones fall back to the headers."""
    schemas = fallback_schema(normalise_schema(parse_schema_text(part_responses(spark, sf_dir))))
    return schemas.select("doc_id", "status", "name", "description", F.array_join("columns.name", "|").alias("names"))


@query(f"""
  SELECT s_suppkey AS doc_id, CASE WHEN s_suppkey % 2 = 0 THEN 'model_error' ELSE 'Error: No headers found in table data' END AS status,
         CASE WHEN s_suppkey % 2 = 0 THEN s_name || '|s_acctbal' END AS names
  FROM supplier""")
def header_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables whose model call failed: header columns, or an error without headers."""
    found = tables_of(extract_tables(shred(bare_pages(spark, sf_dir))))
    failed = found.select("doc_id", "headers", F.lit("Error: down").alias("content"))
    schemas = fallback_schema(normalise_schema(parse_schema_text(failed)))
    return schemas.select("doc_id", "status", F.array_join("columns.name", "|").alias("names"))
