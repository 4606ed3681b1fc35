"""Queries over CSV texts that describe schemas, and over table selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.corpus import dataset_schemas as schemas_of_datasets
from pagetables.corpus import described_schemas
from pagetables.operators.csvschema import (
    csv_tables,
    definitions,
    detect_schema_csv,
    properties_of,
    resolve_roles,
)
from pagetables.operators.extract import extract_tables, tables_of
from pagetables.operators.schemas import definitions_to_schema
from pagetables.operators.select import (
    ANSWER_FORMAT,
    analysis_prompts,
    describe_tables,
    parse_analysis,
    rank_tables,
    select_files,
    select_tables,
    with_advice,
)
from pagetables.operators.shred import shred
from pagetables.plans import render
from pagetables.plans.reading import raw_pages
from pagetables.plans.registry import (
    DOCUMENT_CELLS,
    DOCUMENT_HEADERS,
    LINES,
    ORDER_ROWS,
    query,
    text_literal,
)
from pagetables.sources.csvtext import parse_csv

TYPE_WORD = "int|varchar|char|text|date|time|float|decimal"

# Documents by whether the first line makes their CSV text a schema description.
JUDGED = f"""(
  SELECT doc_id, line_count, regexp_matches(lower(line), '{TYPE_WORD}') AS is_schema
  FROM {LINES} WHERE line_no = 0)"""


def csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_csv(render.document_csv(spark, sf_dir))


def part_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_csv(render.part_csv(spark, sf_dir))


@query(f"""
  SELECT doc_id, 'corpus/' || doc_id || '.csv' AS source,
         CASE WHEN is_schema THEN 'content' END AS reason, is_schema
  FROM {JUDGED} j
  UNION ALL SELECT p_partkey, 'schemas/part_' || p_partkey || '.csv', 'header', true FROM part""")
def schema_csv_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV texts that describe a schema, by their header or their first line."""
    return detect_schema_csv(csv_rows(spark, sf_dir).unionByName(part_rows(spark, sf_dir)))


@query("""
  SELECT p_partkey AS doc_id, 2 AS name_idx, 3 AS type_idx, 1 AS key_idx, 4 AS null_idx,
         6 AS ref_idx, 7 AS desc_idx FROM part
  UNION ALL SELECT doc_id, 0, 1, NULL, NULL, NULL, NULL FROM documents""")
def schema_csv_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions of name, type, key, null flag, reference and description."""
    rows = part_rows(spark, sf_dir).unionByName(csv_rows(spark, sf_dir))
    return resolve_roles(rows).drop("source")


@query("""
  SELECT p_partkey AS doc_id, 0 AS def_no, 'p_partkey' AS name, 'int' AS type, 'PK' AS key,
         'No' AS null, '' AS ref, 'Key ' || p_partkey AS desc FROM part
  UNION ALL SELECT p_partkey, 1, p_name, 'varchar(20)', '', '', '', '' FROM part
  UNION ALL SELECT p_partkey, 2, p_brand, lower(p_type), 'FK', CASE WHEN p_size % 2 = 0 THEN 'No' ELSE '' END,
                   'brand.id', '' FROM part""")
def schema_csv_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Described columns; lines that are too short or have no name are skipped."""
    return definitions(part_rows(spark, sf_dir)).drop("source")


@query("""
  SELECT p_partkey AS doc_id, CAST(prop_no - 1 AS INTEGER) AS prop_no, p[1] AS name, p[2] AS value
  FROM (
    SELECT p_partkey, unnest(range(1, len(ps) + 1)) AS prop_no, unnest(ps) AS p
    FROM (SELECT p_partkey, [
            ['Column Name', 'p_partkey'], ['Data Type', 'int'], ['Key', 'PK'], ['Nullable', 'No'],
            ['Description', 'Key ' || p_partkey],
            ['Column Name', p_name], ['Data Type', 'varchar(20)'], ['Nullable', 'Yes'],
            ['Column Name', p_brand], ['Data Type', lower(p_type)], ['Key', 'FK'],
            ['Nullable', CASE WHEN p_size % 2 = 0 THEN 'No' ELSE 'Yes' END], ['References', 'brand.id'],
            ['_1', '1'], ['_1', '2'], ['Attributes', 'unique'], ['_1', '3'], ['Attributes', 'skipped'],
            ['_1', '4'], ['_1', '5']] AS ps FROM part))""")
def schema_csv_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Definitions and remaining cells unpivoted into named properties, in order."""
    return properties_of(tables_of(csv_tables(part_rows(spark, sf_dir)))).drop("table_id")


@query(f"""
  SELECT doc_id, 'Column Name' AS name, CAST(line_no AS VARCHAR) AS value, line_no
  FROM {LINES} WHERE doc_id IN (SELECT doc_id FROM {JUDGED} WHERE is_schema)
  UNION ALL SELECT doc_id, 'Data Type', trim(line), line_no
  FROM {LINES} WHERE doc_id IN (SELECT doc_id FROM {JUDGED} WHERE is_schema) AND trim(line) <> ''""")
def described_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as schema descriptions: roles at their default positions."""
    found = definitions(csv_rows(spark, sf_dir))
    pairs = F.array(
        F.struct(F.lit("Column Name").alias("name"), F.col("name").alias("value")),
        F.struct(F.lit("Data Type").alias("name"), F.nullif("type", F.lit("")).alias("value")),
    )
    return (
        found.select("doc_id", F.col("name").cast("int").alias("line_no"), F.explode(pairs).alias("p"))
        .select("doc_id", "line_no", "p.name", "p.value")
        .filter(F.col("value").isNotNull())
    )


@query(f"""
  SELECT doc_id, CASE WHEN is_schema THEN 'Database Schema' ELSE doc_id || '.csv' END AS caption,
         2 AS column_count, CAST(CASE WHEN is_schema THEN line_count ELSE least(5, line_count) END AS INTEGER) AS row_count,
         is_schema AS has_properties
  FROM {JUDGED} j""")
def csv_document_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV texts as tables: described schemas count all lines, plain ones the sample."""
    return tables_of(csv_tables(csv_rows(spark, sf_dir))).select(
        "doc_id", "caption", "column_count", "row_count",
        F.col("properties").isNotNull().alias("has_properties"),
    )


@query("""
  SELECT p_partkey AS doc_id, 0 AS pos, 'p_partkey' AS name, 'int' AS type, 'Key ' || p_partkey AS description,
         false AS nullable, '' AS format, true AS primary_key, CAST(NULL AS VARCHAR) AS foreign_key FROM part
  UNION ALL SELECT p_partkey, 1, p_name, 'string', 'Column containing ' || p_name || ' data', true,
                   'varchar(20)', false, NULL FROM part
  UNION ALL SELECT p_partkey, 2, p_brand, lower(p_type), 'Column containing ' || p_brand || ' data',
                   p_size % 2 <> 0, '', false, 'brand.id' FROM part""")
def schema_from_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Described columns as schema columns."""
    return definitions_to_schema(definitions(part_rows(spark, sf_dir)).drop("source"))


@query("""
  SELECT p_partkey AS schema_id, 'part_' || p_partkey || '.csv' AS name, unnest([0, 1, 2]) AS pos,
         unnest(['p_partkey', p_name, p_brand]) AS column_name, unnest(['int', 'string', lower(p_type)]) AS type,
         unnest(['{"primary_key":true}', NULL, '{"foreign_key":"brand.id"}']) AS constraints, 3 AS column_count
  FROM part""")
def described_schema_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema-describing CSV texts as schemas, keys among the constraints."""
    schemas = described_schemas(part_rows(spark, sf_dir))
    count = F.try_variant_get(F.try_element_at("metadata", F.lit("column_count")), "$", "int")
    return schemas.select(
        "schema_id", "name", count.alias("column_count"), F.posexplode("columns").alias("pos", "c")
    ).select(
        "schema_id", "name", "pos", F.col("c.name").alias("column_name"), "c.type",
        F.to_json("c.constraints").alias("constraints"), "column_count",
    )


# --- tables: description, recommendation, selection ----------------------------------------

@query(f"""
  SELECT doc_id, basename AS caption, 1 AS column_count, CAST(least(5, n) AS INTEGER) AS row_count,
         CAST(line_no AS INTEGER) AS row_no, line AS value
  FROM (SELECT *, 'plain_' || doc_id || '.csv' AS basename, line_count AS n FROM {LINES}) WHERE line_no < 5""")
def csv_plain_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV texts whose only header names both name and type: read as plain tables."""
    docs = render.load(spark, sf_dir, "documents")
    lines = F.transform(F.split("text", "\n"), render.quoted)
    files = docs.select(
        "doc_id",
        F.concat(F.lit("plain_"), F.col("doc_id").cast("string"), F.lit(".csv")).alias("source"),
        F.concat(F.lit("Name and data type\n"), F.array_join(lines, "\n")).alias("content"),
    )
    found = tables_of(csv_tables(parse_csv(files)))
    return found.filter(F.col("properties").isNull()).select(
        "doc_id", "caption", "column_count", "row_count", F.posexplode("rows").alias("row_no", "cells")
    ).select("doc_id", "caption", "column_count", "row_count", "row_no", F.get("cells", F.lit(0)).alias("value"))


ORDER_DESCRIPTION = """'Table 1' || chr(10) || 'Context: Order ' || o_orderkey || chr(10) ||
  'Columns (3): Attr, Label, Attr_1' || chr(10) || 'Rows: 5' || chr(10) ||
  'First row: 0 | o_orderkey | ' || o_orderkey"""


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_tables(shred(render.order_pages(spark, sf_dir)))


@query(f"""
  WITH heads AS (
    SELECT doc_id, table_id, list(name ORDER BY pos) AS heads FROM {DOCUMENT_HEADERS} GROUP BY ALL),
  firsts AS (
    SELECT doc_id, table_id, count(DISTINCT row_no) AS row_count,
           string_agg(value, ' | ' ORDER BY pos) FILTER (WHERE row_no = 0) AS first_row
    FROM {DOCUMENT_CELLS} WHERE row_no < 5 GROUP BY ALL)
  SELECT o_orderkey AS doc_id, 0 AS table_id, {ORDER_DESCRIPTION} AS text FROM orders
  UNION ALL
  SELECT doc_id, table_id, 'Table ' || (table_id + 1) || chr(10) || 'Context: '
         || CASE WHEN doc_id % 2 = 0 THEN lang || 'one' WHEN table_id = 1 THEN source ELSE '' END
         || chr(10) || 'Columns (' || len(heads) || '): ' || array_to_string(heads[1:10], ', ')
         || CASE WHEN len(heads) > 10 THEN '...' ELSE '' END || chr(10) || 'Rows: ' || row_count
         || chr(10) || 'First row: ' || first_row
  FROM heads JOIN firsts USING (doc_id, table_id) JOIN documents USING (doc_id)""")
def table_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables as text; more than ten headers end in an ellipsis."""
    pages = render.order_pages(spark, sf_dir).select("doc_id", "html").unionByName(
        render.document_pages(spark, sf_dir)
    )
    return describe_tables(tables_of(extract_tables(shred(pages))))


@query(f"""
  SELECT o_orderkey AS doc_id, 'A web page holds 1 tables, described below.' || chr(10) || chr(10) ||
         {ORDER_DESCRIPTION} || chr(10) || chr(10) ||
         'Which one carries the page''s main, most useful structured data?' || chr(10) ||
         {text_literal(ANSWER_FORMAT)} AS prompt
  FROM orders""")
def analysis_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One question per page with tables; the given pages have none and are left out."""
    pages = render.order_pages(spark, sf_dir).unionByName(raw_pages(spark, sf_dir))
    return analysis_prompts(extract_tables(shred(pages, prefilter=True)))


ANSWERS = """(
  SELECT p_partkey AS doc_id, p_size, p_name, p_type, CASE p_partkey % 4
           WHEN 0 THEN 'Main Table: ' || p_size || chr(10) || 'Reasoning: ' || p_name || chr(10) || ' and more.' || chr(10) || 'Table Type: ' || p_type
           WHEN 1 THEN 'Main Table:' || p_size || ' Reasoning:' || p_name
           WHEN 2 THEN 'I think it is ' || p_name ELSE 'Error: ' || p_name END AS content
  FROM part)"""


def part_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = render.load(spark, sf_dir, "part")
    number, size, name = F.col("p_partkey") % 4, F.col("p_size").cast("string"), F.col("p_name")
    full = F.concat(
        F.lit("Main Table: "), size, F.lit("\nReasoning: "), name, F.lit("\n and more.\nTable Type: "),
        F.col("p_type"),
    )
    return parts.select(
        F.col("p_partkey").alias("doc_id"),
        F.when(number == 0, full)
        .when(number == 1, F.concat(F.lit("Main Table:"), size, F.lit(" Reasoning:"), name))
        .when(number == 2, F.concat(F.lit("I think it is "), name))
        .otherwise(F.concat(F.lit("Error: "), name))
        .alias("content"),
    )


@query(f"""
  SELECT doc_id, CASE WHEN doc_id % 4 < 2 THEN p_size - 1 END AS table_index,
         CASE doc_id % 4 WHEN 0 THEN p_name || chr(10) || ' and more.' WHEN 1 THEN p_name
              ELSE 'No reasoning provided.' END AS reasoning,
         CASE WHEN doc_id % 4 = 0 THEN p_type ELSE 'unknown' END AS table_type
  FROM {ANSWERS} a""")
def analysis_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers read back: number, reasoning over several lines, type, and their defaults."""
    return parse_analysis(part_answers(spark, sf_dir))


# Filled cells of the document pages' three tables; all three are regular unless the first
# has one column, which takes a document that starts with an empty page.
RANKED = f"""(
  SELECT doc_id,
         sum(CASE WHEN value <> '' AND line_no >= first_line AND line_no < first_line + 5 THEN 1 ELSE 0 END) AS filled
  FROM (SELECT doc_id, line_no, pos, value,
               CASE WHEN doc_id % 2 = 0 OR line_count = 1 THEN 0 ELSE 1 END AS first_line
        FROM (SELECT doc_id, line_no, line_count, unnest(range(len(c))) AS pos, unnest(c) AS value
              FROM (SELECT *, list_prepend(CAST(line_no AS VARCHAR), string_split(line, ' ')) AS c FROM {LINES})))
  GROUP BY doc_id)"""


@query(f"""
  SELECT doc_id, CAST(CASE WHEN filled >= 3 THEN 0 ELSE 1 END AS INTEGER) AS table_index,
         'Most filled cells: ' || CAST(greatest(filled, 3) AS INTEGER) AS reasoning, 'data' AS table_type
  FROM {RANKED} r""")
def table_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table with most filled cells, without a model."""
    return rank_tables(extract_tables(shred(render.document_pages(spark, sf_dir))))


@query("""
  SELECT doc_id, CAST(picked AS INTEGER) AS table_index,
         CAST([CASE WHEN doc_id % 2 = 0 THEN 2 ELSE 1 + words END, 6, 3][picked + 1] AS INTEGER) AS column_count
  FROM (SELECT *, CASE WHEN rec BETWEEN 0 AND 2 THEN rec WHEN choice BETWEEN 0 AND 2 THEN choice END AS picked
        FROM (SELECT doc_id, CASE WHEN doc_id % 3 < 2 THEN doc_id % 7 - 1 END AS rec,
                     CASE WHEN doc_id % 5 < 4 THEN doc_id % 5 END AS choice,
                     len(string_split(string_split(text, chr(10))[1], ' ')) AS words FROM documents))""")
def table_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recommendations that are in range win over choices that are."""
    pages = render.document_pages(spark, sf_dir)
    ids = pages.select("doc_id")
    number = F.col("doc_id")
    recommended = ids.filter(number % 3 < 2).withColumn("table_index", (number % 7 - 1).cast("int"))
    chosen = ids.filter(number % 5 < 4).withColumn("table_index", (number % 5).cast("int"))
    advised = with_advice(pages, recommended, chosen)
    selected = select_tables(extract_tables(shred(advised)))
    return selected.select("doc_id", "table_index", F.col("table.column_count").alias("column_count"))


@query("""
  SELECT page_id AS doc_id, CAST(NULL AS INTEGER) AS table_index FROM pages
  UNION ALL SELECT c_custkey, 0 FROM customer""")
def only_table_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's only table is selected; a page without tables has nothing to select."""
    pages = raw_pages(spark, sf_dir).drop("source").unionByName(render.customer_pages(spark, sf_dir))
    return select_tables(extract_tables(shred(pages))).select("doc_id", "table_index")


@query("""
  WITH files AS (SELECT split_part(url, '/', 3) AS dataset, url AS path FROM pages),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY path COLLATE "C") AS place FROM files),
  choices AS (SELECT dataset, length(dataset) % 4 AS choice FROM files GROUP BY dataset HAVING length(dataset) % 2 = 0)
  SELECT dataset, max_by(path, place) AS path
  FROM ranked LEFT JOIN choices USING (dataset)
  WHERE place = 1 OR place = choice GROUP BY dataset""".replace(' COLLATE "C"', ""))
def file_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chosen file of each dataset, else the first."""
    files = raw_pages(spark, sf_dir).select(
        F.split_part("source", F.lit("/"), F.lit(3)).alias("dataset"), F.col("source").alias("path")
    )
    length = F.char_length("dataset")
    choices = files.select("dataset").distinct().filter(length % 2 == 0).withColumn("choice", length % 4)
    return select_files(files, choices)


@query("""
  WITH files AS (SELECT source AS dataset, 'corpus/' || doc_id || '.csv' AS path, length(source) % 4 AS choice FROM documents),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY path) AS place, count(*) OVER (PARTITION BY dataset) AS n FROM files)
  SELECT path AS schema_id, 'Success' AS status, 'no|line' AS names, regexp_extract(path, '[^/]*$') AS csv_file
  FROM ranked WHERE place = CASE WHEN choice BETWEEN 1 AND n THEN choice ELSE 1 END""")
def dataset_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Datasets of CSV files: the chosen file of each becomes a schema."""
    files = render.document_csv(spark, sf_dir, "dataset")
    length = F.char_length("dataset") % 4
    choices = files.select("dataset").distinct().withColumn("choice", length)
    schemas = schemas_of_datasets(files.withColumnRenamed("source", "path"), choices)
    return schemas.select(
        "schema_id", "status", F.array_join("columns.name", "|").alias("names"),
        F.try_variant_get(F.try_element_at("metadata", F.lit("csv_file")), "$", "string").alias("csv_file"),
    )


@query("SELECT split_part(url, '/', 3) AS dataset, min(url) AS path FROM pages GROUP BY 1")
def first_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without choices, the first file of each dataset."""
    return select_files(
        raw_pages(spark, sf_dir).select(
            F.split_part("source", F.lit("/"), F.lit(3)).alias("dataset"),
            F.col("source").alias("path"),
        )
    )


@query(f"""
  SELECT doc_id, max(CASE WHEN row_no = 3 THEN value END) AS total, 5 AS row_count FROM {ORDER_ROWS} GROUP BY doc_id""")
def selected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A value out of the selected table."""
    picked = select_tables(order_documents(spark, sf_dir))
    return picked.select(
        "doc_id",
        F.col("table.rows").getItem(3).getItem(2).alias("total"),
        F.col("table.row_count").alias("row_count"),
    )
