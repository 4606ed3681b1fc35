"""Queries over schemas as data: documents, loading, patches, versions, views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.corpus import csv_documents, document_schemas, page_documents
from pagetables.functions.shared import new_path
from pagetables.functions.text import json_text
from pagetables.operators.infer import COLUMN_DDL
from pagetables.operators.parse import (
    NULL_NAME,
    NULL_TEXT,
    load_lenient,
    load_strict,
    normalise_schema,
    parse_schema_text,
)
from pagetables.operators.schemas import (
    apply_patches,
    attach_metadata,
    column_counts,
    fill_missing_schemas,
    fold_patches,
    metadata_map,
    refine,
    review_view,
    schema_columns,
    source_metadata,
    stamp_version,
    to_json_docs,
    to_yaml_docs,
)
from pagetables.plans import render
from pagetables.plans.reading import raw_pages
from pagetables.plans.registry import day, money, query
from pagetables.sources.documents import format_raw
from pagetables.sources.named import read_named, write_named


def column(name: Column, kind: str, **fields: Column) -> Column:
    return F.struct(
        name.alias("name"),
        F.lit(kind).alias("type"),
        F.concat(F.lit("the "), name).alias("description"),
        fields.get("nullable", F.lit(True)).alias("nullable"),
        fields.get("confidence", F.lit(1.0)).alias("confidence"),
        fields.get("inferred", F.lit(False)).alias("inferred"),
        fields.get("format", F.lit("")).alias("format"),
        fields.get("constraints", F.lit(None).cast("variant")).alias("constraints"),
        F.array(name).alias("sample_values"),
    ).cast(COLUMN_DDL)


def part_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A schema per part: two columns named after its brand and type."""
    parts = render.load(spark, sf_dir, "part")
    limits = F.parse_json(F.to_json(F.struct(F.lit(1).alias("minimum"), F.col("p_size").alias("maximum"))))
    return parts.select(
        F.col("p_partkey").alias("schema_id"),
        F.lit(0).alias("version"),
        F.col("p_name").alias("name"),
        F.concat(F.lit('"'), F.col("p_type"), F.lit('" \u00a0\u2028part')).alias("description"),
        F.array(
            column(F.col("p_brand"), "string", nullable=F.col("p_size") % 2 == 0, format=F.lit("code")),
            column(F.lit("size"), "int", confidence=F.lit(0.5), inferred=F.lit(True), constraints=limits),
        ).alias("columns"),
        metadata_map(table_index=F.col("p_size"), source_url=F.when(F.col("p_size") > 25, F.col("p_name")))
        .alias("metadata"),
    )


def member(path: str) -> Column:
    return F.get_json_object("doc", path)


@query("""
  SELECT p_partkey AS schema_id, p_name AS name, p_brand AS first, p_size % 2 = 0 AS nullable,
         CAST(NULL AS VARCHAR) AS first_confidence, '0.5' AS second_confidence, CAST(NULL AS VARCHAR) AS first_inferred,
         'true' AS second_inferred, 'code' AS first_format, CAST(NULL AS VARCHAR) AS second_format,
         p_size AS maximum, p_size AS table_index, CASE WHEN p_size > 25 THEN p_name END AS url,
         CAST(NULL AS VARCHAR) AS samples
  FROM part""")
def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schemas written as JSON; defaults, samples and missing members are left out."""
    return to_json_docs(part_schemas(spark, sf_dir)).select(
        "schema_id",
        member("$.name").alias("name"),
        member("$.columns[0].name").alias("first"),
        member("$.columns[0].nullable").cast("boolean").alias("nullable"),
        member("$.columns[0].confidence").alias("first_confidence"),
        member("$.columns[1].confidence").alias("second_confidence"),
        member("$.columns[0].inferred").alias("first_inferred"),
        member("$.columns[1].inferred").alias("second_inferred"),
        member("$.columns[0].format").alias("first_format"),
        member("$.columns[1].format").alias("second_format"),
        member("$.columns[1].constraints.maximum").cast("int").alias("maximum"),
        member("$.metadata.table_index").cast("int").alias("table_index"),
        member("$.metadata.source_url").alias("url"),
        member("$.columns[0].sample_values").alias("samples"),
    )


@query(r"""
  SELECT p_partkey AS schema_id, array_to_string([
    'name: "' || p_name || '"', 'description: "\"' || p_type || '\" ' || chr(160) || '\u2028part"', 'columns:',
    '- name: "' || p_brand || '"', '  type: "string"', '  description: "the ' || p_brand || '"',
    '  nullable: ' || (p_size % 2 = 0), '  format: "code"',
    '- name: "size"', '  type: "int"', '  description: "the size"', '  nullable: true', '  confidence: 0.5',
    '  inferred: true', '  constraints: {"maximum":' || p_size || ',"minimum":1}',
    'metadata:', '  "table_index": ' || p_size] ||
    CASE WHEN p_size > 25 THEN ['  "source_url": "' || p_name || '"'] ELSE [] END || [''], chr(10)) AS doc
  FROM part""")
def yaml_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schemas written as YAML, to the character."""
    return to_yaml_docs(part_schemas(spark, sf_dir))


LOADED = """
  SELECT p_partkey AS schema_id, 'Success' AS status, p_name AS schema_name, unnest([0, 1]) AS pos,
         unnest([p_brand, 'size']) AS name, unnest(['string', 'int']) AS type,
         unnest([p_size % 2 = 0, true]) AS nullable, unnest([1.0, 0.5]::DOUBLE[]) AS confidence,
         unnest([false, true]) AS inferred, unnest(['code', '']) AS format,
         unnest([NULL, '{"maximum":' || p_size || ',"minimum":1}']) AS constraints, CAST(p_size AS INTEGER) AS table_index
  FROM part"""


def loaded_columns(loaded: DataFrame) -> DataFrame:
    index = F.try_variant_get(F.try_element_at("metadata", F.lit("table_index")), "$", "int")
    return loaded.select(
        "schema_id", "status", F.col("name").alias("schema_name"), index.alias("table_index"),
        F.posexplode("columns").alias("pos", "c"),
    ).select(
        "schema_id", "status", "schema_name", "table_index", "pos", "c.name", "c.type", "c.nullable",
        "c.confidence", "c.inferred", "c.format", F.to_json("c.constraints").alias("constraints"),
    )


@query(LOADED)
def strict_loading(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written schemas, fenced and amid text, read back whole."""
    docs = to_json_docs(part_schemas(spark, sf_dir))
    wrapped = F.when(F.col("schema_id") % 2 == 0, F.concat(F.lit("```json\n"), "doc", F.lit("\n```"))).otherwise(
        F.concat(F.lit("As asked: "), "doc", F.lit(" Done."))
    )
    return loaded_columns(load_strict(docs.withColumn("doc", wrapped)))


@query(LOADED)
def named_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written schemas as one file each, in two jobs, read back whole."""
    docs, folder = to_json_docs(part_schemas(spark, sf_dir)), new_path(spark, "schemas")
    for rest in (0, 1):
        write_named(docs.filter(F.col("schema_id") % 2 == rest), folder)
    read = read_named(spark, folder).withColumn("schema_id", F.col("schema_id").cast("bigint"))
    return loaded_columns(load_strict(read.drop("file")))


@query(LOADED)
def lenient_loading(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from plain JSON by the lenient reader."""
    return loaded_columns(load_lenient(to_json_docs(part_schemas(spark, sf_dir))))


@query("""
  SELECT p_partkey AS schema_id, CASE p_partkey % 5 WHEN 0 THEN 'Success' WHEN 1 THEN 'Error: Invalid column format'
           WHEN 2 THEN 'Error: Invalid schema format' WHEN 3 THEN 'Error: Invalid JSON' ELSE 'Error: Invalid column format' END AS strict,
         CASE WHEN p_partkey % 5 = 3 THEN 'Error: Invalid JSON' ELSE 'Success' END AS lenient,
         CASE p_partkey % 5 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 4 THEN 1 WHEN 2 THEN 0 END AS columns
  FROM part""")
def load_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old member names, missing types, no columns, no JSON, empty names: strict and lenient."""
    brand = json_text(F.col("p_brand"))
    number = F.col("p_partkey") % 5
    doc = (
        F.when(number == 0, F.concat(F.lit('{"schema":[{"column_name":'), brand, F.lit(',"type":"int"}]}')))
        .when(number == 1, F.concat(F.lit('{"columns":[{"name":'), brand, F.lit("}]}")))
        .when(number == 2, F.concat(F.lit('{"name":'), brand, F.lit("}")))
        .when(number == 3, F.col("p_brand"))
        .otherwise('{"columns":[{"name":"","type":"int"}]}')
    )
    docs = render.load(spark, sf_dir, "part").select(F.col("p_partkey").alias("schema_id"), doc.alias("doc"))
    strict = docs.select("*", F.lit("strict").alias("how")).transform(load_strict)
    lenient = docs.select("*", F.lit("lenient").alias("how")).transform(load_lenient)
    both = strict.unionByName(lenient)
    return both.groupBy("schema_id").agg(
        F.max(F.when(F.col("how") == "strict", F.col("status"))).alias("strict"),
        F.max(F.when(F.col("how") == "lenient", F.col("status"))).alias("lenient"),
        F.max(F.when(F.col("how") == "lenient", F.size("columns"))).alias("columns"),
    )


# Feedback rounds made from events: the schema is a part, the round is the event.
PATCHES = """(
  SELECT user_id AS schema_id, event_id AS round,
         CASE WHEN event_id % 3 = 0 THEN 'size' WHEN event_id % 3 = 1 THEN 'absent' ELSE p_brand END AS column_name,
         ['type', 'nullable', 'description', 'format'][event_id % 4 + 1] AS field,
         CASE event_id % 4 WHEN 1 THEN CASE WHEN event_id % 8 = 1 THEN 'false' ELSE 'true' END ELSE event_type END AS value
  FROM events JOIN part ON p_partkey = user_id)"""


def event_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as patches of the parts; a third of them patch the column named as the part's
    brand."""
    number = F.col("event_id")
    events = render.load(spark, sf_dir, "events").withColumnRenamed("user_id", "schema_id")
    brands = render.load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("schema_id"), F.col("p_brand").alias("brand")
    )
    return events.join(brands, "schema_id").select(
        "schema_id",
        number.alias("round"),
        F.when(number % 3 == 0, "size").when(number % 3 == 1, "absent").otherwise(F.col("brand"))
        .alias("column_name"),
        F.get(F.array(*[F.lit(f) for f in ("type", "nullable", "description", "format")]),
              (number % 4).cast("int")).alias("field"),
        F.when(number % 4 == 1, F.when(number % 8 == 1, "false").otherwise("true"))
        .otherwise(F.col("event_type")).alias("value"),
    )


FOLDED = f"""(
  SELECT schema_id, column_name, max_by(value, round) FILTER (field = 'type') AS type,
         max_by(value, round) FILTER (field = 'nullable') AS nullable,
         max_by(value, round) FILTER (field = 'description') AS description,
         max_by(value, round) FILTER (field = 'format') AS format
  FROM {PATCHES} p GROUP BY ALL)"""


@query(f"SELECT * FROM {FOLDED} f")
def folded_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last value per schema, column and field over all rounds."""
    return fold_patches(event_patches(spark, sf_dir)).drop("name", "constraints")


@query("""
  SELECT conv_id AS schema_id, 'c' || min(turn) AS column_name, 'c' || (max(turn) + 1) AS name,
         max_by(text, turn) FILTER (length(text) % 3 <> 0) AS description,
         max_by(role, turn) FILTER (turn % 2 = 1) AS type
  FROM conversations GROUP BY conv_id""")
def renamed_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of a conversation is a round: it renames the column by the name the round
    before gave, describes it by that name, with no value at times, and gives odd rounds' type."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    name = F.concat(F.lit("c"), F.col("turn").cast("string"))
    described = F.when(F.char_length("text") % 3 != 0, F.col("text"))
    fields = F.array(
        F.struct(F.lit("name").alias("field"), F.concat(F.lit("c"), (F.col("turn") + 1).cast("string")).alias("value")),
        F.struct(F.lit("description").alias("field"), described.alias("value")),
        F.struct(F.lit("type").alias("field"), F.when(F.col("turn") % 2 == 1, F.col("role")).alias("value")),
    )
    patches = turns.select(
        F.col("conv_id").alias("schema_id"), F.col("turn").alias("round"), name.alias("column_name"), F.inline(fields)
    )
    return fold_patches(patches).select("schema_id", "column_name", "name", "description", "type")


@query(f"""
  SELECT s.schema_id, s.pos, s.name, coalesce(f.type, s.type) AS type,
         coalesce(f.description, 'the ' || s.name) AS description,
         coalesce(CAST(f.nullable AS BOOLEAN), s.nullable) AS nullable, coalesce(f.format, s.format) AS format,
         CAST(CASE WHEN t.schema_id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS version,
         CASE WHEN t.schema_id IS NOT NULL THEN 1 END AS refinement_version
  FROM ({LOADED}) s LEFT JOIN {FOLDED} f ON f.schema_id = s.schema_id AND f.column_name = s.name
  LEFT JOIN (SELECT DISTINCT schema_id FROM {FOLDED} WHERE column_name <> 'absent') t ON t.schema_id = s.schema_id""")
def patched_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feedback applied: patches of absent columns do nothing, patched schemas get a version."""
    schemas = part_schemas(spark, sf_dir)
    revised = apply_patches(schemas, event_patches(spark, sf_dir))
    count = F.try_variant_get(F.try_element_at("metadata", F.lit("refinement_version")), "$", "int")
    return revised.select(
        "schema_id", "version", count.alias("refinement_version"), F.posexplode("columns").alias("pos", "c")
    ).select(
        "schema_id", "version", "refinement_version", "pos", "c.name", "c.type", "c.description",
        "c.nullable", "c.format",
    )


@query("""
  SELECT p_partkey AS schema_id, CASE p_partkey % 3 WHEN 0 THEN 'new ' || p_name ELSE p_name END AS name,
         CAST(CASE p_partkey % 3 WHEN 0 THEN 1 ELSE 2 END AS INTEGER) AS columns,
         CAST(CASE p_partkey % 3 WHEN 0 THEN 1 ELSE 0 END AS INTEGER) AS version,
         CASE p_partkey % 3 WHEN 0 THEN 'true' END AS feedback, p_size AS table_index
  FROM part""")
def refinement_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model revisions: taken where they load, else the original stays."""
    schemas = part_schemas(spark, sf_dir)
    number = F.col("p_partkey") % 3
    good = F.concat(
        F.lit('Sure: {"name":'), json_text(F.concat(F.lit("new "), F.col("p_name"))),
        F.lit(',"columns":[{"name":"a","type":"int"}]}'),
    )
    answers = render.load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("schema_id"),
        F.when(number == 0, good).when(number == 1, "Error: down").otherwise('{"columns":[]}').alias("doc"),
    )
    refined = refine(schemas, load_strict(answers))
    return refined.select(
        "schema_id", "name", F.size("columns").alias("columns"), "version",
        F.try_variant_get(F.try_element_at("metadata", F.lit("feedback_incorporated")), "$", "string").alias("feedback"),
        F.try_variant_get(F.try_element_at("metadata", F.lit("table_index")), "$", "int").alias("table_index"),
    )


@query("""
  SELECT p_partkey AS schema_id, CAST(CASE WHEN p_size % 2 = 0 THEN p_size ELSE 0 END + 2 AS INTEGER) AS refinement_version,
         true AS feedback_incorporated, 2 AS version FROM part""")
def version_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refinement counters go on from what is there."""
    schemas = attach_metadata(
        part_schemas(spark, sf_dir).select("schema_id", "version", F.col("metadata")),
        refinement_version=F.when(F.try_variant_get(F.try_element_at("metadata", F.lit("table_index")), "$", "int") % 2 == 0,
                                  F.try_variant_get(F.try_element_at("metadata", F.lit("table_index")), "$", "int")),
    )
    stamped = stamp_version(stamp_version(schemas))
    return stamped.select(
        "schema_id", "version",
        F.try_variant_get(F.try_element_at("metadata", F.lit("refinement_version")), "$", "int").alias("refinement_version"),
        F.try_variant_get(F.try_element_at("metadata", F.lit("feedback_incorporated")), "$", "boolean").alias("feedback_incorporated"),
    )


@query("SELECT p_partkey AS schema_id, 2 AS columns FROM part")
def column_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of columns per schema."""
    return column_counts(part_schemas(spark, sf_dir))


@query("""
  SELECT p_partkey AS schema_id, unnest([0, 1]) AS pos, unnest([p_brand, 'size']) AS "Name",
         unnest(['string', 'int']) AS "Type", unnest(['the ' || p_brand, 'the size']) AS "Description",
         unnest([CASE WHEN p_size % 2 = 0 THEN 'Yes' ELSE 'No' END, 'Yes']) AS "Nullable"
  FROM part""")
def column_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns as they are shown for review."""
    return review_view(part_schemas(spark, sf_dir))


@query(f"""
  SELECT p_partkey AS schema_id, CASE WHEN p_size % 2 = 0 THEN p_name ELSE '{NULL_NAME}' END AS name,
         CAST(CASE WHEN p_size % 2 = 0 THEN 2 ELSE 0 END AS INTEGER) AS columns,
         CASE WHEN p_size % 2 <> 0 THEN '{NULL_TEXT}' END AS note
  FROM part""")
def missing_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys without a schema get a placeholder."""
    schemas = part_schemas(spark, sf_dir)
    size = F.try_variant_get(F.try_element_at("metadata", F.lit("table_index")), "$", "int")
    filled = fill_missing_schemas(schemas, schemas.filter(size % 2 == 0))
    return filled.select(
        "schema_id", "name", F.size("columns").alias("columns"),
        F.when(F.col("name") == NULL_NAME, F.col("description")).alias("note"),
    )


@query("""
  SELECT p_partkey AS schema_id, CASE WHEN p_size % 3 = 0 THEN p_name ELSE 'raw ' || p_name END AS doc
  FROM part WHERE p_size % 3 < 2""")
def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is written: the document, the raw text where it did not load, nothing for errors."""
    number = F.col("p_size") % 3
    return format_raw(
        render.load(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("schema_id"),
            F.when(number == 0, "Success").when(number == 1, "Error: Invalid JSON").otherwise("Error").alias("status"),
            F.col("p_name").alias("doc"),
            F.concat(F.lit("raw "), F.col("p_name")).alias("raw"),
        )
    )


@query(f"""
  SELECT o_orderkey AS schema_id, 'Success' AS status, 'Order ' || o_orderkey AS name, 'Order ' || o_orderkey AS table_caption,
         3 AS column_count, 5 AS sample_rows_count, true AS has_sample_data, 'order/' || o_orderkey AS source_url, 0 AS table_index
  FROM orders UNION ALL
  SELECT page_id, 'Error: No tables found', NULL, NULL, NULL, NULL, NULL, url, NULL FROM pages""")
def page_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages to schemas in one go, with the metadata of table and source."""
    pages = render.order_pages(spark, sf_dir).unionByName(raw_pages(spark, sf_dir))
    schemas = document_schemas(page_documents(pages))

    def meta(name: str, kind: str) -> Column:
        return F.try_variant_get(F.try_element_at("metadata", F.lit(name)), "$", kind).alias(name)

    return schemas.select(
        "schema_id", "status", "name", meta("table_caption", "string"), meta("column_count", "int"),
        meta("sample_rows_count", "int"), meta("has_sample_data", "boolean"), meta("source_url", "string"),
        meta("table_index", "int"),
    )


@query("""
  SELECT p_partkey AS schema_id, 'Database Schema' AS name, 'part_' || p_partkey || '.csv' AS source_file,
         'int,string,string,string,string,string,string,string' AS types
  FROM part""")
def csv_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV texts to schemas in one go, one column per header."""
    schemas = document_schemas(csv_documents(render.part_csv(spark, sf_dir)), kind="file")
    return schemas.select(
        "schema_id", "name",
        F.try_variant_get(F.try_element_at("metadata", F.lit("source_file")), "$", "string").alias("source_file"),
        F.array_join("columns.type", ",").alias("types"),
    )


@query("""
  SELECT page_id AS schema_id, CASE WHEN page_id % 3 = 2 THEN 'kaggle' END AS source_type,
         CASE WHEN page_id % 3 <> 1 THEN url END AS source_url,
         CASE WHEN page_id % 3 = 1 THEN regexp_extract(url, '[^/]*$') END AS source_file,
         CASE WHEN page_id % 3 = 2 THEN regexp_extract(url, '[^/]*$') END AS csv_file,
         CASE WHEN page_id % 3 <> 2 THEN CAST(page_id AS INTEGER) END AS table_index
  FROM pages""")
def source_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata members by kind of source."""
    pages = raw_pages(spark, sf_dir)
    kinds = F.get(F.array(*[F.lit(k) for k in ("url", "file", "dataset")]), (F.col("doc_id") % 3).cast("int"))
    tagged = pages.select(F.col("doc_id").alias("schema_id"), "source", kinds.alias("kind"))
    members = source_metadata(F.col("kind"), F.col("source"), F.col("schema_id").cast("int"))

    def meta(name: str, kind: str = "string") -> Column:
        return F.try_variant_get(F.try_element_at("metadata", F.lit(name)), "$", kind).alias(name)

    return attach_metadata(tagged, **members).select(
        "schema_id", meta("source_type"), meta("source_url"), meta("source_file"), meta("csv_file"),
        meta("table_index", "int"),
    )
