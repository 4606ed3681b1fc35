"""Whole runs: documents in, schemas out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetables.functions.rows import once
from pagetables.functions.text import basename, bind
from pagetables.operators.csvschema import csv_tables, definition_rows, describes_schema, roles
from pagetables.operators.extract import extract_tables
from pagetables.operators.infer import table_columns
from pagetables.operators.parse import (
    HEADER_NAME,
    HEADER_TEXT,
    NO_HEADERS,
    fallback_schema,
    load_strict,
    normalise_schema,
    parse_schema_text,
)
from pagetables.operators.prompts import (
    RESPONSE_COLUMNS,
    kind_of,
    refine_prompts,
    run_model,
    table_prompt,
)
from pagetables.operators.schemas import (
    attach_metadata,
    definition_columns,
    refine,
    source_metadata,
    table_metadata,
    to_json_docs,
)
from pagetables.operators.select import (
    analysis_prompt,
    recommended_index,
    select_files,
    select_tables,
)
from pagetables.operators.shred import shred
from pagetables.sources.csvsamples import csv_samples
from pagetables.sources.csvtext import parse_csv
from pagetables.sources.files import DEFAULT_MAX_MB, guard_size


def page_documents(pages: DataFrame, max_mb: float | None = None, **options) -> DataFrame:
    """``pages(doc_id, source, html)`` to documents.  Narrow: one stage, no exchange.

    Pages of any size are read; files have passed the guard of ``read_files``.
    """
    guarded = pages if max_mb is None else guard_size(pages, max_mb)
    return extract_tables(shred(guarded, prefilter=True), **options)


def csv_documents(files: DataFrame, max_mb: float | None = None, sample: int = 5) -> DataFrame:
    """``files(doc_id, source, content)`` to documents.  Narrow as well."""
    guarded = files if max_mb is None else guard_size(files, max_mb, "content")
    return csv_tables(parse_csv(guarded), sample)


def dataset_schemas(
    files: DataFrame, choices: DataFrame | None = None, sample: int = 100
) -> DataFrame:
    """``files(dataset, path, content)`` to one schema a dataset, from the first rows of its
    chosen CSV file (see ``select_files``).  The choice is made on names; only the contents of
    chosen files are parsed."""
    chosen = select_files(files.select("dataset", "path"), choices)
    held = files.join(chosen, ["dataset", "path"], "left_semi")
    texts = held.select(F.col("path").alias("doc_id"), F.col("path").alias("source"), "content")
    return document_schemas(csv_documents(texts, sample=sample), kind="dataset")


def dataset_file_schemas(
    listing: DataFrame, choices: DataFrame | None = None, n: int = 100, max_mb: float = DEFAULT_MAX_MB
) -> DataFrame:
    """``dataset_schemas`` of files by name: ``listing(dataset, path)`` is all that moves.  A chosen
    file is opened where the choice is made and read as far as its first ``n`` records."""
    chosen = select_files(listing.select("dataset", "path"), choices)
    sampled = csv_samples(chosen.select("path"), n, max_mb)
    grids = sampled.select(F.col("path").alias("doc_id"), F.col("path").alias("source"), "status", "rows")
    return document_schemas(csv_tables(grids, n), kind="dataset")


def described_schemas(files: DataFrame) -> DataFrame:
    """Schemas as ``parse_csv`` rows describe them; other CSV texts give no row.

    This reads the definitions themselves, where ``document_schemas`` infers a schema of
    the describing table.
    """
    rows = F.col("rows")
    found = bind(roles(F.get(rows, F.lit(0))), lambda role: definition_rows(rows, role))
    described = files.filter(F.col("status").isNull() & describes_schema(rows).isNotNull())
    schemas = once(described, columns=definition_columns(found)).select(
        F.col("doc_id").alias("schema_id"),
        F.lit(0).alias("version"),
        basename(F.col("source")).alias("name"),
        F.lit("Database Schema").alias("description"),
        "columns",
        "source",
    )
    return attach_metadata(
        schemas, column_count=F.size("columns"), source_file=basename(F.col("source"))
    ).drop("source")


def advised_documents(
    documents: DataFrame, model_fn: Callable[[str, dict], dict], **options
) -> DataFrame:
    """Documents with a model's ``recommended`` table beside them, for ``select_tables``.

    The answer arrives in the document's row, so pages are parsed once and nothing is joined.
    """
    answers = run_model(documents.withColumn("prompt", analysis_prompt()), model_fn, **options)
    return answers.select(*documents.columns, recommended_index(F.col("content")).alias("recommended"))


def model_schemas(
    documents: DataFrame, model_fn: Callable[[str, dict], dict], kind: str = "url", **options
) -> DataFrame:
    """The schema of each document's selected table as a model describes it.

    Prompt, call, parsing, defaults and metadata happen in the document's row: nothing is
    joined, and every page is parsed once.  Tables without headers are not asked about.  A
    failed call or an unusable answer falls back to the headers, with its status.  The usage
    columns of ``run_model`` stay beside the schema; ``metrics.metrics_of`` makes log rows of
    them.  Write the result before using it twice: a plan that runs again asks again.
    """
    table = F.col("table")
    asked = once(select_tables(documents), ready=F.col("status")).drop("status", "tables", "tables_count")
    kinds = F.when(F.col("ready") == "Success", kind_of(table))
    # Of the table, only what the schema says of it goes to the call and back.
    known = table_metadata(table)
    prompts = asked.select(
        "doc_id", "source", "table_index", "ready",
        table.isNull().alias("no_table"),
        F.coalesce(table["headers"], F.array().cast("array<string>")).alias("headers"),
        *[value.alias(name) for name, value in known.items()],
        table_prompt(table, kinds).alias("prompt"),
    )
    answers = parse_schema_text(run_model(prompts, model_fn, **options))
    schemas = fallback_schema(normalise_schema(answers, "has_sample_data"))
    failed = F.when(
        F.col("ready") != "Success", F.concat(F.lit("Error: "), F.regexp_replace("ready", "^Error: ", ""))
    ).when(F.col("no_table"), "Error: No table selected")
    flat = schemas.select(
        F.col("doc_id").alias("schema_id"),
        F.lit(0).alias("version"),
        F.coalesce(failed, F.when(F.col("status") == "parsed", "Success").otherwise(F.col("status"))).alias("status"),
        "source", "table_index", *known, "name", "description", "columns",
        *[c for c in RESPONSE_COLUMNS if c != "content"],
    )
    members = {**{name: F.col(name) for name in known}, **source_metadata(F.lit(kind), F.col("source"), F.col("table_index"))}
    return attach_metadata(flat, **members).drop("source", "table_index", *known)


def revised_schemas(
    schemas: DataFrame, feedback: DataFrame, model_fn: Callable[[str, dict], dict], **options
) -> DataFrame:
    """One round of feedback through a model: prompt, call, strict reading, new version.

    ``feedback(schema_id, text)`` has one row a schema; schemas without one, and those whose
    answer can't be read, stay as they are.  For several rounds, write each result and give
    it to the next call.
    """
    prompts = refine_prompts(to_json_docs(schemas), feedback)
    answers = run_model(prompts, model_fn, **options).select("schema_id", F.col("content").alias("doc"))
    return refine(schemas, load_strict(answers))


def document_schemas(
    documents: DataFrame,
    kind: str = "url",
) -> DataFrame:
    """Select one table per document (see ``select_tables``) and infer its schema.

    Documents without a selectable table keep their row, with an error status.  ``kind``
    says what ``source`` is: ``url``, ``file`` or ``dataset``.
    """
    selected = select_tables(documents)
    table = F.col("table")
    status = (
        F.when(F.col("status") != "Success", F.concat(F.lit("Error: "), F.regexp_replace("status", "^Error: ", "")))
        .when(table.isNull(), "Error: No table selected")
        .when(F.size(table["headers"]) == 0, NO_HEADERS)
        .otherwise("Success")
    )
    staged = selected.withColumn("status", status)
    ok = F.col("status") == "Success"
    named = F.nullif(table["caption"], F.lit(""))
    schemas = once(staged, columns=F.when(ok, table_columns(table))).select(
        F.col("doc_id").alias("schema_id"),
        F.lit(0).alias("version"),
        "status",
        F.col("source"),
        "table_index",
        "table",
        F.when(ok, F.coalesce(named, F.lit(HEADER_NAME))).alias("name"),
        F.when(ok, HEADER_TEXT).alias("description"),
        "columns",
    )
    members = {**table_metadata(table), **source_metadata(F.lit(kind), F.col("source"), F.col("table_index"))}
    return attach_metadata(schemas, **members).drop("source", "table_index", "table")
