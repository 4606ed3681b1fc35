"""Queries over sources, guards, routing and the written forms of documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.functions.shared import new_path
from pagetables.functions.text import basename, dataset_id
from pagetables.operators.csvschema import csv_tables
from pagetables.operators.extract import page_status, tables_of, texts_of
from pagetables.operators.infer import infer_tables
from pagetables.operators.shred import shred
from pagetables.plans import render
from pagetables.plans.registry import LINES, query
from pagetables.sources.csvsamples import read_csv_samples
from pagetables.sources.csvsplits import read_csv_records
from pagetables.sources.csvtext import parse_csv
from pagetables.sources.documents import format_of, with_extension
from pagetables.sources.files import guard_size, list_csv, read_html_files, read_pages, route_source
from pagetables.sources.named import read_named, write_named


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_pages(spark, f"{sf_dir}/pages.parquet", "page_id", "url", "html")


@query("SELECT page_id AS doc_id, url AS source, length(html) AS chars FROM pages")
def page_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages from a table, with their length."""
    return raw_pages(spark, sf_dir).select(
        "doc_id", "source", F.char_length("html").cast("bigint").alias("chars")
    )


HEADING_SQL = r"""
  SELECT page_id AS doc_id, 'h1' AS tag,
         replace(replace(replace(replace(trim(regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')),
           '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&') AS text
  FROM pages"""


@query(HEADING_SQL)
def binary_page_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings of pages that arrive as bytes, as files do."""
    pages = raw_pages(spark, sf_dir).withColumn("html", F.encode("html", "UTF-8"))
    return texts_of(shred(pages), "h1").select("doc_id", "tag", "text")


@query("""
  SELECT page_id AS doc_id,
         CASE WHEN strlen(html) > 3145 THEN 'Error: File size (' ||
              format('{:.2f}', strlen(html) / 1048576.0) || ' MB) exceeds maximum (0.003 MB)' END AS status,
         strlen(html) <= 3145 AS kept
  FROM pages""")
def oversize_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages over a small limit lose their content and get a status."""
    return guard_size(raw_pages(spark, sf_dir), max_mb=0.003).select(
        "doc_id", "status", F.col("html").isNotNull().alias("kept")
    )


ROUTED = """(
  SELECT page_id AS doc_id, CASE page_id % 4 WHEN 0 THEN url || '/data.csv'
         WHEN 1 THEN 'https://www.kaggle.com/datasets/owner/set-' || page_id || '/'
         WHEN 2 THEN url || '/DATA.CSV' ELSE url END AS source
  FROM pages)"""


def routed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("doc_id") % 4
    address = F.concat(
        F.lit("https://www.kaggle.com/datasets/owner/set-"), F.col("doc_id").cast("string"), F.lit("/")
    )
    return raw_pages(spark, sf_dir).select(
        "doc_id",
        F.when(number == 0, F.concat("source", F.lit("/data.csv")))
        .when(number == 1, address)
        .when(number == 2, F.concat("source", F.lit("/DATA.CSV")))
        .otherwise(F.col("source"))
        .alias("source"),
    )


@query(f"""
  SELECT doc_id, source, CASE WHEN contains(source, 'kaggle.com/datasets') THEN 'dataset'
         WHEN suffix(source, '.csv') THEN 'csv' ELSE 'html' END AS kind
  FROM {ROUTED} t""")
def source_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources by kind."""
    return route_source(routed_sources(spark, sf_dir))


@query(f"""
  SELECT doc_id, p[-2] || '/' || p[-1] AS dataset, regexp_extract(source, '[^/]*$') AS base
  FROM (SELECT *, string_split(rtrim(source, '/'), '/') AS p FROM {ROUTED} t)""")
def dataset_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dataset names and base names of sources."""
    source = F.col("source")
    return routed_sources(spark, sf_dir).select(
        "doc_id", dataset_id(source).alias("dataset"), basename(source).alias("base")
    )


@query(f"""
  SELECT doc_id, line_no + 1 AS row_no, unnest([0, 1]) AS pos,
         unnest([CAST(line_no AS VARCHAR), line]) AS value
  FROM {LINES}
  UNION ALL SELECT doc_id, 0, unnest([0, 1]), unnest(['no', 'line']) FROM documents""")
def csv_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell of the CSV texts made of whole documents."""
    rows = parse_csv(render.document_csv(spark, sf_dir)).select(
        "doc_id", F.posexplode("rows").alias("row_no", "cells")
    )
    return rows.select("doc_id", "row_no", F.posexplode("cells").alias("pos", "value"))


@query("""
  SELECT CAST(doc_id AS VARCHAR) AS name, CAST(unnest(range(len(ls))) AS BIGINT) AS pos, unnest(ls) AS value
  FROM (SELECT doc_id, [CAST(doc_id AS VARCHAR), coalesce(lang, ''), coalesce(source, ''), coalesce(text, '')] AS ls FROM documents)""")
def split_csv_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents written as CSV files and read back over splits: line ends, commas and
    quotes within a text, and a file that many tasks read."""
    folder = new_path(spark, "csv")
    docs = render.load(spark, sf_dir, "documents")
    quoted = [
        F.concat(F.lit('"'), F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
        for c in ("doc_id", "lang", "source", "text")
    ]
    docs.select(F.concat_ws(",", *quoted).alias("value")).write.text(folder)
    rows = read_csv_records(spark, folder, chunk_bytes=65_536)
    return rows.select(F.col("cells")[0].alias("name"), F.posexplode("cells").alias("pos", "value")).select(
        "name", F.col("pos").cast("long").alias("pos"), "value"
    )


@query("""
  SELECT o_orderkey AS doc_id, CASE o_orderkey % 3
           WHEN 0 THEN 'Error: ''utf-8'' codec can''t decode byte 0xff in position 0: invalid start byte'
           WHEN 1 THEN 'Error: Empty CSV file' ELSE 'Success' END AS status,
         CASE WHEN o_orderkey % 3 = 2 THEN 1 ELSE 0 END AS tables_count
  FROM orders""")
def error_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unreadable, empty and good CSV bytes: every document keeps a row with its status."""
    orders = render.load(spark, sf_dir, "orders")
    number = F.col("o_orderkey") % 3
    content = (
        F.when(number == 0, F.unhex(F.lit("FF")))
        .when(number == 1, F.unhex(F.lit("")))
        .otherwise(F.encode(F.concat(F.lit("a,b\n"), F.col("o_orderstatus"), F.lit(",1\n")), "UTF-8"))
    )
    files = orders.select(
        F.col("o_orderkey").alias("doc_id"), F.lit("x.csv").alias("source"), content.alias("content")
    )
    return page_status(csv_tables(parse_csv(files)))


@query(f"""
  SELECT doc_id, source, CASE WHEN suffix(source, '.csv') THEN 'text' WHEN doc_id % 4 = 1 THEN 'yaml'
           WHEN doc_id % 4 = 2 THEN 'json' ELSE 'text' END AS format,
         CASE doc_id % 4 WHEN 1 THEN source || 'a.yml' WHEN 2 THEN source || '.json'
           ELSE source || '.txt' END AS path
  FROM {ROUTED} t""")
def output_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats by suffix, and the suffix added where it is missing."""
    number = F.col("doc_id") % 4
    target = F.when(number == 1, F.concat("source", F.lit("a.yml"))).when(
        number == 2, F.concat("source", F.lit(".json"))
    ).otherwise(F.col("source"))
    return routed_sources(spark, sf_dir).select(
        "doc_id", "source", format_of(target).alias("format"),
        with_extension(target, format_of(target)).alias("path"),
    )


def written_files(spark: SparkSession, docs: DataFrame, extension: str) -> str:
    """Documents as files of a new folder; the pattern of the folders that hold them."""
    folder = new_path(spark, "files")
    write_named(docs, folder, extension)
    return f"{folder}/docs-*/*/*"


def stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)\.[a-z]+$", 1).cast("bigint")


@query("""
  SELECT source || '/' || coalesce(lang, '') || '/' || doc_id AS schema_id,
         replace(source || '/' || coalesce(lang, '') || '/' || doc_id, '/', '%2F') || '.txt' AS name,
         text AS doc FROM documents""")
def text_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents written as one text file each, and read back."""
    folder = new_path(spark, "texts")
    key = F.concat_ws("/", "source", F.coalesce("lang", F.lit("")), "doc_id")
    write_named(render.load(spark, sf_dir, "documents").select(key.alias("schema_id"), F.col("text").alias("doc")), folder, ".txt")
    return read_named(spark, folder).select("schema_id", basename(F.col("file")).alias("name"), "doc")


@query(HEADING_SQL)
def file_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings of pages that are files of their own."""
    pages = raw_pages(spark, sf_dir).select(F.col("doc_id").alias("schema_id"), F.col("html").alias("doc"))
    files = read_html_files(spark, written_files(spark, pages, ".html"), pattern="*.html")
    return texts_of(shred(files), "h1").select(stem(F.col("doc_id")).alias("doc_id"), "tag", "text")


def document_files(spark: SparkSession, sf_dir: str) -> str:
    """The CSV texts of ``document_csv`` as files."""
    docs = render.document_csv(spark, sf_dir).select(F.col("doc_id").alias("schema_id"), F.col("content").alias("doc"))
    return written_files(spark, docs, ".csv")


@query(f"""
  SELECT doc_id, CAST(strlen('no,line' || string_agg(chr(10) || line_no || ',"' || replace(line, '"', '""') || '"', '')) AS BIGINT) AS length
  FROM {LINES} GROUP BY doc_id""")
def listed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files by name and length."""
    return list_csv(spark, document_files(spark, sf_dir)).select(stem(F.col("path")).alias("doc_id"), "length")


SAMPLED_RECORDS = 3


@query(f"""
  SELECT doc_id, 'no,line' AS names, 'int' AS type, CAST(least(any_value(line_count), {SAMPLED_RECORDS}) AS BIGINT) AS records,
         CAST(least(any_value(line_count), {SAMPLED_RECORDS}) - 1 AS DOUBLE) AS maximum,
         max_by(line, line_no) FILTER (line_no < {SAMPLED_RECORDS}) AS last
  FROM {LINES} GROUP BY doc_id""")
def sampled_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed columns of the first records of every file."""
    files = read_csv_samples(spark, document_files(spark, sf_dir), SAMPLED_RECORDS)
    grids = files.select(stem(F.col("path")).alias("doc_id"), F.col("path").alias("source"), "status", "rows")
    tables = infer_tables(tables_of(csv_tables(grids, SAMPLED_RECORDS)))
    number = F.col("columns")[0]
    return tables.select(
        "doc_id", F.array_join("headers", ",").alias("names"), number["type"].alias("type"),
        F.size("rows").cast("long").alias("records"),
        F.try_variant_get(number["constraints"], "$.maximum", "double").alias("maximum"),
        F.element_at("rows", -1)[1].alias("last"),
    )
