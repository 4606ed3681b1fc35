"""Queries over extraction: markup rendered from tables, read back, and compared."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.operators.extract import (
    align_rows,
    aligned_cells,
    cells_of,
    extract_tables,
    find_captions,
    find_status,
    find_tables,
    headers_of,
    tables_of,
    texts_of,
    to_wide,
)
from pagetables.operators.shred import shred
from pagetables.plans import render
from pagetables.plans.reading import raw_pages
from pagetables.plans.registry import (
    DOCUMENT_CELLS,
    DOCUMENT_HEADERS,
    LINES,
    ORDER_ROWS,
    day,
    money,
    query,
)


def tables(pages: DataFrame, **options) -> DataFrame:
    return tables_of(extract_tables(shred(pages), **options))


@query("""
  SELECT page_id AS doc_id, CAST((length(html) - length(replace(html, '<div class="ad">', ''))) / 16 AS BIGINT) AS divs,
         CAST((length(html) - length(replace(html, '<h1>', ''))) / 4 AS BIGINT) AS headings
  FROM pages""")
def page_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the given pages, by tag."""
    tags = F.col("nodes.tag")

    def count(tag: str):
        return F.size(F.filter(tags, lambda t: t == tag)).cast("bigint")

    return shred(raw_pages(spark, sf_dir)).select(
        "doc_id", count("div").alias("divs"), count("h1").alias("headings")
    )


@query("""
  SELECT doc_id, unnest([0, 1, 2]) AS table_id, 'table' AS kind FROM documents""")
def table_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of the document pages, the nested one included."""
    return find_tables(shred(render.document_pages(spark, sf_dir))).select("doc_id", "table_id", "kind")


@query("SELECT p_partkey AS doc_id, unnest([0, 1]) AS table_id, 'div' AS kind FROM part")
def implicit_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of pages that only have styled ``div`` elements."""
    return find_tables(shred(render.part_pages(spark, sf_dir))).select("doc_id", "table_id", "kind")


@query("SELECT page_id AS doc_id, 'No tables found' AS status, 0 AS tables_count FROM pages")
def page_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of the given pages; the filter before the parser keeps their rows."""
    return find_status(shred(raw_pages(spark, sf_dir), prefilter=True)).drop("source")


@query("""
  SELECT doc_id, unnest(['h2', 'caption']) AS tag, unnest([lang || 'one', source]) AS text
  FROM documents WHERE doc_id % 2 = 0
  UNION ALL SELECT doc_id, 'caption', source FROM documents WHERE doc_id % 2 <> 0""")
def element_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heading and caption texts; text nodes are joined without a separator."""
    return texts_of(shred(render.document_pages(spark, sf_dir)), "h2", "caption").select(
        "doc_id", "tag", "text"
    )


@query("""
  SELECT o_orderkey AS doc_id, 0 AS table_id, unnest([0, 1, 2]) AS pos,
         unnest(['Attr', 'Label', 'Attr_1']) AS name
  FROM orders""")
def header_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers from ``th`` elements, a repeated name numbered."""
    return headers_of(tables(render.order_pages(spark, sf_dir)))


@query(f"SELECT * FROM {DOCUMENT_HEADERS}")
def header_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers from ``thead`` or from the first row, repeats numbered."""
    return headers_of(tables(render.document_pages(spark, sf_dir)))


@query("SELECT p_partkey AS doc_id, 0 AS table_id, 0 AS pos, '' AS name FROM part")
def header_divs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers from classed ``div`` elements."""
    return headers_of(tables(render.part_pages(spark, sf_dir)))


@query(f"SELECT * FROM {DOCUMENT_CELLS} WHERE row_no < 5")
def sample_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of the first five rows after the header row."""
    return cells_of(tables(render.document_pages(spark, sf_dir)))


@query(f"SELECT * FROM {DOCUMENT_CELLS}")
def all_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without a limit: whole texts through markup and back."""
    return cells_of(tables(render.document_pages(spark, sf_dir), sample=None))


@query("""
  SELECT doc_id, 0 AS table_id, CAST(n AS INTEGER) AS pos,
         array_to_string(c[n + 1:], '') || chr(124) || array_to_string(rest, '') AS value
  FROM (SELECT doc_id, c, rest, unnest(range(len(c))) AS n
        FROM (SELECT doc_id, string_split(ls[1], ' ') AS c, string_split(array_to_string(ls[2:], ' '), ' ') AS rest
              FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)))""")
def unclosed_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells and rows that are never closed: each holds all that follow it."""
    found = tables(render.unclosed_pages(spark, sf_dir), sample=0)
    return found.select("doc_id", "table_id", F.posexplode("headers").alias("pos", "value"))


@query("""
  SELECT doc_id, table_id, CAST(row_no AS INTEGER) AS row_no, CAST(unnest(range(len(c))) AS INTEGER) AS pos, unnest(c) AS value
  FROM (SELECT doc_id, unnest([1, 2]) AS table_id, 0 AS row_no,
               [source, CAST(n_chars AS VARCHAR), 'x'] AS c FROM documents)""")
def nested_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a nested table count for the outer table as well."""
    return cells_of(tables(render.document_pages(spark, sf_dir)).filter("table_id > 0"))


@query(f"""
  SELECT doc_id, 0 AS table_id, CAST(row_no AS INTEGER) AS row_no, CAST(unnest(range(len(c))) AS INTEGER) AS pos, unnest(c) AS value
  FROM (
    SELECT s_suppkey AS doc_id, 0 AS row_no, [CAST(s_suppkey AS VARCHAR), s_name || 'x', {money('s_acctbal')}] AS c FROM supplier
    UNION ALL SELECT s_suppkey, 1, ['ab' || s_nationkey, CAST(s_nationkey AS VARCHAR)] FROM supplier
    UNION ALL SELECT s_suppkey, 2, ['last', '&<>', CAST(s_nationkey AS VARCHAR)] FROM supplier)""")
def blank_rows_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank rows go after the cut; comments split text; an open cell holds the next one."""
    return cells_of(tables(render.supplier_pages(spark, sf_dir)))


@query(f"""
  SELECT p_partkey AS doc_id, 0 AS table_id, unnest([0, 0, 1, 1, 2, 2, 3, 3]) AS row_no,
         unnest([0, 1, 0, 1, 0, 1, 0, 1]) AS pos,
         unnest(['name', p_name, 'brand', p_brand, 'type', p_type, 'size', CAST(p_size AS VARCHAR)]) AS value
  FROM part""")
def div_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and cells from classed ``div`` elements."""
    return cells_of(tables(render.part_pages(spark, sf_dir)))


@query("""
  SELECT c_custkey AS doc_id, true AS is_vertical FROM customer
  UNION ALL SELECT o_orderkey, false FROM orders""")
def vertical_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The property-value test on tables of both kinds."""
    pages = render.customer_pages(spark, sf_dir).unionByName(
        render.order_pages(spark, sf_dir).select("doc_id", "html")
    )
    return tables(pages).select("doc_id", "is_vertical")


@query(f"""
  SELECT c_custkey AS doc_id, unnest([0, 1, 2, 3, 4, 5]) AS pos,
         unnest(['Name', 'Key', 'Nation', 'Balance', 'Segment', 'Segment']) AS name,
         unnest([c_name, CAST(c_custkey AS VARCHAR), CAST(c_nationkey AS VARCHAR), {money('c_acctbal')},
                 c_mktsegment, c_mktsegment]) AS value
  FROM customer""")
def vertical_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Property-value tables turned into one row; names are not numbered."""
    return aligned_cells(tables(render.customer_pages(spark, sf_dir))).select(
        "doc_id", "pos", "name", "value"
    )


@query("""
  SELECT o_orderkey AS doc_id, 'order' AS origin, 0 AS table_id, 'Order ' || o_orderkey AS caption FROM orders
  UNION ALL SELECT p_partkey, 'part', unnest([0, 1]), p_name FROM part
  UNION ALL SELECT doc_id, 'document', unnest([0, 1, 2]),
                   CASE WHEN doc_id % 2 = 0 THEN lang || 'one'
                        ELSE unnest(['', source, '']) END FROM documents""")
def captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captions from an earlier heading of the highest level, else from the table."""
    sources = {
        "order": render.order_pages(spark, sf_dir).select("doc_id", "html"),
        "part": render.part_pages(spark, sf_dir),
        "document": render.document_pages(spark, sf_dir),
    }
    parts = [pages.withColumn("origin", F.lit(name)) for name, pages in sources.items()]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return find_captions(shred(whole))


@query(f"""
  SELECT l.doc_id, t.table_id, t.caption, t.column_count, t.row_count, t.is_vertical
  FROM (SELECT doc_id, lang, source, line_count, min(CASE WHEN line_no = 0 THEN line END) AS line0
        FROM {LINES} GROUP BY ALL) l,
  LATERAL (
    SELECT 0 AS table_id, CASE WHEN doc_id % 2 = 0 THEN lang || 'one' ELSE '' END AS caption,
           CAST(CASE WHEN doc_id % 2 = 0 THEN 2 ELSE 1 + len(string_split(line0, ' ')) END AS INTEGER) AS column_count,
           CAST(CASE WHEN doc_id % 2 = 0 OR line_count = 1 THEN least(5, line_count) ELSE least(5, line_count - 1) END AS INTEGER) AS row_count,
           false AS is_vertical
    UNION ALL SELECT 1, CASE WHEN doc_id % 2 = 0 THEN lang || 'one' ELSE source END, 6, 1, false
    UNION ALL SELECT 2, CASE WHEN doc_id % 2 = 0 THEN lang || 'one' ELSE '' END, 3, 1, false) t""")
def assembled_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables with their caption and counts; the row count is that of the sample."""
    return tables(render.document_pages(spark, sf_dir)).select(
        "doc_id", "table_id", "caption", "column_count", "row_count", "is_vertical"
    )


@query(f"""
  WITH cells AS (SELECT * FROM {DOCUMENT_CELLS} WHERE row_no < 5)
  SELECT g.doc_id, g.table_id, g.row_no, h.pos, h.name, coalesce(c.value, '') AS value
  FROM (SELECT DISTINCT doc_id, table_id, row_no FROM cells) g
  JOIN {DOCUMENT_HEADERS} h ON h.doc_id = g.doc_id AND h.table_id = g.table_id
  LEFT JOIN cells c ON c.doc_id = g.doc_id AND c.table_id = g.table_id AND c.row_no = g.row_no AND c.pos = h.pos""")
def aligned_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample rows padded and cut to the headers."""
    found = tables(render.document_pages(spark, sf_dir))
    return aligned_cells(found).select("doc_id", "table_id", "row_no", "pos", "name", "value")


@query(f"""
  SELECT doc_id, 0 AS table_id, CAST(row_no AS INTEGER) AS row_no, CAST(row_no AS VARCHAR) AS attr,
         name AS label, value
  FROM {ORDER_ROWS} WHERE row_no < 5""")
def wide_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample rows as a wide table."""
    return to_wide(align_rows(tables(render.order_pages(spark, sf_dir))), ["attr", "label", "value"])


LINE_ITEM_VALUES = ", ".join(
    f"CAST({c} AS VARCHAR)" if f is render.text else (money(c) if f is render.money else day(c))
    for c, f in render.LINE_FIELDS.items()
)


@query(f"""
  SELECT l_orderkey, unnest([{', '.join(f"'{c}'" for c in render.LINE_FIELDS)}]) AS name,
         unnest([{LINE_ITEM_VALUES}]) AS value
  FROM lineitem""")
def line_item_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as a page, and every cell back from it."""
    return aligned_cells(tables(render.lineitem_pages(spark, sf_dir)), "l_orderkey").select(
        "l_orderkey", "name", "value"
    )
