"""Where queries register themselves with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name; ``sql`` gives the same rows on the same tables."""

    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


def text_literal(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def money(column: str) -> str:
    return f"CAST(CAST({column} AS DECIMAL(18,2)) AS VARCHAR)"


def day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


# The lines of every document, with their number and the number of lines.
LINES = """(
  SELECT doc_id, lang, source, n_chars, len(ls) AS line_count,
         CAST(unnest(range(len(ls))) AS INTEGER) AS line_no, unnest(ls) AS line
  FROM (SELECT *, string_split(text, chr(10)) AS ls FROM documents))"""

# The cells of the first table of ``document_pages``: the line number, then the words.
LINE_CELLS = f"""(
  SELECT doc_id, line_no, line_count, CAST(unnest(range(len(c))) AS INTEGER) AS pos, unnest(c) AS value
  FROM (SELECT *, list_prepend(CAST(line_no AS VARCHAR), string_split(line, ' ')) AS c FROM {LINES}))"""

# The three tables of ``document_pages``: the text by lines, and one table inside another.
# Their header names, repeats numbered, and the filled rows after the header row.
DOCUMENT_HEADERS = f"""(
  SELECT doc_id, table_id, pos, CASE WHEN k > 0 THEN value || '_' || k ELSE value END AS name
  FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id, table_id, value ORDER BY pos) - 1 AS k
    FROM (
      SELECT doc_id, 0 AS table_id, pos, value FROM {LINE_CELLS} WHERE line_no = 0 AND doc_id % 2 <> 0
      UNION ALL SELECT doc_id, 0, unnest([0, 1]), unnest(['line', 'text']) FROM documents WHERE doc_id % 2 = 0
      UNION ALL SELECT doc_id, 1, unnest([0, 1, 2, 3, 4, 5]),
        unnest([lang, source || n_chars || 'x', source, CAST(n_chars AS VARCHAR), 'x', 'z']) FROM documents
      UNION ALL SELECT doc_id, 2, unnest([0, 1, 2]), unnest([source, CAST(n_chars AS VARCHAR), 'x']) FROM documents)))"""

DOCUMENT_CELLS = f"""(
  SELECT doc_id, 0 AS table_id, CAST(line_no - first_line AS INTEGER) AS row_no, pos, value
  FROM (SELECT *, CASE WHEN doc_id % 2 = 0 OR line_count = 1 THEN 0 ELSE 1 END AS first_line FROM {LINE_CELLS})
  WHERE line_no >= first_line
  UNION ALL
  SELECT doc_id, unnest([1, 1, 1, 2, 2, 2]), 0, unnest([0, 1, 2, 0, 1, 2]),
         unnest([source, CAST(n_chars AS VARCHAR), 'x', source, CAST(n_chars AS VARCHAR), 'x']) FROM documents)"""

# Field rows of ``order_pages``: number, name, value.
ORDER_ROWS = f"""(
  SELECT o_orderkey AS doc_id, unnest([0, 1, 2, 3, 4, 5]) AS row_no,
         unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate',
                 'o_orderpriority']) AS name,
         unnest([CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus,
                 {money('o_totalprice')}, {day('o_orderdate')}, o_orderpriority]) AS value
  FROM orders)"""
