"""Nodes to tables, without leaving the document's row.

The functions that take and return columns work on ``nodes`` arrays and the page's text (see
``shred``); the DataFrame operators at the end apply them.  Cells stay elements, which say
where their text is, until it is known which of them are returned.  Because a table is found, sampled and captioned
inside its page's row, extraction needs no exchange, however many pages there are and
however they are distributed over sites.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetables.functions.rows import once
from pagetables.functions.text import bind, choose, contains_any, strip

# First cells that mark a property-value row.
PROPERTY_WORDS = (
    "name", "type", "description", "id", "key", "column", "property", "attribute", "field",
    "constraint", "value", "default", "null", "nullable", "required", "format", "length", "min",
    "max",
)

TABLE_TYPE = T.StructType(
    [
        T.StructField("table_id", T.IntegerType()),
        T.StructField("kind", T.StringType()),
        T.StructField("caption", T.StringType()),
        T.StructField("column_count", T.IntegerType()),
        T.StructField("row_count", T.IntegerType()),
        T.StructField("headers", T.ArrayType(T.StringType())),
        T.StructField("rows", T.ArrayType(T.ArrayType(T.StringType()))),
        T.StructField("is_vertical", T.BooleanType()),
        T.StructField(
            "properties",
            T.ArrayType(
                T.StructType(
                    [T.StructField("name", T.StringType()), T.StructField("value", T.StringType())]
                )
            ),
        ),
    ]
)
TABLES_TYPE = T.ArrayType(TABLE_TYPE)
NOT_KEPT = ("status", "nodes", "places", "page_text")


# --- elements ---------------------------------------------------------------------------


def inside(nodes: Column, element: Column) -> Column:
    """Descendants of an element."""
    return F.slice(nodes, element["id"] + 2, element["last"] - element["id"])


def within(places: Column, element: Column) -> Column:
    """Those of a page's ordered ``places`` that are inside an element, mostly all."""
    first, last = F.get(places, F.lit(0)), F.get(places, F.size(places) - 1)
    return choose(
        (first > element["id"]) & (last <= element["last"]),
        places,
        F.filter(places, lambda place: (place > element["id"]) & (place <= element["last"])),
    )


def at(nodes: Column, places: Column) -> Column:
    return F.transform(places, lambda place: F.get(nodes, place))


def element_text(text: Column, element: Column) -> Column:
    """The element's stripped texts joined without a separator: a part of the page's text."""
    return F.substring(text, element["start"] + 1, element["end"] - element["start"]).cast("string")


def with_text(body: Callable[[Column], Column]) -> Column:
    """``body`` of the page's text, taken out of the row once; a row's binary column is copied
    whole wherever an expression names it, so once a cell if that is done in a ``transform``."""
    return bind(F.col("page_text"), body)


def texts(text: Column, elements: Column) -> Column:
    return F.transform(elements, lambda e: element_text(text, e))


def tagged(nodes: Column, *tags: str) -> Column:
    return F.filter(nodes, lambda n: n["tag"].isin(*tags))


def classed(nodes: Column, *words: str) -> Column:
    """``div`` elements whose class contains one of the words."""
    return F.filter(
        nodes, lambda n: (n["tag"] == "div") & F.coalesce(contains_any(n["cls"], words), F.lit(False))
    )


def table_elements(nodes: Column, places: Column, implicit: bool = True, div_classes: bool = True) -> Column:
    """All ``table`` elements, nested ones too; if none, ``div`` elements styled as tables."""
    tables = at(nodes, places["table"])
    if not (implicit and div_classes):
        return tables
    styled = classed(at(nodes, places["div"]), "table", "grid")
    return choose(F.size(places["table"]) > 0, tables, styled)


# --- parts of one table; ``element`` is the table


def row_cells(nodes: Column, row: Column) -> Column:
    """The ``td`` and ``th`` elements inside a row; mostly there is nothing else."""
    found = inside(nodes, row)
    return choose(row["cells"] == row["last"] - row["id"], found, tagged(found, "td", "th"))


def header_elements(
    nodes: Column, places: Column, element: Column, first_row: Column, div_classes: bool = True
) -> Column:
    """Header cascade: every ``th``; else the first row of the first ``thead``; else the
    first row; else ``div`` elements classed as headers."""

    def in_thead(heads: Column) -> Column:
        rows = bind(F.get(nodes, F.get(heads, F.lit(0))), lambda head: within(places["tr"], head))
        return bind(F.get(nodes, F.get(rows, F.lit(0))), lambda row: row_cells(nodes, row))

    def some(cells: Column) -> Column:
        return F.when(F.size(cells) > 0, cells)

    steps = [
        bind(within(places["th"], element), lambda found: F.when(F.size(found) > 0, at(nodes, found))),
        bind(within(places["thead"], element), lambda h: F.when(F.size(h) > 0, bind(in_thead(h), some))),
        some(first_row),
    ]
    if div_classes:
        steps.append(classed(at(nodes, within(places["div"], element)), "header"))
    return F.coalesce(*steps, F.filter(nodes, lambda _: F.lit(False)))


def dedupe(names: Column) -> Column:
    """The k-th repeat of a name becomes ``name_k``; made-up names are not checked again.

    Names are sorted with their positions and cut where the name changes, so every copy
    knows its number and the work is that of sorting.  Arrays without repeats are returned
    as they are.
    """

    def number(pairs: Column, starts: Column) -> Column:
        def copies(start: Column, m: Column) -> Column:
            end = F.coalesce(F.get(starts, m + 1), F.size(pairs))
            return F.transform(
                F.slice(pairs, start + 1, end - start),
                lambda p, k: F.struct(
                    p["pos"].alias("pos"),
                    F.when(k > 0, F.concat_ws("_", p["name"], k.cast("string")))
                    .otherwise(p["name"])
                    .alias("name"),
                ),
            )

        return F.array_sort(F.flatten(F.transform(starts, copies)))["name"]

    def starts_of(pairs: Column) -> Column:
        return F.array_compact(
            F.transform(
                pairs,
                lambda p, j: F.when((j == 0) | (F.get(pairs, j - 1)["name"] != p["name"]), j),
            )
        )

    pairs = F.array_sort(F.transform(names, lambda n, i: F.struct(n.alias("name"), i.alias("pos"))))
    return F.when(F.size(F.array_distinct(names)) == F.size(names), names).otherwise(
        bind(pairs, lambda ps: bind(starts_of(ps), lambda starts: number(ps, starts)))
    )


def keep_filled(rows: Column) -> Column:
    """Drop rows without cells and rows whose cells are all blank."""
    return F.filter(rows, lambda r: F.exists(r, lambda c: c["end"] > c["start"]))


def sample_rows(
    nodes: Column,
    places: Column,
    element: Column,
    grid: Column,
    row_total: Column,
    headers: Column,
    limit: int | None,
    div_classes: bool = True,
) -> Column:
    """The first rows after the header row (all without a limit), blank ones dropped after the
    cut; a row is its cells' elements.

    ``grid`` holds the cells of at least the first ``limit + 1`` rows.  Without any
    filled row, ``div`` elements classed as rows and cells are taken instead.
    """
    start = F.when((F.size(headers) > 0) & (row_total > 1), 2).otherwise(1)
    rows = keep_filled(F.slice(grid, start, F.size(grid) if limit is None else limit))
    if not div_classes:
        return rows
    div_nodes = classed(at(nodes, within(places["div"], element)), "row")
    div_rows = keep_filled(
        F.transform(
            div_nodes if limit is None else F.slice(div_nodes, 1, limit),
            lambda r: classed(inside(nodes, r), "cell", "col"),
        )
    )
    return bind(rows, lambda r: F.when(F.size(r) > 0, r).otherwise(div_rows))


def looks_vertical(text: Column, grid: Column, row_total: Column) -> Column:
    """Property-value test on the first five rows of the uncut grid."""

    def is_name(first: Column) -> Column:
        return (F.char_length(first) < 30) & (
            first.endswith(":") | F.lower(first).isin(*PROPERTY_WORDS)
        )

    def is_property(cells: Column) -> Column:
        # A name of under 30 characters has at most 116 bytes: longer texts aren't cut out.
        first = F.get(cells, F.lit(0))
        return F.when(
            (F.size(cells) == 2) & (first["end"] - first["start"] <= 116),
            bind(element_text(text, first), is_name),
        ).otherwise(False)

    checked = F.least(F.lit(5), row_total)
    hits = F.size(F.filter(F.slice(grid, 1, 5), is_property))
    return (row_total >= 2) & (hits >= F.floor(checked / 2))


def property_rows(grid: Column) -> Column:
    """Rows with a name and a value cell."""
    return F.filter(grid, lambda r: F.size(r) >= 2)


def property_name(first: Column) -> Column:
    return F.when(first.endswith(":"), strip(F.regexp_replace(first, ":$", ""))).otherwise(first)


def caption(nodes: Column, places: Column, text: Column, element: Column) -> Column:
    """The text of the heading in force where the table starts, which is the nearest ``h1``
    before any ``h2`` and ``h3``; else the table's own caption; else empty."""
    heading = F.when(
        element["head"] >= 0,
        bind(F.get(nodes, element["head"]), lambda h: element_text(text, h)),
    )
    own = texts(text, at(nodes, F.slice(within(places["caption"], element), 1, 1)))
    return F.coalesce(heading, F.get(own, F.lit(0)), F.lit(""))


def table_record(
    nodes: Column,
    places: Column,
    text: Column,
    element: Column,
    position: Column,
    limit: int | None = 5,
    vertical: bool = True,
    div_classes: bool = True,
) -> Column:
    """One table as a struct of type ``TABLE_TYPE``."""

    def content(headers: Column, rows: Column) -> Column:
        return F.struct(headers.alias("headers"), rows.alias("rows"))

    def as_vertical(pairs: Column) -> Column:
        names = texts(text, F.transform(pairs, lambda p: F.get(p, F.lit(0))))
        values = texts(text, F.transform(pairs, lambda p: F.get(p, F.lit(1))))
        return content(F.transform(names, property_name), F.array(values))

    def as_rows(grid: Column, total: Column, headers: Column) -> Column:
        rows = sample_rows(nodes, places, element, grid, total, headers, limit, div_classes)
        return content(headers, F.transform(rows, lambda r: texts(text, r)))

    def record(is_vertical: Column, found: Column) -> Column:
        return F.struct(
            position.cast("int").alias("table_id"),
            F.when(element["tag"] == "table", "table").otherwise("div").alias("kind"),
            caption(nodes, places, text, element).alias("caption"),
            F.size(found["headers"]).alias("column_count"),
            F.size(found["rows"]).alias("row_count"),
            found["headers"].alias("headers"),
            found["rows"].alias("rows"),
            is_vertical.alias("is_vertical"),
            F.lit(None).cast(TABLE_TYPE["properties"].dataType).alias("properties"),
        )

    def cells(rows: Column) -> Column:
        return F.transform(rows, lambda place: bind(F.get(nodes, place), lambda row: row_cells(nodes, row)))

    def with_flag(rows: Column, grid: Column, flag: Column) -> Column:
        names = header_elements(nodes, places, element, F.get(grid, F.lit(0)), div_classes)
        found = bind(bind(texts(text, names), dedupe), lambda headers: as_rows(grid, F.size(rows), headers))
        if vertical:
            found = F.when(flag, bind(property_rows(cells(rows)), as_vertical)).otherwise(found)
        return bind(found, lambda f: record(flag, f))

    def with_grid(rows: Column, grid: Column) -> Column:
        if not vertical:
            return with_flag(rows, grid, F.lit(False))
        flag = looks_vertical(text, grid, F.size(rows))
        return bind(flag, lambda f: with_flag(rows, grid, f))

    def with_rows(rows: Column) -> Column:
        seen = rows if limit is None else F.slice(rows, 1, max(limit + 1, 5))
        return bind(cells(seen), lambda grid: with_grid(rows, grid))

    return bind(within(places["tr"], element), with_rows)


# --- operators ----------------------------------------------------------------------------


def extract_tables(
    dom: DataFrame,
    sample: int | None = 5,
    implicit: bool = True,
    div_classes: bool = True,
    vertical: bool = True,
) -> DataFrame:
    """``shred`` output to documents: ``(…, status, tables_count, tables)``.

    ``status`` is ``Success``, ``No tables found`` or the error that stopped the page, and
    every page of the input has exactly one row.  ``sample=None`` takes all rows.
    """
    nodes, places = F.col("nodes"), F.col("places")
    found = with_text(
        lambda text: F.transform(
            table_elements(nodes, places, implicit, div_classes),
            lambda e, i: table_record(nodes, places, text, e, i, sample, vertical, div_classes),
        )
    )
    tables = F.when(F.col("status").isNull(), found).cast(TABLES_TYPE)
    return with_status(once(dom, tables=tables).drop("nodes", "places", "page_text"))


def with_status(documents: DataFrame) -> DataFrame:
    """Fill ``status`` and ``tables_count`` from ``tables``; an error status is kept."""
    keep = [c for c in documents.columns if c not in ("status", "tables")]
    tables = F.coalesce(F.col("tables"), F.array().cast(TABLES_TYPE))
    return documents.select(*keep, "status", tables.alias("tables")).select(
        *keep,
        status_of(F.col("status"), F.size("tables")).alias("status"),
        F.size("tables").alias("tables_count"),
        "tables",
    )


def status_of(error: Column, count: Column) -> Column:
    return F.coalesce(error, F.when(count > 0, "Success").otherwise("No tables found"))


def find_status(dom: DataFrame, implicit: bool = True, div_classes: bool = True) -> DataFrame:
    """``(…, status, tables_count)`` of each page, without the content of its tables."""
    keep = [c for c in dom.columns if c not in NOT_KEPT]
    found = F.size(table_elements(F.col("nodes"), F.col("places"), implicit, div_classes))
    count = F.when(F.col("status").isNull(), F.coalesce(found, F.lit(0))).otherwise(0)
    counted = once(dom, tables_count=count)
    return counted.select(*keep, status_of(F.col("status"), F.col("tables_count")).alias("status"), "tables_count")


def find_captions(dom: DataFrame, implicit: bool = True, div_classes: bool = True) -> DataFrame:
    """``(…, table_id, caption)`` of each table, without the rest of its content."""
    keep = [c for c in dom.columns if c not in NOT_KEPT]
    nodes, places = F.col("nodes"), F.col("places")
    found = with_text(
        lambda text: F.transform(
            table_elements(nodes, places, implicit, div_classes),
            lambda e: caption(nodes, places, text, e),
        )
    )
    wanted = F.when(F.col("status").isNull(), found)
    return dom.select(*keep, F.posexplode(wanted).alias("table_id", "caption"))


def page_status(documents: DataFrame, key: str = "doc_id") -> DataFrame:
    return documents.select(key, "status", "tables_count")


def find_tables(dom: DataFrame, implicit: bool = True, div_classes: bool = True) -> DataFrame:
    """``(…, table_id, kind, node_id)``: the tables of each page without their content."""
    keep = [c for c in dom.columns if c not in NOT_KEPT]
    found = F.transform(
        table_elements(F.col("nodes"), F.col("places"), implicit, div_classes), lambda e: F.struct(e["id"], e["tag"])
    )
    return dom.select(*keep, F.posexplode(found).alias("table_id", "e")).select(
        *keep,
        "table_id",
        F.when(F.col("e.tag") == "table", "table").otherwise("div").alias("kind"),
        F.col("e.id").alias("node_id"),
    )


def texts_of(dom: DataFrame, *tags: str) -> DataFrame:
    """``(…, node_id, tag, text)`` of all elements with one of the tags."""
    keep = [c for c in dom.columns if c not in NOT_KEPT]
    found = with_text(
        lambda text: F.transform(
            tagged(F.col("nodes"), *tags),
            lambda e: F.struct(e["id"], e["tag"], element_text(text, e).alias("text")),
        )
    )
    return dom.select(*keep, F.explode(found).alias("e")).select(
        *keep, F.col("e.id").alias("node_id"), F.col("e.tag").alias("tag"), F.col("e.text").alias("text")
    )


def tables_of(documents: DataFrame) -> DataFrame:
    """One row per table: the fields of ``TABLE_TYPE`` beside the document's columns."""
    keep = [c for c in documents.columns if c not in ("status", "tables_count", "tables")]
    return documents.select(*keep, F.explode("tables").alias("t")).select(*keep, "t.*")


def headers_of(tables: DataFrame, key: str = "doc_id", *others: str) -> DataFrame:
    """Long form ``(doc_id, table_id, …, pos, name)`` with other columns of the tables."""
    return tables.select(key, "table_id", *others, F.posexplode("headers").alias("pos", "name"))


def cells_of(tables: DataFrame, key: str = "doc_id") -> DataFrame:
    """Long form ``(doc_id, table_id, row_no, pos, value)``; rows may be ragged."""
    rows = tables.select(key, "table_id", F.posexplode("rows").alias("row_no", "cells"))
    return rows.select(key, "table_id", "row_no", F.posexplode("cells").alias("pos", "value"))


def align_rows(tables: DataFrame) -> DataFrame:
    """Pad short rows with empty strings and cut long ones to the headers."""
    headers = F.col("headers")
    rows = F.transform(
        "rows",
        lambda r: F.transform(headers, lambda _, i: F.coalesce(F.get(r, i), F.lit(""))),
    )
    return once(tables, rows=rows)


def aligned_cells(tables: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(doc_id, table_id, pos, name, row_no, value)``: one cell per header and row.

    A table without rows gives one line per header with NULL ``row_no`` and ``value``, so
    no header is lost.
    """
    pairs = align_rows(tables).select(
        key, "table_id", "headers", F.posexplode_outer("rows").alias("row_no", "cells")
    )
    return pairs.select(
        key, "table_id", "row_no", "cells", F.posexplode("headers").alias("pos", "name")
    ).select(
        key, "table_id", "pos", "name", "row_no", F.get("cells", F.col("pos")).alias("value")
    )


def to_wide(tables: DataFrame, names: list[str], key: str = "doc_id") -> DataFrame:
    """Preview rows as ordinary columns, one per header position; names are the caller's."""
    rows = align_rows(tables).select(
        key, "table_id", F.posexplode("rows").alias("row_no", "cells")
    )
    return rows.select(
        key, "table_id", "row_no",
        *[F.get("cells", F.lit(i)).alias(name) for i, name in enumerate(names)],
    )
