"""Markup and CSV text rendered from table rows, as input for round trips.

Every row of a source table becomes one document, so rendering is a projection too: no
document is put together from a group of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.session import PARTITIONS

MONEY = "decimal(18,2)"


TASKS_A_CORE = 4


def load(
    spark: SparkSession, sf_dir: str, table: str, partitions: int | None = None, deal: bool = False
) -> DataFrame:
    """A table, dealt to ``partitions`` tasks if that is given here or set in the session.

    With ``deal`` it is dealt to all cores anyway.  A narrow table's rows have few bytes, and as
    pages they are much work: its files, cut by bytes and by row groups, would give that to a few tasks.
    """
    frame = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    wanted = partitions or int(spark.conf.get(PARTITIONS, "0"))
    if deal and not wanted:
        cores = spark.sparkContext.defaultParallelism
        wanted = max(TASKS_A_CORE * cores, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return frame.repartition(wanted) if wanted else frame


def escape(col: Column) -> Column:
    """Text to markup."""
    text = F.replace(col, F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(text, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def element(tag: str, *content: Column | str) -> Column:
    parts = [F.lit(c) if isinstance(c, str) else c for c in content]
    return F.concat(F.lit(f"<{tag}>"), *parts, F.lit(f"</{tag.split(' ')[0]}>"))


def row(tag: str, *cells: Column | str) -> Column:
    """A table row; cells are texts."""
    texts = [F.lit(c) if isinstance(c, str) else c for c in cells]
    return element("tr", *[element(tag, escape(F.coalesce(t, F.lit("")))) for t in texts])


def money(name: str) -> Column:
    return F.col(name).cast(MONEY).cast("string")


def day(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd")


def text(name: str) -> Column:
    return F.col(name).cast("string")


ORDER_FIELDS = {
    "o_orderkey": text,
    "o_custkey": text,
    "o_orderstatus": text,
    "o_totalprice": money,
    "o_orderdate": day,
    "o_orderpriority": text,
}


def order_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per order: a heading, a header row with a repeated name, six field rows."""
    orders = load(spark, sf_dir, "orders", deal=True)
    rows = [
        row("td", str(i), name, value(name)) for i, (name, value) in enumerate(ORDER_FIELDS.items())
    ]
    table = element("table", row("th", "Attr", "Label", "Attr"), *rows)
    return orders.select(
        F.col("o_orderkey").alias("doc_id"),
        F.concat(F.lit("order/"), text("o_orderkey")).alias("source"),
        F.concat(
            F.lit("<!DOCTYPE html><html><head><title>t</title></head><body>"),
            element("h1", F.concat(F.lit("Order "), text("o_orderkey"))),
            element("h2", "fields"),
            table,
            F.lit("</body></html>"),
        ).alias("html"),
    )


LINE_FIELDS = {
    "l_orderkey": text,
    "l_partkey": text,
    "l_suppkey": text,
    "l_linenumber": text,
    "l_quantity": money,
    "l_extendedprice": money,
    "l_discount": money,
    "l_tax": money,
    "l_returnflag": text,
    "l_linestatus": text,
    "l_shipdate": day,
}


def lineitem_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per line item: a header row of eleven names and one data row."""
    items = load(spark, sf_dir, "lineitem", deal=True)
    return items.select(
        F.xxhash64(*items.columns).alias("doc_id"),
        F.col("l_orderkey"),
        F.concat(
            element("h1", "Line item"),
            element(
                "table",
                row("th", *LINE_FIELDS),
                row("td", *[value(name) for name, value in LINE_FIELDS.items()]),
            ),
        ).alias("html"),
    )


def customer_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per customer: a property-value table of seven rows."""
    customers = load(spark, sf_dir, "customer", deal=True)
    table = element(
        "table",
        row("td", "Name:", F.col("c_name")),
        row("td", "Key", text("c_custkey")),
        row("td", "Nation :", text("c_nationkey")),
        row("td", "one cell only"),
        row("td", "Balance:", money("c_acctbal")),
        row("td", "Segment", F.col("c_mktsegment")),
        row("td", "Segment:", F.col("c_mktsegment")),
    )
    return customers.select(F.col("c_custkey").alias("doc_id"), table.alias("html"))


def supplier_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per supplier, with a blank row and a row without cells among the first five,
    a cell with markup and a comment, and an unclosed cell."""
    suppliers = load(spark, sf_dir, "supplier", deal=True)
    name = escape(F.col("s_name"))
    table = element(
        "table",
        row("th", "key", "name", "balance"),
        element("tr", element("td", text("s_suppkey")), element("td", " ", element("b", name), " x "),
                element("td", money("s_acctbal"))),
        element("tr", element("td", ""), element("td", " "), element("td", "<!-- none -->")),
        element("tr", "<!-- no cells -->"),
        element("tr", "<td>a<!-- c --> b<td>", text("s_nationkey")),
        row("td", "last", "&<>", text("s_nationkey")),
        row("td", "beyond", "the", "sample"),
    )
    return suppliers.select(F.col("s_suppkey").alias("doc_id"), table.alias("html"))


def part_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per part: no table element but a ``div`` grid."""
    parts = load(spark, sf_dir, "part", deal=True)

    def line(*cells: Column | str) -> Column:
        return element(
            'div class="Row odd"',
            *[element('div class="my-cell"', escape(F.lit(c) if isinstance(c, str) else c)) for c in cells],
        )

    grid = element(
        'div class="Data-Grid wide"',
        element('div class="grid-header-x"', ""),
        line("name", F.col("p_name")),
        line("", " "),
        line("brand", F.col("p_brand")),
        line("type", F.col("p_type")),
        line("size", text("p_size")),
        line("price", money("p_retailprice")),
    )
    return parts.select(
        F.col("p_partkey").alias("doc_id"), F.concat(element("h3", F.col("p_name")), grid).alias("html")
    )


def words(line: Column) -> Column:
    return F.split(line, " ")


def document_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per document, its whole text in two tables.

    The first table has a row per line: the line number and the words, one cell each; its
    header is a ``thead`` for even documents and just the first row for odd ones.  The second
    holds the language and the source, nested in a cell, under ``caption``.
    """
    docs = load(spark, sf_dir, "documents")
    lines = F.split(escape(F.col("text")), "\n")  # whole texts at once: a step a word is slow

    def cells(line: Column, i: Column) -> Column:
        tds = F.replace(line, F.lit(" "), F.lit("</td><td>"))
        return element("tr", element("td", i.cast("string")), element("td", tds))

    body = F.array_join(F.transform(lines, cells), "")
    thead = element("thead", row("td", "line", "text"))
    even = F.col("doc_id") % 2 == 0
    nested = element(
        "table",
        element("caption", escape(F.col("source"))),
        element(
            "tr",
            element("td", escape(F.col("lang"))),
            element("td", element("table", row("td", F.col("source"), text("n_chars"), "x"))),
            element("td", "z"),
        ),
    )
    head = F.when(even, element("h2", element("b", escape(F.col("lang"))), " one")).otherwise(F.lit(""))
    return docs.select(
        "doc_id",
        F.concat(
            head, element("table", F.when(even, thead).otherwise(F.lit("")), body), nested
        ).alias("html"),
    )


def unclosed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per document, whose first line's words are cells that nothing closes; the other
    words follow in the last of them.

    In the header row of ``n`` cells the k-th holds the words from k on, then all others.
    """
    docs = load(spark, sf_dir, "documents")
    lines = F.split("text", "\n")
    tds = F.transform(words(F.get(lines, F.lit(0))), lambda w: F.concat(F.lit("<td>"), escape(w)))
    rest = F.split(F.array_join(F.slice(lines, F.lit(2), F.size(lines)), " "), " ")
    spans = F.transform(rest, lambda w: element("i", escape(w)))
    return docs.select(
        "doc_id",
        F.concat(F.lit("<table><tr>"), F.array_join(tds, ""), F.lit("<b>|</b>"), F.array_join(spans, "")).alias("html"),
    )


def quoted(col: Column) -> Column:
    """A CSV field in quotes."""
    return F.concat(F.lit('"'), F.replace(col, F.lit('"'), F.lit('""')), F.lit('"'))


def csv_line(*cells: Column | str) -> Column:
    return F.concat_ws(",", *[quoted(F.lit(c) if isinstance(c, str) else c) for c in cells])


def document_csv(spark: SparkSession, sf_dir: str, dataset: str | None = None) -> DataFrame:
    """One CSV text per document: a header, then per line its number and the whole line; with
    the documents' source as the name of its dataset, if that column is asked for."""
    docs = load(spark, sf_dir, "documents")
    lines = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.concat_ws(",", i.cast("string"), quoted(line)),
    )
    return docs.select(
        "doc_id",
        F.concat(F.lit("corpus/"), text("doc_id"), F.lit(".csv")).alias("source"),
        F.concat(F.lit("no,line\n"), F.array_join(lines, "\n")).alias("content"),
        *([F.col("source").alias(dataset)] if dataset else []),
    )


def part_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One schema-describing CSV text per part; column names and types come from the row."""
    parts = load(spark, sf_dir, "part", deal=True)
    size_null = F.when(F.col("p_size") % 2 == 0, "No").otherwise("")
    content = F.concat_ws(
        "\n",
        csv_line("_1", "Key", "Name", "Data type", "Null", "Attributes", "References", "Description"),
        csv_line("1", "PK", "p_partkey", "int", "No", "", "", F.concat(F.lit("Key "), text("p_partkey"))),
        csv_line("2", "", F.col("p_name"), "varchar(20)", "", "unique", "", " "),
        csv_line("3", "", "", "int", "", "skipped", "", ""),
        csv_line("4", "FK", F.col("p_brand"), F.lower("p_type"), size_null, "", "brand.id", ""),
        csv_line("5", "short"),
    )
    return parts.select(
        F.col("p_partkey").alias("doc_id"),
        F.concat(F.lit("schemas/part_"), text("p_partkey"), F.lit(".csv")).alias("source"),
        content.alias("content"),
    )
