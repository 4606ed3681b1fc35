"""Describe a page's tables, recommend one, and select it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagetables.functions.rows import once
from pagetables.functions.text import preview, strip

ANSWER_FORMAT = (
    "Answer in three lines:\n"
    "Main Table: [number]\n"
    "Reasoning: [two or three sentences]\n"
    "Table Type: [data/schema/list/other]"
)


def describe(table: Column) -> Column:
    """One table as text: number, caption, columns, row count and the first sample row."""
    first = F.get(table["rows"], F.lit(0))
    return F.concat(
        F.lit("Table "), (table["table_id"] + 1).cast("string"),
        F.lit("\nContext: "), table["caption"],
        F.lit("\nColumns ("), table["column_count"].cast("string"), F.lit("): "),
        preview(table["headers"], 10),
        F.lit("\nRows: "), table["row_count"].cast("string"),
        F.coalesce(F.concat(F.lit("\nFirst row: "), F.array_join(first, " | ")), F.lit("")),
    )


def describe_tables(tables: DataFrame, key: str = "doc_id") -> DataFrame:
    record = F.struct("table_id", "caption", "column_count", "row_count", "headers", "rows")
    return tables.select(key, "table_id", describe(record).alias("text"))


def analysis_prompt() -> Column:
    """What is asked about a page; NULL for pages without tables."""
    descriptions = F.array_join(F.transform("tables", describe), "\n\n")
    return F.when(
        (F.col("status") == "Success") & (F.col("tables_count") > 0),
        F.concat(
            F.lit("A web page holds "), F.col("tables_count").cast("string"),
            F.lit(" tables, described below.\n\n"), descriptions,
            F.lit("\n\nWhich one carries the page's main, most useful structured data?\n"),
            F.lit(ANSWER_FORMAT),
        ),
    )


def analysis_prompts(documents: DataFrame, key: str = "doc_id") -> DataFrame:
    """One prompt per page with tables; pages without any are not asked about."""
    asked = documents.select(key, analysis_prompt().alias("prompt"))
    return asked.filter(F.col("prompt").isNotNull())


def recommended_index(text: Column) -> Column:
    """The position of the table an answer names."""
    number = F.nullif(F.regexp_extract(text, r"(?U)Main Table:\s*(\d+)", 1), F.lit(""))
    return number.try_cast("int") - 1


def parse_analysis(responses: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(doc_id, table_index, reasoning, table_type)`` from the three-line answers."""
    text = F.col("content")

    def group(pattern: str) -> Column:
        return F.regexp_extract(text, pattern, 1)

    kind = F.nullif(group(r"(?U)Table Type:\s*(\w+)"), F.lit(""))
    reasoning = strip(group(r"(?s)Reasoning:(.*?)(?:Table Type:|$)"))
    return responses.select(
        key,
        recommended_index(text).alias("table_index"),
        F.when(text.contains("Reasoning:"), reasoning)
        .otherwise("No reasoning provided.")
        .alias("reasoning"),
        F.coalesce(kind, F.lit("unknown")).alias("table_type"),
    )


def filled_cells(table: Column) -> Column:
    return F.aggregate(
        table["rows"], F.lit(0), lambda n, r: n + F.size(F.filter(r, lambda c: c != ""))
    )


def best_table(tables: Column) -> Column:
    """Position of the table with most filled cells; property-value and one-column tables
    come after all others, ties go to the first."""
    return -F.array_max(
        F.transform(
            tables,
            lambda t: F.struct(
                (~t["is_vertical"] & (t["column_count"] > 1)).alias("regular"),
                filled_cells(t).alias("filled"),
                (-t["table_id"]).alias("order"),
            ),
        )
    )["order"]


def rank_tables(documents: DataFrame, key: str = "doc_id") -> DataFrame:
    """Recommendations without a model, in the shape of ``parse_analysis``."""
    best = best_table(F.col("tables"))
    return documents.filter(F.col("tables_count") > 0).select(
        key,
        best.alias("table_index"),
        F.concat(
            F.lit("Most filled cells: "),
            filled_cells(F.get("tables", best)).cast("string"),
        ).alias("reasoning"),
        F.lit("data").alias("table_type"),
    )


def selection(count: Column, recommended: Column, choice: Column, accept: bool = True) -> Column:
    """The only table; else an accepted recommendation; else an explicit choice; if in range."""

    def in_range(index: Column) -> Column:
        return F.when((index >= 0) & (index < count), index)

    steps = [in_range(recommended)] if accept else []
    return F.when(count == 1, 0).when(count > 1, F.coalesce(*steps, in_range(choice)))


def with_advice(
    pages: DataFrame,
    recommendations: DataFrame | None = None,
    choices: DataFrame | None = None,
    key: str = "doc_id",
) -> DataFrame:
    """Pages with the columns ``recommended`` and ``choice`` that ``select_tables`` goes by.

    Recommendations and choices have one row per document and are kept apart from the pages;
    they meet them before the pages are parsed, so no extracted table is moved.
    """
    for name, advice in (("recommended", recommendations), ("choice", choices)):
        if advice is not None:
            pages = pages.join(advice.select(key, F.col("table_index").alias(name)), key, "left")
    return pages


def select_tables(documents: DataFrame, accept: bool = True) -> DataFrame:
    """Add ``table_index`` and the selected ``table``; NULL when nothing is selected.

    Columns ``recommended`` and ``choice`` of the documents (see ``with_advice``; a model's
    answer brings ``recommended`` as well) say which; without a recommendation the native
    ranking is used.  A projection: nothing is joined.
    """
    given = documents.columns
    ranked = F.when(F.col("tables_count") > 0, best_table(F.col("tables")))
    recommended = F.col("recommended") if "recommended" in given else ranked
    choice = F.col("choice") if "choice" in given else F.lit(None).cast("int")
    index = selection(F.col("tables_count"), recommended, choice, accept)
    return once(
        documents, table_index=F.when(F.col("status") == "Success", index).cast("int")
    ).select(
        *[c for c in given if c not in ("recommended", "choice")],
        "table_index",
        F.get("tables", F.col("table_index")).alias("table"),
    )


SPREAD = 64  # parts that the files of one dataset are ranked in


def select_files(files: DataFrame, choices: DataFrame | None = None, group: str = "dataset") -> DataFrame:
    """``(dataset, path)``: the chosen (1-based) file of each dataset, else its first.

    The first file is a plain minimum, reduced in each task.  Only datasets with a choice
    beyond the first are ranked; all others never meet a window.  A dataset's files are ranked
    in ``SPREAD`` parts first, of which no more than its choice stay, so one of much of the
    files is sorted by many tasks and ends as ``SPREAD`` times its choice at most.
    """
    firsts = files.groupBy(group).agg(F.min("path").alias("path"))
    if choices is None:
        return firsts
    deeper = choices.filter(F.col("choice") > 1).select(group, "choice")
    part = F.pmod(F.xxhash64("path"), F.lit(SPREAD))
    parted = files.select(group, "path", part.alias("_part")).join(deeper, group)
    first = F.row_number().over(W.partitionBy(group, "_part").orderBy("path"))
    nearest = parted.withColumn("place", first).filter(F.col("place") <= F.col("choice"))
    ranked = nearest.withColumn("place", F.row_number().over(W.partitionBy(group).orderBy("path")))
    chosen = ranked.filter(F.col("place") == F.col("choice")).select(group, F.col("path").alias("chosen"))
    return firsts.join(chosen, group, "left").select(group, F.coalesce("chosen", "path").alias("path"))
