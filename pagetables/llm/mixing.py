"""Mixing sources to target weights by hash-random order, prefix sums and an exact cut.

Every row gets a uniform number from a hash of its key; within a source, rows are sorted by
ranges of that number.  The ranges' word counts give every range its place in the source's
order (a prefix sum over ranges, not rows), a window inside each range gives every row its
place, and the source's budget is cut there: whole epochs first, then the rows from the
front, the last of them in part.  A source is as many ranges as its rows need, so a source
with a third of all rows is spread like the others; no task sees a whole source.

Defined cases: a NULL text or one without words has size 0 and nothing taken; a NULL source
is a source, after all others; rows without a key get their place from their text; repeated
rows share a place in the order and are interchangeable; an empty table gives no rows; a
source of size 0 has target 0.  Columns of the input are kept unless they are named as one of
the result's, which replace them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetables.llm.common import SPACE, Tucked, count_words, stored, unit

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2
ROWS_PER_RANGE = 8192
ADDED = ("size", "source_size", "target", "taken")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE,
                   epochs: int = MOST_EPOCHS) -> DataFrame:
    """``sizes(source, source_size, …)`` with ``target``: a row for each source.

    Shares are proportional to weights; no source goes over ``epochs`` times its size, and
    what it leaves is shared by the others again.  Sources full first are those with the
    smallest size per weight, so one pass over the sources in that order finds the level:
    a source is full if its limit is under its part of what those before it left.  The level
    only falls after the first source that is not full, so theirs is the largest.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int"))
    ordered = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("budget") - F.col("full_before")) / (F.col("all_weight") - F.col("weight_before"))
    return (
        sizes.withColumn("weight", weight)
        .withColumns({
            "budget": F.sum("source_size").over(everything) * F.lit(share),
            "all_weight": F.sum("weight").over(everything),
            "full_before": F.coalesce(F.sum("source_size").over(before), F.lit(0)) * F.lit(epochs),
            "weight_before": F.coalesce(F.sum("weight").over(before), F.lit(0)),
        })
        .withColumn("level", level)
        .withColumn("is_full", F.col("source_size") * F.lit(epochs) <= F.col("level") * F.col("weight"))
        .withColumn("shared", F.max(F.when(~F.col("is_full"), F.col("level"))).over(everything))
        .withColumn(
            "target",
            F.when(F.col("is_full"), F.col("source_size") * F.lit(float(epochs)))
            .otherwise(F.col("shared") * F.col("weight")).cast("double"),
        )
        .drop("budget", "all_weight", "full_before", "weight_before", "level", "is_full", "shared", "weight")
    )


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        seed: str = "mix", rows_per_range: int = ROWS_PER_RANGE, keep_text: bool = True, **shares) -> DataFrame:
    """Every row with ``size``, ``source_size``, ``target`` and ``taken`` words.

    Without ``keep_text`` the text is left out and every other step works on a table of sizes,
    written once, so words are counted once."""
    tucked = Tucked(docs)
    mixed = _mixed(tucked, key, text, source, seed, rows_per_range, keep_text, **shares)
    left_out = ADDED if keep_text else (*ADDED, text)
    return mixed.select(*tucked.back(*left_out), *ADDED)


def mixture(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
            seed: str = "mix", rows_per_range: int = ROWS_PER_RANGE, **shares) -> DataFrame:
    """The mix itself, with the input's columns: a row for every epoch of a document; of a
    document that the budget cuts, the text up to the last word taken."""
    tucked = Tucked(docs)
    mixed = _mixed(tucked, key, text, source, seed, rows_per_range, True, **shares)
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(F.lit(0))
    left = F.col("taken") - whole * F.col("size")
    copies = F.concat(
        F.array_repeat(F.col("size"), whole.cast("int")),
        F.when(left > 0, F.array(left)).otherwise(F.array().cast("array<bigint>")),
    )
    taken = mixed.withColumn("words", F.explode(copies))
    cut = F.when(F.col("words") < F.col("size"), first_words(tucked[text], F.col("words"))).otherwise(tucked[text])
    return taken.withColumn(tucked.name(text), cut).select(*tucked.back())


def _mixed(tucked: Tucked, key: str, text: str, source: str, seed: str, rows_per_range: int, keep_text: bool,
           **shares) -> DataFrame:
    order = F.concat_ws("|", F.lit(seed), F.coalesce(tucked[key].cast("string"), tucked[text], F.lit("")))
    rows = tucked.frame.select(
        "*",
        tucked[source].alias("source"),
        count_words(tucked[text]).alias("size"),
        F.md5(order).alias("place_key"),
        F.xxhash64(tucked[text]).alias("tie"),
        unit(order).alias("place"),
    )
    if not keep_text:
        rows = stored(rows.drop(tucked.name(text)), "sizes")
    # One row for each source, from per-task sums.  Sources are told apart null-safely.
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    targets = source_targets(sizes, **shares).withColumns({
        "n_ranges": F.ceil(F.col("n_rows") / F.lit(rows_per_range)).cast("long"),
        "epochs": F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"),
    })
    rest = F.floor(F.col("target")).cast("long") - F.col("epochs") * F.col("source_size")
    targets = targets.withColumn("rest", rest).withColumnRenamed("source", "_of")
    ranged = rows.join(targets, F.col("source").eqNullSafe(F.col("_of"))).drop("_of").withColumn(
        "range_no", F.floor(F.col("place") * F.col("n_ranges")).cast("long")
    )
    sums = ranged.groupBy("source", "range_no").agg(F.sum("size").alias("range_size"))
    ahead = Window.partitionBy("source").orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col("source").alias("_of"), F.col("range_no").alias("_range"),
        F.coalesce(F.sum("range_size").over(ahead), F.lit(0)).alias("range_start"),
    )
    inside = (
        Window.partitionBy("source", "range_no").orderBy("place_key", tucked[key], "tie", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = ranged.withColumn("end", F.sum("size").over(inside)).join(
        starts, F.col("source").eqNullSafe(F.col("_of")) & (F.col("range_no") == F.col("_range"))
    )
    begin = F.col("range_start") + F.col("end") - F.col("size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - begin))
    return placed.withColumn("taken", (F.col("epochs") * F.col("size") + part).cast("long"))


def first_words(text: Column, count: Column) -> Column:
    """The text up to the end of its ``count``-th word."""
    pieces = F.split(F.ltrim(text, F.lit(" \t\n\x0b\x0c\r")), r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    return F.regexp_replace(F.array_join(F.slice(pieces, F.lit(1), count.cast("int")), ""), SPACE + "$", "")
