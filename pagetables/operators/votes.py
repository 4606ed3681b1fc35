"""Column votes kept part by part, so that what is known of old files need not be read again.

A part is whatever arrives or leaves as a whole: a file, a day, a delivery.  Its votes (see
``infer.profile_votes``: counts, minima, maxima, the kinds seen) are one stored row a column, and
the votes of a table are the merge of those of its parts: sums of counts, least of minima, union
of kinds.  So adding a part reads that part only; and since every part keeps votes of its own,
taking one out again is exact, which minima of the whole alone could not be.

Additions and removals are appended under a growing version; of a part, the last one counts.  An
append that is lost leaves nothing behind, and one made twice changes nothing.

Defined cases: a part that is there already isn't read again unless ``again`` says that its
content has changed, and then replaces itself; removing an unknown part changes nothing; a
store without parts gives no rows; a NULL part is a part.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.operators.infer import DATE_FORMATS, infer_columns, profile_votes

SUMMED = ("total", "blank", "strings", "wholes", "shapeless")
LEAST = ("minimum", "least", "first_shape")
MOST = ("maximum", "most", "last_shape")


def merged_votes() -> Column:
    """Votes of several parts of a table as one aggregate, which combines before an exchange."""

    def of(name: str) -> Column:
        return F.col("votes")[name]

    def counts(i: int) -> Column:
        return F.coalesce(F.sum(F.get(of("formats"), F.lit(i))), F.lit(0))

    return F.struct(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(of("kinds"))))).alias("kinds"),
        *[F.sum(of(name)).alias(name) for name in SUMMED[:3]],
        F.array(*[counts(i) for i in range(len(DATE_FORMATS))]).alias("formats"),
        F.min(of("minimum")).alias("minimum"), F.max(of("maximum")).alias("maximum"),
        F.sum(of("wholes")).alias("wholes"), F.min(of("least")).alias("least"), F.max(of("most")).alias("most"),
        F.sum(of("shapeless")).alias("shapeless"),
        F.min(of("first_shape")).alias("first_shape"), F.max(of("last_shape")).alias("last_shape"),
    )


def merge(votes: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """``(by…, pos, name, votes)`` of rows that hold several votes of a column."""
    return votes.groupBy(*by, "pos", "name").agg(merged_votes().alias("votes"))


def _stored(spark: SparkSession, store: str, schema) -> DataFrame:
    """The store's rows; makes it if it isn't there."""
    spark.createDataFrame([], schema).coalesce(1).write.mode("append").parquet(store)
    return spark.read.schema(schema).parquet(store)


def _next_version(rows: DataFrame) -> Column:
    """A version after all that are there, found by the job that writes it."""
    return (F.coalesce(rows.agg(F.max("version").alias("last")).scalar(), F.lit(0)) + 1).cast("bigint")


def live(rows: DataFrame) -> DataFrame:
    """Of each part the rows of its last version, unless that took it out."""
    last = rows.groupBy("part").agg(F.max("version").alias("_last"))
    same = F.col("part").eqNullSafe(F.col("_part")) & (F.col("version") == F.col("_last"))
    return rows.join(last.withColumnRenamed("part", "_part"), same).filter(F.col("votes").isNotNull()).drop("_part", "_last")


def add_parts(frame: DataFrame, store: str, part: str, by: Iterable[str] = (), again: bool = False) -> None:
    """Votes for the parts of a wide table of strings that the store doesn't have."""
    spark, by = frame.sparkSession, list(by)
    named = frame.withColumnRenamed(part, "part").withColumn("part", F.col("part").cast("string"))
    # A value has the same votes in whatever order columns of the group come.
    shaped = profile_votes(named, ["part", *by]).withColumn("version", F.lit(0).cast("bigint"))
    known = _stored(spark, store, shaped.schema)
    version = _next_version(known)
    fresh = shaped
    if not again:
        parts = live(known).select(F.col("part").alias("_part")).distinct()
        unknown = named.join(parts, F.col("part").eqNullSafe(F.col("_part")), "left_anti")
        fresh = profile_votes(unknown, ["part", *by])
    fresh.withColumn("version", version).select(shaped.columns).write.mode("append").parquet(store)


def remove_parts(parts: DataFrame, store: str) -> None:
    """Takes the parts of a table ``(part)`` out of the store."""
    spark = parts.sparkSession
    rows = spark.read.parquet(store)
    version = _next_version(rows)
    gone = parts.select(F.col("part").cast("string").alias("part")).distinct()
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema if f.name not in ("part", "version")]
    marks = gone.select("part", *empty, version.alias("version"))
    marks.select(rows.columns).write.mode("append").parquet(store)


def stored_votes(spark: SparkSession, store: str, by: Iterable[str] = ()) -> DataFrame:
    """The votes of all parts that are in the store."""
    return merge(live(spark.read.parquet(store)), by)


def stored_profile(spark: SparkSession, store: str, by: Iterable[str] = ()) -> DataFrame:
    """``infer.profile`` of the table that the store's parts make up."""
    return infer_columns(stored_votes(spark, store, by))
