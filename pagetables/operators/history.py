"""A history of runs as a stored table that several writers add to.

A writer adds the runs that the history does not have, in one append, with a round one above the
highest it saw and a name of its own.  Writers that read before the other wrote may both append a
run: the history takes each run from the first round, then from the least name, so no run counts
twice, whoever comes first, and none is lost.  Which of two writers of one round counts is settled
once both have written; nothing later changes it.  A writer that is lost leaves nothing, and its
run is added by the next one.

Defined cases: of copies of a run in one call one counts, by its values; runs without an id are one
run; an empty table adds nothing; a history nobody has written to is opened by ``add_runs``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OWN = ("round", "writer")


def _rows(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.parquet(f"{store}/runs")


def _first(rows: DataFrame, key: str) -> DataFrame:
    """One row a key: the least by round, writer and values."""
    others = [c for c in rows.columns if c not in (key, *OWN)]
    best = F.min(F.struct(*OWN, *others)).alias("best")
    return rows.groupBy(key).agg(best).select(key, *[f"best.{c}" for c in (*OWN, *others)])


def read_history(spark: SparkSession, store: str, key: str = "run_id") -> DataFrame:
    """One row a run."""
    return _first(_rows(spark, store), key).drop(*OWN)


def new_rows(runs: DataFrame, store: str, key: str = "run_id") -> DataFrame:
    """What a writer that looks at the history now would append."""
    spark = runs.sparkSession
    blank = runs.limit(0).withColumns({"round": F.lit(0).cast("long"), "writer": F.lit("")})
    spark.createDataFrame([], blank.schema).coalesce(1).write.mode("append").parquet(f"{store}/runs")
    held = _rows(spark, store)
    last = held.agg(F.coalesce(F.max("round"), F.lit(0)).alias("last"))
    known = held.select(F.col(key).alias("known")).distinct()
    fresh = runs.join(known, F.col(key).eqNullSafe(F.col("known")), "left_anti")
    mine = fresh.withColumns({"round": last.scalar() + 1, "writer": F.lit(uuid.uuid4().hex)})
    return _first(mine, key).select(*runs.columns, *OWN)


def append_rows(rows: DataFrame, store: str) -> None:
    rows.write.mode("append").parquet(f"{store}/runs")


def add_runs(runs: DataFrame, store: str, key: str = "run_id") -> None:
    """Add the runs that the history does not have yet."""
    append_rows(new_rows(runs, store, key), store)
