"""Totals of a metrics log that arrives as a stream.

An operation is told by its run, phase and number.  The stream's state holds the operations seen,
keyed by all three, so a run of much of the log is spread over all tasks; state is dropped once
the watermark has passed it by ``delay``.  What is new in a batch is summed by run and phase, in
each task first, and written under the number of the batch: a batch that runs again after a
failure replaces its own sums, and operations delivered twice add nothing.  Totals are the sums
of all batches, a row per batch, run and phase.

Late operations count as long as they are not ``delay`` behind the newest one seen before their
batch; those further behind are left out, since whether they are copies can't be told any more.
Without a delay nothing is ever left out, and the state grows with the log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pagetables.operators.metrics import merged_totals, phase_totals

OPERATION = ["run_id", "phase", "seq"]
LOG_SCHEMA = (
    "run_id bigint, seq bigint, agent string, phase string, latency_s double, memory_mb double, prompt_tokens bigint, "
    "completion_tokens bigint, total_tokens bigint, model string, logged_at timestamp"
)
LOG_COLUMNS = [c.split(" ")[0] for c in LOG_SCHEMA.split(", ")]
TOTALS_SCHEMA = (
    "run_id bigint, phase string, operations bigint, seconds decimal(28,6), prompt_tokens bigint, completion_tokens bigint, "
    "total_tokens bigint"
)


def log_stream(spark: SparkSession, directory: str, files_per_trigger: int = 1000) -> DataFrame:
    """Parquet files of log rows that appear in a directory."""
    reader = spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(directory)


def new_operations(log: DataFrame, delay: str | None = "7 days") -> DataFrame:
    """The operations of a stream that were not delivered before."""
    if delay is None:
        return log.dropDuplicates(OPERATION)
    return log.withWatermark("logged_at", delay).dropDuplicatesWithinWatermark(OPERATION)


def write_totals(log: DataFrame, path: str, checkpoint: str, delay: str | None = "7 days") -> StreamingQuery:
    """Adds what has arrived so far to the totals under ``path``."""

    def add(batch: DataFrame, number: int) -> None:
        phase_totals(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        new_operations(log, delay).writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_totals(spark: SparkSession, path: str) -> DataFrame:
    """``phase_totals`` of all operations that have arrived, for ``summary_of`` and ``history_of``."""
    return merged_totals(spark.read.schema(TOTALS_SCHEMA).parquet(f"{path}/batch=*"))
