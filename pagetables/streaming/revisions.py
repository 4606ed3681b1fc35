"""Feedback rounds whose answers arrive later, as streams.

Requests ``(schema_id, round, prompt, asked_at)`` and answers ``(schema_id, round, content,
answered_at)`` arrive as two streams.  A request waits as state of their join until its answer
comes or ``wait`` has passed; Spark keeps that state by schema and round, so a schema with much
of the feedback is spread over all tasks, and drops it once the watermark has gone by.  What a
batch decides is written under its number: a batch that runs again replaces its own rows.

Every request gets one outcome:

* ``answered``: the first answer of its time (of equal times the least text), up to ``wait``
  after the request, that of the same instant included;
* ``timed out``: no such answer, and both streams have passed that time by more than ``delay``
  in one run (Spark keeps the clock of both together, not of each, when a run ends);
* ``pending``: not decided yet.  Only ``outcomes`` says so, since no batch has a row for it.

An answer without a request, before it, or after its time is ``stray``: it has a row of its own,
and its request has timed out.  Rows that come when the watermark is beyond them are left out;
their requests have timed out already.  Repeated requests and answers count once, of requests the
first.  Rows without a schema, a round or a time are no requests and no answers, but a row with a
time alone moves the clock of its stream, as a source does that has nothing to say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

REQUEST_SCHEMA = "schema_id bigint, round int, prompt string, asked_at timestamp"
ANSWER_SCHEMA = "schema_id bigint, round int, content string, answered_at timestamp"
DECIDED_SCHEMA = "schema_id bigint, round int, asked_at timestamp, answered_at timestamp, content string"
KEY = ["schema_id", "round"]


def arriving(spark: SparkSession, directory: str, schema: str, files_per_trigger: int = 1000) -> DataFrame:
    """Parquet files of requests or answers that appear in a directory."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(directory)


def decided(requests: DataFrame, answers: DataFrame, wait: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """A stream of ``DECIDED_SCHEMA``: pairs of a request and an answer of its time, requests
    that timed out (no ``answered_at``), and stray answers (no ``asked_at``)."""
    asked = requests.select(*KEY, "asked_at").withWatermark("asked_at", delay)
    given = answers.select(
        F.col("schema_id").alias("_schema"), F.col("round").alias("_round"), "content", "answered_at"
    ).withWatermark("answered_at", delay)
    in_time = F.expr(f"answered_at >= asked_at AND answered_at <= asked_at + INTERVAL {wait}")
    same = (F.col("schema_id") == F.col("_schema")) & (F.col("round") == F.col("_round"))
    return asked.join(given, same & in_time, "full").select(
        F.coalesce("schema_id", "_schema").alias("schema_id"), F.coalesce("round", "_round").alias("round"),
        "asked_at", "answered_at", "content",
    )


def write_decided(requests: DataFrame, answers: DataFrame, path: str, checkpoint: str, wait: str = "1 day",
                  delay: str = "1 hour") -> StreamingQuery:
    """Adds what the rows that have arrived so far decide to the table under ``path``."""

    def add(batch: DataFrame, number: int) -> None:
        known = batch.filter("schema_id IS NOT NULL AND round IS NOT NULL")
        known.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        decided(requests, answers, wait, delay).writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_decided(spark: SparkSession, path: str) -> DataFrame:
    """One row a request that is decided, and one a stray answer, with ``outcome``.

    A request sent twice may have been paired twice: its first answered time counts, and a pair
    counts before a time-out.  Partial minima leave each task with a row a request."""
    rows = spark.read.schema(DECIDED_SCHEMA).parquet(f"{path}/batch=*")
    answer = F.struct("answered_at", "content")
    asked = rows.filter("asked_at IS NOT NULL").groupBy(*KEY).agg(
        F.min("asked_at").alias("asked_at"), F.min(F.when(F.col("answered_at").isNotNull(), answer)).alias("answer")
    ).select(
        *KEY, F.when(F.col("answer").isNull(), "timed out").otherwise("answered").alias("outcome"), "asked_at", "answer.*"
    )
    stray = rows.filter("asked_at IS NULL").select(
        *KEY, F.lit("stray").alias("outcome"), "asked_at", "answered_at", "content"
    ).distinct()
    return asked.unionByName(stray)


def outcomes(requests: DataFrame, found: DataFrame) -> DataFrame:
    """``(schema_id, round, outcome, content)`` of all requests that were sent, a batch frame,
    from ``read_decided``; those without an outcome yet are ``pending``."""
    sent = requests.filter("schema_id IS NOT NULL AND round IS NOT NULL AND asked_at IS NOT NULL").select(*KEY).distinct()
    known = found.filter("outcome <> 'stray'").select(*KEY, "outcome", "content")
    return sent.join(known, KEY, "left").select(*KEY, F.coalesce("outcome", F.lit("pending")).alias("outcome"), "content")


def answers_of_round(found: DataFrame, number: int) -> DataFrame:
    """``(schema_id, doc)`` of the answers to one round, for ``parse.load_strict`` and
    ``schemas.refine``."""
    return found.filter((F.col("outcome") == "answered") & (F.col("round") == number)).select(
        "schema_id", F.col("content").alias("doc")
    )
