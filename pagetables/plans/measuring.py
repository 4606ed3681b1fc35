"""Queries over a metrics log made from the events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.functions.shared import kept, new_path
from pagetables.operators.history import add_runs, read_history
from pagetables.operators.metrics import (
    FEEDBACK,
    INITIAL,
    agent_detail,
    append_metrics,
    combined_report,
    history_of,
    phase_summary,
    positive_flags,
    report_status,
    run_history,
    with_messages,
)
from pagetables.plans import render
from pagetables.plans.registry import query
from pagetables.streaming.usage import LOG_COLUMNS, log_stream, read_totals, write_totals

# Runs are users; errors have no agent, purchases and sign-ups are feedback.
LOG = """(
  SELECT user_id AS run_id, event_id AS seq, CASE WHEN event_type <> 'error' THEN event_type END AS agent,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 'feedback' ELSE 'initial' END AS phase,
         CASE WHEN event_type <> 'click' THEN value END AS latency_s, value / 2 AS memory_mb,
         CASE WHEN event_type = 'click' THEN 0 ELSE CAST(round(value * 1000) AS BIGINT) END AS ms,
         CASE WHEN event_type <> 'view' THEN CAST(props->>'$.k' AS BIGINT) END AS prompt_tokens,
         CAST(props->>'$.k' AS BIGINT) * 2 AS completion_tokens, CAST(props->>'$.k' AS BIGINT) * 3 AS total_tokens
  FROM events)"""


def operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = render.load(spark, sf_dir, "events")
    kind, tokens = F.col("event_type"), F.get_json_object("props", "$.k").cast("bigint")
    return events.select(
        F.col("user_id").alias("run_id"),
        F.col("event_id").alias("seq"),
        F.when(kind != "error", kind).alias("agent"),
        F.when(kind != "click", F.col("value")).alias("latency_s"),
        (F.col("value") / 2).alias("memory_mb"),
        F.when(kind != "view", tokens).alias("prompt_tokens"),
        (tokens * 2).alias("completion_tokens"),
        (tokens * 3).alias("total_tokens"),
        kind.isin("purchase", "signup").alias("is_feedback"),
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as one projection of the events."""
    phase = F.when(F.col("is_feedback"), FEEDBACK).otherwise(INITIAL)
    return operations(spark, sf_dir).withColumn("phase", phase).drop("is_feedback")


TOTALS = f"""(
  SELECT run_id, phase, count(*) AS operations, CAST(sum(ms) AS BIGINT) AS ms,
         CAST(sum(coalesce(prompt_tokens, 0)) AS BIGINT) AS prompt_tokens,
         CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens, CAST(sum(total_tokens) AS BIGINT) AS total_tokens
  FROM {LOG} GROUP BY run_id, phase)"""


@query(f"SELECT run_id, seq, agent, phase, latency_s, total_tokens, CASE WHEN phase = 'feedback' THEN 'm' END AS model FROM {LOG} l")
def appended_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches appended with their phases; the second has one more column."""
    batch = operations(spark, sf_dir)
    first = append_metrics(
        batch.filter("false").drop("is_feedback").withColumn("phase", F.lit("")),
        batch.filter(~F.col("is_feedback")).drop("is_feedback"), INITIAL,
    )
    second = batch.filter("is_feedback").drop("is_feedback").withColumn("model", F.lit("m"))
    return append_metrics(first, second, FEEDBACK).select(
        "run_id", "seq", "agent", "phase", "latency_s", "total_tokens", "model"
    )


@query(f"""
  SELECT run_id, phase, operations, ms / 1000.0::DOUBLE AS total_time_s, prompt_tokens, completion_tokens, total_tokens,
         ((2 * ms + operations) // (2 * operations)) / 1000.0::DOUBLE AS average_time_s,
         ((20 * total_tokens + operations) // (2 * operations)) / 10.0::DOUBLE AS average_tokens
  FROM {TOTALS} t""")
def phase_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals and averages per run and phase."""
    return phase_summary(event_log(spark, sf_dir))


@query(f"""
  SELECT r.run_id, p.phase, t.operations,
         CASE WHEN t.operations IS NULL THEN 'No ' || CASE p.phase WHEN 'initial' THEN 'initial generation' ELSE 'feedback iterations' END || ' metrics collected' END AS message
  FROM (SELECT DISTINCT c_custkey AS run_id FROM customer) r
  CROSS JOIN (SELECT unnest(['initial', 'feedback']) AS phase) p
  LEFT JOIN {TOTALS} t ON t.run_id = r.run_id AND t.phase = p.phase""")
def empty_phases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs with both phases; those without operations say so."""
    runs = render.load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("run_id"))
    summary = phase_summary(event_log(spark, sf_dir))
    return with_messages(runs, summary).select("run_id", "phase", "operations", "message")


@query(f"""
  SELECT run_id, phase, CAST(sum(operations) AS BIGINT) AS operations, sum(ms) / 1000.0::DOUBLE AS total_time_s,
         CAST(sum(total_tokens) AS BIGINT) AS total_tokens
  FROM {TOTALS} t GROUP BY GROUPING SETS ((run_id, phase), (run_id))""")
def combined_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phases and their total per run."""
    return combined_report(event_log(spark, sf_dir))


@query("SELECT count(*) AS operations, CASE WHEN count(*) = 0 THEN 'No metrics collected' END AS message FROM events")
def log_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether anything was logged."""
    return report_status(event_log(spark, sf_dir))


@query(f"""
  SELECT run_id, seq, agent, CASE phase WHEN 'initial' THEN 'Initial Generation' ELSE 'Feedback Iteration' END AS phase,
         coalesce(latency_s, 0) AS latency_s, memory_mb, coalesce(prompt_tokens, 0) AS prompt_tokens, completion_tokens, total_tokens
  FROM {LOG} l WHERE agent IS NOT NULL""")
def agent_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operations that name an agent."""
    return agent_detail(event_log(spark, sf_dir))


HISTORY = f"""
  SELECT run_id, CAST(sum(operations) AS BIGINT) AS agents, sum(ms) / 1000.0::DOUBLE AS total_time_s,
         CAST(sum(total_tokens) AS BIGINT) AS total_tokens,
         coalesce(sum(ms) FILTER (phase = 'initial'), 0) / 1000.0::DOUBLE AS initial_time_s,
         CAST(coalesce(sum(total_tokens) FILTER (phase = 'initial'), 0) AS BIGINT) AS initial_tokens,
         coalesce(sum(ms) FILTER (phase = 'feedback'), 0) / 1000.0::DOUBLE AS feedback_time_s,
         CAST(coalesce(sum(total_tokens) FILTER (phase = 'feedback'), 0) AS BIGINT) AS feedback_tokens
  FROM {TOTALS} t GROUP BY run_id"""


@query(HISTORY)
def run_histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per run, by phase."""
    return run_history(event_log(spark, sf_dir))


@query(HISTORY)
def streamed_histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as a stream of three deliveries, each spread over the whole time, so most of the
    second and third is late; the third holds the first once more."""
    times = render.load(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("logged_at"))
    log = event_log(spark, sf_dir).join(times, "seq").withColumn("model", F.lit(None).cast("string")).select(*LOG_COLUMNS)
    arriving, totals, progress = (new_path(spark, name) for name in ("log", "totals", "progress"))
    for numbers in ([0], [1], [2, 0]):
        log.filter((F.col("seq") % 3).isin(numbers)).write.mode("append").parquet(arriving)
        write_totals(log_stream(spark, arriving), totals, progress, "60 days").awaitTermination()
    return history_of(read_totals(spark, totals))


@query(f"SELECT run_id, agents, CASE WHEN run_id % 2 = 0 THEN -1.0::DOUBLE ELSE total_time_s END AS total_time_s FROM ({HISTORY}) h")
def new_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs added to a stored history that already has every second one."""
    runs = kept(run_history(event_log(spark, sf_dir)).select("run_id", "agents", "total_time_s"), new_path(spark, "runs"))
    store = new_path(spark, "history")
    add_runs(runs.filter("run_id % 2 = 0").withColumn("total_time_s", F.lit(-1.0)), store)
    add_runs(runs, store)
    return read_history(spark, store)


@query(f"SELECT run_id, bool_or(total_tokens > 0) AS any_tokens, bool_or(memory_mb > 0) AS any_memory FROM {LOG} l GROUP BY run_id")
def usage_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a run used tokens or memory at all."""
    return positive_flags(event_log(spark, sf_dir))
