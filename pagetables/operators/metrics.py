"""The metrics log and its summaries.

``log(run_id, seq, agent, phase, latency_s, memory_mb, prompt_tokens, completion_tokens,
total_tokens, model)`` has one row per operation; missing measurements count as zero.
Times are summed as decimals, so sums do not depend on the order of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INITIAL = "initial"
FEEDBACK = "feedback"
PHASE_TITLES = {INITIAL: "Initial Generation", FEEDBACK: "Feedback Iterations"}
EMPTY_TEXT = "No metrics collected"
TIME = "decimal(28,6)"


def _number(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def _seconds(name: str = "latency_s") -> Column:
    return F.coalesce(F.col(name).cast("decimal(18,6)"), F.lit(0).cast("decimal(18,6)"))


def _rounded(value: Column, places: int) -> Column:
    return F.round(value, places).cast("double")


def metrics_of(
    responses: DataFrame, run_id: Column, agent: str, phase: str, key: str = "doc_id"
) -> DataFrame:
    """Log rows of a model's responses (``run_model``): one operation for every call.

    ``run_id`` is a column of the responses or a literal; the key orders a run's operations.
    Rows that were not asked about have no model and no operation.
    """
    return responses.filter(F.col("model").isNotNull()).select(
        run_id.alias("run_id"), F.col(key).alias("seq"), F.lit(agent).alias("agent"), F.lit(phase).alias("phase"),
        "latency_s", F.lit(None).cast("double").alias("memory_mb"), "prompt_tokens", "completion_tokens",
        "total_tokens", "model",
    )


def append_metrics(log: DataFrame, batch: DataFrame, phase: str, agent: str | None = None) -> DataFrame:
    """The log with a batch of operations, marked with their phase and agent."""
    marked = batch.withColumn("phase", F.lit(phase))
    if agent:
        marked = marked.withColumn("agent", F.lit(agent))
    return log.unionByName(marked, allowMissingColumns=True)


def _phase_totals(log: DataFrame) -> DataFrame:
    """Per run and phase: counts and exact sums; combines before the exchange."""
    return log.groupBy("run_id", "phase").agg(
        F.count(F.lit(1)).alias("operations"),
        F.sum(_seconds()).cast(TIME).alias("seconds"),
        F.sum(_number("prompt_tokens")).alias("prompt_tokens"),
        F.sum(_number("completion_tokens")).alias("completion_tokens"),
        F.sum(_number("total_tokens")).alias("total_tokens"),
    )


def phase_totals(log: DataFrame) -> DataFrame:
    """``(run_id, phase, operations, seconds, …_tokens)``: sums that can be merged further."""
    return _phase_totals(log)


def merged_totals(totals: DataFrame) -> DataFrame:
    """One row per run and phase of the ``phase_totals`` of several parts of a log."""
    return totals.groupBy("run_id", "phase").agg(
        F.sum("operations").alias("operations"),
        F.sum("seconds").cast(TIME).alias("seconds"),
        *[F.sum(c).alias(c) for c in ("prompt_tokens", "completion_tokens", "total_tokens")],
    )


def phase_summary(log: DataFrame) -> DataFrame:
    """One row per run and phase with totals and averages."""
    return summary_of(_phase_totals(log))


def summary_of(totals: DataFrame) -> DataFrame:
    """``phase_summary`` of a log whose totals are there."""
    n = F.col("operations")
    return totals.select(
        "run_id",
        "phase",
        "operations",
        _rounded(F.col("seconds"), 3).alias("total_time_s"),
        "prompt_tokens",
        "completion_tokens",
        "total_tokens",
        _rounded(F.col("seconds") / n, 3).alias("average_time_s"),
        _rounded(F.col("total_tokens").cast(TIME) / n, 1).alias("average_tokens"),
    )


def with_messages(runs: DataFrame, summary: DataFrame) -> DataFrame:
    """Every run with both phases; a phase without operations has a message instead."""
    titles = F.create_map(*[F.lit(x) for pair in PHASE_TITLES.items() for x in pair])
    phases = runs.select("run_id").select(
        "run_id", F.explode(F.array(*[F.lit(p) for p in PHASE_TITLES])).alias("phase")
    )
    return phases.join(summary, ["run_id", "phase"], "left").withColumn(
        "message",
        F.when(
            F.col("operations").isNull(),
            F.concat(F.lit("No "), F.lower(titles[F.col("phase")]), F.lit(" metrics collected")),
        ),
    )


def combined_report(log: DataFrame) -> DataFrame:
    """Per run the phases and, with a NULL phase, their total.

    The total adds the rounded phase times.  The log is aggregated once; the roll-up works
    on its two rows per run.
    """
    phases = _phase_totals(log).withColumn(
        "seconds", F.round("seconds", 3).cast("decimal(28,3)")
    )
    return (
        phases.rollup("run_id", "phase")
        .agg(
            F.sum("operations").alias("operations"),
            F.sum("seconds").alias("seconds"),
            F.sum("total_tokens").alias("total_tokens"),
            F.grouping_id().alias("level"),
        )
        .filter(F.col("level") < 3)
        .select(
            "run_id", "phase", "operations",
            _rounded(F.col("seconds"), 3).alias("total_time_s"), "total_tokens",
        )
    )


def report_status(log: DataFrame) -> DataFrame:
    """One row: the number of operations, and a message when there are none."""
    return log.agg(F.count(F.lit(1)).alias("operations")).withColumn(
        "message", F.when(F.col("operations") == 0, EMPTY_TEXT)
    )


def agent_detail(log: DataFrame) -> DataFrame:
    """The operations that name an agent, with the title of their phase."""
    return log.filter(F.col("agent").isNotNull()).select(
        "run_id",
        "seq",
        "agent",
        F.when(F.col("phase") == INITIAL, "Initial Generation")
        .otherwise("Feedback Iteration")
        .alias("phase"),
        _number("latency_s").alias("latency_s"),
        _number("memory_mb").alias("memory_mb"),
        _number("prompt_tokens").alias("prompt_tokens"),
        _number("completion_tokens").alias("completion_tokens"),
        _number("total_tokens").alias("total_tokens"),
    )


def run_history(log: DataFrame) -> DataFrame:
    """One row per run: total, initial and feedback time and tokens."""
    return history_of(_phase_totals(log))


def history_of(totals: DataFrame) -> DataFrame:
    """``run_history`` of a log whose totals are there."""
    totals = totals.withColumn("seconds", F.round("seconds", 3).cast("decimal(28,3)"))

    def of(phase: str, name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("phase") == phase, F.col(name))), F.lit(0))

    return totals.groupBy("run_id").agg(
        F.sum("operations").alias("agents"),
        _rounded(F.sum("seconds"), 3).alias("total_time_s"),
        F.sum("total_tokens").alias("total_tokens"),
        _rounded(of(INITIAL, "seconds"), 3).alias("initial_time_s"),
        of(INITIAL, "total_tokens").alias("initial_tokens"),
        _rounded(of(FEEDBACK, "seconds"), 3).alias("feedback_time_s"),
        of(FEEDBACK, "total_tokens").alias("feedback_tokens"),
    )


def append_if_new(history: DataFrame, runs: DataFrame) -> DataFrame:
    """The history with those runs it does not have yet; both have one row per run."""
    return history.unionByName(runs.join(history.select("run_id"), "run_id", "left_anti"))


def positive_flags(log: DataFrame) -> DataFrame:
    """Per run: whether any operation used tokens, or memory."""
    return log.groupBy("run_id").agg(
        F.bool_or(_number("total_tokens") > 0).alias("any_tokens"),
        F.bool_or(_number("memory_mb") > 0).alias("any_memory"),
    )
