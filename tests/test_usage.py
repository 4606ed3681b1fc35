"""A metrics log as a stream: late rows, copies, batches that run twice."""

import datetime

import pytest

from pagetables.operators.metrics import history_of, phase_summary, run_history, summary_of
from pagetables.streaming.usage import LOG_SCHEMA, log_stream, read_totals, write_totals

START = datetime.datetime(2024, 1, 1)


def operation(run, seq, hour, phase="initial", seconds=0.1):
    return (run, seq, "a", phase, seconds, None, seq, 1, seq + 1, "m", START + datetime.timedelta(hours=hour))


@pytest.fixture
def stream(spark, tmp_path):
    arriving, totals, progress = (str(tmp_path / n) for n in ("in", "totals", "progress"))

    def deliver(rows, delay="48 hours"):
        spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(arriving)
        write_totals(log_stream(spark, arriving), totals, progress, delay).awaitTermination()
        return read_totals(spark, totals)

    return deliver


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_three_batches_with_late_rows_equal_the_batch_queries(spark, stream):
    first = [operation(r, s, s % 40, "initial" if s % 3 else "feedback", s / 7) for r in (1, 2, None) for s in range(40)]
    late = [operation(r, s + 100, s % 30) for r in (1, 3) for s in range(30)]
    third = [operation(1, s + 200, 50 + s, "feedback") for s in range(5)] + first[:50]
    stream(first)
    stream(late)
    totals = stream(third + third)
    whole = spark.createDataFrame(first + late + third[:5], LOG_SCHEMA)
    assert rows_of(summary_of(totals)) == rows_of(phase_summary(whole))
    assert rows_of(history_of(totals)) == rows_of(run_history(whole))


def test_a_replayed_delivery_adds_nothing(spark, stream):
    rows = [operation(r, s, s) for r in range(3) for s in range(20)]
    before = rows_of(stream(rows))
    assert rows_of(stream(rows)) == before == rows_of(stream(rows[:7]))


def test_rows_beyond_the_delay(spark, stream):
    stream([operation(1, 1, 0), operation(1, 2, 500)])
    stream([operation(1, 3, 501)])
    totals = rows_of(stream([operation(1, 4, 10), operation(1, 5, 480)]))
    assert totals[0][2] == 4  # the one of 490 hours ago is left out, the one of 21 is not


def test_without_a_delay_all_rows_count(spark, stream):
    stream([operation(1, 1, 0), operation(1, 2, 500)], None)
    assert rows_of(stream([operation(1, 4, 10), operation(1, 1, 0)], None))[0][2] == 3


def test_a_hot_run_is_deduplicated_by_operation(spark, tmp_path):
    """The state's exchange is keyed by the whole operation, and sums combine before theirs."""
    log = spark.createDataFrame([operation(1, s, 0) for s in range(3)], LOG_SCHEMA)
    log.write.parquet(str(tmp_path / "in"))
    query = write_totals(log_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "p"))
    query.awaitTermination()
    assert query.lastProgress is not None and read_totals(spark, str(tmp_path / "out")).first()["operations"] == 3
