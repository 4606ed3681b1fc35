"""A stored history keeps one row a run, whatever its writers do."""

from pagetables.functions.shared import kept
from pagetables.operators.history import add_runs, append_rows, new_rows, read_history
from pagetables.operators.metrics import append_if_new

SCHEMA = "run_id bigint, agents bigint, total_time_s double"


def said(spark, store):
    return sorted(map(tuple, read_history(spark, store).collect()), key=str)


def test_known_runs_stay_as_they_are(spark, tmp_path):
    store = str(tmp_path / "history")
    add_runs(spark.createDataFrame([], SCHEMA), store)
    assert said(spark, store) == []
    add_runs(spark.createDataFrame([(1, 1, 1.0), (2, 1, 1.0)], SCHEMA), store)
    add_runs(spark.createDataFrame([(2, 9, 9.0), (3, 9, 9.0), (3, 8, 8.0), (None, 7, None)], SCHEMA), store)
    add_runs(spark.createDataFrame([(None, 6, 6.0), (1, 0, 0.0)], SCHEMA), store)
    assert said(spark, store) == sorted([(1, 1, 1.0), (2, 1, 1.0), (3, 8, 8.0), (None, 7, None)], key=str)


def test_interleaved_writers_add_a_run_once(spark, tmp_path):
    store = str(tmp_path / "history")
    add_runs(spark.createDataFrame([(0, 0, 0.0)], SCHEMA), store)
    # Both look before either writes.
    looks = [
        kept(new_rows(spark.createDataFrame([(1, i, 1.0), (10 + i, i, 1.0)], SCHEMA), store), str(tmp_path / f"look{i}")) for i in (1, 2)
    ]
    append_rows(looks[1], store)
    alone = said(spark, store)
    assert alone == [(0, 0, 0.0), (1, 2, 1.0), (12, 2, 1.0)]
    append_rows(looks[0], store)
    both = said(spark, store)
    assert [r[0] for r in both] == [0, 1, 11, 12] and both[1][1] in (1, 2)
    add_runs(spark.createDataFrame([(1, 5, 5.0), (20, 5, 5.0)], SCHEMA), store)
    assert said(spark, store) == [*both, (20, 5, 5.0)]


def test_a_lost_writer_adds_nothing(spark, tmp_path):
    store = str(tmp_path / "history")
    new_rows(spark.createDataFrame([(1, 1, 1.0)], SCHEMA), store)  # never appended
    assert said(spark, store) == []
    add_runs(spark.createDataFrame([(1, 2, 2.0)], SCHEMA), store)
    assert said(spark, store) == [(1, 2, 2.0)]


def test_histories_that_are_not_stored(spark):
    frames = [spark.createDataFrame(rows, SCHEMA) for rows in ([(1, 1, 1.0)], [(1, 2, 2.0), (2, 2, 2.0)])]
    assert sorted(map(tuple, append_if_new(*frames).collect())) == [(1, 1, 1.0), (2, 2, 2.0)]
