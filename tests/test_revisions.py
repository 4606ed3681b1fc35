"""Feedback whose answers arrive later: late, lost, repeated and stray ones."""

import datetime
import json

import pytest

from pagetables.operators.parse import load_strict
from pagetables.operators.schemas import refine, to_json_docs
from pagetables.plans.revising import part_schemas
from pagetables.streaming.revisions import (
    ANSWER_SCHEMA,
    REQUEST_SCHEMA,
    answers_of_round,
    arriving,
    outcomes,
    read_decided,
    write_decided,
)

START = datetime.datetime(2024, 1, 1)


def at(hours):
    return START + datetime.timedelta(hours=hours)


@pytest.fixture
def deliver(spark, tmp_path):
    folders = {n: str(tmp_path / n) for n in ("requests", "answers", "decided", "progress")}

    def add(requests=(), answers=()):
        for rows, schema, name in ((requests, REQUEST_SCHEMA, "requests"), (answers, ANSWER_SCHEMA, "answers")):
            spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(folders[name])
        streams = [arriving(spark, folders[n], s) for n, s in (("requests", REQUEST_SCHEMA), ("answers", ANSWER_SCHEMA))]
        write_decided(*streams, folders["decided"], folders["progress"], "24 hours").awaitTermination()
        return read_decided(spark, folders["decided"])

    add.sent = lambda: spark.read.parquet(folders["requests"])
    return add


def told(frame):
    return sorted((r["schema_id"], r["round"], r["outcome"], r["content"] or "") for r in frame.collect())


def ask(key, hours, number=1):
    return (key, number, "prompt", at(hours))


def reply(key, hours, content="yes", number=1):
    return (key, number, content, at(hours))


CLOCK = ([(None, None, None, at(1000))], [(None, None, None, at(1000))])


def test_answered_late_lost_and_stray(deliver):
    deliver([ask(1, 0), ask(2, 0), ask(3, 0), ask(4, 5), ask(5, 0), ask(1, 2, 2)], [reply(1, 3), reply(5, 24, "just")])
    deliver([], [reply(4, 20, "later"), reply(9, 6, "who?"), reply(2, 25, "late"), (4, 1, "no time", None)])
    found = deliver(*CLOCK)
    assert told(found) == [
        (1, 1, "answered", "yes"), (1, 2, "timed out", ""), (2, 1, "stray", "late"), (2, 1, "timed out", ""),
        (3, 1, "timed out", ""), (4, 1, "answered", "later"), (5, 1, "answered", "just"), (9, 1, "stray", "who?"),
    ]
    assert (3, 1, "timed out", "") in told(outcomes(deliver.sent(), found))


def test_pending_until_both_clocks_have_passed_in_a_run(deliver):
    found = deliver([ask(1, 0), ask(2, 0)], [reply(1, 1)])
    assert told(outcomes(deliver.sent(), found)) == [(1, 1, "answered", "yes"), (2, 1, "pending", "")]
    found = deliver(CLOCK[0])  # the answers may still come
    assert told(outcomes(deliver.sent(), found))[1] == (2, 1, "pending", "")
    found = deliver(*CLOCK)
    assert told(outcomes(deliver.sent(), found))[1] == (2, 1, "timed out", "")
    found = deliver([], [reply(2, 2, "far too late")])  # beyond the watermark: left out
    assert told(outcomes(deliver.sent(), found))[1] == (2, 1, "timed out", "")


def test_answers_before_their_requests_arrive_and_copies(deliver):
    deliver([], [reply(1, 2, "b"), reply(1, 2, "a"), reply(1, 1, "first"), reply(1, 1, "first")])
    found = deliver([ask(1, 0), ask(1, 0)])
    assert told(found) == [(1, 1, "answered", "first")]
    deliver([ask(1, 0)], [reply(1, 3, "again")])
    assert told(deliver(*CLOCK)) == [(1, 1, "answered", "first")]


def test_nothing_arrives(deliver):
    assert told(deliver()) == [] == told(outcomes(deliver.sent(), deliver()))


def test_answers_revise_schemas(spark, deliver):
    schemas = part_schemas(spark, "/root/testdata/sf0.001").filter("schema_id <= 3")
    docs = {r["schema_id"]: json.loads(r["doc"]) for r in to_json_docs(schemas).collect()}
    deliver([ask(i, 0) for i in (1, 2, 3)], [reply(1, 2, json.dumps(docs[1] | {"name": "better"})), reply(2, 3, "prose")])
    found = deliver(*CLOCK)
    revised = refine(schemas, load_strict(answers_of_round(found, 1)))
    got = {r["schema_id"]: (r["name"], r["version"]) for r in revised.collect()}
    assert got[1] == ("better", 1)
    assert all(got[i] == (docs[i]["name"], 0) for i in (2, 3))
