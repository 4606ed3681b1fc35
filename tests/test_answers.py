"""Answers are asked for once, whatever is lost in between."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from pagetables.operators.answers import answered, read_answers


@pytest.fixture
def calls(tmp_path):
    folder = tmp_path / "calls"
    folder.mkdir()

    def said():
        return sorted((folder / name).read_text() for name in os.listdir(folder))

    return str(folder), said


def logging_model(folder, fails=(), dies=None):
    def model(prompt, options):
        with open(f"{folder}/{uuid.uuid4().hex}", "w") as file:
            file.write(prompt)
        if dies and os.path.exists(dies) and prompt.endswith("7"):
            os._exit(1)  # the worker is lost with its calls
        if prompt in fails:
            raise ValueError("no")
        return {"content": prompt.upper(), "total_tokens": 1}

    return model


def prompts(spark, n=60, copies=3):
    return spark.range(n * copies).select("id", F.concat(F.lit("p"), F.col("id") % n).alias("prompt"))


def test_equal_prompts_are_asked_once_and_never_again(spark, tmp_path, calls):
    folder, said = calls
    store = str(tmp_path / "store")
    frame = prompts(spark).unionByName(spark.sql("select -1L as id, cast(null as string) as prompt"))
    for _ in range(2):
        rows = {r["id"]: r for r in answered(frame, logging_model(folder), store, calls_per_round=7).collect()}
        assert len(said()) == len(set(said())) == 60
    assert len(rows) == 181 and rows[-1]["content"] is None and rows[-1]["tries"] is None
    assert all(r["content"] == f"P{i % 60}" and r["tries"] == 1 for i, r in rows.items() if i >= 0)
    other = answered(frame, logging_model(folder), store, model="other")
    assert other.count() == 181 and len(said()) == 120


def test_a_lost_round_costs_that_round_only(spark, tmp_path, calls):
    folder, said = calls
    store, dies = str(tmp_path / "store"), str(tmp_path / "die")
    open(dies, "w").close()
    with pytest.raises(Exception):
        answered(prompts(spark), logging_model(folder, dies=dies), store, calls_per_round=6)
    committed = {r["content"].lower() for r in read_answers(spark, store).collect()}
    before = len(said())
    os.unlink(dies)
    rows = answered(prompts(spark), logging_model(folder), store, calls_per_round=6).collect()
    again = said()[:]
    assert len(rows) == 180 and all(r["error"] is None for r in rows)
    assert len(again) - before == 60 - len(committed) and len(committed) < 60
    for prompt in committed:
        assert again.count(prompt) == 1


def test_failures_have_a_number_of_tries(spark, tmp_path, calls):
    folder, said = calls
    store = str(tmp_path / "store")
    for number, tries in enumerate((1, 2, 2)):
        rows = answered(prompts(spark, 5, 1), logging_model(folder, fails=("p2",)), store, most_tries=2).collect()
        bad = [r for r in rows if r["error"]]
        assert len(rows) == 5 and [(r["content"], r["tries"]) for r in bad] == [("Error: no", tries)], number
    assert said().count("p2") == 2
    rows = answered(prompts(spark, 5, 1), logging_model(folder), store, most_tries=3).collect()
    assert all(r["error"] is None for r in rows) and said().count("p2") == 3 and len(said()) == 7


def test_a_hot_prompt_and_an_empty_table(spark, tmp_path, calls):
    folder, said = calls
    store = str(tmp_path / "store")
    frame = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 50)).alias("prompt"))
    found = answered(frame, logging_model(folder), store)
    assert found.count() == 30_000 and found.filter("content = 'HOT'").count() == 10_000
    assert len(said()) == 51
    assert answered(frame.limit(0), logging_model(folder), store).count() == 0
