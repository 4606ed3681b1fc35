"""A store of model answers, so that no prompt is paid for twice.

An answer is kept under the SHA-256 of all it depends on: the prompt and the options of the
call.  ``answered`` reduces its prompts to the distinct ones, leaves out those that the store
has, and asks the rest in rounds of a bounded number of calls.  A round is one append to the
store, which becomes visible when its job commits: a run that is lost in a round has kept all
rounds before it, and the next run asks only for what is not there.  Calls that fail are kept
with their number of tries and are asked again by later runs, up to ``most_tries`` in all.

Rows meet their answers by a join on the key.  Prompts that a thousandth of all rows share, at
most a thousand of them, are answered from a broadcast; the others by a join whose keys are
then even.

Defined cases: rows without a prompt aren't asked about and get NULLs; of several answers under
one key a good one counts before a failed one, then the one of the most tries; other options or
another model make other keys; an empty table asks nothing and gives no rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.functions.shared import emptied, kept
from pagetables.operators.prompts import RESPONSE_COLUMNS, RESPONSE_DDL, SYSTEM_TEXT, run_model

CALLS_PER_ROUND = 100_000
MOST_TRIES = 3
SHARE = 1000  # a prompt of a thousandth of all rows is hot
STORE_DDL = f"answer_key string, tries int, {RESPONSE_DDL}"


def answer_key(prompt: Column, **options) -> Column:
    """What an answer is stored under; NULL for no prompt."""
    return F.sha2(F.concat(F.lit(json.dumps(options, sort_keys=True) + "\n"), prompt), 256)


def read_answers(spark: SparkSession, store: str) -> DataFrame:
    """One row a key: its good answer, or its last failure."""
    rows = spark.read.schema(STORE_DDL).parquet(f"{store}/answers")
    order = F.struct(F.col("error").isNull().alias("good"), "tries", "content")
    best = F.max_by(F.struct("tries", *RESPONSE_COLUMNS), order).alias("best")
    return rows.groupBy("answer_key").agg(best).select("answer_key", "best.*")


def _open(spark: SparkSession, store: str) -> None:
    """Makes the store if it isn't there; an append of nothing changes nothing."""
    spark.createDataFrame([], STORE_DDL).coalesce(1).write.mode("append").parquet(f"{store}/answers")


def answered(
    prompts: DataFrame,
    model_fn: Callable[[str, dict], dict],
    store: str,
    calls_per_round: int = CALLS_PER_ROUND,
    most_tries: int = MOST_TRIES,
    model: str = "default",
    system: str = SYSTEM_TEXT,
    max_tokens: int = 2000,
    temperature: float = 0.0,
    calls: int = 4,
) -> DataFrame:
    """``run_model`` through a store: the rows of ``prompts`` with the columns of a response and
    ``tries``.  Asks now, in rounds; the result reads the store."""
    spark = prompts.sparkSession
    options = {"model": model, "system": system, "max_tokens": max_tokens, "temperature": temperature}
    keyed = prompts.withColumn("answer_key", answer_key(F.col("prompt"), **options))
    distinct = keyed.filter("answer_key is not null").groupBy("answer_key").agg(
        F.first("prompt").alias("prompt"), F.count("*").alias("n")
    )
    _open(spark, store)
    asking = f"{store}/_asking-{uuid.uuid4().hex}"
    wanted = kept(distinct, asking)
    known = read_answers(spark, store).select("answer_key", "tries", F.col("error").isNull().alias("good"))
    missing = wanted.join(known, "answer_key", "left").filter(
        F.col("tries").isNull() | (~F.col("good") & (F.col("tries") < most_tries))
    ).select("answer_key", (F.coalesce("tries", F.lit(0)) + 1).alias("tries"), "prompt")
    todo_path = f"{asking}-todo"
    todo = kept(missing, todo_path)  # what a round appends must not change what the next one asks
    rounds = max(1, -(-todo.count() // calls_per_round))
    for number in range(rounds):
        part = todo.filter(F.pmod(F.xxhash64("answer_key"), F.lit(rounds)) == number)
        replies = run_model(part, model_fn, calls=calls, **options)
        replies.select(*[c.split(" ")[0] for c in STORE_DDL.split(", ")]).write.mode("append").parquet(f"{store}/answers")
    counts = kept(wanted.filter(F.col("n") > 1).select("answer_key", "n"), f"{asking}-counts")
    emptied(wanted, asking)
    emptied(todo, todo_path)
    return _with_answers(keyed.drop("prompt"), read_answers(spark, store), counts)


def _with_answers(rows: DataFrame, answers: DataFrame, counts: DataFrame) -> DataFrame:
    """Rows joined with the answers of their keys, hot keys apart.  A key is hot if its rows are
    a thousandth of those that share a prompt with another row."""
    shared = counts.agg(F.sum("n").alias("shared"))
    hot = F.broadcast(counts.filter(F.col("n") * SHARE >= shared.scalar()).select("answer_key"))
    facts = ["tries", *RESPONSE_COLUMNS]
    columns = [c for c in rows.columns if c != "answer_key"] + facts
    hot_answers = F.broadcast(answers.join(hot, "answer_key", "left_semi"))
    common = rows.join(hot, "answer_key", "left_semi").join(hot_answers, "answer_key", "left")
    rare = rows.filter("answer_key is not null").join(hot, "answer_key", "left_anti").join(answers, "answer_key", "left")
    # However many rows have no prompt, they meet no answer.
    silent = rows.filter("answer_key is null").withColumns({f: F.lit(None).cast(answers.schema[f].dataType) for f in facts})
    return common.select(columns).unionByName(rare.select(columns)).unionByName(silent.select(columns))
