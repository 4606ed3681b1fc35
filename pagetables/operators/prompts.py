"""Prompts for a batch model, and the batch call itself."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pagetables.functions.text import json_text

SAMPLE_ROWS = 5
SYSTEM_TEXT = "You infer precise column types. Reply with one JSON object and nothing else."

# The answer every schema prompt asks for.
ANSWER_SHAPE = """{"name": "...", "description": "...", "columns": [{"name": "...", \
"type": "string|int|float|date|boolean|object|array|null", "description": "...", \
"nullable": true, "format": "...", "constraints": {"minimum": 0, "maximum": 1, \
"pattern": "..."}}]}"""
RULES = (
    "Give one column per header, in order, named exactly like the header even if it is empty. "
    "Take types, nullability, formats and constraints from the values. Reply with JSON only."
)
NAME_RULES_TEXT = (
    "There are no values: judge by the names alone, and add \"inferred\": true and a "
    "\"confidence\" between 0 and 1 to every column. Give one column per header, in order, "
    "named exactly like the header. Reply with JSON only."
)


def kind_of(table: Column) -> Column:
    """``schema_csv``, ``vertical``, ``samples``, ``names``; NULL without headers."""
    return F.when(
        F.size(table["headers"]) > 0,
        F.when(table["properties"].isNotNull(), "schema_csv")
        .when(F.size(table["rows"]) == 0, "names")
        .when(table["is_vertical"], "vertical")
        .otherwise("samples"),
    )


def prompt_kind(selected: DataFrame) -> DataFrame:
    """Add ``readiness`` and ``kind`` to rows with a ``table`` struct."""
    table = F.col("table")
    filled = (F.size(table["headers"]) > 0) & (F.size(table["rows"]) > 0)
    return selected.withColumn(
        "readiness", F.when(filled, "Success").otherwise("No data found")
    ).withColumn("kind", kind_of(table))


def quoted_list(items: Column) -> Column:
    return F.to_json(items)


def pair_lines(pairs: Column) -> Column:
    return F.array_join(F.transform(pairs, lambda p: F.concat(p["name"], F.lit(": "), p["value"])), "\n")


def table_prompt(table: Column, kind: Column) -> Column:
    """The prompt for one table, by kind."""
    headers = F.concat(F.lit("Headers: "), quoted_list(table["headers"]), F.lit("\n"))
    rows = F.array_join(
        F.transform(F.slice(table["rows"], 1, SAMPLE_ROWS), quoted_list), "\n"
    )
    values = F.coalesce(F.get(table["rows"], F.lit(0)), F.array().cast("array<string>"))
    properties = F.transform(
        table["headers"],
        lambda h, i: F.struct(
            h.alias("name"), F.coalesce(F.get(values, i), F.lit("(no value)")).alias("value")
        ),
    )
    shape = F.lit(f"\nReply in this form:\n{ANSWER_SHAPE}\n")
    return (
        F.when(
            kind == "samples",
            F.concat(F.lit("Describe the columns of a table.\n"), headers, F.lit("Rows:\n"), rows,
                     shape, F.lit(RULES)),
        )
        .when(
            kind == "vertical",
            F.concat(F.lit("Describe the entity given by these properties and their values.\n"),
                     pair_lines(properties), shape, F.lit(RULES)),
        )
        .when(
            kind == "schema_csv",
            F.concat(F.lit("This file describes the columns of a database table.\n"), headers,
                     F.lit("Properties:\n"), pair_lines(table["properties"]), shape,
                     F.lit("Also give \"primary_key\" and \"foreign_key\" where stated. "), F.lit(RULES)),
        )
        .when(
            kind == "names",
            F.concat(F.lit("Describe the columns of a table from its headers.\n"), headers, shape,
                     F.lit(NAME_RULES_TEXT)),
        )
    )


def schema_prompts(selected: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(doc_id, table_index, kind, prompt)`` of the selected tables that have headers."""
    return (
        prompt_kind(selected)
        .filter(F.col("kind").isNotNull())
        .select(
            key, F.col("table.table_id").alias("table_index"), "kind",
            table_prompt(F.col("table"), F.col("kind")).alias("prompt"),
        )
    )


def refine_prompts(docs: DataFrame, feedback: DataFrame) -> DataFrame:
    """``(schema_id, prompt)``: a schema document with the reader's feedback on it."""
    return docs.join(feedback, "schema_id").select(
        "schema_id",
        F.concat(
            F.lit("Revise this table schema as the feedback asks.\n\nSchema:\n"), F.col("doc"),
            F.lit("\n\nFeedback:\n"), json_text(F.col("text")),
            F.lit(
                "\n\nUse precise types, add formats and constraints where they are known, keep "
                "names and structure. Reply with the whole revised schema as JSON only."
            ),
        ).alias("prompt"),
    )


RESPONSE_DDL = (
    "content string, error string, prompt_tokens bigint, completion_tokens bigint, "
    "total_tokens bigint, latency_s double, model string"
)
RESPONSE_COLUMNS = [field.split(" ")[0] for field in RESPONSE_DDL.split(", ")]
_ARROW = {"string": pa.string(), "long": pa.int64(), "double": pa.float64()}
BATCH = 32
_USAGE = ("prompt_tokens", "completion_tokens", "total_tokens")


def run_model(
    prompts: DataFrame,
    model_fn: Callable[[str, dict], dict],
    model: str = "default",
    system: str = SYSTEM_TEXT,
    max_tokens: int = 2000,
    temperature: float = 0.0,
    calls: int = 4,
) -> DataFrame:
    """Ask ``model_fn(prompt, options)`` for every prompt; every prompt gets a response row.

    ``model_fn`` returns ``{"content": …}`` with optional token counts; it is called from
    ``calls`` threads at once in each task, and answers are passed on after ``BATCH`` prompts.
    What it raises, and a reply that can't be read, becomes ``content = "Error: …"`` and
    ``error``.  Rows without a prompt aren't asked about and get NULLs.  It runs once per row and again when a task is retried, so write the responses
    before using them more than once.
    """
    keep = [c for c in prompts.columns if c != "prompt"]
    answer = StructType.fromDDL(RESPONSE_DDL)
    schema = StructType([prompts.schema[c] for c in keep] + answer.fields)
    names = schema.names
    types = [_ARROW[f.dataType.typeName()] for f in answer.fields]
    options = {
        "model": model, "system": system, "max_tokens": max_tokens, "temperature": temperature,
    }

    def ask(prompt: str | None) -> dict:
        if prompt is None:  # not asked
            return {}
        begin = time.perf_counter()
        try:
            reply = model_fn(prompt, options)
            content = reply["content"]
            if not isinstance(content, str):
                raise TypeError(f"content is {type(content).__name__}, not text")
            usage = {name: int(reply[name]) for name in _USAGE if reply.get(name) is not None}
            answer = {"content": content, **usage}
        except Exception as problem:  # kept as a row
            answer = {"content": f"Error: {problem}", "error": str(problem) or type(problem).__name__}
        seconds = round(time.perf_counter() - begin, 3)
        return {**answer, "latency_s": seconds, "model": model}

    def take(waiting: Iterator[tuple[int, str | None]], replies: list[dict]) -> None:
        for i, prompt in waiting:  # shared by the threads: each takes the next one
            replies[i] = ask(prompt)

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(calls) as threads:
            for batch in batches:
                for begin in range(0, batch.num_rows, BATCH):
                    part = batch.slice(begin, BATCH)
                    waiting, replies = enumerate(part.column(len(keep)).to_pylist()), [{}] * part.num_rows
                    list(threads.map(take, [waiting] * calls, [replies] * calls))
                    columns = [
                        pa.array([r.get(name) for r in replies], kind)
                        for name, kind in zip(names[len(keep):], types)
                    ]
                    passed = [part.column(i) for i in range(len(keep))]
                    yield pa.RecordBatch.from_arrays([*passed, *columns], names=names)

    return prompts.select(*keep, "prompt").mapInArrow(call, schema)
