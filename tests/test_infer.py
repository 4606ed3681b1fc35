"""Column inference: kinds of values, votes in both forms, and names."""

import pytest
from pyspark.sql import functions as F

from pagetables.operators.infer import (
    array_votes,
    constraints_of,
    infer_from_names,
    infer_tables,
    normalise_types,
    profile,
    profile_votes,
    resolve,
    with_facts,
)
from pagetables.operators.schemas import sql_type

KINDS = {
    "12": "int", "-7": "int", "+0012": "int", " 3 ": "int", "9" * 18: "int", "9" * 19: "int", "-" + "9" * 60: "int",
    "1.5": "float", ".5": "float", "5.": "float", "1e5": "float", "1E-05": "float", "1e-0005": "float", "1f": "string", "NaN": "string",
    ".": "string", "1,000": "string", "TRUE": "boolean", "false": "boolean", "t": "string", "1": "int",
    "2024-02-29": "date", "2023-02-29": "string", "2024-01-01 10:11:12": "date", "2024-01-01T10:11:12": "date",
    "31/12/2024": "date", "12/31/2024": "date", "31.12.2024": "date", "2024/01/02": "date", "2020": "int",
    '{"k": 1}': "object", "{x}": "string", "[1, 2]": "array", "[a]": "string", "x": "string", "": None, "   ": None,
}


def test_kinds(spark):
    frame = spark.createDataFrame([(v,) for v in KINDS], "value string").select("value", F.col("value").alias("v"))
    found = {r.v: r.kind for r in with_facts(frame, "value").collect()}
    assert found == KINDS


COLUMNS = {
    "ints": (["1", "2", "", "40"], ("int", True, 1.0, "", 1.0, 40.0, None)),
    "mixed numbers": (["1", "2.5"], ("float", False, 1.0, "", 1.0, 2.5, None)),
    "nothing": (["", " "], ("null", True, 1.0, "", None, None, None)),
    "days": (["01/02/2024", "03/04/2024"], ("date", False, 1.0, "MM/dd/yyyy", None, None, None)),
    "day first": (["01/02/2024", "13/04/2024"], ("date", False, 1.0, "dd/MM/yyyy", None, None, None)),
    "codes": (["AB-12", "XYZ-7"], ("string", False, 1.0, "", None, None, "^[A-Z]+-\\d+$")),
    "dots": (["a.b", "c.d"], ("string", False, 1.0, "", None, None, "^[a-z]+\\.[a-z]+$")),
    "mostly numbers": (["1", "2", "x"], ("string", False, 0.333, "", None, None, None)),
    "long": (["x" * 70, "y" * 70], ("string", False, 1.0, "", None, None, "^[a-z]+$")),
    "flags": (["true", "FALSE"], ("boolean", False, 1.0, "", None, None, None)),
    "objects": (["{}", '{"a":1}'], ("object", False, 1.0, "", None, None, None)),
}
FIELDS = ("type", "nullable", "confidence", "format", "minimum", "maximum", "pattern")


@pytest.mark.parametrize("name", COLUMNS)
def test_both_ways_of_voting_agree(spark, name):
    values, want = COLUMNS[name]
    frame = spark.createDataFrame([(v,) for v in values], f"`{name}` string")
    rows = profile(frame).first()
    assert tuple(rows[f] for f in FIELDS) == want and rows.name == name
    nested = spark.createDataFrame([(values,)], "v array<string>").select(
        resolve(array_votes(F.col("v"))).alias("r")
    ).first().r
    assert tuple(nested[f] for f in FIELDS) == want


def test_one_column_per_header(spark):
    frame = spark.createDataFrame(
        [(1, ["a", "", "c"], [["1", "x"], ["2"]]), (2, ["order_id", "ship_date", "blurb"], [])],
        "doc_id int, headers array<string>, rows array<array<string>>",
    )
    found = {r.doc_id: r.columns for r in infer_tables(frame).orderBy("doc_id").collect()}
    assert [(c.name, c.type, c.nullable, c.inferred) for c in found[1]] == [
        ("a", "int", False, False), ("", "string", True, False), ("c", "null", True, False),
    ]
    assert found[1][1].sample_values == ["x", ""]
    assert [(c.name, c.type, c.confidence, c.inferred) for c in found[2]] == [
        ("order_id", "int", 0.7, True), ("ship_date", "date", 0.7, True), ("blurb", "string", 0.5, True),
    ]


def test_names(spark):
    names = ["id", "o_totalprice", "is active", "created_at", "country", "x"]
    frame = spark.createDataFrame([(n,) for n in names], "name string")
    assert [r.type for r in infer_from_names(frame).collect()] == [
        "int", "float", "boolean", "date", "string", "string",
    ]


def test_type_names(spark):
    frame = spark.createDataFrame([("VarChar(20)", ""), ("Str", "f"), ("money", "")], "type string, format string")
    assert [tuple(r) for r in normalise_types(frame).collect()] == [
        ("string", "varchar(20)"), ("string", "f"), ("money", ""),
    ]
    sql = spark.createDataFrame([("DECIMAL(10, 2)",), (" int",), ("geometry",)], "t string")
    assert [r[0] for r in sql.select(sql_type(F.col("t"))).collect()] == ["float", "int", "geometry"]


def test_votes_hash_and_combine_before_the_exchange(spark):
    frame = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").cast("string").alias("v"))
    plan = profile(frame, ["g"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ObjectHashAggregate") == 2 and "SortAggregate" not in plan
    assert plan.count("Exchange hashpartitioning") == 1
    assert profile_votes(frame, ["g"]).count() == 3


def test_constraints_are_written_once(spark):
    frame = spark.createDataFrame([("1", "2", "^a$"), (None, None, None)], "low string, high string, pattern string")
    found = frame.select(constraints_of(F.col("low"), F.col("high"), F.col("pattern")).alias("c"))
    assert found._jdf.queryExecution().analyzed().toString().count("to_json(") == 1
    texts = [r.c for r in found.select(F.to_json("c").alias("c")).collect()]
    assert texts == ['{"maximum":2,"minimum":1,"pattern":"^a$"}', None]


MIXED = [
    ["1", "2024-01-02", ""], ["1", "2.5", "x"], ["2024-01-02", "x"], ["true", "{}", "[1]"], ["", "x", "y"],
    ["a\tb", "c"], ["9" * 40, "1"], ["", "2024-01-02", "02.01.2024"], ["[a]", "{"], [],
]


def test_kinds_that_do_not_ask_for_a_fact_leave_its_votes_empty(spark):
    """Votes over arrays end in the same columns as votes over rows, whatever kinds meet."""
    frame = spark.createDataFrame(list(enumerate(MIXED)), "g int, v array<string>")
    nested = frame.select("g", resolve(array_votes(F.col("v"))).alias("r")).select("g", "r.*")
    rows = frame.select("g", F.explode("v").alias("v"))
    fields = [*FIELDS, "least", "most"]
    want = {r.g: tuple(r[f] for f in fields) for r in profile(rows, ["g"]).collect()}
    got = {r.g: tuple(r[f] for f in fields) for r in nested.collect()}
    assert got.pop(len(MIXED) - 1)[:2] == ("null", False) and got == want
