"""Canonical JSON against ``decimal``, nested fields against a walk in Python."""

import json
import random
from decimal import Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from pagetables.llm import jsonform, toolcalls

CALLS = "conv_id bigint, call_id string, parent_id string, turn bigint, name string, arguments string"
RESULTS = "conv_id bigint, call_id string, turn bigint, content string"


def spelled(number: Decimal) -> str:
    sign, digits, exponent = number.as_tuple()
    text = "".join(map(str, digits)).lstrip("0")
    d = text.rstrip("0")
    p = len(text) + exponent
    if not d:
        return "0"
    minus = "-" if sign else ""
    if len(d) <= p <= 21:
        return minus + d + "0" * (p - len(d))
    if 0 < p <= 21:
        return f"{minus}{d[:p]}.{d[p:]}"
    if -6 < p <= 0:
        return f"{minus}0.{'0' * -p}{d}"
    return f"{minus}{d[0]}{'.' + d[1:] if d[1:] else ''}e{'+' if p > 0 else ''}{p - 1}"


def number(rng):
    text = rng.choice(["", "-"]) + rng.choice(["0", str(rng.randint(1, 9)), str(rng.randint(1, 10**rng.randint(2, 50))), "1" + "0" * rng.randint(1, 30)])
    if rng.random() < 0.5:
        text += "." + "".join(rng.choice("0001234569") for _ in range(rng.randint(1, 40)))
    if rng.random() < 0.4:
        text += rng.choice("eE") + rng.choice(["", "+", "-"]) + rng.choice(["0", "007", str(rng.randint(0, 400)), "123456789"])
    return text


def canonicals(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, j string").select("i", jsonform.canonical(F.col("j")).alias("c")).collect()
    return [r.c for r in sorted(rows, key=lambda r: r.i)]


def test_numbers_equal_those_of_decimal(spark):
    rng = random.Random(1)
    texts = [number(rng) for _ in range(400)] + ["1", "1.0", "1e0", "100", "1e2", "-0", "-0.0e9", "1.5e400", "9" * 45]
    with localcontext() as context:
        context.prec = 200
        want = [spelled(Decimal(t)) for t in texts]
    got = canonicals(spark, ["[" + t + "]" for t in texts])
    assert got == [f"[{w}]" for w in want]
    assert canonicals(spark, [g for g in got]) == got  # spelled once, spelled for ever
    for g, t in zip(got, texts):
        assert Decimal(g[1:-1]) == Decimal(t)


def test_texts_are_left_alone(spark):
    values = ["1.50", "\ue000", "\ue0001", "\ue000\ue001-3", "\\", '\\"', '"1.0"', 'a\\\\"2.0":', "\\ue000" + "5", "", "tab\tline\n", "{1:2}", "é "]
    documents = [{"b": v, v + "k": [v, 1.5, {"z": v}], "a": None} for v in values] + [values, True, None, {}]
    texts = [json.dumps(d, ensure_ascii=bool(i % 2)) for i, d in enumerate(documents)] + ['{"a":"\\uE0007"}']
    for text, got in zip(texts, canonicals(spark, texts)):
        assert json.loads(got) == json.loads(text)


def test_what_is_not_json(spark):
    texts = ["", "nothing", "{1:2}", '{"a":01}', '{"a":1.}', '{"a":+1}', '{"a":--1}', "[1,]", '["\\x"]', '{"a":1e9999999999999999}', '{"a":1,"a":2}', None]
    assert canonicals(spark, texts) == [None] * len(texts)


def test_long_texts_and_many_numbers(spark):
    long = json.dumps({"text": 'a"\\\n1.0' * 300_000, "numbers": list(range(20_000))})
    assert json.loads(canonicals(spark, [long])[0]) == json.loads(long)


TOOLS = {"trip": [
    {"name": "where/city", "type": "string", "required": True, "most_length": 6},
    {"name": "legs", "type": "array", "required": True},
    {"name": "legs/*", "type": "object"},
    {"name": "legs/*/km", "type": "number", "required": True, "least": 0.0, "most": 1e30},
    {"name": "legs/*/tags/*", "type": "string", "choices": ["slow", "fast"]},
    {"name": "count", "type": "integer", "required": False},
    {"name": "odd~1name", "type": "null", "required": False},
    {"name": "free", "type": "object", "required": False},
]}


@pytest.mark.parametrize("arguments, errors", [
    ('{"where":{"city":"Rome"},"legs":[]}', ""),
    ('{"where":{},"legs":[{"km":1},{"km":-1},{"km":1e400},{}]}', "legs/1/km: too small; legs/2/km: too large; legs/3/km: missing; where/city: missing"),
    ('{"where":{"city":"Reykjavik","zip":1},"legs":[2]}', "legs/0: integer instead of object; where/city: too long; where/zip: not a field"),
    ('{"legs":{"km":1}}', "legs/km: not a field; legs: object instead of array"),
    ('{"where":{"city":"x"},"legs":[{"km":1,"tags":["slow","no",3]}]}', "legs/0/tags/1: not a choice; legs/0/tags/2: integer instead of string"),
    ('{"where":{"city":"x"},"legs":[],"count":1.0}', ""),
    ('{"where":{"city":"x"},"legs":[],"count":%s}' % ("9" * 60), ""),
    ('{"where":{"city":"x"},"legs":[],"count":%s.5}' % ("9" * 60), "count: number instead of integer"),
    ('{"where":{"city":"x"},"legs":[],"count":"1","odd/name":null,"free":{"any":[{"thing":1}]}}', "count: string instead of integer"),
    ('{"where":{"city":1},"legs":null,"count":null}', "count: null instead of integer; legs: null instead of array; where/city: integer instead of string"),
])
def test_nested_fields(spark, arguments, errors):
    rows = toolcalls.link(
        spark.createDataFrame([(1, "a", None, 1, "trip", arguments)], CALLS), spark.createDataFrame([(1, "a", 2, "\ue0001")], RESULTS),
        toolcalls.schema_table(spark, TOOLS),
    ).collect()
    assert (rows[0]["errors"], rows[0]["status"]) == (errors, "invalid" if errors else "ok")
    exact = lambda text: json.loads(text, parse_int=lambda n: str(Decimal(n).normalize()), parse_float=lambda n: str(Decimal(n).normalize()))
    said = exact(rows[0]["call_json"])
    assert said["result"] == "\ue0001" and json.dumps(said["arguments"], sort_keys=True) == json.dumps(exact(arguments), sort_keys=True)


def test_fields_have_a_depth(spark):
    with pytest.raises(ValueError):
        toolcalls.schema_table(spark, {"t": [{"name": "/".join("a" * 17), "type": "null"}]})
