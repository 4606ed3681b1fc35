"""Model answers, schema documents, patches and their written forms."""

import json
import random

import pytest
import yaml
from pyspark.sql import functions as F

from pagetables.functions.text import WHITESPACE, dataset_id, preview, strip
from pagetables.operators.parse import (
    COLUMNS_DDL,
    METADATA_DDL,
    fallback_schema,
    load_lenient,
    load_strict,
    normalise_schema,
    parse_schema_text,
    strip_fences,
)
from pagetables.operators.prompts import run_model
from pagetables.operators.schemas import apply_patches, fold_patches, metadata_map, to_json_docs, to_yaml_docs
from pagetables.operators.select import parse_analysis, select_files, select_tables, with_advice
from pagetables.sources.documents import read_docs, read_schema_docs, resolve_format, write_docs

GOOD = '{"name":"n","columns":[{"name":"a","type":"int","constraints":{"pattern":"^\\d+$"}},{"column_name":"b"},{"name":null},5]}'
ANSWERS = {
    GOOD: ("parsed", ["a", "b", "Column_3", "Column_4"]),
    "```json\n" + GOOD + "\n```": ("parsed", ["a", "b", "Column_3", "Column_4"]),
    "Sure! " + GOOD + " Anything else?": ("parsed", ["a", "b", "Column_3", "Column_4"]),
    '{"schema":[{"column_name":"x"},{"type":"int"}]}': ("parsed", ["x", ""]),
    '{"name":"n"}': ("no_columns", []),
    "Error: down": ("model_error", ["h1", "h2"]),
    "[1]": ("not_a_schema", ["h1", "h2"]),
    '{"title":"t"}': ("not_a_schema", ["h1", "h2"]),
    "no json": ("unparsed", []),
    '"{\\"columns\\":[{\\"name\\":\\"q\\"}]}"': ("parsed", ["q"]),
    '{"columns":[]}': ("parsed", []),
    'Error: but {"columns":[{"name":"z"}]}': ("parsed", ["z"]),
}


def test_answers(spark):
    frame = spark.createDataFrame(list(enumerate(ANSWERS)), "doc_id int, content string")
    parsed = parse_schema_text(frame).withColumn("headers", F.array(F.lit("h1"), F.lit("h2")))
    found = fallback_schema(normalise_schema(parsed)).orderBy("doc_id").collect()
    assert [(r.status, [c.name for c in r.columns]) for r in found] == list(ANSWERS.values())
    first = found[0].columns
    assert first[0].constraints.toPython() == {"pattern": "^\\d+$"}
    assert (first[1].type, first[1].description) == ("string", "Column containing b data")
    assert (first[3].confidence, first[3].inferred) == (0.5, True)
    assert found[5].name == "CSV Data Schema" and found[5].columns[0].confidence == 0.5
    assert found[10].description == "Schema created with no column data"


def test_missing_headers_are_an_error(spark):
    frame = spark.createDataFrame([(1, "Error: x", [])], "doc_id int, content string, headers array<string>")
    found = fallback_schema(normalise_schema(parse_schema_text(frame))).first()
    assert found.status == "Error: No headers found in table data" and found.columns is None


def test_analysis_answers(spark):
    texts = {
        "Main Table: 1\nReasoning: most rows\nTable Type: data": (0, "most rows", "data"),
        "Reasoning: a\nb Table Type:  schema!": (None, "a\nb", "schema"),
        "Main Table: x": (None, "No reasoning provided.", "unknown"),
        "Reasoning:\n": (None, "", "unknown"),
    }
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, content string")
    found = parse_analysis(frame).orderBy("doc_id").collect()
    assert [(r.table_index, r.reasoning, r.table_type) for r in found] == list(texts.values())


def test_fences(spark):
    texts = {"```json\n{}\n```": "{}", "``` {}```": "{}", "{}": "{}", "\n```\n": "", "a```b": "a```b"}
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in frame.select(strip_fences(F.col("t"))).collect()] == list(texts.values())


ODD = ["", "a", "yes", "null", "1", "- x", "a: b", "#c", '"q"', "it's", "tab\t", "line\nend", "back\\slash", " lead",
       "\x01", "\x7f", "\x85", "\xa0", "\u2028", "\u2029x", "\ufeff", "\uffff", "é", "表", "😀", "😀\x9f😀", "{", "%d", "&<>"]


def random_schemas(seed, count):
    pick = random.Random(seed)

    def text():
        return "".join(pick.choice(ODD) for _ in range(pick.randint(0, 3)))

    def column():
        return {
            "name": text() or "n", "type": pick.choice(["int", "string"]), "description": text(),
            "nullable": pick.random() < 0.5, "confidence": pick.choice([1.0, 0.5]), "inferred": pick.random() < 0.5,
            "format": text(), "pattern": pick.choice([None, text()]),
        }

    return [
        {"name": text(), "description": text(), "caption": text(), "columns": [column() for _ in range(pick.randint(1, 3))]}
        for _ in range(count)
    ]


ROW_DDL = (
    "schema_id int, name string, description string, caption string, columns array<struct<name:string,"
    "type:string,description:string,nullable:boolean,confidence:double,inferred:boolean,format:string,pattern:string>>"
)


def frame_of(spark, schemas):
    rows = [(i, s["name"], s["description"], s["caption"], s["columns"]) for i, s in enumerate(schemas)]
    columns = F.transform("columns", lambda c: F.struct(
        c["name"].alias("name"), c["type"].alias("type"), c["description"].alias("description"),
        c["nullable"].alias("nullable"), c["confidence"].alias("confidence"), c["inferred"].alias("inferred"),
        c["format"].alias("format"),
        F.when(c["pattern"].isNotNull(), F.parse_json(F.to_json(F.struct(c["pattern"].alias("pattern"))))).alias("constraints"),
        F.array().cast("array<string>").alias("sample_values"),
    )).cast(COLUMNS_DDL)
    return spark.createDataFrame(rows, ROW_DDL).select(
        "schema_id", "name", "description", columns.alias("columns"),
        metadata_map(table_caption=F.col("caption"), table_index=F.col("schema_id")).alias("metadata"),
    )


def written(schema, i):
    """The document a schema is written as."""
    def column(c):
        out = {k: c[k] for k in ("name", "type", "description", "nullable")}
        if c["confidence"] < 1:
            out["confidence"] = c["confidence"]
        if c["inferred"]:
            out["inferred"] = True
        if c["format"]:
            out["format"] = c["format"]
        if c["pattern"] is not None:
            out["constraints"] = {"pattern": c["pattern"]}
        return out

    return {
        "name": schema["name"], "description": schema["description"],
        "columns": [column(c) for c in schema["columns"]],
        "metadata": {"table_caption": schema["caption"], "table_index": i},
    }


def test_written_forms_and_loading(spark):
    schemas = random_schemas(7, 400)
    frame = frame_of(spark, schemas).cache()
    want = [written(s, i) for i, s in enumerate(schemas)]
    docs = {r.schema_id: r.doc for r in to_json_docs(frame).collect()}
    assert [json.loads(docs[i]) for i in range(len(want))] == want
    texts = {r.schema_id: r.doc for r in to_yaml_docs(frame).collect()}
    assert [yaml.safe_load(texts[i]) for i in range(len(want))] == want
    again = to_json_docs(load_strict(to_json_docs(frame)))
    assert [json.loads(r.doc) for r in again.orderBy("schema_id").collect()] == want
    frame.unpersist()


def test_lenient_and_strict(spark):
    docs = spark.createDataFrame(
        [(1, '{"columns":[{"column_name":"a","type":"int"}]}'), (2, '{"columns":[{"name":"a"}]}'), (3, "[1]"),
         (4, 'x {"columns":[{"name":"a","type":"t"}]} y')],
        "schema_id int, doc string",
    )
    strict = {r.schema_id: r for r in load_strict(docs).collect()}
    lenient = {r.schema_id: r for r in load_lenient(docs).collect()}
    assert [strict[i].status for i in range(1, 5)] == [
        "Success", "Error: Invalid column format", "Error: Invalid JSON", "Success",
    ]
    assert strict[1].name == "Table Schema" and strict[1].columns[0].name == "a"
    assert lenient[1].columns[0].name == "" and lenient[2].columns[0].type == "string"
    assert lenient[2].name == "Unknown" and lenient[4].status == "Error: Invalid JSON"


def test_files(spark, tmp_path):
    schemas = [{"name": "n", "description": "", "caption": "c", "columns": [
        {"name": "a", "type": "int", "description": "", "nullable": True, "confidence": 1.0, "inferred": False,
         "format": "", "pattern": None}]}]
    docs = to_json_docs(frame_of(spark, schemas)).withColumn("schema_id", F.col("schema_id").cast("string"))
    write_docs(docs, str(tmp_path / "out.json"))
    assert load_strict(read_docs(spark, str(tmp_path / "out.json"))).first().name == "n"
    write_docs(docs, str(tmp_path / "txt"), "txt")
    one = read_schema_docs(spark, str(tmp_path / "txt" / "part-*"))
    assert load_strict(one).filter("status = 'Success'").first().columns[0].type == "int"
    write_docs(to_yaml_docs(frame_of(spark, schemas)), str(tmp_path / "out.yml"))
    text = "".join(p.read_text() for p in (tmp_path / "out.yml").glob("part-*"))
    assert [d["name"] for d in yaml.safe_load_all(text)] == ["n"]
    assert resolve_format(None, "a.yml") == "yaml" and resolve_format("TXT", "a.json") == "text"
    with pytest.raises(ValueError):
        resolve_format("xml", "a")


def test_patches(spark):
    schemas = [{"name": f"s{i}", "description": "", "caption": "", "columns": [
        {"name": n, "type": "string", "description": "", "nullable": True, "confidence": 1.0, "inferred": False,
         "format": "", "pattern": None} for n in ("a", "b")]} for i in range(3)]
    frame = frame_of(spark, schemas).withColumn("version", F.lit(0))
    patches = spark.createDataFrame(
        [(0, 1, "a", "type", "int"), (0, 2, "a", "type", "date"), (0, 1, "b", "nullable", "false"),
         (0, 3, "b", "constraints", '{"minimum":1}'), (0, 1, "c", "type", "int"), (1, 1, "zz", "type", "int"),
         (0, 2, "b", "name", "bb"), (9, 1, "a", "type", "int")],
        "schema_id int, round int, column_name string, field string, value string",
    )
    found = {r.schema_id: r for r in apply_patches(frame, patches).collect()}
    a, b = found[0].columns
    assert (a.type, a.nullable, b.name, b.nullable) == ("date", True, "bb", False)
    assert b.constraints.toPython() == {"minimum": 1}
    assert [found[i].version for i in range(3)] == [1, 0, 0]
    assert found[0].metadata["refinement_version"].toPython() == 1 and "refinement_version" not in found[1].metadata


def test_rounds_follow_renames(spark):
    log = [
        (1, 1, "a", "name", "b"), (1, 2, "b", "type", "int"), (1, 3, "b", "name", "c"), (1, 4, "d", "name", "b"),
        (1, 5, "b", "type", "date"), (1, 6, "c", "format", "f"), (1, 2, "a", "format", "of a new a"),
        (2, 1, "x", "type", "int"), (2, 2, "x", "type", None), (2, 3, "y", "name", None),
    ]
    patches = spark.createDataFrame(log, "schema_id int, round int, column_name string, field string, value string")
    found = {(r.schema_id, r.column_name): (r.name, r.type, r.format) for r in fold_patches(patches).collect()}
    assert found == {
        (1, "a"): ("c", "int", "f"), (1, "d"): ("b", "date", None), (2, "x"): (None, "int", None), (2, "y"): (None, None, None),
    }
    hot = spark.range(100_000).selectExpr(
        "7 as schema_id", "cast(id % 50 as int) as round", "concat('c', id % 9) as column_name", "'type' as field", "concat('t', id) as value"
    )
    assert fold_patches(hot).count() == 9


def test_bad_replies_are_rows(spark):
    replies = {"none": None, "number": {"content": 5}, "count": {"content": "x", "total_tokens": "many"}, "empty": {}, "good": {"content": "y", "total_tokens": "3"}}

    def model(prompt, options):
        return replies[prompt]

    frame = spark.createDataFrame([(k,) for k in replies] + [(None,)], "prompt string").withColumn("doc", F.col("prompt"))
    found = {r.doc: r for r in run_model(frame, model, calls=2).collect()}
    assert all(found[k].content.startswith("Error: ") and found[k].error and found[k].latency_s is not None for k in ("none", "number", "count", "empty"))
    assert (found["good"].content, found["good"].total_tokens, found["good"].prompt_tokens) == ("y", 3, None)
    assert found[None].content is None and found[None].model is None


def test_yaml_keeps_columns_with_missing_members(spark):
    schemas = [{"name": None, "description": "d", "caption": None, "columns": [
        {"name": "a", "type": None, "description": None, "nullable": None, "confidence": 1.0, "inferred": False, "format": None, "pattern": None},
        {"name": None, "type": "int", "description": None, "nullable": True, "confidence": None, "inferred": None, "format": "", "pattern": None}]}]
    doc = to_yaml_docs(frame_of(spark, schemas)).first().doc
    assert doc.startswith('description: "d"\ncolumns:\n- name: "a"\n- type: "int"\n  nullable: true\n')


def test_selection(spark):
    documents = spark.createDataFrame(
        [(1, "Success", 3), (2, "Success", 1), (3, "No tables found", 0), (4, "Success", 2), (5, "Success", 2)],
        "doc_id int, status string, tables_count int",
    ).withColumn("tables", F.transform(F.sequence(F.lit(1), F.greatest("tables_count", F.lit(1))), lambda i: F.struct(i.alias("x"))))
    recommended = spark.createDataFrame([(1, 2), (2, 5), (3, 0), (4, 9), (5, None)], "doc_id int, table_index int")
    choices = spark.createDataFrame([(1, 0), (4, 1), (5, 7)], "doc_id int, table_index int")
    def index(accept):
        advised = with_advice(documents, recommended, choices)
        rows = select_tables(advised, accept).orderBy("doc_id").collect()
        return [r.table_index for r in rows]
    assert index(True) == [2, 0, None, 1, None]
    assert index(False) == [0, 0, None, 1, None]


def test_file_choice(spark):
    files = spark.createDataFrame([("d", p) for p in "cab"] + [("e", "x"), ("f", "y"), ("f", "z")], "dataset string, path string")
    choices = spark.createDataFrame([("d", 3), ("e", 2), ("f", 0)], "dataset string, choice int")
    found = {r.dataset: r.path for r in select_files(files, choices).collect()}
    assert found == {"d": "c", "e": "x", "f": "y"}
    assert {r.dataset: r.path for r in select_files(files).collect()} == {"d": "a", "e": "x", "f": "y"}


def test_model_calls_keep_failures(spark):
    def model(prompt, options):
        if prompt == "bad":
            raise RuntimeError("down")
        return {"content": prompt + options["model"], "prompt_tokens": 2, "total_tokens": 3}

    frame = spark.createDataFrame([(1, "ok"), (2, "bad")], "doc_id int, prompt string")
    good, bad = run_model(frame, model, model="m").orderBy("doc_id").collect()
    assert (good.content, good.prompt_tokens, good.completion_tokens, good.total_tokens, good.error) == ("okm", 2, None, 3, None)
    assert (bad.content, bad.error, bad.total_tokens) == ("Error: down", "down", None)


def test_text_functions(spark):
    frame = spark.createDataFrame([(WHITESPACE + "a b" + WHITESPACE,)], "t string")
    assert frame.select(strip(F.col("t"))).first()[0] == "a b"
    assert all(not c.strip() for c in WHITESPACE) and len([c for c in map(chr, range(0x110000)) if c.isspace()]) == len(WHITESPACE)
    urls = {" https://x/o/n/ ": "o/n", "word": None, "a/b": "a/b", "a/b//": "a/b"}
    found = spark.createDataFrame([(u,) for u in urls], "u string").select(dataset_id(F.col("u"))).collect()
    assert [r[0] for r in found] == list(urls.values())
    row = spark.range(1).select(preview(F.array(F.lit("a"), F.lit("b")), 1), preview(F.array(F.lit("a")), 1)).first()
    assert tuple(row) == ("a...", "a")


def original_by_walking(patches):
    """The names that columns had at first, by going back over a schema's renames in turn."""
    found = set()
    for schema, round_no, name, _, _ in patches:
        renames = sorted(
            {(r, old, new) for s, r, old, field, new in patches if s == schema and field == "name" and new and new != old}, reverse=True
        )
        for r, old, new in renames:
            if new == name and r < round_no:
                name, round_no = old, r
        found.add((schema, name))
    return found


def test_names_are_followed_back_as_by_walking(spark):
    rng = random.Random(13)
    patches = set()
    for _ in range(600):
        key = (rng.randrange(6), rng.randrange(25), rng.choice("abcdef"))
        patches.add((*key, rng.choice(["name", "name", "type"])))
    rows = [(*key, rng.choice("abcdef") if key[3] == "name" else "int") for key in sorted(patches)]
    frame = spark.createDataFrame(rows, "schema_id bigint, round bigint, column_name string, field string, value string")
    got = {(r.schema_id, r.column_name) for r in fold_patches(frame).collect()}
    assert got == original_by_walking(rows)
