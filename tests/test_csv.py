"""CSV texts: schema descriptions, plain tables, files and their guards."""

import pytest
from pyspark.sql import functions as F

from pagetables.corpus import csv_documents
from pagetables.operators.csvschema import definitions, resolve_roles
from pagetables.operators.infer import profile
from pagetables.sources.csvtext import parse_csv, read_csv_files
from pagetables.sources.files import list_csv, read_csv_sample, read_html_files


@pytest.fixture(scope="module")
def load(spark):
    def run(*texts):
        return spark.createDataFrame(
            [(i, f"d/t{i}.csv", t) for i, t in enumerate(texts)], "doc_id bigint, source string, content string"
        )

    return run


FULL = "_1,Key,Name,Data type,Null,Attributes,References,Description\n1,PK,id,int,,auto,,the key\n2,,,int,x\n3,,short\n4,, n ,text,No,,t.id, \n"


def tables(frame):
    return [r.asDict(recursive=True) for r in csv_documents(frame).orderBy("doc_id").collect()]


def test_described_schema(load):
    found = tables(load(FULL))[0]["tables"][0]
    assert found["caption"] == "Database Schema" and found["row_count"] == 4 and found["column_count"] == 8
    assert [(p["name"], p["value"]) for p in found["properties"]] == [
        ("Column Name", "id"), ("Data Type", "int"), ("Key", "PK"), ("Nullable", "Yes"), ("Description", "the key"),
        ("Column Name", "n"), ("Data Type", "text"), ("Nullable", "No"), ("References", "t.id"),
        ("_1", "1"), ("Attributes", "auto"), ("_1", "2"), ("_1", "3"), ("_1", "4"),
    ]


def test_detection_and_fallback(load):
    found = tables(load("x,y\nid,varchar(20)\n", "x,y\n7,8\n", "database_name,v\na,b\n", "database_name,v\n\n", "x,y\na,point\n", ""))
    assert [t["tables"][0]["caption"] if t["tables"] else t["status"] for t in found] == [
        "Database Schema", "t1.csv", "t2.csv", "Database Schema", "Database Schema", "Error: Empty CSV file",
    ]
    assert found[1]["tables"][0]["rows"] == [["7", "8"]] and found[1]["tables"][0]["properties"] is None


def test_roles(load):
    rows = parse_csv(load(FULL, "x,y\na,int", "a,b,c,d,e,f\n1,int", "Type,Column name\nint,a"))
    found = resolve_roles(rows).orderBy("doc_id").collect()
    assert [(r.name_idx, r.type_idx, r.key_idx, r.null_idx, r.ref_idx, r.desc_idx) for r in found] == [
        (2, 3, 1, 4, 6, 7), (0, 1, None, None, None, None), (3, 4, None, None, None, None), (1, 0, None, None, None, None),
    ]
    assert [r.name for r in definitions(rows).filter("doc_id = 3").collect()] == ["a"]


def test_quoting_and_ragged_rows(load):
    found = tables(load('a,b\r\n"1, ""x""\r\ny",2,3\r\n\r\nlast\r\n'))[0]["tables"][0]
    assert found["rows"] == [['1, "x"\ny', "2", "3"], [], ["last"]]


def test_long_fields_are_read(load):
    found = tables(load("a,b\n" + "x" * 1_200_000 + ",1\n"))[0]
    assert found["status"] == "Success" and [len(c) for c in found["tables"][0]["rows"][0]] == [1_200_000, 1]


def test_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("\ufeffa,b\n1,2\n".encode())
    (tmp_path / "b.csv").write_bytes(b"a,b\n\xff\n")
    (tmp_path / "big.csv").write_bytes(b"a,b\n" + b"1,2\n" * 1000)
    (tmp_path / "page.html").write_text("<h1>x</h1><table><tr><th>a</th><th>b</th></tr></table>")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "c.csv").write_text("a\n")
    files = read_csv_files(spark, str(tmp_path), max_mb=0.003)
    found = {r.source.rsplit("/", 1)[1]: r for r in files.collect()}
    assert found["a.csv"].rows == [["a", "b"], ["1", "2"]]
    assert found["b.csv"].status.startswith("Error: 'utf-8' codec")
    assert found["big.csv"].status == "Error: File size (0.00 MB) exceeds maximum (0.003 MB)"
    listed = list_csv(spark, str(tmp_path)).collect()
    assert sorted(r.path.rsplit("/", 1)[1] for r in listed) == ["a.csv", "b.csv", "big.csv"]
    from pagetables.operators.extract import extract_tables
    from pagetables.operators.shred import shred

    pages = extract_tables(shred(read_html_files(spark, str(tmp_path), pattern="*.html"), prefilter=True))
    assert [t.headers for t in pages.first().tables] == [["a", "b"]]


def test_length_filter_reaches_the_file_scan(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a\n")
    frame = read_csv_files(spark, str(tmp_path))
    plan = frame._sc._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "formatted")
    pushed = [line for line in plan.splitlines() if line.startswith("PushedFilters")]
    assert len(pushed) == 2
    assert "LessThanOrEqual(length,10485760)" in pushed[0] and "GreaterThan(length,10485760)" in pushed[1]
    read = [line for line in plan.splitlines() if line.startswith("ReadSchema")]
    assert "content" in read[0] and "content" not in read[1]


def test_typed_sample(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('id,note,at\n' + "".join(f'{i},"line\n""{i}""",2024-01-0{i % 9 + 1}\n' for i in range(300)))
    sample = read_csv_sample(spark, str(path))
    assert sample.count() == 100
    found = {r.name: r for r in profile(sample).collect()}
    assert (found["id"].type, found["id"].maximum) == ("int", 99.0)
    assert (found["at"].type, found["at"].format) == ("date", "yyyy-MM-dd")
    assert found["note"].type == "string"
    assert sample.first().note == 'line\n"0"'
    assert sample.select(F.count("id")).first()[0] == 100


def test_files_are_listed_by_tasks(spark, tmp_path):
    for folder in ("docs-1/a/0", "docs-1/b/0", "docs-1/b/1", "other/a/0"):
        (tmp_path / folder).mkdir(parents=True)
        for name in ("a.csv", "a b%2F.csv", "_x.csv", ".x.csv", "x.txt", "none.csv"):
            (tmp_path / folder / name).write_text("" if name == "none.csv" else name)
    for path in (f"{tmp_path}/docs-*/*/*", f"file://{tmp_path}/docs-?/b/*", f"{tmp_path}/other/a/0/", f"{tmp_path}/{{docs-1,other}}/a/0"):
        frame = list_csv(spark, path)
        known = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path)
        assert sorted(map(tuple, frame.collect())) == sorted(map(tuple, known.select("path", "length").collect()))
        if "{" not in path:  # the driver knows no file
            assert frame.inputFiles() == [] and len(known.inputFiles()) > 1
