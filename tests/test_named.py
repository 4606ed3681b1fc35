"""Documents as named files: written, made visible at once, read back; samples of many files."""

import os

import pytest
from pyspark.sql import functions as F

from pagetables.corpus import dataset_file_schemas
from pagetables.sources.csvsamples import csv_samples, read_csv_samples
from pagetables.sources.named import BLOCK_FILES, NamedReader, NamedWriter, file_name, read_named, write_named
from pagetables.sources.shares import opened

SCHEMA = "schema_id string, doc string"
ROWS = [
    ("a/b c?.json", "é\r\n\"x\"\x00"), ("a", "1"), ("a", "2"), ("A", "3"), ("", "empty"), (None, "none"), ("null", "word"),
    ("nothing", None), ("+null", "plus"), ("..", "dots"), ("x" * 5000, "long"), ("x" * 5000 + "y", "longer"), ("blank", ""),
    ("_index", "index"), ("ü" * 100, "wide"),
]


def files_below(path):
    return sorted(os.path.join(r, f) for r, _, fs in os.walk(path) for f in fs)


def back(spark, path):
    return sorted(((r.schema_id, r.doc) for r in read_named(spark, path).collect()), key=str)


def test_round_trip(spark, tmp_path):
    path = str(tmp_path / "docs")
    docs = spark.createDataFrame([(*r, 1) for r in ROWS], SCHEMA + ", file int").repartition(3)
    write_named(docs, path)
    assert back(spark, path) == sorted(ROWS, key=str)
    for row in read_named(spark, path).filter("file is not null").collect():
        with open(f"{path}/{row.file}", encoding="utf-8", newline="") as f:
            assert f.read() == row.doc
    write_named(spark.createDataFrame([("more", "x")], SCHEMA), path)
    assert back(spark, path) == sorted([*ROWS, ("more", "x")], key=str)
    write_named(spark.createDataFrame([("new", "y")], SCHEMA), path, ".txt", overwrite=True)
    assert back(spark, path) == [("new", "y")]
    assert [os.path.basename(f) for f in files_below(path) if "commits" not in f] == ["_index", "new.txt"]


def test_empty_tables_and_folders(spark, tmp_path):
    assert back(spark, str(tmp_path / "none")) == []
    write_named(spark.createDataFrame([], SCHEMA), str(tmp_path / "empty"))
    assert back(spark, str(tmp_path / "empty")) == []


def test_names_differ():
    keys = ["a", "A", "a+2", None, "+null", "null", "", "+empty", "x" * 500, "x" * 501, "ü" * 90]
    names = {file_name(k, ".json", n) for k in keys for n in (1, 2)}
    assert len(names) == 2 * len(keys) and max(map(len, names)) < 200


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "docs")
    write_named(spark.createDataFrame([("kept", "x")], SCHEMA), path)
    before = files_below(path)
    many = spark.range(0, 4000, 1, 4).select(
        F.col("id").cast("string").alias("schema_id"),
        F.when(F.col("id") == 3999, F.raise_error(F.lit("lost"))).otherwise("x").alias("doc"),
    )
    with pytest.raises(Exception, match="lost"):
        write_named(many, path)
    assert files_below(path) == before and back(spark, path) == [("kept", "x")]


def batches(*rows):
    import pyarrow as pa

    return iter([pa.RecordBatch.from_pylist([{"schema_id": k, "doc": d} for k, d in rows])])


def test_visible_at_once_and_lost_attempts_removed(tmp_path):
    path = str(tmp_path / "docs")
    first, second = NamedWriter(path, ".json", False), NamedWriter(path, ".json", False)
    done = [first.write(batches(("a", "1"))), first.write(batches(("b", "2")))]
    first.write(batches(("b", "2")))  # an attempt whose executor is lost before it reports
    other = [second.write(batches(("c", "3"))), None]
    blocks = lambda: [p.value for p in NamedReader(path).partitions() if p.value]
    assert blocks() == []
    first.commit(done)
    assert len(blocks()) == 2 and len([f for f in files_below(path) if f.endswith("b.json")]) == 1
    second.commit(other)
    assert len(blocks()) == 3


def test_blocks(tmp_path, monkeypatch):
    monkeypatch.setattr("pagetables.sources.named.BLOCK_FILES", 3)
    path, rows = str(tmp_path / "docs"), [(str(i % 4), str(i)) for i in range(8)]
    writer = NamedWriter(path, ".json", False)
    writer.commit([writer.write(batches(*rows))])
    reader = NamedReader(path)
    got = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert len(reader.partitions()) == 3 < BLOCK_FILES
    assert [(r["schema_id"], r["doc"]) for r in got] == rows


def test_paths_of_spark():
    assert opened("file:/tmp/a b%.csv")[1] == opened("file:///tmp/a b%.csv")[1] == "/tmp/a b%.csv"


def test_samples_read_the_beginning_alone(spark, tmp_path):
    big = "no,note\n" + "".join(f'{i},"a\r\n""b"""\n' for i in range(300_000))
    (tmp_path / "big one%.csv").write_bytes(big.encode())
    (tmp_path / "bom.csv").write_bytes("\ufeffx\r1\r".encode())
    (tmp_path / "bad.csv").write_bytes(b"x\n\xff\n")
    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "open.csv").write_bytes(b'x\n"' + b"y" * 300_000)
    (tmp_path / "other.txt").write_bytes(b"x\n")
    rows = {os.path.basename(r.path): r for r in read_csv_samples(spark, str(tmp_path), 5, max_mb=0.25).collect()}
    assert set(rows) == {"big one%.csv", "bom.csv", "bad.csv", "open.csv"}  # Spark lists no empty files
    found = rows["big one%.csv"]
    assert found.rows == [["no", "note"], *[[str(i), 'a\n"b"'] for i in range(5)]]
    assert found.length > 4_000_000 and found.bytes_read <= 65_536
    assert rows["bom.csv"].rows == [["x"], ["1"]]
    assert rows["bad.csv"].status.startswith("Error: 'utf-8' codec")
    assert rows["open.csv"].status == "Error: First records exceed maximum (0.25 MB)" and rows["open.csv"].bytes_read == 262_144
    odd = spark.createDataFrame([(None, 1), (str(tmp_path / "gone.csv"), 2), (str(tmp_path / "empty.csv"), 3)], "path string, status int")
    lost = {r.path: r for r in csv_samples(odd).collect()}
    assert lost[None].rows is None and lost[None].status is None
    assert lost[str(tmp_path / "gone.csv")].status.startswith("Error: ")
    assert lost[str(tmp_path / "empty.csv")].status == "Error: Empty CSV file"
    assert csv_samples(odd.limit(0)).count() == 0


def test_contents_of_files_that_are_not_chosen_stay_closed(spark, tmp_path):
    for name in ("a", "b", "c"):
        (tmp_path / f"{name}.csv").write_text(f"{name},n\n" + "".join(f"x,{i}.5\n" for i in range(50)))
    listing = spark.createDataFrame(
        [("one", str(tmp_path / "a.csv")), ("one", str(tmp_path / "b.csv")), ("two", str(tmp_path / "c.csv")), ("lost", str(tmp_path / "d.csv"))],
        "dataset string, path string",
    )
    choices = spark.createDataFrame([("one", 2)], "dataset string, choice int")
    schemas = dataset_file_schemas(listing, choices, n=20)
    found = {os.path.basename(r.schema_id): r for r in schemas.collect()}
    assert set(found) == {"b.csv", "c.csv", "d.csv"}
    assert [(c.name, c.type) for c in found["b.csv"].columns] == [("b", "string"), ("n", "float")]
    assert found["d.csv"].status.startswith("Error: ")
    plan = schemas._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") > plan.index("MapInArrow")  # files are opened after the choice
