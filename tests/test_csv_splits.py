"""CSV files over splits equal the same files read whole."""

import random
from collections import defaultdict

import pytest

from pagetables.sources import csvsplits
from pagetables.sources.csvtext import parse_csv, rows_of

BITS = ["a", "b c", '"', '""', ",", ",", "\n", "\n", '"x,y"', '"two\nlines"', '"q""q"', 'm"n', "é", '"\n', ' "s"', ""]


def texts(seed, n=60):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) for _ in range(rng.randrange(1, 60))) for _ in range(n)]


def lines_of(text):
    lines = text.split("\n")
    return lines[:-1] if lines[-1] == "" else lines


def test_quotes_follow_the_parser():
    for text in texts(1, 400):
        expected = rows_of(text)
        inside, records = False, 0
        for line in lines_of(text):
            records += not inside
            inside = csvsplits.inside_after(line, inside)
        assert records == len(expected), text


@pytest.mark.parametrize("seed,chunk", [(2, 1), (3, 12)])
def test_any_cut_gives_the_rows_of_whole_files(spark, seed, chunk):
    """Splits at random line ends, and chunks of as little as one line."""
    rng = random.Random(seed)
    files = {f"f{i}": text for i, text in enumerate(texts(seed))}
    rows = []
    for source, text in files.items():
        split = 0
        for line in lines_of(text):
            split += rng.random() < 0.3
            rows.append((source, split, line))
    frame = spark.createDataFrame(rows, "source string, split bigint, value string").coalesce(1)
    got = defaultdict(dict)
    for r in csvsplits.csv_records(frame, chunk_bytes=chunk).collect():
        assert r["row_no"] not in got[r["source"]]
        got[r["source"]][r["row_no"]] = r["cells"]
    for source, text in files.items():
        inside = False
        for line in lines_of(text):
            inside = csvsplits.inside_after(line, inside)
        # A file's last line end is no part of a field that is open there.
        expected = rows_of(text.removesuffix("\n") if inside else text)
        assert [got[source][i] for i in range(len(got[source]))] == expected, text


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_files_are_split_by_size(spark, tmp_path, end):
    rng = random.Random(4)
    rows = [f'{i},"{"x" * rng.randrange(50)}{end if i % 7 == 0 else ""},""q"" ",é{i}' for i in range(5000)]
    path = tmp_path / "large.csv"
    path.write_bytes(("\ufeffid,text,name" + end + end.join(rows) + end).encode())
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(10_000))
    try:
        lines = spark.read.text(str(path))
        assert lines.rdd.getNumPartitions() > 10
        got = sorted((r["row_no"], r["cells"]) for r in csvsplits.read_csv_records(spark, str(tmp_path), chunk_bytes=3000).collect())
    finally:
        spark.conf.set(key, before)
    expected = rows_of(path.read_bytes())
    assert [cells for _, cells in got] == expected and [n for n, _ in got] == list(range(5001))
    assert expected[0][0] == "id"


def test_open_quotes_blank_lines_and_empty_files(spark, tmp_path):
    contents = {"open.csv": 'a,b\n1,"never\nends\n\nat all', "blank.csv": "a\n\nb\n", "empty.csv": "", "one.csv": "x"}
    for name, text in contents.items():
        (tmp_path / name).write_text(text)
    got = defaultdict(list)
    for r in csvsplits.read_csv_records(spark, str(tmp_path), chunk_bytes=4).orderBy("row_no").collect():
        got[r["source"].rpartition("/")[2]].append(r["cells"])
    assert got == {name: rows_of(text) for name, text in contents.items() if text}
    whole = spark.createDataFrame(list(contents.items()), "doc_id string, content string")
    for r in parse_csv(whole).collect():
        assert (r["rows"] or []) == got.get(r["doc_id"], [])
