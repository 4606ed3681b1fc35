"""Large CSV files over many tasks: a row for every record, whatever the size of a file.

Spark splits the files by size and reads lines.  A task cuts the lines of its splits into
chunks of about ``CHUNK_BYTES``, numbered by file and place.  Whether a chunk begins inside
quotes depends on all text before it, so each chunk says for both cases how it ends: inside
quotes or not, whether the record open at its end began in it, and how many records begin in
it.  A fold over these few numbers a chunk, in order, tells each chunk how it begins and how many
records come before it.  Chunks then parse their whole records by themselves; what lies across
borders is stitched together from its pieces, one group a record.

The rules of quoting are those of ``csvtext.rows_of``: a quote opens only at the beginning of a
field, two quotes within are one, and after a closing quote a field goes on without.  A record
has all its lines' ends as ``\\n``.

Defined cases: a byte order mark is left out; a blank line is a record without cells; quotes
that are still open at the end of a file end there, before its last line end; bytes that aren't UTF-8 become the
replacement character, since a part of a file can't tell that another part fails; an empty file
has no rows.  A record, and so a line, is one row and must fit a task.
"""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.functions.shared import kept, new_path

CHUNK_BYTES = 1024 * 1024
CHUNKS = "source string, split bigint, part int, text string"
ENDS = "source string, split bigint, part int, ends array<struct<inside:boolean,began:boolean,records:bigint>>"
BEGINS = "source string, split bigint, part int, inside boolean, first_row bigint, owner_row bigint"
PIECES = "source string, row_no bigint, piece bigint, whole boolean, text string, cells array<string>"


def inside_after(line: str, inside: bool, delimiter: str = ",", quote: str = '"') -> bool:
    """Whether quotes are open at the end of a line that begins a record, or inside quotes."""
    if quote not in line:
        return inside
    at = 0
    while True:
        if inside:
            at = line.find(quote, at)
            if at < 0:
                return True
            if line.startswith(quote, at + 1):
                at += 2
                continue
            inside, at = False, at + 1
        elif line.startswith(quote, at):
            inside, at = True, at + 1
            continue
        at = line.find(delimiter, at)
        if at < 0:
            return False
        at += 1


def chunks_of(lines: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``(source, split, value)`` in file order within a split, to chunks.  Narrow."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split(" ")[0] for c in CHUNKS.split(", ")]
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.string()]
        own, part, held, size = None, 0, [], 0

        def taken() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip((*own, part, "\n".join(held)), kinds)], names=names
            )

        for batch in batches:
            for source, split, value in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                if own != (source, split):
                    if held:
                        yield taken()
                    own, part, held, size = (source, split), 0, [], 0
                elif size >= chunk_bytes:
                    yield taken()
                    part, held, size = part + 1, [], 0
                held.append(value)
                size += len(value) + 1
        if held:
            yield taken()

    return lines.select("source", "split", "value").mapInArrow(cut, CHUNKS)


def _ends(batches: Iterator[pa.RecordBatch], delimiter: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for source, split, part, text in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            lines = text.split("\n")
            ends = []
            for inside in (False, True):
                began, records = False, 0
                for line in lines:
                    if not inside:
                        began, records = True, records + 1
                    inside = inside_after(line, inside, delimiter)
                ends.append({"inside": inside, "began": began, "records": records})
            rows.append({"source": source, "split": split, "part": part, "ends": ends})
        end = pa.struct([("inside", pa.bool_()), ("began", pa.bool_()), ("records", pa.int64())])
        schema = pa.schema([("source", pa.string()), ("split", pa.int64()), ("part", pa.int32()), ("ends", pa.list_(end))])
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def fold_ends(found):
    """How each chunk of one file begins: inside quotes or not, the number of its first record,
    and the number of the record that is open there."""
    rows = found.sort_by([("split", "ascending"), ("part", "ascending")]).to_pylist()
    inside, first, out = False, 0, []
    for row in rows:
        out.append((row["source"], row["split"], row["part"], inside, first, first - 1 if inside else None))
        end = row["ends"][inside]
        inside, first = end["inside"], first + end["records"]
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int64()]
    names = [c.split(" ")[0] for c in BEGINS.split(", ")]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)


def parsed(text: str, delimiter: str = ",") -> list[list[str]]:
    csv.field_size_limit(sys.maxsize)
    return list(csv.reader(io.StringIO(text, newline=""), delimiter=delimiter))


def _records(batches: Iterator[pa.RecordBatch], delimiter: str) -> Iterator[pa.RecordBatch]:
    """Whole records with their cells, and the pieces of those that cross a border."""
    names = [c.split(" ")[0] for c in PIECES.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.list_(pa.string())]
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(7)]
        for source, split, part, text, inside, first, owner in zip(*columns):
            lines = text.split("\n")
            place = (split << 20) + part  # chunks of a file in order
            out: list[tuple] = []
            at = 0
            if inside:  # the end, or all, of a record that began before
                while at < len(lines) and inside:
                    inside = inside_after(lines[at], inside, delimiter)
                    at += 1
                out.append((source, owner, place, False, "\n".join(lines[:at]), None))
            begin, row, starts = at, first, []
            open_at = None
            while at < len(lines):
                if not inside:
                    open_at = at
                    starts.append(at)
                inside = inside_after(lines[at], inside, delimiter)
                at += 1
            end = open_at if inside and starts else len(lines)
            if end > begin:
                for cells in parsed("\n".join(lines[begin:end]) + "\n", delimiter):
                    out.append((source, row, place, True, None, cells))
                    row += 1
            if end < len(lines):
                out.append((source, row, place, False, "\n".join(lines[end:]), None))
            for k in range(0, len(out), 4096):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out[k : k + 4096]), kinds)], names=names
                )


def csv_records(lines: DataFrame, delimiter: str = ",", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``(source, row_no, cells)`` of ``lines(source, split, value)``: the lines of each split in
    order, splits numbered by their place in the file."""
    # Written once: how a file is split must not change between the two readings.
    chunks = kept(chunks_of(lines, chunk_bytes), new_path(lines.sparkSession, "csv-chunks"))
    ends = chunks.mapInArrow(lambda batches: _ends(batches, delimiter), ENDS)
    begins = ends.groupBy("source").applyInArrow(fold_ends, BEGINS)
    told = chunks.join(begins, ["source", "split", "part"]).select(
        "source", "split", "part", "text", "inside", "first_row", "owner_row"
    )
    found = told.mapInArrow(lambda batches: _records(batches, delimiter), PIECES)
    whole = found.filter("whole").select("source", "row_no", "cells")
    stitched = found.filter("not whole").groupBy("source", "row_no").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "text"))), lambda p: p["text"]), "\n").alias("text")
    )

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [parsed(text, delimiter)[0] for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(cells, pa.list_(pa.string()))], names=["source", "row_no", "cells"]
            )

    schema = "source string, row_no bigint, cells array<string>"
    return whole.unionByName(stitched.select("source", "row_no", "text").mapInArrow(parse, schema))


def read_csv_records(spark: SparkSession, path: str, delimiter: str = ",", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``(source, row_no, cells)`` of every record of CSV files of any size."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_block_start").alias("split"),
        F.when(F.col("_metadata.file_block_start") == 0, F.regexp_replace("value", "^\ufeff", "")).otherwise(F.col("value")).alias("value"),
    )
    return csv_records(lines, delimiter, chunk_bytes)
