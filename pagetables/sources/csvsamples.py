"""The first records of many CSV files, without reading what follows them.

Files are rows of a listing, so a task has as many as Spark packs into it, and no content moves.
A file is opened where its row is and read in blocks of 64 KB until the header and ``n`` records
are there.  The result has the form of ``csvtext.parse_csv``, so the same functions make
documents, typed columns and schemas of it.

Defined cases: a file that can't be opened or decoded, or is empty, keeps its row with an error
status; so does one whose first records need more than ``max_mb``, as a quote that is never closed
does; a file of fewer records gives what it has; a NULL path gives NULL rows and no status;
columns beside the path stay.
"""

from __future__ import annotations

import csv
import io
import itertools
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pagetables.sources.csvtext import GRID_TYPE
from pagetables.sources.files import DEFAULT_MAX_MB, MEGABYTE, list_csv
from pagetables.sources.shares import opened

BLOCK_BYTES = 64 * 1024
GRID = pa.list_(pa.list_(pa.string()))


class Metered(io.RawIOBase):
    """A stream that counts what is read, and refuses to go beyond a limit."""

    def __init__(self, stream, limit: int) -> None:
        self.stream, self.limit, self.count = stream, limit, 0

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        if self.count >= self.limit and self.stream.read(1):
            raise ValueError(f"First records exceed maximum ({self.limit / MEGABYTE:g} MB)")
        got = self.stream.read(min(len(buffer), max(self.limit - self.count, 0)))
        buffer[: len(got)] = got
        self.count += len(got)
        return len(got)


def first_records(path: str, n: int, limit: int) -> tuple[list[list[str]] | None, str | None, int]:
    """The header and ``n`` records of a file, or what is wrong with it; and the bytes read."""
    csv.field_size_limit(sys.maxsize)
    source = None
    try:
        files, place = opened(path)
        with files.open_input_stream(place, compression=None, buffer_size=BLOCK_BYTES) as stream:
            source = Metered(stream, limit)
            lines = io.TextIOWrapper(io.BufferedReader(source), encoding="utf-8-sig")
            rows = list(itertools.islice(csv.reader(lines), n + 1))
        return rows or None, None if rows else "Error: Empty CSV file", source.count
    except Exception as problem:  # becomes the file's status
        return None, f"Error: {problem}", source.count if source else 0


def csv_samples(files: DataFrame, n: int = 100, max_mb: float = DEFAULT_MAX_MB, path: str = "path") -> DataFrame:
    """``(…, path)`` to ``(…, path, status, rows, bytes_read)``: the header and ``n`` records."""
    keep = [c for c in files.columns if c not in ("status", "rows", "bytes_read")]
    schema = T.StructType([files.schema[c] for c in keep])
    schema = schema.add("status", T.StringType()).add("rows", GRID_TYPE).add("bytes_read", T.LongType())
    names, place, limit = schema.names, keep.index(path), int(max_mb * MEGABYTE)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # samples of several files aren't held at once
                own = batch.slice(i, 1)
                name = own.column(place)[0].as_py()
                rows, status, count = (None, None, None) if name is None else first_records(name, n, limit)
                found = [pa.array([status], pa.string()), pa.array([rows], GRID), pa.array([count], pa.int64())]
                yield pa.RecordBatch.from_arrays([*own.columns, *found], names=names)

    return files.select(*keep).mapInArrow(sample, schema)


def read_csv_samples(spark: SparkSession, path: str, n: int = 100, max_mb: float = DEFAULT_MAX_MB) -> DataFrame:
    """``(path, length, status, rows, bytes_read)`` of the CSV files right in one or more folders."""
    return csv_samples(list_csv(spark, path), n, max_mb)
