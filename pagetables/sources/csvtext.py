"""CSV texts to rows; files differ in width, so a row is an array of strings."""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetables.functions.rows import by_bytes
from pagetables.sources.files import DEFAULT_MAX_MB, read_files

GRID_TYPE = T.ArrayType(T.ArrayType(T.StringType()))
_ARROW_GRID = pa.list_(pa.list_(pa.string()))


def rows_of(content: bytes | str) -> list[list[str]]:
    """All rows of one CSV text, with universal line ends and without a byte order mark."""
    text = content if isinstance(content, str) else content.decode("utf-8-sig")
    csv.field_size_limit(sys.maxsize)  # the parser's own limit is 131,072 characters
    text = text.removeprefix("\ufeff").replace("\r\n", "\n").replace("\r", "\n")
    return list(csv.reader(io.StringIO(text, newline="")))


def parse_csv(files: DataFrame, content: str = "content") -> DataFrame:
    """``(…, content)`` to ``(…, status, rows)``; a text that cannot be read, or is empty,
    becomes an error status."""
    if "status" not in files.columns:
        files = files.withColumn("status", F.lit(None).cast("string"))
    keep = [c for c in files.columns if c not in (content, "status")]
    schema = T.StructType([files.schema[c] for c in keep])
    schema = schema.add("status", T.StringType()).add("rows", GRID_TYPE)
    names = schema.names

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, len(keep) + 1):
            grids, errors = [], []
            for value in batch.column(len(keep) + 1):
                grid, error, text = None, None, value.as_py()
                if text is not None:
                    try:
                        grid = rows_of(text) or None
                        error = None if grid else "Error: Empty CSV file"
                    except Exception as problem:  # becomes the document's status
                        error = f"Error: {problem}"
                grids.append(grid)
                errors.append(error)
            status = pc.coalesce(batch.column(len(keep)).cast(pa.string()), pa.array(errors, pa.string()))
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*columns, status, pa.array(grids, _ARROW_GRID)], names=names
            )

    return files.select(*keep, "status", content).mapInArrow(parse, schema)


def read_csv_files(spark: SparkSession, path: str, max_mb: float = DEFAULT_MAX_MB) -> DataFrame:
    """CSV files as ``(doc_id, source, status, rows)``, keyed by their path."""
    files = read_files(spark, path, max_mb, "*.csv")
    return parse_csv(files.select(F.col("source").alias("doc_id"), "source", "status", "content"))
