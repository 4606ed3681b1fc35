"""Row-level helpers."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(frame: DataFrame, **columns: Column) -> DataFrame:
    """Add (or replace) columns whose expressions are evaluated exactly once per row.

    Catalyst pushes filters, also those it infers for ``explode``, below a projection by
    substituting the projected expression, which then runs again in every such filter.  A
    generated column is not substituted, so extraction and parsing go through here.
    """
    keep = [c for c in frame.columns if c not in columns]
    record = F.struct(*[value.alias(name) for name, value in columns.items()])
    return frame.select(*keep, F.inline(F.array(record)))


def by_bytes(
    batches: Iterator[pa.RecordBatch], column: int, limit: int = 4 * 1024 * 1024
) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a column of long texts holds about ``limit`` bytes in each;
    what a task keeps in memory then depends on the longest text only."""
    for batch in batches:
        begin = size = 0
        for i, length in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
            if size and size + (length or 0) > limit:
                yield batch.slice(begin, i - begin)
                begin, size = i, 0
            size += length or 0
        if begin < batch.num_rows:
            yield batch.slice(begin)
