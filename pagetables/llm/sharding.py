"""Shards of a random order by a two-pass external shuffle.

The first pass scatters rows over buckets by a seeded hash of their key and place in the
input; a bucket holds about ``bucket_bytes`` of records, so one fits in a task's memory
whatever the input's size.  The second reads a bucket, sorts it by the hash (so that the
order blocks arrive in doesn't matter), shuffles it by Fisher and Yates from a seed of its
own and writes it.  Buckets in turn make one random order of all rows; the numbers of rows
in the buckets give each its start there, and a row at place p of that order is record
``p div n`` of shard ``p mod n``: numbers of rows are at most one apart (law ``rows``).

Equal rows have places of their own in the hash, so copies spread over buckets and shards
like any other rows.  The input should be a table in storage: its rows' places are then the
same when a lost task runs again.

Defined cases: NULLs in any column are kept; NULL text has size 1 and the checksum NULL; an
empty table gives no rows; columns of the input that clash with added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetables.llm.common import Tucked, stored, utf8_bytes

BUCKET_BYTES = 64 * 1024 * 1024
LEAST_BUCKETS = 16
BROADCAST_BUCKETS = 2_000_000  # 32 MB of starts
ADDED = ("bucket", "bucket_slot")


def record_size(text: Column) -> Column:
    return F.coalesce(utf8_bytes(text), F.lit(0)) + F.lit(1)


def text_crc32(text: Column) -> Column:
    return F.crc32(text.cast("binary"))


def row_bytes(docs: DataFrame) -> Column:
    """About the bytes of a row in memory: all its columns count, nested ones by their JSON."""
    size = F.lit(8 * len(docs.columns))
    for number, field in enumerate(docs.schema.fields):
        value = F.col(f"`{field.name}`") if docs.columns.count(field.name) == 1 else docs[number]
        kind = field.dataType.typeName()
        if kind in ("struct", "array", "map", "variant"):
            value = F.to_json(F.struct(value.alias("value")))
        elif kind not in ("string", "binary"):
            continue
        size = size + F.coalesce(F.octet_length(value), F.lit(0)).cast("long")
    return size


def bucket_count(docs: DataFrame, size: Column, bucket_bytes: int = BUCKET_BYTES) -> int:
    total = docs.agg(F.sum(size).alias("n")).first()["n"] or 0
    return max(LEAST_BUCKETS, -(-total // bucket_bytes))


def fisher_yates(n: int, seed: int) -> np.ndarray:
    """A random order of ``range(n)``: from the end, each place swaps with one not after it."""
    order = list(range(n))
    draws = np.random.default_rng(seed).random(n)
    for i in range(n - 1, 0, -1):
        j = int(draws[i] * (i + 1))
        order[i], order[j] = order[j], order[i]
    return np.array(order, dtype=np.int64)


def shuffled(docs: DataFrame, buckets: int, seed: int = 0, key: str = "doc_id",
             out: str | None = None) -> DataFrame:
    """Both passes: all rows with ``bucket`` and ``bucket_slot``, written and read back."""
    tucked = Tucked(docs)
    hashed = tucked.frame.select(
        "*", F.xxhash64(F.lit(seed), tucked[key], F.monotonically_increasing_id()).alias("place")
    ).withColumn("bucket", F.pmod("place", F.lit(buckets)).cast("int"))
    scattered = hashed.repartitionById(buckets, F.col("bucket"))
    schema = scattered.drop("place").withColumn("bucket_slot", F.lit(0).cast("long")).schema

    def permute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        bucket = pa.Table.from_batches(held)
        del held
        places, numbers = (bucket.column(c).to_numpy() for c in ("place", "bucket"))
        by_hash = np.lexsort((places, numbers))
        starts = np.flatnonzero(np.r_[True, np.diff(numbers[by_hash]) != 0])
        for begin, end in zip(starts, np.r_[starts[1:], len(numbers)]):
            rows = by_hash[begin:end]
            order = rows[fisher_yates(len(rows), (seed << 32) + int(numbers[rows[0]]))]
            for at in range(0, len(order), 1024):
                part = bucket.take(pa.array(order[at : at + 1024])).drop_columns(["place"])
                slots = pa.array(np.arange(at, at + part.num_rows))
                yield from part.append_column("bucket_slot", slots).combine_chunks().to_batches()

    done = scattered.mapInArrow(permute, schema).select(*tucked.back(*ADDED), *ADDED)
    if out is None:
        return stored(done, "shuffled")
    done.write.parquet(out)
    return docs.sparkSession.read.schema(done.schema).parquet(out)


def shards(docs: DataFrame, n_shards: int, text: str = "text", key: str = "doc_id", seed: int = 0,
           bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All rows and columns with ``shard`` and ``slot``, the slots of a shard gapless from 0."""
    buckets = bucket_count(docs, row_bytes(docs), bucket_bytes)
    rows = shuffled(docs, buckets, seed, key)
    tucked = Tucked(rows)
    ahead = Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1)
    # One row of 16 bytes for each bucket, so this is a four-millionth of the input: 25 MB of
    # 100 TB.  It is broadcast, since a join on buckets would move all records once more; only
    # buckets beyond the bound, which are counted above, are joined.
    starts = rows.groupBy(F.col("bucket").alias("of")).agg(F.count("*").alias("n")).select(
        "of", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("start")
    )
    starts = F.broadcast(starts) if buckets <= BROADCAST_BUCKETS else starts
    place = F.col("start") + tucked["bucket_slot"]
    return tucked.frame.join(starts, tucked["bucket"] == F.col("of")).select(
        *tucked.back(*ADDED, "shard", "slot"),
        F.pmod(place, F.lit(n_shards)).cast("int").alias("shard"),
        F.floor(place / n_shards).cast("long").alias("slot"),
    )


def write_shards(docs: DataFrame, path: str, n_shards: int, **options) -> None:
    """A folder for each shard.  Rows keep their ``slot``; sort by it when reading a shard."""
    shards(docs, n_shards, **options).write.partitionBy("shard").parquet(path)
