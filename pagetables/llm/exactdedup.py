"""Exact deduplication through a cuckoo-filter index.

Texts are compared by the SHA-256 of their UTF-8 bytes.  Rows are first reduced to one entry
a text and task (largest key, number of rows), so a text that a third of all rows holds sends
one short entry from each task.  Entries are dealt by digest to the index's partitions.  In a
partition, a cuckoo filter of 16-bit fingerprints answers whether a digest may be live: a miss
is new and is inserted; a hit is verified against the whole digests stored in its two buckets.
A full filter is rebuilt, twice as large, from the stored digests.  Since entries can leave
again, the index follows a table that changes: ``insert`` adds rows to an index, ``delete``
takes rows out of it, and a digest without live rows is deleted from the filter.

Defined cases: NULL text counts as empty; a row without a key is a copy like any other and
never the one that stays unless all of its text's rows have none, then it stays; rows that
share the kept key all stay; an empty table gives no rows; columns of the input are kept,
those named as the result's are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagetables.llm.common import Tucked

SLOTS = 4
LEAST_BUCKETS = 256
MOST_KICKS = 200
KEYS_PER_PARTITION = 250_000
INDEX = "digest binary, keep_id bigint, group_size bigint"


class CuckooIndex:
    """A cuckoo filter whose buckets also hold the whole digests, for verifying hits."""

    def __init__(self, buckets: int = LEAST_BUCKETS):
        self._allot(buckets)
        self.live = 0

    def _allot(self, buckets: int) -> None:
        self.buckets = buckets
        self.marks = [[0] * SLOTS for _ in range(buckets)]
        self.content: list[dict[bytes, list]] = [{} for _ in range(buckets)]

    @staticmethod
    def mark_of(digest: bytes) -> int:
        return int.from_bytes(digest[8:10], "little") or 1

    def homes(self, digest: bytes) -> tuple[int, int]:
        first = int.from_bytes(digest[:8], "little") & (self.buckets - 1)
        return first, self.other(first, self.mark_of(digest))

    def other(self, bucket: int, mark: int) -> int:
        return bucket ^ ((mark * 0x5BD1E995 & 0xFFFFFFFF) & (self.buckets - 1))

    def may_hold(self, digest: bytes) -> bool:
        mark = self.mark_of(digest)
        return any(mark in self.marks[b] for b in self.homes(digest))

    def find(self, digest: bytes) -> list | None:
        """The live entry of a digest, or None; whole digests are compared on hits only."""
        if not self.may_hold(digest):
            return None
        return next((e for b in self.homes(digest) if (e := self.content[b].get(digest))), None)

    def insert(self, digest: bytes, keep_id: int | None, rows: int) -> None:
        entry = self.find(digest)
        if entry is None:
            if not self._place(digest, [keep_id, rows]):
                self.resize()
            self.live += 1
        else:
            entry[0] = keep_id if entry[0] is None else max(entry[0], keep_id if keep_id is not None else entry[0])
            entry[1] += rows

    def delete(self, digest: bytes) -> bool:
        mark = self.mark_of(digest)
        for bucket in self.homes(digest):
            if digest in self.content[bucket]:
                del self.content[bucket][digest]
                self.marks[bucket][self.marks[bucket].index(mark)] = 0
                self.live -= 1
                return True
        return False

    def _place(self, digest: bytes, entry: list) -> bool:
        """Put an entry into a free slot, moving others to their second bucket if need be.
        False if there was none: then everything is stored, but one entry lacks its mark."""
        bucket = self.homes(digest)[0]
        for kick in range(MOST_KICKS):
            for at in self.homes(digest) if kick == 0 else (bucket,):
                if 0 in self.marks[at]:
                    self.marks[at][self.marks[at].index(0)] = self.mark_of(digest)
                    self.content[at][digest] = entry
                    return True
            # The bucket is full: its oldest entry goes to its other home.
            moved = next(iter(self.content[bucket]))
            out = self.content[bucket].pop(moved)
            slot = self.marks[bucket].index(self.mark_of(moved))
            self.marks[bucket][slot] = self.mark_of(digest)
            self.content[bucket][digest] = entry
            digest, entry = moved, out
            bucket = self.other(bucket, self.mark_of(digest))
        self.content[bucket][digest] = entry
        return False

    def resize(self) -> None:
        """Twice the buckets, filled from the stored digests, until all of them fit."""
        stored = [item for bucket in self.content for item in bucket.items()]
        buckets = self.buckets
        while True:
            buckets *= 2
            self._allot(buckets)
            if all(self._place(digest, entry) for digest, entry in stored):
                return

    def entries(self) -> Iterator[tuple[bytes, int | None, int]]:
        for bucket in self.content:
            for digest, (keep_id, rows) in bucket.items():
                yield digest, keep_id, rows


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def _batches(rows: Iterator[tuple], size: int = 65_536) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("digest", pa.binary()), ("keep_id", pa.int64()), ("group_size", pa.int64())])
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def entries_of(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``(digest, keep_id, group_size)`` of every text, by partial sums in each task."""
    digest = digest_of(F.col(text))
    return docs.groupBy(digest.alias("digest")).agg(F.max(key).alias("keep_id"), F.count("*").alias("group_size"))


def partial_entries(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One entry a text and task: no exchange, hot texts are reduced where they are read.

    The index merges the entries of different tasks, so a task may also send an entry more
    than once; it does so when it has held ``KEYS_PER_PARTITION`` digests.
    """
    rows = docs.select(digest_of(F.col(text)).alias("digest"), F.col(key).cast("long").alias("key"))

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = CuckooIndex()
        for batch in batches:
            for digest, key_value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                index.insert(digest, key_value, 1)
            if index.live >= KEYS_PER_PARTITION:
                yield from _batches(index.entries())
                index = CuckooIndex()
        yield from _batches(index.entries())

    return rows.mapInArrow(reduce, INDEX)


def _partitions(docs: DataFrame) -> int:
    """Index partitions of a bounded number of keys each, from the number of rows."""
    rows = docs.count()
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-rows // KEYS_PER_PARTITION))


def insert(index: DataFrame | None, docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The index ``(digest, keep_id, group_size)`` with the rows of ``docs`` added."""
    entries = partial_entries(docs, text, key)
    if index is not None:
        entries = index.select("digest", "keep_id", "group_size").unionByName(entries)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        live = CuckooIndex()
        for batch in batches:
            for digest, keep_id, rows in zip(*(c.to_pylist() for c in batch.columns)):
                live.insert(digest, keep_id, rows)
        yield from _batches(live.entries())

    return entries.repartition(_partitions(docs), "digest").mapInArrow(merge, INDEX)


def delete(index: DataFrame, gone: DataFrame, remaining: DataFrame, text: str = "text",
           key: str = "doc_id") -> DataFrame:
    """The index without the rows of ``gone``; ``remaining`` are the rows still there.

    Digests of deleted rows leave the filter; those that have remaining rows come back with
    their new largest key.  Only the remaining rows of these digests are read again.
    """
    touched = entries_of(gone, text, key).select("digest")
    again = remaining.select(F.col(text), F.col(key), digest_of(F.col(text)).alias("_own")).join(
        touched.withColumnRenamed("digest", "_touched"), F.col("_own") == F.col("_touched"), "left_semi"
    )
    steps = (
        index.select("digest", "keep_id", "group_size", F.lit(0).alias("step"))
        .unionByName(touched.select("digest", F.lit(None).cast("long").alias("keep_id"), F.lit(0).cast("long").alias("group_size"), F.lit(1).alias("step")))
        .unionByName(entries_of(again, text, key).withColumn("step", F.lit(2)))
    )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        live = CuckooIndex()
        for batch in batches:
            for digest, keep_id, rows, step in zip(*(c.to_pylist() for c in batch.columns)):
                if step == 1:
                    live.delete(digest)
                else:
                    live.insert(digest, keep_id, rows)
        yield from _batches(live.entries())

    parts = _partitions(index)
    return steps.repartition(parts, "digest").sortWithinPartitions("step").mapInArrow(merge, INDEX)


def groups(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """All rows with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    The index has one row a text, so rows of a hot text meet it in a join whose large
    partitions Spark splits.
    """
    added = ("keep_id", "group_size", "kept", "text_sha256")
    tucked = Tucked(docs)
    rows = tucked.frame.withColumn("own", digest_of(tucked[text]))
    index = insert(None, docs, text, key)
    return rows.join(index, F.col("own") == F.col("digest")).select(
        *tucked.back(*added), "keep_id", "group_size", tucked[key].eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicated(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows that stay, with the columns of the input.

    Rows and index meet by digest and key, which spreads the copies of a hot text.
    """
    index = insert(None, docs, text, key).select("digest", "keep_id")
    tucked = Tucked(docs)
    rows = tucked.frame.withColumn("own", digest_of(tucked[text]))
    same = (F.col("own") == F.col("digest")) & tucked[key].eqNullSafe(F.col("keep_id"))
    return rows.join(index, same, "left_semi").select(*tucked.back())
