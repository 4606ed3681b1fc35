"""One file a document, named by its key: a data source to write and read such folders.

A task writes its documents below a folder of its own, 4,096 to a folder, each with an index of
keys and files.  A finished task reports its folder and the number of its blocks, nothing of its
documents.  The commit writes these reports as one file and moves it to its final name: at that
moment all documents of the job can be read, and none before.  A task that fails removes what
it wrote; an aborted job removes its folder; the commit removes folders of lost attempts.

    path/commits/<number>-<job>.json      the parts of a job, and whether they replace all before
    path/<job>/<task>/<block>/<name>      a document
    path/<job>/<task>/<block>/_index      a line a document: key, file, length in bytes

A reader has one task a block, so planning grows with the blocks.  Paths are opened by Arrow: a
folder that all executors mount, ``hdfs://``, ``s3a://`` and ``gs://``.

Defined cases: a key's name is its percent-encoded text; the second of equal keys in a block
ends in ``+2`` (a plus sign is never part of an encoded key); long keys keep 120 characters and
their hash; NULL keys and empty keys have the names ``+null`` and ``+empty``; a NULL document has
no file and is read as NULL; repeated keys are all kept; of jobs that commit at the same time none
is lost; an overwrite removes the files before it, as Spark's own does; an empty table is
an empty folder, a folder without commits is read as empty.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from pagetables.sources.shares import listed, opened

FORMAT = "named_docs"
DOCS = "schema_id string, doc string, file string"
BLOCK_FILES = 4096
BATCH_BYTES = 4 * 1024 * 1024
LONGEST_NAME = 120
REMOVALS = 50


def file_name(key: str | None, extension: str, repeat: int = 1) -> str:
    """The name of a document's file; different keys have different names."""
    if not key:
        name = "+null" if key is None else "+empty"
    else:
        name = quote(key, safe="")
        if len(name) > LONGEST_NAME:
            name = f"{name[:LONGEST_NAME]}+{hashlib.sha256(key.encode()).hexdigest()}"
    return f"{name}{f'+{repeat}' if repeat > 1 else ''}{extension}"


@dataclass
class Part(WriterCommitMessage):
    """What a task has written."""

    folder: str
    blocks: int


class NamedWriter(DataSourceArrowWriter):
    def __init__(self, path: str, extension: str, overwrite: bool) -> None:
        self.path, self.extension, self.overwrite = path, extension, overwrite
        self.job = f"docs-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        files, root = opened(self.path)
        part = f"{self.job}/{uuid.uuid4().hex}"
        index: list[tuple] = []
        repeats: dict[str | None, int] = {}
        blocks = 0

        def closed() -> None:
            with files.open_output_stream(f"{root}/{part}/{blocks - 1:08d}/_index") as out:
                out.write("".join(json.dumps(entry) + "\n" for entry in index).encode())

        files.create_dir(f"{root}/{part}")
        try:
            for batch in iterator:
                for key, doc in zip(batch.column("schema_id"), batch.column("doc")):
                    key, doc = key.as_py(), doc.as_py()
                    if len(index) % BLOCK_FILES == 0:
                        if index:
                            closed()
                        index, repeats, blocks = [], {}, blocks + 1
                        files.create_dir(f"{root}/{part}/{blocks - 1:08d}", recursive=False)
                    name, length = None, 0
                    if doc is not None:
                        repeats[key] = repeats.get(key, 0) + 1
                        name, content = file_name(key, self.extension, repeats[key]), doc.encode()
                        length = len(content)
                        with files.open_output_stream(f"{root}/{part}/{blocks - 1:08d}/{name}") as out:
                            out.write(content)
                    index.append((key, name, length))
            if index:
                closed()
        except BaseException:
            removed(files, f"{root}/{part}")
            raise
        return Part(part, blocks)

    def commit(self, messages: list[Part | None]) -> None:
        files, root = opened(self.path)
        parts = sorted((m.folder, m.blocks) for m in messages if m is not None and m.blocks)
        kept = {folder for folder, _ in parts}
        for found in listed(files, f"{root}/{self.job}"):
            if f"{self.job}/{found.base_name}" not in kept:  # of an attempt that was lost
                removed(files, found.path)
        before = commits(files, root)
        number = 1 + max((int(c.base_name.split("-")[0]) for c in before), default=0)
        final = f"{root}/commits/{number:012d}-{self.job}.json"
        files.create_dir(f"{root}/commits")
        with files.open_output_stream(f"{final}.new") as out:
            out.write(json.dumps({"overwrite": self.overwrite, "parts": parts}).encode())
        files.move(f"{final}.new", final)
        if self.overwrite:
            for old in before:  # nothing reads them any more
                for job in {folder.split("/")[0] for folder, _ in said(files, old.path)["parts"]}:
                    removed(files, f"{root}/{job}")
                files.delete_file(old.path)

    def abort(self, messages: list[Part | None]) -> None:
        files, root = opened(self.path)
        removed(files, f"{root}/{self.job}")


class NamedReader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path

    def partitions(self) -> list[InputPartition]:
        files, root = opened(self.path)
        blocks: list[str] = []
        for commit in commits(files, root):
            found = said(files, commit.path)
            if found["overwrite"]:
                blocks = []
            blocks += [f"{folder}/{i:08d}" for folder, count in found["parts"] for i in range(count)]
        return [InputPartition(block) for block in blocks] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value is None:
            return
        files, root = opened(self.path)
        folder = f"{root}/{partition.value}"
        with files.open_input_stream(f"{folder}/_index") as lines:
            index = [json.loads(line) for line in lines.read().splitlines()]
        rows, size = [], 0
        for key, name, length in index:
            if rows and size + length > BATCH_BYTES:
                yield batch_of(rows)
                rows, size = [], 0
            doc = None
            if name is not None:
                with files.open_input_stream(f"{folder}/{name}") as content:
                    doc = content.read().decode()
            rows.append((key, doc, name and f"{partition.value}/{name}"))
            size += length
        if rows:
            yield batch_of(rows)


class NamedDocs(DataSource):
    """``spark.read.format("named_docs")`` and ``write.format("named_docs")``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return DOCS

    def reader(self, schema) -> NamedReader:
        return NamedReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> NamedWriter:
        return NamedWriter(self.options["path"], self.options.get("extension", ".json"), overwrite)


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split(" ")[0] for c in DOCS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=names)


def commits(files: fs.FileSystem, root: str) -> list[fs.FileInfo]:
    """The commit files in order."""
    found = [f for f in listed(files, f"{root}/commits") if f.base_name.endswith(".json")]
    return sorted(found, key=lambda f: f.base_name)


def said(files: fs.FileSystem, path: str) -> dict:
    with files.open_input_stream(path) as content:
        return json.loads(content.read())


def removed(files: fs.FileSystem, folder: str) -> None:
    """Removes a folder, again if a task that is being ended has still added to it.  Such a task
    then fails, since it makes no folder above its blocks."""
    for attempt in range(REMOVALS):
        if files.get_file_info(folder).type != fs.FileType.Directory:
            return
        try:
            files.delete_dir(folder)
        except OSError:
            if attempt == REMOVALS - 1:
                raise
            time.sleep(0.1)


def write_named(docs: DataFrame, path: str, extension: str = ".json", overwrite: bool = False) -> None:
    """Write ``(schema_id, doc)`` as one file a document."""
    docs.sparkSession.dataSource.register(NamedDocs)
    docs.select(F.col("schema_id").cast("string"), F.col("doc").cast("string")).write.format(FORMAT).mode(
        "overwrite" if overwrite else "append"
    ).option("extension", extension).save(path)


def read_named(spark: SparkSession, path: str) -> DataFrame:
    """``(schema_id, doc, file)`` of all committed documents; ``file`` is below the path."""
    spark.dataSource.register(NamedDocs)
    return spark.read.format(FORMAT).load(path)
