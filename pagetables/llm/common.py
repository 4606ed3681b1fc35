"""Tables, shared storage and small column helpers of the training-data operators."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Callable
from types import ModuleType

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space that parts words, as the contracts of the operators name it.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_own_folder: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.  Only a session of one machine may go without:
    it gets a temporary folder, which a cluster's executors could not share."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if not _own_folder:
            _own_folder.append(tempfile.mkdtemp(prefix="pagetables-"))
        folder = _own_folder[0]
    return folder.rstrip("/")


class Tucked:
    """A frame whose columns have names no operator uses, so that nothing can clash.

    ``frame`` is renamed by position; ``self[name]`` is a column of the input in it, and
    ``back(*replaced)`` restores the input's columns but for the replaced ones.
    """

    def __init__(self, frame: DataFrame):
        self.names = frame.columns
        self.frame = frame.toDF(*[f"_in{i}" for i in range(len(self.names))])

    def name(self, column: str) -> str:
        return f"_in{self.names.index(column)}"

    def __getitem__(self, column: str) -> Column:
        return F.col(self.name(column))

    def back(self, *replaced: str) -> list[Column]:
        return [F.col(f"_in{i}").alias(c) for i, c in enumerate(self.names) if c not in replaced]


# The session's bound of the Arrow batches that Python tasks are sent.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def stored(frame: DataFrame, name: str, batch_bytes: int | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back: its lineage is cut, later jobs
    read the same rows whatever executors are lost, and it holds no memory.

    ``batch_bytes`` bounds the Arrow batches of this write, for steps that hold long texts."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    schema = frame.schema
    before = spark.conf.get(BATCH, None)
    if batch_bytes:
        spark.conf.set(BATCH, str(batch_bytes))
    try:
        frame.write.parquet(path)
    finally:
        if batch_bytes and before is not None:
            spark.conf.set(BATCH, before)
    return spark.read.schema(schema).parquet(path)


def once_a_worker(name: str, make: Callable[[], object]) -> object:
    """A thing that is costly to make, kept by the worker process for its later tasks.  What
    tasks run is sent by value, so a module of ours would be a new one in each of them."""
    held = sys.modules.setdefault("_pagetables_held", ModuleType("_pagetables_held"))
    if not hasattr(held, name):
        setattr(held, name, make())
    return getattr(held, name)


def released(*frames: DataFrame) -> None:
    """Frees the space of ``stored`` frames that nothing will read again."""
    for frame in frames:
        files = frame.inputFiles()
        if files:
            empty = frame.sparkSession.createDataFrame([], frame.schema)
            empty.write.mode("overwrite").parquet(files[0].rpartition("/")[0])


def count_words(text: Column) -> Column:
    """Number of words; NULL text has none.  ``split`` yields one part more than there are
    gaps; parts before a leading gap and after a trailing one are empty."""
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(F.coalesce(F.length(trimmed), F.lit(0)) == 0, F.lit(0)).otherwise(
        F.size(F.split(trimmed, SPACE))
    ).cast("long")


def utf8_bytes(text: Column) -> Column:
    return F.octet_length(text).cast("long")


def unit(key: Column, bits: int = 48) -> Column:
    """A uniform number in [0, 1) from the first ``bits`` bits of a text's MD5."""
    return F.conv(F.substring(F.md5(key), 1, bits // 4), 16, 10).cast("long") / F.lit(float(1 << bits))
