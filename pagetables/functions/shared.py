"""The folder that driver and executors share, for what must outlive a job."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_folder: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one only in a session of one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if not _own_folder:
            _own_folder.append(tempfile.mkdtemp(prefix="pagetables-"))
        folder = _own_folder[0]
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def kept(frame: DataFrame, path: str) -> DataFrame:
    """Write a frame and read it back, so that what made it never runs again."""
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def emptied(frame: DataFrame, path: str) -> None:
    """Frees the space of a frame that was ``kept`` and that nothing reads any more."""
    frame.sparkSession.createDataFrame([], frame.schema).write.mode("overwrite").parquet(path)
