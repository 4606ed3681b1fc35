"""Streams of pages.

Extraction and inference of a document never look at another one, so the batch functions
run unchanged on a streaming DataFrame: no state, no watermark, append output.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from pagetables.corpus import document_schemas, page_documents
from pagetables.operators.schemas import to_json_docs

PAGES_SCHEMA = StructType().add("doc_id", "long").add("source", "string").add("html", "string")


def page_stream(spark: SparkSession, directory: str, files_per_trigger: int = 1000) -> DataFrame:
    """Parquet files of ``pages`` that appear in a directory."""
    return (
        spark.readStream.schema(PAGES_SCHEMA)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(directory)
    )


def schema_stream(pages: DataFrame) -> DataFrame:
    """``(schema_id, doc)`` for every arriving page with a usable table."""
    schemas = document_schemas(page_documents(pages))
    return to_json_docs(schemas.filter(F.col("status") == "Success"))


def write_stream(frame: DataFrame, path: str, checkpoint: str | None = None) -> StreamingQuery:
    """Append to Parquet, exactly once, for what has arrived so far.

    Without a place for its progress the stream keeps it in the shared folder that
    ``spark.checkpoint.dir`` names, under the name of the output.
    """
    if checkpoint is None:
        shared = frame.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not shared:
            raise ValueError("give a checkpoint folder or set spark.checkpoint.dir")
        checkpoint = f"{shared}/{re.sub(r'[^A-Za-z0-9]+', '_', path).strip('_')}"
    return (
        frame.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
