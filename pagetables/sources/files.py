"""Files of a bounded size as rows, and the guards every document passes first."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetables.sources.shares import listed, opened

LISTED_AT_ONCE = 4096
MEGABYTE = 1024 * 1024
DEFAULT_MAX_MB = 10
# Fixed value: the address part that marks a hosted dataset.
DATASET_ADDRESS = "kaggle.com/datasets"


def size_error(length: Column, max_mb: float) -> Column:
    """The status of an oversized document, NULL for the others."""
    return F.when(
        length > max_mb * MEGABYTE,
        F.format_string(
            f"Error: File size (%.2f MB) exceeds maximum ({max_mb:g} MB)", length / MEGABYTE
        ),
    )


def read_files(
    spark: SparkSession, path: str, max_mb: float = DEFAULT_MAX_MB, pattern: str | None = None
) -> DataFrame:
    """``(source, content binary, status)``; files over the limit are listed, not read.

    Both length filters are pushed into the file scan, and the listing of oversized files
    does not select the content, so their bytes are never loaded.
    """
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    files = reader.load(path)
    limit = int(max_mb * MEGABYTE)
    fitting = files.filter(F.col("length") <= limit).select(
        F.col("path").alias("source"), "content", F.lit(None).cast("string").alias("status")
    )
    oversized = files.filter(F.col("length") > limit).select(
        F.col("path").alias("source"),
        F.lit(None).cast("binary").alias("content"),
        size_error(F.col("length"), max_mb).alias("status"),
    )
    return fitting.unionByName(oversized)


def read_html_files(
    spark: SparkSession, path: str, max_mb: float = DEFAULT_MAX_MB, pattern: str | None = None
) -> DataFrame:
    """Markup files as pages keyed by their path; bytes are decoded where they are parsed."""
    return read_files(spark, path, max_mb, pattern).select(
        F.col("source").alias("doc_id"), "source", "status", F.col("content").alias("html")
    )


def read_pages(
    spark: SparkSession, path: str, key: str = "doc_id", source: str = "source", html: str = "html"
) -> DataFrame:
    """A table of crawled pages as ``pages(doc_id, source, html)``."""
    return spark.read.parquet(path).select(
        F.col(key).alias("doc_id"), F.col(source).alias("source"), F.col(html).alias("html")
    )


def folders_of(spark: SparkSession, pattern: str) -> list[str] | None:
    """The folders a path names, where ``*`` and ``?`` stand for parts of a name, in Spark's form;
    None where only Spark can tell: other storage, other signs, files, or nothing there."""
    scheme = re.match("([a-zA-Z0-9+.-]+):", pattern)
    default = spark.conf.get("spark.hadoop.fs.defaultFS", "file:")
    local = pattern.startswith("/") and default.startswith("file:")
    if re.search(r"[\[{\\]", pattern) or not (scheme or local):
        return None
    try:
        files, place = opened(pattern)
        start, *parts = re.split("/(?=[^/]*[*?])", re.sub("(?<=.)/+$", "", place))
        head = pattern.removesuffix("/")[: -len(place.rstrip("/"))] if "://" in pattern else ""
        found = [start]
        for part in parts:  # names with signs, then what follows them up to the next
            sign, _, rest = part.partition("/")
            test = re.compile("".join({"*": ".*", "?": "."}.get(c, re.escape(c)) for c in sign), re.DOTALL)
            names = [f for folder in found for f in listed(files, folder) if test.fullmatch(f.base_name)]
            found = [f"{f.path}/{rest}" if rest else f.path for f in names]
        kinds = [f.type for f in files.get_file_info(found)]
    except (OSError, pa.ArrowException):
        return None
    if not kinds or any(kind == fs.FileType.File for kind in kinds):
        return None
    prefix = "file:" if scheme is None or scheme.group(1) == "file" else head
    return [f"{prefix}{f}" for f, kind in zip(found, kinds) if kind == fs.FileType.Directory] or None


def list_csv(spark: SparkSession, directory: str) -> DataFrame:
    """``(path, length)`` of the ``*.csv`` files right in a directory; content is not
    read.  Spark lists no empty and no hidden files, here and in ``read_files``.

    The driver finds the folders and tasks list the files in them, so that no file is known to the
    driver; where only Spark reaches a path, it lists the files.
    """
    folders = folders_of(spark, directory)
    if folders is None:
        return (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", "*.csv")
            .load(directory)
            .select("path", "length")
        )

    def files_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                files, place = opened(folder)
                found = [
                    (f"{folder}/{f.base_name}", f.size)
                    for f in listed(files, place)
                    if f.type == fs.FileType.File
                    and f.base_name.endswith(".csv")
                    and f.size
                    and not f.base_name.startswith(".")
                    and (not f.base_name.startswith("_") or "=" in f.base_name)
                ]
                for i in range(0, len(found), LISTED_AT_ONCE):
                    paths, lengths = zip(*found[i : i + LISTED_AT_ONCE])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(paths, pa.string()), pa.array(lengths, pa.int64())], names=["path", "length"]
                    )

    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    named = spark.createDataFrame([(f,) for f in folders], "folder string")
    listing = named.repartition(min(tasks, len(folders))).mapInArrow(files_in, "path string, length long")
    return listing if len(folders) >= tasks else listing.repartition(tasks)


def guard_size(pages: DataFrame, max_mb: float = DEFAULT_MAX_MB, content: str = "html") -> DataFrame:
    """Give oversized documents an error status and drop their content."""
    length = F.octet_length(content)
    known = F.col("status") if "status" in pages.columns else F.lit(None).cast("string")
    keep = [c for c in pages.columns if c not in ("status", content)]
    return pages.select(
        *keep,
        F.coalesce(known, size_error(length, max_mb)).alias("status"),
        F.when(length <= int(max_mb * MEGABYTE), F.col(content)).alias(content),
    )


def route_source(pages: DataFrame, source: str = "source") -> DataFrame:
    """``kind`` of a source: ``dataset``, ``csv`` or ``html``; case-sensitive."""
    name = F.col(source)
    return pages.withColumn(
        "kind",
        F.when(name.contains(DATASET_ADDRESS), "dataset")
        .when(name.endswith(".csv"), "csv")
        .otherwise("html"),
    )


def read_csv_sample(spark: SparkSession, path: str, n: int = 100) -> DataFrame:
    """The first ``n`` rows of one wide CSV file with a header, as strings."""
    return (
        spark.read.option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .csv(path)
        .limit(n)
    )

