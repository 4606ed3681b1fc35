"""Schema documents as files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Output formats by suffix, and the suffix added when there is none.
FORMATS = {"json": "json", "yaml": "yaml", "text": "text", "txt": "text"}
SUFFIXES = {".json": "json", ".yaml": "yaml", ".yml": "yaml"}
EXTENSIONS = {"json": [".json"], "yaml": [".yaml", ".yml"], "text": [".txt"]}


def resolve_format(fmt: str | None, path: str) -> str:
    """The output format; without one it follows from the path's suffix."""
    if fmt is not None:
        if fmt.lower() not in FORMATS:
            raise ValueError(f"Unsupported format type: {fmt}")
        return FORMATS[fmt.lower()]
    return next((f for suffix, f in SUFFIXES.items() if path.endswith(suffix)), "text")


def format_of(path: Column) -> Column:
    """``resolve_format`` for a column of paths."""
    return (
        F.when(path.endswith(".json"), "json")
        .when(path.endswith(".yaml") | path.endswith(".yml"), "yaml")
        .otherwise("text")
    )


def with_extension(path: Column, fmt: Column) -> Column:
    """The path, with the format's extension if it does not have it."""
    chain = F
    for name, extensions in EXTENSIONS.items():
        has = F.lit(False)
        for extension in extensions:
            has = has | path.endswith(extension)
        chain = chain.when(
            fmt == name, F.when(has, path).otherwise(F.concat(path, F.lit(extensions[0])))
        )
    return chain.otherwise(path)


def write_docs(docs: DataFrame, path: str, fmt: str | None = None) -> None:
    """Write ``(schema_id, doc)`` to a directory.

    ``json``: one JSON object per line, ``{"schema_id", "doc"}``; ``yaml``: one stream of
    YAML documents per part file; ``text``: the documents one after the other.
    """
    kind = resolve_format(fmt, path)
    writer = docs.write.mode("overwrite")
    if kind == "json":
        writer.json(path)
    elif kind == "yaml":
        docs.select(F.concat(F.lit("---\n"), F.rtrim(F.col("doc"), F.lit("\n")))).write.mode(
            "overwrite"
        ).text(path)
    else:
        docs.select("doc").write.mode("overwrite").text(path)


def read_docs(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_docs`` wrote as ``json``: ``(schema_id, doc)``."""
    return spark.read.schema("schema_id string, doc string").json(path)


def read_schema_docs(spark: SparkSession, path: str) -> DataFrame:
    """One JSON schema document per file, keyed by the file's path."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("schema_id"), F.col("value").alias("doc")
    )


def format_raw(docs: DataFrame) -> DataFrame:
    """``(schema_id, status, doc, raw)`` to what is written: the document where the schema
    loaded, else the raw text; nothing for errors."""
    return docs.filter(F.col("status") != "Error").select(
        "schema_id",
        F.when(F.col("status") == "Success", F.col("doc")).otherwise(F.col("raw")).alias("doc"),
    )
