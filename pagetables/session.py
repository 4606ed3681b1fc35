"""Session settings of tests and the benchmark."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# How many tasks queries deal the small tables of tests and of the benchmark to, before they
# render and parse them.  Unset, and so on a cluster, inputs stay as their files are split.
PARTITIONS = "spark.pagetables.partitions"


def get_session(app: str = "pagetables", cores: str = "*") -> SparkSession:
    """A session for tests and the benchmark; on a cluster pass your own session instead."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", os.environ.get("SHUFFLE_PARTITIONS", "8"))
        .config(PARTITIONS, cores if cores.isdigit() else str(os.cpu_count()))
        .config("spark.driver.memory", os.environ.get("DRIVER_MEMORY", "12g"))
        # A row holds a whole page, so Arrow batches are bounded by bytes, not by rows.
        .config("spark.sql.execution.arrow.maxBytesPerBatch", str(16 * 1024 * 1024))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
