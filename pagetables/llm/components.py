"""Connected components of an edge table by alternating large-star and small-star steps.

Every step joins edges with one minimum a node, found by partial sums; no neighbourhood is
ever collected, and Spark splits the join's large partitions where a node has many edges.
Rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetables.llm.common import stored

MOST_ROUNDS = 60


def _star(arcs: DataFrame, least: DataFrame) -> DataFrame:
    """Arcs with the least node around their first end.  The minima are stored tables, so both
    sides of the join are dealt anew, and Spark can split the arcs of one busy node."""
    return arcs.join(least.withColumnRenamed("a", "_a"), F.col("a") == F.col("_a")).drop("_a")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around it."""
    arcs = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = arcs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    least = stored(least, "least")
    return _star(arcs.filter("b > a"), least).filter("m <> b").select(F.col("m").alias("a"), "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them."""
    arcs = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    least = arcs.groupBy("a").agg(F.min("b").alias("m"))
    least = stored(least, "least")
    moved = _star(arcs, least).filter("m <> b").select(F.col("m").alias("a"), "b")
    return moved.unionByName(least.select(F.col("m").alias("a"), F.col("a").alias("b"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of every node of an edge; a component is its smallest node.

    NULL ends and loops are ignored, edges may repeat in either direction; an empty table
    gives no rows.
    """
    known = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    plain = known.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a <> b").distinct()
    mark = None
    for _ in range(MOST_ROUNDS):
        plain = stored(_small_star(_large_star(plain)), "components")
        now = plain.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark or now[0] == 0:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    return plain.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        plain.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )
