"""Exact top-k inner products over vector-approximation files.

Vectors are integers.  Every dimension's range is cut into ``CELLS`` equal cells, and a
vector's approximation holds one byte a dimension, its cell.  A cell's borders bound a
component, so a query's product with an approximation lies between two bounds.  The scan
meets blocks of queries and blocks of approximations and keeps, of each block, what may be
among a query's k best: upper bounds not under the k-th largest lower bound, of the block
first and then of all blocks.  Of a flat query, whose scores the cells give exactly, a block
keeps the k best by score and id.  Exact vectors are then read in the order of their upper
bounds: the best ``2 k`` first, and those after them only while their bound is not under the
k-th exact score found.

Of equal vectors only the ``k + 1`` smallest ids can be among any k best, the rest are left
out of the scan; so a vector that a third of all rows hold costs no more than another.
A block holds a bounded number of rows, whatever the table's size.

Defined cases: a vector that is NULL, or has a NULL, NaN or infinite component, or no id takes
no part; an empty vector meets empty vectors with score 0; vectors meet only vectors of their
own length; rows with the same id are candidates of one another, and each gets its k best; an
empty table gives no rows.  Components are whole numbers under 2^53, scores fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetables.llm.common import stored

CELLS = 64
BLOCK_ROWS = 16_384
QUERY_ROWS = 4_096
FOUND = "q_row bigint, row bigint, low double, high double"


def integers(vector: Column, scale: int = 256) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))


def usable(vector: Column) -> Column:
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != F.lit(float("inf"))),
    )
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def grid_of(rows: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Lower border and cell width of each dimension, by the vectors' length."""
    ranges = rows.select("n", F.posexplode("v").alias("at", "x")).groupBy("n", "at").agg(
        F.min("x").alias("low"), F.max("x").alias("high")
    )
    grid: dict[int, tuple[np.ndarray, np.ndarray]] = {0: (np.zeros(0), np.ones(0))}
    for row in ranges.collect():  # one row a dimension
        low, width = grid.setdefault(row["n"], (np.zeros(row["n"]), np.ones(row["n"])))
        low[row["at"]] = row["low"]
        width[row["at"]] = max(1, -(-(row["high"] - row["low"] + 1) // CELLS))
    return grid


def approximations(rows: DataFrame, grid: dict) -> DataFrame:
    """``(row, n, cells)``: the vector-approximation file."""

    def approximate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = []
            for n, vector in zip(batch.column(1).to_pylist(), batch.column(2)):
                low, width = grid[n]
                values = np.asarray(vector.values, dtype=np.float64)
                cells.append(((values - low) // width).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(cells, pa.binary()), batch.column(3)],
                names=["row", "n", "cells", "id"],
            )

    return rows.select("row", "n", "v", "id").mapInArrow(approximate, "row bigint, n int, cells binary, id bigint")


def _scan(grid: dict, k: int):
    def scan(key, queries: pa.Table, block: pa.Table) -> pa.Table:
        names = ["q_row", "row", "low", "high"]
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        empty = pa.table([pa.array([], t) for t in kinds], names=names)
        if not queries.num_rows or not block.num_rows:
            return empty
        n = queries.column("n")[0].as_py()
        low, width = grid[n]
        rows, own = block.column("row").to_numpy(), queries.column("q_row").to_numpy()
        ids = block.column("id").to_numpy()
        cells = np.frombuffer(b"".join(block.column("cells").to_pylist()), dtype=np.uint8).reshape(len(rows), n)
        corner = cells.astype(np.float64) * width + low
        values = np.array(queries.column("v").to_pylist(), dtype=np.float64).reshape(len(own), n)
        parts = []
        for at in range(0, len(own), 256):
            q = values[at : at + 256]
            base = q @ corner.T
            down = (np.minimum(q, 0) @ (width - 1))[:, None]
            up = (np.maximum(q, 0) @ (width - 1))[:, None]
            least = base + down
            mine = own[at : at + 256, None] == rows[None, :]
            least[mine] = -np.inf
            kth = np.partition(least, -k, axis=1)[:, -k, None] if len(rows) > k else np.full((len(q), 1), -np.inf)
            keep = (base + up >= kth) & ~mine
            # Cells say all of a query that is zero wherever they are wider than one number: its
            # scores are known, so of many equal ones only those of the k smallest ids stay.
            for flat in np.flatnonzero((up - down)[:, 0] == 0):
                some = np.flatnonzero(keep[flat])
                best = some[np.lexsort((ids[some], -base[flat, some]))][:k]
                keep[flat] = False
                keep[flat, best] = True
            i, j = np.nonzero(keep)
            parts.append([own[at + i], rows[j], least[i, j], (base + up)[i, j]])
        return pa.table([pa.array(np.concatenate(c), t) for c, t in zip(zip(*parts), kinds)], names=names)

    return scan


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "v",
            block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best of each query among all other rows.

    ``vector`` holds whole numbers; ``is_query`` says which rows are queries.
    """
    rows = stored(
        vectors.filter(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(
            F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"),
            F.size(vector).alias("n"), F.col(vector).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"),
        ),
        "vectors",
    )
    grid = grid_of(rows)
    # Only the k + 1 smallest ids of equal vectors; Spark limits them before the exchange.
    equal = Window.partitionBy("n", "v").orderBy("id", "row")
    firsts = rows.withColumn("copy", F.row_number().over(equal)).filter(F.col("copy") <= k + 1)
    approximate = stored(approximations(firsts, grid), "approximations")
    queries = rows.filter("asks").select(F.col("row").alias("q_row"), "n", "v")
    n_rows, n_queries = approximate.count(), queries.count()
    least = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(-(-n_rows // block_rows), min(least, -(-n_rows // 1024)), 1)
    q_blocks = max(-(-n_queries // query_rows), 1)

    def dealt(name: str, n: int) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    asked = queries.withColumn("q_block", dealt("q_row", q_blocks)).withColumn("block", every(blocks))
    held = approximate.withColumn("block", dealt("row", blocks)).withColumn("q_block", every(q_blocks))
    by = ["block", "q_block", "n"]
    found = asked.groupBy(by).cogroup(held.groupBy(by)).applyInArrow(_scan(grid, k), FOUND)
    found = stored(found, "found")

    by_low = Window.partitionBy("q_row").orderBy(F.col("low").desc())
    sure = found.withColumn("at", F.row_number().over(by_low)).filter(F.col("at") <= k).groupBy("q_row").agg(
        F.when(F.count("*") == k, F.min("low")).otherwise(F.lit(float("-inf"))).alias("floor")
    )
    by_high = Window.partitionBy("q_row").orderBy(F.col("high").desc(), "row")
    ordered = stored(
        found.join(sure, "q_row").filter("high >= floor").withColumn("at", F.row_number().over(by_high)), "ordered"
    )
    exact = rows.select("row", "id", "v")

    def read(candidates: DataFrame) -> DataFrame:
        asking = exact.select(F.col("row").alias("q_row"), F.col("id").alias("query_id"), F.col("v").alias("q"))
        product = F.aggregate(F.zip_with("q", "v", lambda x, y: x * y), F.lit(0).cast("long"), lambda s, x: s + x)
        return candidates.join(asking, "q_row").join(exact, "row").select("q_row", "query_id", "id", "row", product.alias("score"))

    first = stored(read(ordered.filter(F.col("at") <= 2 * k)), "first")
    by_score = Window.partitionBy("q_row").orderBy(F.col("score").desc(), "id", "row")
    kth = first.withColumn("at", F.row_number().over(by_score)).filter(F.col("at") == k).select("q_row", F.col("score").alias("kth"))
    rest = ordered.filter(F.col("at") > 2 * k).join(kth, "q_row").filter("high >= kth")
    best = first.unionByName(read(rest)).withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
