"""One key, group or document that holds much of the data changes no result."""

from pyspark.sql import functions as F

from pagetables.operators.infer import profile, type_votes
from pagetables.operators.metrics import combined_report, phase_summary, run_history
from pagetables.operators.schemas import fold_patches
from pagetables.operators.select import select_files

HOT = 200_000


def test_metrics_of_a_hot_run(spark):
    log = spark.range(HOT).select(
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 1000).alias("run_id"),
        F.when(F.col("id") % 2 == 0, "initial").otherwise("feedback").alias("phase"),
        F.lit(0.001).alias("latency_s"), *[F.lit(1).cast("bigint").alias(c) for c in ("prompt_tokens", "completion_tokens", "total_tokens")],
    )
    hot = phase_summary(log).filter("run_id = 0 and phase = 'initial'").first()
    count = log.filter("run_id = 0 and phase = 'initial'").count()
    assert hot.operations == hot.total_tokens == count and hot.total_time_s == round(count * 0.001, 3)
    total = combined_report(log).filter("phase is null").agg(F.sum("operations")).first()[0]
    assert total == HOT == run_history(log).agg(F.sum("agents")).first()[0]


def test_votes_of_a_hot_column(spark):
    cells = spark.range(HOT).select(
        F.lit(1).alias("doc_id"), F.lit(0).alias("table_id"), F.when(F.col("id") < HOT // 3, F.col("id")).otherwise(-1).alias("pos"),
        F.col("id").cast("string").alias("value"),
    )
    hot = type_votes(cells).filter("pos = -1").first()
    assert hot.total == hot.int_votes == HOT - HOT // 3 and hot.maximum == HOT - 1
    wide = cells.select((F.col("pos") < 0).alias("hot"), "value")
    found = profile(wide, ["hot"]).filter("hot").first()
    assert (found.type, found.maximum) == ("int", HOT - 1.0)


def test_patches_of_a_hot_column(spark):
    patches = spark.range(HOT).select(
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("schema_id"), F.col("id").alias("round"),
        F.lit("a").alias("column_name"), F.lit("type").alias("field"), F.col("id").cast("string").alias("value"),
    )
    assert fold_patches(patches).filter("schema_id = 0").first().type == str(HOT - 1)


def test_renames_of_a_hot_schema(spark):
    """One schema holds most of the log, all of it renames in one chain; others rename back and
    forth.  Every patch is of the name that the column had at first."""
    n = 3000
    chain = spark.range(n).select(
        F.lit(0).cast("long").alias("schema_id"), F.col("id").alias("round"), F.concat(F.lit("n"), "id").alias("column_name"),
        F.lit("name").alias("field"), F.concat(F.lit("n"), F.col("id") + 1).alias("value"),
    )
    typed = chain.select("schema_id", "round", "column_name", F.lit("type").alias("field"), F.col("round").cast("string").alias("value"))
    back = spark.range(1, 40).select(
        (F.col("id") % 5 + 1).alias("schema_id"), "id", F.when(F.floor(F.col("id") / 5) % 2 == 0, "a").otherwise("b").alias("column_name"),
        F.lit("name").alias("field"), F.when(F.floor(F.col("id") / 5) % 2 == 0, "b").otherwise("a").alias("value"),
    )
    rows = fold_patches(chain.union(typed).union(back)).collect()
    hot = [r for r in rows if r.schema_id == 0]
    assert [(r.column_name, r.name, r.type) for r in hot] == [("n0", f"n{n}", str(n - 1))]
    assert {(r.schema_id, r.column_name) for r in rows if r.schema_id} == {(1, "b"), *((s, "a") for s in range(2, 6))}


def test_file_of_a_hot_dataset(spark):
    files = spark.range(HOT).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("dataset"),
        F.format_string("%08d", "id").alias("path"),
    )
    choices = spark.createDataFrame([("hot", 4)], "dataset string, choice int")
    chosen = select_files(files, choices)
    assert chosen.filter("dataset = 'hot'").first().path == "00000005"
    assert chosen.filter("dataset = '3'").first().path == "00000003"
    # Only datasets with a choice beyond the first reach a window, and the parts of a dataset first.
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 2 and "Join" in plan[plan.rindex("Window ["):]
    assert "_part" in plan[plan.rindex("Window ["):].split("\n")[0]
    large = spark.createDataFrame([("hot", 5000), ("3", 9)], "dataset string, choice int")
    rows = {r.dataset: r.path for r in select_files(files, large).filter("dataset in ('hot', '3')").collect()}
    names = sorted(f"{i:08d}" for i in range(HOT) if i % 3 > 0)
    assert rows == {"hot": names[4999], "3": "00000003"}
