"""Narrow tables are dealt to all cores before they become pages."""

from pagetables.plans import render
from pagetables.session import PARTITIONS


def test_pages_of_one_small_file_are_rendered_by_many_tasks(spark, tmp_path):
    rows = [(i, f"name {i}", "brand", "type", i, 1.5) for i in range(100)]
    ddl = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    before = spark.conf.get(PARTITIONS, None)
    spark.conf.unset(PARTITIONS)
    try:
        pages = render.part_pages(spark, str(tmp_path))
        assert pages.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        assert render.part_csv(spark, str(tmp_path)).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        assert sorted(r.doc_id for r in pages.collect()) == list(range(100))
    finally:
        if before is not None:
            spark.conf.set(PARTITIONS, before)
