"""Plans: what moves data, what is pushed down, and streams."""

import pathlib

import pytest
from pyspark.sql import functions as F

import pagetables
from pagetables.corpus import csv_documents, document_schemas, model_schemas, page_documents
from pagetables.operators.extract import find_captions, find_status
from pagetables.operators.metrics import phase_summary
from pagetables.operators.schemas import apply_patches, to_json_docs
from pagetables.operators.select import select_tables, with_advice
from pagetables.operators.shred import shred
from pagetables.plans import inferring, measuring, reading, render, revising
from pagetables.session import PARTITIONS
from pagetables.streaming.arrivals import PAGES_SCHEMA, page_stream, schema_stream, write_stream

SF_DIR = "/root/testdata/sf0.001"


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def pages(spark):
    return reading.raw_pages(spark, SF_DIR)


def test_pages_to_documents_is_one_python_stage_without_exchange(spark):
    plan = plan_of(to_json_docs(document_schemas(page_documents(pages(spark)))))
    assert "Exchange" not in plan and plan.count("MapInArrow") == 1
    read = plan[plan.index("ReadSchema"):].splitlines()[0]
    assert all(c in read for c in ("page_id", "url", "html"))


def test_csv_to_documents_is_one_python_stage_without_exchange(spark):
    files = spark.read.schema("doc_id bigint, source string, content string").parquet(f"{SF_DIR}/pages.parquet")
    plan = plan_of(document_schemas(csv_documents(files), kind="file"))
    assert "Exchange" not in plan and plan.count("MapInArrow") == 1


def test_extraction_is_not_repeated_by_filters(spark):
    documents = page_documents(pages(spark))
    plan = documents.filter("status = 'Success' and tables_count > 1").select(F.explode("tables.caption"))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("INSET") == 1  # the word list of the property-value test


def test_rows_and_headers_are_found_without_reading_all_nodes(spark):
    text = page_documents(pages(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert "places" in text and text.count("filter(nodes") <= 1  # the empty list of headers
    assert ".tag = tr" not in text and ".tag = th" not in text


def test_headers_are_counted_before_they_are_rows_and_judged(spark):
    plan = plan_of(inferring.columns_from_names(spark, SF_DIR))
    assert plan.index("partial_sum(n") < plan.index("posexplode(headers") < plan.index("partial_count(1)")
    assert "RLIKE" not in plan[plan.index("partial_sum(n"):]


def test_inputs_are_dealt_out_only_where_the_session_says_so(spark):
    assert "RoundRobinPartitioning(4)" in plan_of(render.load(spark, SF_DIR, "pages"))
    assert "RoundRobinPartitioning(3)" in plan_of(render.load(spark, SF_DIR, "pages", 3))
    elsewhere = spark.newSession()
    elsewhere.conf.unset(PARTITIONS)
    assert "Exchange" not in plan_of(render.load(elsewhere, SF_DIR, "pages"))


def test_headings_and_statuses_do_not_read_rows(spark):
    dom = shred(pages(spark), prefilter=True)
    for frame in (find_captions(dom), find_status(dom)):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "INSET" not in plan and "constraint" not in plan  # the property-value words
        assert "thead" not in plan and "cell" not in plan


def test_advice_meets_raw_pages(spark):
    advice = pages(spark).select("doc_id", F.lit(0).alias("table_index"))
    frame = select_tables(page_documents(with_advice(pages(spark), advice, advice)))
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("MapInArrow") < plan.index("Join")  # printed from the top


def test_no_driver_action_or_private_access_in_operators():
    found = []
    for file in (pathlib.Path(pagetables.__file__).parent).rglob("*.py"):
        if "llm" not in file.parts:
            found += [(file.name, word) for word in (".first()", ".collect()", "_jdf", "localCheckpoint") if word in file.read_text()]
    assert found == []


def test_model_path_is_one_narrow_run(spark):
    frame = model_schemas(page_documents(pages(spark)), lambda prompt, options: {"content": "{}"})
    plan = plan_of(frame)
    assert "Exchange" not in plan and plan.count("MapInArrow") == 2  # parsing and asking


def test_tables_do_not_go_to_the_model_call(spark):
    frame = model_schemas(page_documents(pages(spark)), lambda prompt, options: {"content": "{}"})
    sent = plan_of(frame).split("MapInArrow call(")[1].split(")#")[0]
    assert "prompt#" in sent and "headers#" in sent and ", table#" not in sent
    assert set(frame.columns) >= {"schema_id", "status", "columns", "metadata"} and "headers" not in frame.columns


def test_metrics_combine_before_one_exchange(spark):
    plan = plan_of(phase_summary(measuring.event_log(spark, SF_DIR)))
    assert plan.count("hashpartitioning") == 1 and plan.count("partial_sum") >= 4
    assert "SortAggregate" not in plan


def test_patches_combine_before_they_meet_their_schemas(spark):
    schemas = revising.part_schemas(spark, SF_DIR)
    patches = spark.createDataFrame([], "schema_id bigint, round int, column_name string, field string, value string")
    plan = apply_patches(schemas, patches)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "CartesianProduct" not in plan


def test_stream_gives_what_the_batch_gives(spark, tmp_path):
    arriving = tmp_path / "in"
    rendered = render.order_pages(spark, SF_DIR).select(*PAGES_SCHEMA.names)
    rendered.filter("doc_id % 2 = 0").write.parquet(str(arriving), mode="append")
    stream = schema_stream(page_stream(spark, str(arriving)))
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    write_stream(stream, out, state).awaitTermination()
    rendered.filter("doc_id % 2 = 1").write.parquet(str(arriving), mode="append")
    write_stream(stream, out, state).awaitTermination()
    got = spark.read.parquet(out)
    want = to_json_docs(document_schemas(page_documents(rendered)))
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_stream_progress_goes_to_the_shared_folder(spark, tmp_path):
    rendered = render.order_pages(spark, SF_DIR).select(*PAGES_SCHEMA.names)
    rendered.write.parquet(str(tmp_path / "in"))
    stream = schema_stream(page_stream(spark, str(tmp_path / "in")))
    if not spark.conf.get("spark.checkpoint.dir", None):
        with pytest.raises(ValueError):
            write_stream(stream, str(tmp_path / "out"))
        return
    write_stream(stream, str(tmp_path / "out")).awaitTermination()
    write_stream(stream, str(tmp_path / "out")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == rendered.count()
