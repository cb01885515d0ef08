"""What the plans look like."""

from __future__ import annotations

import re

import pytest
from conftest import DATA, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as entry_point  # noqa: F401  registers the queries
from recordflow.checks.registry import QUERIES
from recordflow import schema
from recordflow.functions import text
from recordflow.operators import enrich, project
from recordflow.plans import steps
from recordflow.plans.bindings import Tables, document_records
from recordflow.sinks.first_wins import rows_to_insert
from recordflow.sinks.tables import ResultTable
from recordflow.sources.store import scan_execution

# These run whole chains or streams when they are called and give back a stored table.
EAGER = {name for name in dict(QUERIES) if name.startswith(("stream_", "workflow_"))}


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().toString()


def physical(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_unpartitioned_window_would_be_found(spark):
    alone = spark.range(5).withColumn("n", F.row_number().over(Window.orderBy("id")))
    assert re.search(r"windowspecdefinition\([^,()]* (ASC|DESC)\b", plan_of(alone))


@pytest.mark.parametrize("name", sorted(set(dict(QUERIES)) - EAGER))
def test_plan_of_query(spark, name):
    plan = plan_of(dict(QUERIES)[name](spark, DATA))
    assert not re.search("PythonUDF|MapInPandas|ArrowEval|BatchEvalPython|FlatMapGroups", plan)
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan)
    # A window without partition columns starts with its order or its frame.
    assert not re.search(
        r"windowspecdefinition\(([^,()]* (ASC|DESC)\b|specifiedwindowframe)", plan)
    assert not re.search(r"\bGlobalLimit|\bCollectLimit|\bSample ", plan)


def test_counts_do_not_read_record_data(spark):
    plan = plan_of(dict(QUERIES)["count_records"](spark, DATA))
    read = re.findall("ReadSchema: (.*)", plan.replace("\\n", "\n"))
    assert read and not any("text" in columns for columns in read)


def test_key_filter_reaches_the_scan(spark):
    records = Tables(spark, DATA).documents.select(
        F.col("source").alias("dataset_id"), F.lit("E0").alias("execution_id"),
        F.lit("S").alias("execution_name"), F.col("doc_id").cast("string").alias("record_id"),
        F.col("text").alias("record_data"))
    plan = physical(scan_execution(records, "E0", "src3"))
    assert "EqualTo(source,src3)" in plan


def test_scan_of_an_execution_prunes_partitions(spark, folder):
    table = ResultTable(spark, folder)
    frame = document_records(Tables(spark, DATA)).withColumn(
        "exception", F.lit(None).cast("string"))
    for execution in ("E0", "E1"):
        table.insert(frame.withColumn("execution_id", F.lit(execution)), execution)
    one = table.records("E1", "src3")
    assert "PartitionFilters: [isnotnull(" in physical(one)
    assert all("execution_id=E1/dataset_id=src3" in f for f in one.inputFiles())
    pruned = physical(table.records().where("execution_id = 'E1' and dataset_id = 'src3'"))
    assert "execution_id" in pruned.split("PartitionFilters:")[1].split("]")[0]


def test_insert_writes_few_files(spark, folder):
    table = ResultTable(spark, folder)
    table.insert(document_records(Tables(spark, DATA)).withColumn(
        "exception", F.lit(None).cast("string")), "E0")
    assert len(table.records("E0").inputFiles()) <= 2 * 20


def test_step_is_a_narrow_projection(spark):
    frame = document_records(Tables(spark, DATA))
    plan = physical(project.step_result(frame, "E1", schema.MEDIA, F.upper("record_data")))
    assert "Exchange" not in plan


def test_spread_gives_the_partitions_asked_for(spark):
    assert project.spread(spark.range(10).coalesce(1), 6).rdd.getNumPartitions() == 6


def test_hot_reference_is_split(spark, folder):
    """One reference holds a third of all rows: its partition is split among tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        references = spark.range(0, 60_000, 1, 8).select(
            F.col("id").cast("string").alias("record_id"),
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("reference"))
        entities = spark.range(60_000).select(
            F.col("id").alias("reference"), F.format_string("e%d", "id").alias("label"))
        joined = enrich.lookup_references(references, entities)
        rows = joined.collect()
        plan = physical(joined)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert len(rows) == 60_000 and all(r["resolved"] for r in rows)
    assert "skew=true" in plan


def test_fresh_insert_of_a_step_shuffles_nothing(spark, folder):
    table = ResultTable(spark, folder)
    frame = document_records(Tables(spark, DATA)).withColumn(
        "exception", F.lit(None).cast("string"))
    rows = rows_to_insert(frame, table.records("E0"), ["record_data"], unique=True)
    assert "Exchange" not in physical(rows)


def test_repeated_insert_does_not_shuffle_the_rows(spark, folder):
    table = ResultTable(spark, folder)
    frame = document_records(Tables(spark, DATA)).withColumn(
        "exception", F.lit(None).cast("string"))
    table.insert(frame, "E0")
    again = rows_to_insert(frame, table.records("E0"), ["record_data"], unique=True)
    assert again.count() == 0
    exchanged = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", physical(again))
    assert not any("record_data" in columns for columns in exchanged)


def test_costly_references_are_computed_once_per_use(spark):
    """Once beside the text and once for the lookup; no filter computes them again."""
    frame = document_records(Tables(spark, DATA))
    links = text.parse_xml(F.col("record_data"), "link array<string>")["link"]
    plan = physical(enrich.record_references(frame, links))
    assert plan.count("from_xml") == 1


def test_dates_are_served_without_reading_texts(spark, folder):
    from recordflow.plans.workflow import SERVING
    from recordflow.sinks.tables import ChangeTable
    table = ChangeTable(spark, folder, SERVING, ["record_id"])
    rows = spark.createDataFrame([("r1", "d", "<record/>", None)], SERVING)
    table.write(rows, 0)
    table.compact(0)
    table.write(rows, 1)
    state = table.state(columns=["updated"])
    read = re.findall("ReadSchema: (.*)", state._jdf.queryExecution().executedPlan().toString().replace("\\n", "\n"))
    assert state.columns == ["record_id", "updated"] and state.count() == 1
    assert read and not any("record_data" in columns for columns in read)


def test_internal_validation_cuts_a_record_once(spark):
    records = spark.createDataFrame([
        ("d", "e", "S", "1", "<record><b>2</b> <!-- c --><a>1</a></record>"), ("d", "e", "S", "2", "<record><b>"),
        ("d", "e", "S", "3", None), ("d", "e", "S", "4", "<record><a>1</a></record>")], schema.EXECUTION_RECORD)
    seen = {"in order": F.col("checked_text").isin("<record><a>1</a><b>2</b></record>", "<record><a>1</a></record>")}
    done = steps.internal_validation(seen, {"a": 0, "b": 1}).run(records, "E1")
    assert rows(done, "record_id", "exception") == [
        ("1", None), ("2", "malformed record"), ("3", "malformed record"), ("4", None)]
    assert physical(done).count("regexp_extract_all") == 1
