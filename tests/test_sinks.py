from __future__ import annotations

from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordflow import schema
from recordflow.sinks import upsert
from recordflow.sinks.bucketed import AppendTable, MergeTable
from recordflow.sinks.first_wins import insert_counts, rows_to_insert
from recordflow.sinks.tables import ChangeTable, ResultTable
from recordflow.sources.chunks import headers_after, resume_pending

COLUMNS = "dataset_id string, execution_id string, execution_name string, " \
          "record_id string, record_data string, exception string"


def result(spark, *items, execution="e1"):
    return spark.createDataFrame(
        [("d1", execution, "STEP", record, data, error) for record, data, error in items], COLUMNS)


def test_a_record_stored_twice_stays_as_it_was(spark, folder):
    table = ResultTable(spark, folder)
    table.insert(result(spark, ("r1", "<xml/>", None)), "e1")
    table.insert(result(spark, ("r1", "<changed/>", None), ("r2", "<xml/>", None)), "e1")
    assert rows(table.records("e1"), "record_id", "record_data") == [
        ("r1", "<xml/>"), ("r2", "<xml/>")]


def test_an_error_stored_twice_stays_as_it_was(spark, folder):
    table = ResultTable(spark, folder)
    table.insert(result(spark, ("r1", "", "NoSuchMethodError: one")), "e1")
    table.insert(result(spark, ("r1", "", "NoSuchMethodError: two")), "e1")
    assert rows(table.errors("e1"), "record_id", "exception") == [
        ("r1", "NoSuchMethodError: one")]
    assert table.records("e1").count() == 0


def test_an_empty_exception_is_still_an_error(spark, folder):
    table = ResultTable(spark, folder)
    table.insert(result(spark, ("r1", "", "")), "e1")
    assert table.records().count() == 0 and table.errors().count() == 1


def test_repeats_in_one_batch_are_counted(spark):
    incoming = result(spark, ("r1", "b", None), ("r1", "a", None), ("r2", "c", None))
    existing = result(spark, ("r2", "old", None))
    assert rows(rows_to_insert(incoming, existing, ["record_data"]), "record_id",
                "record_data") == [("r1", "a")]
    assert rows(insert_counts(incoming, existing), "inserted", "skipped") == [(1, 2)]


def test_executions_are_apart(spark, folder):
    table = ResultTable(spark, folder)
    for execution in ("e1", "e:2/x"):
        table.insert(result(spark, ("r1", execution, None), execution=execution), execution)
    assert rows(table.records("e1"), "record_data") == [("e1",)]
    assert rows(table.records("e:2/x", "d1"), "record_data") == [("e:2/x",)]
    assert table.written("e1") == 1
    assert table.records("none").count() == 0


def test_resume_heals_a_crash_between_the_two_writes(spark):
    source = result(spark, ("r1", "a", None), ("r2", "b", None), ("r3", "c", None))
    done = source.where("record_id = 'r1'")
    errors = source.where("record_id = 'r3'")
    assert rows(resume_pending(source, done, errors), "record_id") == [("r2",)]


def test_header_resume_wants_a_listed_identifier(spark):
    headers = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "identifier string, n int")
    assert rows(headers_after(headers, "a", ["n"])) == [("b", 2), ("c", 3)]
    with pytest.raises(Exception, match="last identifier not in the listing: z"):
        headers_after(headers, "z", ["n"]).collect()


def test_null_rules_of_the_upsert(spark):
    old = spark.createDataFrame([(1, "a", "b", 1)], "k int, x string, y string, version int")
    new = spark.createDataFrame([(1, None, "c", 2)], "k int, x string, y string, version int")
    assert rows(upsert.upsert(old, new, ["k"])) == [(1, None, "c", 2)]
    assert rows(upsert.upsert(old, new, ["k"], nulls="ignore")) == [(1, "a", "c", 2)]
    with pytest.raises(ValueError):
        upsert.upsert(old, new, ["k"], nulls="other")


def test_change_table_versions(spark, folder):
    table = ChangeTable(spark, folder, schema.TASK_INFO, ["task_id"])

    def write(version, *items, removed=False):
        table.write(spark.createDataFrame(items, schema.TASK_INFO), version, removed)

    assert table.state().count() == 0
    write(0, (1, 1, 10), (2, 1, 20))
    write(1, (1, 2, 15))
    write(1, (1, 2, 16))
    assert rows(table.state()) == [(1, 2, 16), (2, 1, 20)]
    assert rows(table.state(before=1)) == [(1, 1, 10), (2, 1, 20)]
    write(2, (2, 0, 0), removed=True)
    assert rows(table.state()) == [(1, 2, 16)]
    table.compact(1)
    assert rows(table.state()) == [(1, 2, 16)]
    assert rows(table.state(before=2)) == [(1, 2, 16), (2, 1, 20)]
    assert rows(table.state(before=1)) == [(1, 1, 10), (2, 1, 20)]
    write(3, (2, 9, 9))
    assert rows(table.state()) == [(1, 2, 16), (2, 9, 9)]


def test_a_row_of_the_driver_is_a_version_like_any_other(spark, folder):
    table = ChangeTable(spark, f"{folder}/a table", T.StructType.fromDDL("k bigint, n bigint"), ["k"])
    table.write(spark.createDataFrame([(1, 10), (2, 20)], "k bigint, n bigint"), 0)
    table.write_one({"k": 1, "n": 11}, 1)
    table.write_one({"k": 2, "n": None}, 2)
    assert rows(table.state()) == [(1, 11), (2, None)]
    table.write_one({"k": 1, "n": 12}, 0)  # in place of both rows
    table.write_one({"k": 2, "n": 21}, 2)
    table.write_one({"k": 2, "n": 21}, 2)
    assert rows(table.state()) == [(1, 11), (2, 21)]
    table.write_one({"k": 1, "n": None}, 3, removed=True)
    assert rows(table.state()) == [(2, 21)]
    (Path(folder) / "a table/changes/version=4").mkdir()
    (Path(folder) / "a table/changes/version=4/_part-00000").write_bytes(b"PAR1")  # the driver was lost as it wrote
    assert rows(table.state()) == [(2, 21)]
    table.write_one({"k": 3, "n": 30}, 4)
    assert rows(table.state()) == [(2, 21), (3, 30)]


def test_one_hot_record_is_inserted_once(spark):
    copies = spark.range(5000).select(
        F.lit("d1").alias("dataset_id"), F.lit("e1").alias("execution_id"),
        F.lit("S").alias("execution_name"), F.lit("r1").alias("record_id"),
        F.format_string("%05d", "id").alias("record_data"))
    none = copies.where("false")
    assert rows(rows_to_insert(copies, none, ["record_data"]), "record_data") == [("00000",)]


def test_blank_datasets_are_stored_once(spark, folder):
    from recordflow.sinks.tables import ResultTable

    table = ResultTable(spark, folder)
    results = spark.createDataFrame(
        [("", "e", "S", "r1", "x", None), (None, "e", "S", "r2", "y", None), ("d", "e", "S", "r1", "z", None), ("", "e", "S", "r3", "", "bad")],
        "dataset_id string, execution_id string, execution_name string, record_id string, record_data string, exception string")
    for _ in range(3):
        table.insert(results, "e")
    assert rows(table.records("e"), "dataset_id", "record_id") == [("d", "r1"), (None, "r1"), (None, "r2")]
    assert rows(table.errors("e"), "record_id", "exception") == [("r3", "bad")]


VALUES = "key string, a int, b string"


def test_a_merge_rewrites_the_buckets_it_touches(spark, folder):
    table = MergeTable(spark, folder, spark.createDataFrame([], VALUES).schema, ["key"], buckets=8)
    table.merge(spark.createDataFrame([(str(i), i, "old") for i in range(100)] + [(None, 0, "none")], VALUES), 0)
    change = spark.createDataFrame([("7", None, "new"), (None, 1, None), ("x", 5, "first"), ("x", 6, "second")], VALUES)
    touched = {r[0] for r in change.select(table._bucket().alias("b")).distinct().collect()}
    for _ in range(2):  # a version written again starts from what was there before it
        table.merge(change, 1)
        assert {p.name for p in Path(folder, "version=1").glob("bucket=*")} == {f"bucket={b}" for b in touched}
        state = {r.key: (r.a, r.b) for r in table.state().collect()}
        assert len(state) == 102 and state["7"] == (None, "new") and state[None] == (1, None) and state["x"] == (5, "first")
        assert state["8"] == (8, "old")
    table.merge(change, 2, upsert.IGNORE_NULLS)
    assert {r.key: (r.a, r.b) for r in table.state().collect()}[None] == (1, None)
    table.merge(spark.createDataFrame([("7", 70, None), (None, None, "late")], VALUES), 3, upsert.IGNORE_NULLS)
    state = {r.key: (r.a, r.b) for r in table.state().collect()}
    assert state["7"] == (70, "new") and state[None] == (1, "late")
    assert table.state(before=1).count() == 101
    table.merge(change.where("false"), 4)
    assert table.state().count() == 102


def test_a_merge_reads_only_its_buckets(spark, folder):
    table = MergeTable(spark, folder, spark.createDataFrame([], VALUES).schema, ["key"], buckets=8)
    table.merge(spark.createDataFrame([(str(i), i, "old") for i in range(100)], VALUES), 0)
    plan = table.state(1, [3])._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    read = {f.split("bucket=")[1].split("/")[0] for f in table.state(1, [3]).inputFiles()}
    assert len({r.key for r in table.state(1, [3]).collect()}) < 100 and "3" in read


def test_first_rows_stay_and_are_never_written_again(spark, folder):
    table = AppendTable(spark, folder, spark.createDataFrame([], VALUES).schema, ["key"], buckets=4)
    table.insert(spark.createDataFrame([("1", 1, "a"), ("1", 2, "b"), (None, 3, "c")], VALUES), 0)
    files = {p: p.stat().st_mtime_ns for p in Path(folder).rglob("*.parquet")}
    for _ in range(2):
        table.insert(spark.createDataFrame([("1", 9, "z"), (None, 9, "z"), ("2", 4, "d")], VALUES), 1)
    assert set(rows(table.state())) == {("1", 1, "a"), ("2", 4, "d"), (None, 3, "c")}
    assert all(p.stat().st_mtime_ns == t for p, t in files.items())
