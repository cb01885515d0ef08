"""Restart, replay, expiry and cancellation."""

from __future__ import annotations

import threading
import time
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from recordflow import schema
from recordflow.checks import streams
from recordflow.checks.registry import QUERIES
from recordflow.operators import progress
from recordflow.operators.project import step_result
from recordflow.plans.steps import Step
from recordflow.sinks.tables import ProgressLog, ResultTable
from recordflow.streaming import admission, notifications, records, settings, statistics, tasks
from recordflow.streaming.settings import finish, finish_all, landed_stream, start, state_settings

SECONDS = 300
TASKS = "task_id bigint, id bigint, status string"


def land(spark, folder, items, columns):
    spark.createDataFrame(items, columns).coalesce(1).write.mode("append").parquet(folder)


def upper_step():
    return Step(schema.MEDIA, lambda frame, execution_id: step_result(
        frame, execution_id, schema.MEDIA, F.upper("record_data"),
        F.when(F.col("record_data") == "bad", F.lit("bad data"))))


def record(i, data):
    return ("d1", "e0", "S", i, data)


def test_step_goes_on_after_a_crash_in_its_commit(spark, folder):
    results, log = ResultTable(spark, folder), ProgressLog(spark, f"{folder}/progress")
    broken = ProgressLog(spark, f"{folder}/progress")

    def fail(*_):
        raise RuntimeError("executor host is gone")

    broken.add = fail

    def run(progress_log):
        stream = landed_stream(spark, f"{folder}/landed", schema.EXECUTION_RECORD, max_files=1)
        finish(records.start_step(stream, upper_step(), "e1", results, progress_log, 5,
                                  f"{folder}/checkpoint"), SECONDS)

    land(spark, f"{folder}/landed", [record("1", "a"), record("2", "bad")], schema.EXECUTION_RECORD)
    with pytest.raises(Exception, match="executor host is gone"):
        run(broken)
    assert results.written("e1") == 2 and log.find(5) == (0, 0)
    land(spark, f"{folder}/landed", [record("3", "c"), record("1", "late")], schema.EXECUTION_RECORD)
    run(log)
    run(log)
    assert rows(results.records("e1"), "record_id", "record_data") == [("1", "A"), ("3", "C")]
    assert rows(results.errors("e1"), "record_id", "exception") == [("2", "bad data")]
    assert log.find(5) == (2, 3) and rows(log.repeats()) == [(5, 1)]  # of four rows read, one came again


def test_trigger_bounds_the_batch(spark, folder):
    for i in range(3):
        land(spark, f"{folder}/landed", [record(str(i), "a")], schema.EXECUTION_RECORD)
    results, log = ResultTable(spark, folder), ProgressLog(spark, f"{folder}/progress")
    stream = landed_stream(spark, f"{folder}/landed", schema.EXECUTION_RECORD, max_files=1)
    finish(records.start_step(stream, upper_step(), "e1", results, log, 5,
                              f"{folder}/checkpoint"), SECONDS)
    assert log.find(5) == (3, 3)


def flags():
    return progress.counter_flags(F.col("deleted"), F.lit(False), F.col("failed"))


def test_a_notification_batch_run_again_changes_nothing(spark, folder):
    columns = "task_id bigint, id bigint, deleted boolean, failed boolean"
    first = spark.createDataFrame([(1, 1, False, False), (1, 2, True, False)], columns)
    second = spark.createDataFrame([(1, 3, False, True), (2, 4, False, False),
                                    (1, 5, False, False)], columns)
    counters = notifications.counter_state(spark, f"{folder}/counters")
    for batch_id, batch in ((0, first), (1, second), (1, second)):
        notifications.write_batch(batch, batch_id, flags(), ["id"], counters, f"{folder}/out",
                                  compact_every=1)
    out = spark.read.parquet(f"{folder}/out")
    assert rows(out, "task_id", "id", "resource_num") == [
        (1, 1, 1), (1, 2, 2), (1, 3, 2), (1, 5, 3), (2, 4, 1)]
    assert rows(counters.state(), "task_id", "processed_records", "deleted_records",
                "processed_errors") == [(1, 2, 1, 1), (2, 1, 0, 0)]


def run_statistics(spark, folder, ttl_ms, **options):
    stream = landed_stream(
        spark, f"{folder}/landed", spark.createDataFrame([], TASKS).schema, max_files=1)
    finish(statistics.start_statistics(
        statistics.task_statistics(stream, F.col("status"), ttl_ms, **options),
        f"{folder}/statistics", f"{folder}/checkpoint"), SECONDS)


def test_statistics_expire(spark, folder):
    land(spark, f"{folder}/landed", [(1, 1, "STOP"), (1, 2, "CONTINUE")], TASKS)
    run_statistics(spark, folder, 3000)
    time.sleep(4)
    land(spark, f"{folder}/landed", [(1, 3, "CONTINUE")], TASKS)
    run_statistics(spark, folder, 3000)
    out = spark.read.parquet(f"{folder}/statistics")
    assert rows(out, "batch_id", "failed", "succeeded") == [(0, 1, 1), (1, 0, 1)]


def test_statistics_live_on_and_come_per_row(spark, folder):
    land(spark, f"{folder}/landed", [(1, 1, "STOP"), (1, 2, "CONTINUE")], TASKS)
    land(spark, f"{folder}/landed", [(1, 3, "CONTINUE"), (2, 4, "STOP")], TASKS)
    run_statistics(spark, folder, 600_000, each_row=True)
    out = spark.read.parquet(f"{folder}/statistics").withColumn(
        "n", F.col("failed") + F.col("succeeded"))
    assert rows(out, "task_id", "n") == [(1, 1), (1, 2), (1, 3), (2, 1)]
    assert out.where("task_id = 1 and n = 3").first()["failed"] == 1


def test_cancelled_tasks_are_read_for_each_batch(spark, folder):
    Path(folder, "lines").mkdir()
    Path(folder, "cancel").mkdir()
    cancelled = tasks.cancelled_tasks(spark, f"{folder}/cancelled")
    files = spark.createDataFrame([("f1", "one")], "file_url string, content string")

    def run():
        finish(tasks.start_cancellations(
            spark.readStream.text(f"{folder}/cancel"), cancelled, f"{folder}/c1"), SECONDS)
        finish(tasks.start_tasks(
            spark.readStream.text(f"{folder}/lines"), lambda: files,
            lambda frame: frame.withColumn("status", F.lit("CONTINUE")), cancelled,
            f"{folder}/out", f"{folder}/c2"), SECONDS)
        return rows(spark.read.parquet(f"{folder}/out"), "task_id", "task_name", "content")

    Path(folder, "lines", "1.txt").write_text("1 a f1\n2 b f1\nnot a task line\n")
    assert run() == [("1", "a", "one"), ("2", "b", "one")]
    Path(folder, "cancel", "1.txt").write_text("2 9\n")
    Path(folder, "lines", "2.txt").write_text("1 c f1\n2 d f1\n")
    assert run() == [("1", "a", "one"), ("1", "c", "one"), ("2", "b", "one")]


def test_print_sink_ends_with_what_has_landed(spark, folder):
    land(spark, f"{folder}/landed", [(1, 1, "STOP")], TASKS)
    stream = landed_stream(
        spark, f"{folder}/landed", spark.createDataFrame([], TASKS).schema)
    query = statistics.start_print(stream, f"{folder}/checkpoint")
    finish(query, SECONDS)
    assert query.lastProgress["numInputRows"] == 1


def test_settings_of_a_stateful_query_do_not_stay(spark):
    key = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(key)
    with state_settings(spark):
        assert spark.conf.get(key) == "false"
    assert spark.conf.get(key) == before


def test_checkpoints_on_a_local_disk_start_few_processes(spark, folder):
    key, before = settings.CHECKPOINT_MANAGER, spark.conf.get(settings.CHECKPOINT_MANAGER, None)
    land(spark, f"{folder}/landed", [(1, 1, "STOP")], TASKS)
    stream = landed_stream(spark, f"{folder}/landed", spark.createDataFrame([], TASKS).schema)
    for _ in range(2):  # goes on from its own checkpoint, and from one of the other manager's
        seen = []
        with settings.checkpoint_settings(spark, folder):
            assert spark.conf.get(key) == settings.LOCAL_MANAGER
            finish(start(stream.writeStream.foreachBatch(lambda rows, _: seen.append(rows.count())), f"{folder}/checkpoint"), SECONDS)
        assert spark.conf.get(key, None) == before
        land(spark, f"{folder}/landed", [(2, 2, "STOP")], TASKS)
        finish(start(stream.writeStream.foreachBatch(lambda rows, _: seen.append(rows.count())), f"{folder}/checkpoint"), SECONDS)
        land(spark, f"{folder}/landed", [(3, 3, "STOP")], TASKS)
        assert seen == [1, 1]
    spark.conf.set(key, "a.manager.of.its.own")
    try:
        with settings.checkpoint_settings(spark, folder):
            assert spark.conf.get(key) == "a.manager.of.its.own"
    finally:
        spark.conf.unset(key)


def batches_of(files, rows_per_file, rows):
    """How many batches a reader needs for so many files."""
    return -(-files // max(1, rows // rows_per_file))


@pytest.mark.parametrize("files", [1, 2, 5, 16, 17, 99])
@pytest.mark.parametrize("rows_per_file, limit", [(200, 400), (200, 100), (7, 50)])
def test_files_are_dealt_to_readers_by_the_batch(spark, files, rows_per_file, limit):
    readers = admission.readers_for(files * rows_per_file, limit, rows_per_file)
    dealt = spark.range(files).groupBy(
        admission.reader_of(F.col("id"), readers, limit, rows_per_file).alias("reader")).count()
    of_each = [n for _, n in rows(dealt)]
    assert len(of_each) == readers == min(admission.READERS, batches_of(files, rows_per_file, limit))
    assert sum(batches_of(n, rows_per_file, limit) for n in of_each) == batches_of(files, rows_per_file, limit)


def test_bounded_queries_run_side_by_side_and_stop_together(spark, folder):
    land(spark, f"{folder}/landed", [(1, 1, "STOP")], TASKS)
    both = threading.Barrier(2)

    def starting(name, write):
        stream = landed_stream(spark, f"{folder}/landed", spark.createDataFrame([], TASKS).schema)
        return lambda: start(stream.writeStream.foreachBatch(write), f"{folder}/{name}", name)

    finish_all([starting(name, lambda batch, batch_id: both.wait(SECONDS) and None) for name in ("one", "two")], SECONDS)

    def fail(*_):
        raise RuntimeError("no more room")

    with pytest.raises(Exception, match="no more room"):
        finish_all([starting("bad", fail), starting("slow", lambda batch, batch_id: time.sleep(20))], SECONDS)
    assert spark.streams.active == []


@pytest.mark.parametrize("landing, batches", [(0, 0), (1, 1), (1700, 5)])
def test_admission_takes_batches_up_side_by_side(spark, folder, monkeypatch, landing, batches):
    checkpoints = []

    def noted(writer, checkpoint):
        checkpoints.append(checkpoint)
        return start(writer, checkpoint)

    monkeypatch.setattr(streams, "start", noted)
    spark.range(landing).select(F.col("id").alias("event_id"), F.col("id").alias("user_id")).write.parquet(f"{folder}/events.parquet")
    assert rows(QUERIES["stream_admission"](spark, folder)) == [
        ("batches over the limit", 0), ("batches", batches), ("rows", landing)]
    assert len(set(checkpoints)) == batches


@pytest.mark.parametrize("limit, tasks", [(400, {1}), (admission.ONE_TASK + 1, {1, 3})])
def test_a_small_batch_is_counted_by_one_task(spark, folder, limit, tasks):
    log, context = admission.admission_log(spark, folder), spark.sparkContext
    group = f"counted {limit}"
    context.setJobGroup(group, group)
    log.add(0, spark.range(0, 300, 1, 3), limit)
    context.setLocalProperty("spark.jobGroup.id", None)
    status = context.statusTracker()
    stages = [stage for job in status.getJobIdsForGroup(group) for stage in status.getJobInfo(job).stageIds]
    assert {status.getStageInfo(stage).numTasks for stage in stages} == tasks
    assert len(stages) == 1 or limit > admission.ONE_TASK
    assert rows(log.state()) == [(0, 300, limit)]


def test_admission_holds_the_checkpoint_settings(spark, folder, monkeypatch):
    managers = []

    def noted(writer, checkpoint):
        managers.append(spark.conf.get(settings.CHECKPOINT_MANAGER, None))
        return start(writer, checkpoint)

    monkeypatch.setattr(streams, "start", noted)
    spark.range(500).select(F.col("id").alias("event_id"), F.col("id").alias("user_id")).write.parquet(f"{folder}/events.parquet")
    assert rows(QUERIES["stream_admission"](spark, folder), "what", "n")[1:] == [("batches", 2), ("rows", 500)]
    assert managers == [settings.LOCAL_MANAGER] * 2
