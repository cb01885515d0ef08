"""Counters, running values and progress."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordflow.checks.fragments import ITEMS
from recordflow.checks.registry import query
from recordflow.checks.store import RANGE
from recordflow.operators import progress
from recordflow.plans import bindings

FLAGS = """
SELECT *, CAST(NOT failed AND NOT deleted AND NOT ignored AS INTEGER) AS processed_flag,
       CAST(NOT failed AND NOT deleted AND ignored AS INTEGER) AS ignored_flag,
       CAST(NOT failed AND deleted AS INTEGER) AS deleted_flag,
       CAST(failed AND NOT deleted AS INTEGER) AS error_flag,
       CAST(failed AND deleted AS INTEGER) AS deleted_error_flag
FROM (""" + ITEMS + ")"


def _sums(over: str) -> str:
    pairs = (("processed_flag", "processed_records"), ("ignored_flag", "ignored_records"),
             ("deleted_flag", "deleted_records"), ("error_flag", "processed_errors"),
             ("deleted_error_flag", "deleted_errors"))
    return ", ".join(f"CAST(sum({flag}) {over} AS BIGINT) AS {name}" for flag, name in pairs)


PROCESSED = "processed_records + ignored_records + deleted_records"
RUNNING = "OVER (PARTITION BY task_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"


def counter_flags():
    return progress.counter_flags(F.col("deleted"), F.col("ignored"), F.col("failed"))


@query("notification_totals", f"""
SELECT *, {PROCESSED} AS processed
FROM (SELECT task_id, {_sums('')} FROM ({FLAGS}) GROUP BY 1)""")
def _(tables):
    return progress.counter_totals(bindings.notification_events(tables), counter_flags())


@query("notification_running", f"""
SELECT *, {PROCESSED} AS resource_num
FROM (SELECT task_id, event_id, {_sums(RUNNING)} FROM ({FLAGS}))""")
def _(tables):
    return progress.running_counters(
        bindings.notification_events(tables), counter_flags(), ["ts", "event_id"],
        rows_per_range=RANGE).select(
        "task_id", "event_id", *progress.COUNTERS, "resource_num")


@query("task_stats_totals", f"""
SELECT task_id, count(CASE WHEN status = 'STOP' THEN 1 END) AS failed,
       count(CASE WHEN status <> 'STOP' THEN 1 END) AS succeeded
FROM ({ITEMS}) GROUP BY 1""")
def _(tables):
    return progress.task_statistics(bindings.notification_events(tables), F.col("status"))


@query("task_stats_running", f"""
SELECT task_id, event_id, count(CASE WHEN status = 'STOP' THEN 1 END) {RUNNING} AS failed,
       count(CASE WHEN status <> 'STOP' THEN 1 END) {RUNNING} AS succeeded
FROM ({ITEMS})""")
def _(tables):
    return progress.running_task_statistics(
        bindings.notification_events(tables), F.col("status"), ["ts", "event_id"],
        rows_per_range=RANGE).select("task_id", "event_id", "failed", "succeeded")


SNAPSHOTS = """
SELECT user_id AS split_id, event_id AS checkpoint_id,
       CAST(json_extract(props, '$.k') AS BIGINT) AS emitted_count FROM events"""
DELTA = f"""
SELECT *, emitted_count - coalesce(lag(emitted_count) OVER (
  PARTITION BY split_id ORDER BY checkpoint_id), 0) AS increase FROM ({SNAPSHOTS})"""


def _snapshots(tables):
    return tables.events.select(
        F.col("user_id").alias("split_id"), F.col("event_id").alias("checkpoint_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("emitted_count"))


@query("progress_delta", DELTA)
def _(tables):
    return progress.progress_delta(_snapshots(tables), ["checkpoint_id"], rows_per_range=RANGE)


@query("progress_violations", f"SELECT * FROM ({DELTA}) WHERE increase < 0")
def _(tables):
    return progress.progress_violations(
        _snapshots(tables), ["checkpoint_id"], rows_per_range=RANGE)


@query("progress_asof", """
SELECT c.task_id, c.event_id, s.finished_count
FROM (SELECT user_id AS task_id, ts, event_id FROM events WHERE event_type = 'view') c
ASOF LEFT JOIN (
  SELECT user_id AS task_id, ts, CAST(json_extract(props, '$.k') AS BIGINT) AS finished_count
  FROM events WHERE event_type <> 'view') s
ON c.task_id = s.task_id AND c.ts >= s.ts""")
def _(tables):
    rows = tables.events.select(
        F.col("user_id").alias("task_id"), "ts", "event_id", "event_type",
        F.get_json_object("props", "$.k").cast("bigint").alias("finished_count"))
    return progress.progress_asof(
        rows.where("event_type = 'view'"), rows.where("event_type <> 'view'"),
        "task_id", "ts", "event_id", "finished_count", RANGE,
    ).select("task_id", "event_id", "finished_count")
