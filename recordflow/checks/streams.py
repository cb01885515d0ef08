"""Streams over the given tables; each must give what the batch form gives.

Rows are landed in three parts, in time order, and the query is started again after each
part, so every check also goes on from a checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordflow import schema
from recordflow.checks.fragments import ITEMS, MESSAGE_PARTS, TASK_PARAMS, VALIDATED
from recordflow.checks.progress import FLAGS, PROCESSED, RUNNING, _sums, counter_flags
from recordflow.checks.registry import query
from recordflow.checks.rules import external_rules
from recordflow.checks.store import RANGE
from recordflow.operators import validate
from recordflow.plans import bindings, message_job
from recordflow.operators.project import step_result
from recordflow.plans.steps import Step
from recordflow.session import new_work_folder
from recordflow.sinks.representations import Representations, Revisions
from recordflow.sinks.tables import ProgressLog, ResultTable
from recordflow.sources.messages import decode_messages
from recordflow.functions.prefix import positions
from recordflow.streaming import notifications, records, statistics, tasks
from recordflow.streaming.admission import admission_log, admitted, reader_of, readers_for
from recordflow.streaming.settings import checkpoint_settings, finish, finish_all, landed_stream, start


def land_in_parts(rows: DataFrame, by: str, folder: str) -> Sequence[Callable[[], None]]:
    """Three writers that together land all rows, in the order of the number ``by``."""
    first, second = rows.agg(F.percentile_approx(by, [0.33, 0.66])).first()[0]
    parts = (F.col(by) <= first, (F.col(by) > first) & (F.col(by) <= second), F.col(by) > second)
    return [lambda part=part: rows.where(part).write.mode("append").parquet(folder)
            for part in parts]


def run_in_parts(rows: DataFrame, by: str, folder: str, start: Callable) -> None:
    """Lands each part and runs ``start(stream)`` to its end after it."""
    for land in land_in_parts(rows, by, folder):
        land()
        finish(start(landed_stream(rows.sparkSession, folder, rows.schema)))


NEVER = 100 * 365 * 24 * 3600 * 1000


@query("stream_task_stats", f"""
SELECT task_id, count(CASE WHEN status = 'STOP' THEN 1 END) AS failed,
       count(CASE WHEN status <> 'STOP' THEN 1 END) AS succeeded
FROM ({ITEMS}) GROUP BY 1""")
def _(tables):
    work = new_work_folder(tables.spark, "stream-statistics")
    run_in_parts(
        bindings.notification_events(tables), "event_id", f"{work}/landed",
        lambda rows: statistics.start_statistics(
            # totals since the start: no state may expire meanwhile, however long a part takes
            statistics.task_statistics(rows, F.col("status"), ttl_ms=NEVER), f"{work}/statistics",
            f"{work}/checkpoint"))
    return tables.spark.read.parquet(f"{work}/statistics").groupBy("task_id").agg(
        F.max("failed").alias("failed"), F.max("succeeded").alias("succeeded"))


@query("stream_notification_running", f"""
SELECT *, {PROCESSED} AS resource_num
FROM (SELECT task_id, event_id, {_sums(RUNNING)} FROM ({FLAGS}))""")
def _(tables):
    work = new_work_folder(tables.spark, "stream-notifications")
    counters = notifications.counter_state(tables.spark, f"{work}/counters")
    run_in_parts(
        bindings.notification_events(tables), "event_id", f"{work}/landed",
        lambda rows: notifications.start_notifications(
            rows, counter_flags(), ["ts", "event_id"], counters, f"{work}/notifications",
            f"{work}/checkpoint", rows_per_range=RANGE))
    return tables.spark.read.parquet(f"{work}/notifications").select(
        "task_id", "event_id", *notifications.COUNTERS, "resource_num")


@query("stream_notification_totals", f"""
SELECT *, {PROCESSED} AS processed
FROM (SELECT task_id, {_sums('')} FROM ({FLAGS}) GROUP BY 1)""")
def _(tables):
    work = new_work_folder(tables.spark, "stream-totals")

    def start(rows):
        def write(batch, batch_id):
            batch.write.mode("overwrite").parquet(f"{work}/totals/batch_id={batch_id}")

        totals = notifications.running_totals(rows, counter_flags())
        return notifications.start(
            totals.writeStream.outputMode("update").foreachBatch(write), f"{work}/checkpoint")

    run_in_parts(bindings.notification_events(tables), "event_id", f"{work}/landed", start)
    written = tables.spark.read.parquet(f"{work}/totals")
    names = [*notifications.COUNTERS, "processed"]
    return written.groupBy("task_id").agg(*[F.max(n).alias(n) for n in names])


@query("stream_record_step", VALIDATED)
def _(tables):
    work = new_work_folder(tables.spark, "stream-step")
    results = ResultTable(tables.spark, work)
    progress = ProgressLog(tables.spark, f"{work}/progress")
    step = Step(schema.VALIDATION_EXTERNAL, lambda rows, execution_id: validate.validate(
        rows, schema.VALIDATION_EXTERNAL, external_rules(), execution_id))
    rows = bindings.document_records(tables, "lang", "doc_id")
    run_in_parts(rows, "doc_id", f"{work}/landed", lambda landed: records.start_step(
        landed, step, "E1", results, progress, 1, f"{work}/checkpoint"))
    none = F.lit(None).cast("string")
    return bindings.union(
        results.records("E1").withColumn("exception", none),
        results.errors("E1").select("*", F.lit("").alias("record_data")))


@query("stream_cancelled_tasks", """
WITH line AS (SELECT *, CAST(user_id AS VARCHAR) AS task_id FROM events
              WHERE event_type NOT IN ('error', 'view'))
SELECT task_id, event_type AS task_name, 'file' || event_id AS file_url,
       CAST(NULL AS VARCHAR) AS exception
FROM line WHERE user_id NOT IN (SELECT user_id FROM events GROUP BY 1 HAVING count(*) > 70)""")
def _(tables):
    work = new_work_folder(tables.spark, "stream-tasks")
    spark = tables.spark
    cancelled = tasks.cancelled_tasks(spark, f"{work}/cancelled")
    tables.events.groupBy("user_id").count().where("count > 70").select(
        F.col("user_id").cast("string").alias("value")).write.text(f"{work}/cancellations")
    finish(tasks.start_cancellations(
        spark.readStream.text(f"{work}/cancellations"), cancelled, f"{work}/checkpoint-cancel"))
    bindings.task_lines(tables).write.text(f"{work}/lines")
    files = tables.events.select(
        F.concat(F.lit("file"), F.col("event_id").cast("string")).alias("file_url"),
        F.col("props").alias("content"))
    finish(tasks.start_tasks(
        spark.readStream.text(f"{work}/lines"), lambda: files,
        lambda rows: rows.withColumn("status", F.lit("CONTINUE")), cancelled, f"{work}/tasks",
        f"{work}/checkpoint-tasks"))
    return spark.read.parquet(f"{work}/tasks").select(
        "task_id", "task_name", "file_url", "exception")


MESSAGE_RESULT = f"""
SELECT event_id, task_id, record_id AS resource, marked_as_deleted,
       CASE WHEN failed IS NULL AND NOT marked_as_deleted THEN new_url END AS result_resource,
       CASE WHEN failed IS NULL THEN
         CASE WHEN marked_as_deleted THEN record_id ELSE new_url END END AS revision_resource,
       coalesce(failed, '') AS info_text,
       CASE WHEN failed IS NULL THEN 'SUCCESS' ELSE 'ERROR' END AS state,
       CASE WHEN failed IS NULL AND NOT marked_as_deleted THEN hex(encode(event_type)) END
         AS file_content
FROM (
  SELECT m.*, representation_name AS event_type,
         CASE WHEN provider_id IS NULL THEN 'no parameters for task ' || m.task_id
              WHEN NOT marked_as_deleted AND representation_name = 'error' THEN 'no file' END
           AS failed,
         'http://repository.test/records/' || cloud_id || '/representations/'
           || new_representation_name || '/versions/'
           || sha256(sent_micros || '|' || record_id) AS new_url
  FROM ({MESSAGE_PARTS}) m LEFT JOIN ({TASK_PARAMS}) p ON p.task_id = m.task_id)"""


def _message_inputs(tables, decoded: DataFrame) -> message_job.Inputs:
    kind = F.regexp_extract("record_id", "/representations/([^/]+)", 1)
    content = decoded.select(
        F.col("record_id").alias("resource_url"),
        F.encode(F.concat(F.lit("  "), kind, F.lit(" \n"), kind), "UTF-8").alias("file_content"),
    ).where(kind != "error")
    return message_job.Inputs(bindings.task_params(tables), content, "http://repository.test")


MESSAGE_COLUMNS = ["event_id", "task_id", "resource", "marked_as_deleted", "result_resource",
                   "revision_resource", "info_text", "state", "file_content"]


@query("message_job", MESSAGE_RESULT)
def _(tables):
    decoded = decode_messages(bindings.raw_messages(tables), "event_id")
    return message_job.process(decoded, _message_inputs(tables, decoded), "event_id").select(
        *MESSAGE_COLUMNS).withColumn("file_content", F.hex("file_content"))


@query("stream_message_job", f"""
SELECT * EXCLUDE (ok), count(CASE WHEN ok THEN 1 END) OVER (PARTITION BY task_id ORDER BY event_id
                                          ROWS UNBOUNDED PRECEDING) AS resource_num
FROM (SELECT *, state = 'SUCCESS' AS ok FROM ({MESSAGE_RESULT}))""")
def _(tables):
    work = new_work_folder(tables.spark, "stream-messages")
    raw = bindings.raw_messages(tables).select("event_id", "value")
    inputs = _message_inputs(tables, decode_messages(raw))
    counters = notifications.counter_state(tables.spark, f"{work}/counters")
    run_in_parts(raw, "event_id", f"{work}/landed", lambda rows: message_job.start_messages(
        decode_messages(rows, "event_id"), inputs, ["event_id"], counters,
        f"{work}/notifications", f"{work}/checkpoint", rows_per_range=RANGE))
    return tables.spark.read.parquet(f"{work}/notifications").select(
        *MESSAGE_COLUMNS, "resource_num").withColumn("file_content", F.hex("file_content"))


@query("stream_null_task", f"""
SELECT *, {PROCESSED} AS resource_num
FROM (SELECT task_id, event_id, {_sums(RUNNING)} FROM (SELECT * REPLACE (CASE WHEN event_id % 3 > 0 THEN task_id % 7 END AS task_id) FROM ({FLAGS})))""")
def _(tables):
    """Every third row belongs to no task; its counters go on from batch to batch like any other's."""
    work = new_work_folder(tables.spark, "stream-null-task")
    counters = notifications.counter_state(tables.spark, f"{work}/counters")
    rows = bindings.notification_events(tables).withColumn(
        "task_id", F.when(F.col("event_id") % 3 > 0, F.col("task_id") % 7))
    run_in_parts(
        rows, "event_id", f"{work}/landed",
        lambda landed: notifications.start_notifications(
            landed, counter_flags(), ["ts", "event_id"], counters, f"{work}/notifications",
            f"{work}/checkpoint", rows_per_range=RANGE))
    return tables.spark.read.parquet(f"{work}/notifications").select(
        "task_id", "event_id", *notifications.COUNTERS, "resource_num")


@query("stream_insert_repeats", """
WITH again AS (SELECT doc_id % 400 AS record_id, min(doc_id) AS first, count(*) AS n FROM documents GROUP BY 1)
SELECT 'stored' AS what, count(*) AS n FROM again UNION ALL SELECT 'repeated', sum(n) - count(*) FROM again
UNION ALL SELECT 'firsts', sum(first) FROM again""")
def _(tables):
    """Keys that come again in later batches are counted and not stored; what came first stays."""
    work = new_work_folder(tables.spark, "stream-repeats")
    results, progress = ResultTable(tables.spark, work), ProgressLog(tables.spark, f"{work}/progress")
    step = Step(schema.MEDIA, lambda rows, execution_id: step_result(
        rows, execution_id, schema.MEDIA, F.col("record_data")))
    rows = tables.documents.select(
        F.lit("d").alias("dataset_id"), (F.col("doc_id") % 400).cast("string").alias("record_id"),
        F.col("doc_id").cast("string").alias("record_data"), "doc_id")
    # the first 400 ids hold every key once, the next ones again, the third part many times
    for part in ("doc_id < 400", "doc_id >= 400 and doc_id < 800", "doc_id >= 800"):
        rows.where(part).write.mode("append").parquet(f"{work}/landed")
        finish(records.start_step(
            landed_stream(tables.spark, f"{work}/landed", rows.schema), step, "E1", results, progress, 3, f"{work}/checkpoint"))
    first = results.records("E1").select(F.col("record_data").cast("bigint").alias("first"))
    return bindings.union(
        first.agg(F.count("*").alias("n")).select(F.lit("stored").alias("what"), "n"),
        progress.repeats().select(F.lit("repeated").alias("what"), F.col("repeated").alias("n")),
        first.agg(F.sum("first").alias("n")).select(F.lit("firsts").alias("what"), "n"))


@query("stream_admission", """
SELECT 'batches' AS what, CASE WHEN count(*) = 0 THEN 0 ELSE ceil(ceil(count(*) / 200) / 2) :: bigint END AS n FROM events
UNION ALL SELECT 'rows', count(*) FROM events
UNION ALL SELECT 'batches over the limit', 0""")
def _(tables):
    """Rows are landed 200 a file, a micro-batch may hold 400 at most; what waits is read by later ones."""
    work = new_work_folder(tables.spark, "stream-admission")
    readers = readers_for(tables.events.count(), rows=400, rows_per_file=200)
    ordered = tables.events.select("event_id", "user_id").withColumn("of", F.lit(0))
    placed = positions(ordered, ["of"], ["event_id"], rows_per_range=RANGE).withColumn(
        "part", F.floor((F.col("position") - 1) / 200)).withColumn(
        "reader", reader_of(F.col("part"), max(1, readers), rows=400, rows_per_file=200))
    # one file a part: what lands is cut to the size that admission counts by, and all parts of a reader lie in one folder
    placed.repartition("part").sortWithinPartitions("reader", "part").select("event_id", "user_id", "part", "reader").write.option(
        "maxRecordsPerFile", 200).partitionBy("reader").parquet(f"{work}/landed")
    schema_ = "event_id bigint, user_id bigint, part bigint"
    logs = [admission_log(tables.spark, f"{work}/admitted/{reader}") for reader in range(max(1, readers))]

    def start_reader(reader):
        def write(batch, batch_id):
            logs[reader].add(batch_id, batch, limit=400)

        rows = admitted(tables.spark, f"{work}/landed/reader={reader}", schema_, rows=400, rows_per_file=200)
        return start(rows.writeStream.foreachBatch(write), f"{work}/checkpoint/{reader}")

    with checkpoint_settings(tables.spark, work):
        finish_all(partial(start_reader, reader) for reader in range(readers))
    taken = bindings.union(*[log.state() for log in logs]).agg(
        F.count("*").alias("batches"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.count_if(F.col("rows") > F.col("most")).alias("over"))
    return taken.selectExpr("stack(3, 'batches', batches, 'rows', rows, 'batches over the limit', over) AS (what, n)")


@query("stream_representations", f"""
SELECT regexp_extract(resource, '/records/([^/?#]+)', 1) AS cloud_id, result_resource AS url, file_content
FROM ({MESSAGE_RESULT}) WHERE result_resource IS NOT NULL
UNION ALL SELECT 'deleted ' || marked_as_deleted, revision_resource, NULL FROM ({MESSAGE_RESULT}) WHERE revision_resource IS NOT NULL""")
def _(tables):
    """The job's representations and revisions as tables, after a stream in three parts."""
    work = new_work_folder(tables.spark, "stream-representations")
    raw = bindings.raw_messages(tables).select("event_id", "value")
    inputs = _message_inputs(tables, decode_messages(raw))
    counters = notifications.counter_state(tables.spark, f"{work}/counters")
    files, revisions = Representations(tables.spark, work), Revisions(tables.spark, work)
    run_in_parts(raw, "event_id", f"{work}/landed", lambda rows: message_job.start_messages(
        decode_messages(rows, "event_id"), inputs, ["event_id"], counters, f"{work}/notifications",
        f"{work}/checkpoint", rows_per_range=RANGE, representations=files, revisions=revisions))
    url = F.concat(F.lit("http://repository.test/records/"), "cloud_id", F.lit("/representations/"), "representation_name",
                   F.lit("/versions/"), "version")
    return bindings.union(
        files.state().select("cloud_id", url.alias("url"), F.hex("file_content").alias("file_content")),
        revisions.rows().select(
            F.concat(F.lit("deleted "), F.col("deleted").cast("string")).alias("cloud_id"), F.col("resource").alias("url"),
            F.lit(None).cast("string").alias("file_content")))
