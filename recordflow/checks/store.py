"""Scans, chunks, resuming, sinks and keyed state."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordflow import schema
from recordflow.checks.fragments import DOCUMENT_RECORDS, HEADERS, LABELLED, TURN_RECORDS, VALIDATED
from recordflow.checks.registry import query
from recordflow.checks.rules import validated
from recordflow.operators import progress, route
from recordflow.plans import bindings
from recordflow.session import new_work_folder
from recordflow.sinks import first_wins, upsert
from recordflow.sinks.bucketed import MergeTable
from recordflow.sinks.tables import ChangeTable, ResultTable
from recordflow.sources import chunks, landed, store

CHUNK = 7
RANGE = 2_000  # rows per range: small enough that the given tables need several

PLACED = f"""
SELECT *, row_number() OVER (PARTITION BY dataset_id, execution_id ORDER BY record_id)
       AS position FROM ({DOCUMENT_RECORDS})"""
CHUNKED = f"SELECT *, (position - 1) // {CHUNK} AS chunk_id FROM ({PLACED})"


@query("scan_execution", f"SELECT * EXCLUDE (lang) FROM ({DOCUMENT_RECORDS})")
def _(tables):
    records = bindings.union(bindings.document_records(tables), bindings.turn_records(tables))
    return store.scan_execution(records, bindings.HARVEST_ID)


@query("stored_records", f"SELECT * EXCLUDE (lang) FROM ({DOCUMENT_RECORDS})")
def _(tables):
    table = ResultTable(tables.spark, new_work_folder(tables.spark, "stored-records"))
    no_error = F.lit(None).cast("string").alias("exception")
    for records, execution in ((bindings.document_records(tables), bindings.HARVEST_ID),
                               (bindings.turn_records(tables), "E1"),
                               (bindings.document_records(tables), bindings.HARVEST_ID)):
        table.insert(records.select("*", no_error), execution)
    return table.records(bindings.HARVEST_ID)


@query("count_records", f"""
SELECT dataset_id, execution_id, count(*) AS record_count
FROM (SELECT dataset_id, execution_id FROM ({DOCUMENT_RECORDS})
      UNION ALL SELECT dataset_id, execution_id FROM ({TURN_RECORDS}))
GROUP BY 1, 2""")
def _(tables):
    return progress.count_per_execution(
        bindings.union(bindings.document_records(tables), bindings.turn_records(tables)))


@query("count_errors", f"""
SELECT dataset_id, execution_id, count(*) AS record_count
FROM ({VALIDATED}) WHERE exception IS NOT NULL GROUP BY 1, 2""")
def _(tables):
    return progress.count_per_execution(route.bad_records(validated(tables)))


@query("chunk_counts", f"""
SELECT dataset_id, execution_id, count(*) AS record_count,
       (count(*) + {CHUNK - 1}) // {CHUNK} AS chunk_count
FROM ({DOCUMENT_RECORDS}) GROUP BY 1, 2""")
def _(tables):
    return chunks.chunk_counts(bindings.document_records(tables), CHUNK)


@query("chunk_plan", f"""
SELECT dataset_id, execution_id, chunk_id, min(position) AS first_pos,
       max(position) AS last_pos, min(record_id) AS first_id, max(record_id) AS last_id,
       count(*) AS record_count
FROM ({CHUNKED}) GROUP BY 1, 2, 3""")
def _(tables):
    return chunks.chunk_plan(bindings.document_records(tables), CHUNK, RANGE)


@query("chunk_read", f"SELECT * EXCLUDE (lang) FROM ({CHUNKED})")
def _(tables):
    return chunks.with_chunk(bindings.document_records(tables), CHUNK, RANGE)


@query("chunk_status", """
SELECT task_id, count(*) AS started, count(CASE WHEN status = 'returned' THEN 1 END) AS returned,
       count(CASE WHEN status = 'executing' THEN 1 END) AS executing,
       count(*) - count(CASE WHEN status IN ('returned', 'executing') THEN 1 END) AS finished
FROM (SELECT user_id AS task_id, CASE event_type WHEN 'error' THEN 'returned'
        WHEN 'view' THEN 'executing' ELSE 'done' END AS status FROM events)
GROUP BY 1""")
def _(tables):
    return progress.chunk_status(tables.events.select(
        F.col("user_id").alias("task_id"),
        F.when(F.col("event_type") == "error", "returned")
        .when(F.col("event_type") == "view", "executing").otherwise("done").alias("status")),
        ["task_id"])


@query("resume_pending", f"""
SELECT source AS dataset_id, 'E0' AS execution_id, 'OAI_HARVEST' AS execution_name,
       CAST(doc_id AS VARCHAR) AS record_id, text AS record_data
FROM ({LABELLED}) WHERE quality = 0 AND toxic = 0""")
def _(tables):
    source = bindings.document_records(tables)
    keys = bindings.labelled(tables).select(
        F.col("source").alias("dataset_id"), F.col("doc_id").cast("string").alias("record_id"),
        "quality", "toxic")
    return chunks.resume_pending(source, keys.where("quality = 1"), keys.where("toxic = 1"))


@query("resume_offset", f"""
SELECT p.dataset_id, p.execution_id, p.execution_name, p.record_id, p.record_data, p.position
FROM ({PLACED}) p LEFT JOIN (
  SELECT source AS dataset_id, count(CASE WHEN quality = 1 THEN 1 END) AS write_count
  FROM ({LABELLED}) GROUP BY 1
) w USING (dataset_id)
WHERE p.position > coalesce(w.write_count, 0)""")
def _(tables):
    written = bindings.labelled(tables).groupBy(F.col("source").alias("dataset_id")).agg(
        F.count_if(F.col("quality") == 1).alias("write_count")).withColumn(
        "execution_id", F.lit(bindings.HARVEST_ID))
    return chunks.resume_from_offset(bindings.document_records(tables), written, RANGE)


@query("header_list", HEADERS)
def _(tables):
    folder = new_work_folder(tables.spark, "header-pages")
    bindings.headers(tables).select(
        F.when(F.col("deleted"), "deleted").alias("_status"), "identifier",
        F.date_format(F.convert_timezone(
            F.current_timezone(), F.lit("UTC"), F.col("datestamp").cast("timestamp_ntz")),
            "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("datestamp"),
    ).write.xml(folder, rowTag="header", rootTag="ListIdentifiers")
    listed = landed.read_headers(tables.spark, folder)
    return listed.select("identifier", "deleted", F.unix_seconds("datestamp").alias("listed_at"))


@query("header_resume", f"""
SELECT identifier, deleted, listed_at FROM ({HEADERS})
WHERE (listed_at, identifier) > (SELECT (listed_at, identifier) FROM ({HEADERS})
                                 WHERE deleted ORDER BY identifier LIMIT 1)""")
def _(tables):
    headers = bindings.headers(tables)
    last = headers.where("deleted").agg(F.min("identifier")).scalar()
    return chunks.headers_after(headers, last, ["datestamp", "identifier"]).select(
        "identifier", "deleted", F.unix_seconds("datestamp").alias("listed_at"))


FIRST_BATCH = f"""
SELECT source AS dataset_id, 'E1' AS execution_id, 'NORMALIZATION' AS execution_name,
       CAST(doc_id AS VARCHAR) AS record_id, 'first ' || text AS record_data
FROM ({LABELLED}) WHERE quality = 1"""
SECOND_BATCH = """
SELECT source AS dataset_id, 'E1' AS execution_id, 'NORMALIZATION' AS execution_name,
       CAST(doc_id AS VARCHAR) AS record_id, 'second ' || text AS record_data
FROM documents"""


def _batch(frame, word, column="record_data"):
    return frame.select(
        F.col("source").alias("dataset_id"), F.lit("E1").alias("execution_id"),
        F.lit(schema.NORMALIZATION).alias("execution_name"),
        F.col("doc_id").cast("string").alias("record_id"),
        F.concat(F.lit(word + " "), "text").alias(column))


def _two_batches(tables, column="record_data"):
    existing = _batch(bindings.labelled(tables).where("quality = 1"), "first", column)
    incoming = bindings.union(
        _batch(tables.documents, "third", column), _batch(tables.documents, "second", column))
    return incoming, existing


INSERTED = f"""
({FIRST_BATCH}) UNION ALL
SELECT * FROM ({SECOND_BATCH}) s WHERE NOT EXISTS (
  SELECT 1 FROM ({FIRST_BATCH}) f
  WHERE f.dataset_id = s.dataset_id AND f.record_id = s.record_id)"""


@query("idempotent_insert", INSERTED)
def _(tables):
    incoming, existing = _two_batches(tables)
    return first_wins.insert_first_wins(incoming, existing, ["record_data"])


@query("idempotent_error_insert",
       f"SELECT * RENAME (record_data AS exception) FROM ({INSERTED})")
def _(tables):
    incoming, existing = _two_batches(tables, "exception")
    return first_wins.insert_first_wins(incoming, existing, ["exception"])


@query("insert_counts", f"""
SELECT source AS dataset_id, 'E1' AS execution_id,
       count(CASE WHEN quality = 0 THEN 1 END) AS inserted,
       count(CASE WHEN quality = 0 THEN 1 END) + 2 * count(CASE WHEN quality = 1 THEN 1 END) AS skipped
FROM ({LABELLED}) GROUP BY 1""")
def _(tables):
    return first_wins.insert_counts(*_two_batches(tables))


@query("keyed_upsert", """
SELECT o_custkey AS task_id, arg_max(o_orderstatus, o_orderkey) AS status,
       arg_max(o_totalprice, o_orderkey) AS total, max(o_orderkey) AS version
FROM orders GROUP BY 1""")
def _(tables):
    rows = tables.orders.select(
        F.col("o_custkey").alias("task_id"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total"), F.col("o_orderkey").alias("version"))
    return upsert.upsert(rows.where("status = 'F'"), rows.where("status <> 'F'"), ["task_id"])


@query("upsert_ignore_nulls", """
SELECT user_id AS task_id,
       arg_max(event_id, event_id) FILTER (WHERE event_type = 'purchase') AS resource,
       arg_max(event_id, event_id) FILTER (WHERE event_type = 'click') AS result_resource,
       arg_max(props, event_id) FILTER (WHERE event_type = 'error') AS info_text,
       max(event_id) AS version
FROM events GROUP BY 1""")
def _(tables):
    kind = F.col("event_type")
    rows = tables.events.select(
        F.col("user_id").alias("task_id"),
        F.when(kind == "purchase", F.col("event_id")).alias("resource"),
        F.when(kind == "click", F.col("event_id")).alias("result_resource"),
        F.when(kind == "error", F.col("props")).alias("info_text"),
        F.col("event_id").alias("version"), "event_type")
    old, new = rows.where("event_type = 'click'"), rows.where("event_type <> 'click'")
    return upsert.upsert(old.drop("event_type"), new.drop("event_type"), ["task_id"],
                         nulls=upsert.IGNORE_NULLS)


RESULT_ROW = T.StructType([
    T.StructField("task_id", T.LongType()), T.StructField("resource", T.LongType()),
    T.StructField("result_resource", T.LongType()), T.StructField("info_text", T.StringType())])


def _result_rows(tables):
    """Result rows in three writes, by event: each names one of the columns, or none."""
    kind, event = F.col("event_type"), F.col("event_id")
    return tables.events.select(
        F.col("user_id").alias("task_id"), F.when(kind == "purchase", event).alias("resource"),
        F.when(kind == "click", event).alias("result_resource"), F.when(kind == "error", F.col("props")).alias("info_text"),
        "event_id", (event % 3).alias("turn"))


def _merged(tables, nulls):
    table = MergeTable(tables.spark, new_work_folder(tables.spark, "result-rows"), RESULT_ROW, ["task_id"])
    rows = _result_rows(tables)
    # one row a task and write: that of its last event; the last write comes again
    for version in (0, 1, 2, 2):
        latest = rows.where(F.col("turn") == version).groupBy("task_id").agg(
            F.max_by(F.struct("resource", "result_resource", "info_text"), "event_id").alias("r"))
        table.merge(latest.select("task_id", "r.*"), version, nulls)
    return table.state()


WRITES = """
WITH one AS (SELECT user_id AS task_id, event_id % 3 AS turn, max(event_id) AS event_id FROM events GROUP BY 1, 2),
row AS (SELECT one.*, CASE WHEN event_type = 'purchase' THEN event_id END AS resource,
               CASE WHEN event_type = 'click' THEN event_id END AS result_resource,
               CASE WHEN event_type = 'error' THEN props END AS info_text FROM one JOIN events USING (event_id))"""


@query("merge_save_nulls", f"""{WRITES}
SELECT task_id, arg_max_null(resource, turn) AS resource, arg_max_null(result_resource, turn) AS result_resource,
       arg_max_null(info_text, turn) AS info_text FROM row GROUP BY 1""")
def _(tables):
    return _merged(tables, upsert.SAVE_NULLS)


@query("merge_ignore_nulls", f"""{WRITES}
SELECT task_id, arg_max(resource, turn) FILTER (resource IS NOT NULL) AS resource,
       arg_max(result_resource, turn) FILTER (result_resource IS NOT NULL) AS result_resource,
       arg_max(info_text, turn) FILTER (info_text IS NOT NULL) AS info_text FROM row GROUP BY 1""")
def _(tables):
    return _merged(tables, upsert.IGNORE_NULLS)


@query("iteration_state", """
SELECT source AS dataset_id, 'E0' AS execution_id, CAST(count(*) AS INTEGER) AS emitted_count,
       printf('doc:%08d', max(doc_id)) AS last_identifier
FROM documents GROUP BY 1""")
def _(tables):
    table = ChangeTable(
        tables.spark, new_work_folder(tables.spark, "iteration-state"),
        schema.ITERATION_STATE, ["dataset_id", "execution_id"])
    first = bindings.labelled(tables).where("toxic = 0")
    for version, rows in enumerate((first, tables.documents, tables.documents)):
        table.write(rows.groupBy(F.col("source").alias("dataset_id")).agg(
            F.lit(bindings.HARVEST_ID).alias("execution_id"),
            F.count(F.lit(1)).cast("int").alias("emitted_count"),
            F.format_string("doc:%08d", F.max("doc_id")).alias("last_identifier"),
        ), version)
    return table.state()


@query("task_info_state", """
SELECT user_id AS task_id, coalesce(count(*) FILTER (WHERE event_type = 'purchase'), 0)
         AS commit_count,
       CAST(coalesce(sum(CAST(json_extract(props, '$.k') AS BIGINT))
            FILTER (WHERE event_type = 'purchase'), 0) AS BIGINT) AS write_count
FROM events GROUP BY 1""")
def _(tables):
    tasks = tables.events.select(F.col("user_id").alias("task_id")).withColumns(
        {"commit_count": F.lit(0).cast("bigint"), "write_count": F.lit(0).cast("bigint")})
    known = tasks.dropDuplicates(["task_id"])
    again = upsert.register_absent(known, tasks, "task_id")
    registered = known.unionByName(again).withColumn("version", F.lit(0))
    done = progress.progress_state(tables.events.where("event_type = 'purchase'").select(
        F.col("user_id").alias("task_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("written")))
    return upsert.upsert(registered, done.withColumn("version", F.lit(1)), ["task_id"]).drop(
        "version")


@query("task_progress_increments", """
SELECT user_id AS task_id, count(*) AS commit_count,
       CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS write_count
FROM events GROUP BY 1""")
def _(tables):
    return progress.progress_state(tables.events.select(
        F.col("user_id").alias("task_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("written")))
