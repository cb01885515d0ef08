"""Bad rows among good ones: what a job must neither stop at, nor lose, nor take for good."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordflow.checks.fragments import DOCUMENT_RECORDS, TASK_PARAMS
from recordflow.checks.registry import query
from recordflow.functions import text
from recordflow.operators import harvest
from recordflow.plans import bindings, steps
from recordflow.sources import chunks
from recordflow.sources.messages import parse_cancelled_ids
from recordflow.streaming.tasks import not_cancelled


@query("invalid_bytes_isolated", """
SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN text || chr(65533) || 'x' ELSE text END AS record_data
FROM documents""")
def _(tables):
    """Every fifth text ends in a byte that UTF-8 never has."""
    bad = F.concat(F.encode("text", "UTF-8"), F.unhex(F.lit("FF78")))
    content = F.when(F.col("doc_id") % 5 == 0, bad).otherwise(F.encode("text", "UTF-8"))
    return tables.documents.select("doc_id", text.utf8_text(content).alias("record_data"))


@query("cancel_non_numeric", """
SELECT user_id AS task_id, event_id FROM events
WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND event_id % 40 = 0)""")
def _(tables):
    """Cancellation lines hold words, numbers and blanks."""
    lines = tables.events.where("event_type = 'error' and event_id % 40 = 0").select(
        F.concat_ws(" ", "event_type", F.lit(""), F.col("user_id").cast("string"), F.lit("")).alias("value"))
    running = tables.events.select(F.col("user_id").alias("task_id"), "event_id")
    return not_cancelled(running, parse_cancelled_ids(lines))


@query("task_params_null_task", f"""
WITH message AS (SELECT CASE WHEN event_id % 7 > 0 THEN user_id END AS task_id, event_id FROM events)
SELECT task_id, event_id, provider_id,
       CASE WHEN provider_id IS NULL THEN 'no parameters for task ' || coalesce(task_id :: varchar, 'without an id') END
         AS exception
FROM message LEFT JOIN ({TASK_PARAMS}) USING (task_id)""")
def _(tables):
    sent = tables.events.select(
        F.when(F.col("event_id") % 7 > 0, F.col("user_id")).alias("task_id"), "event_id")
    return harvest.task_params_join(sent, bindings.task_params(tables)).select(
        "task_id", "event_id", "provider_id", "exception")


@query("read_one_chunk", f"""
SELECT dataset_id, record_id FROM (
  SELECT dataset_id, record_id, row_number() OVER (PARTITION BY dataset_id ORDER BY record_id) AS place
  FROM ({DOCUMENT_RECORDS}) WHERE dataset_id = 'src3') WHERE place BETWEEN 4 AND 6""")
def _(tables):
    """The second chunk of one of many datasets, whose ids lie among each other's."""
    records = bindings.document_records(tables)
    plan = chunks.chunk_plan(records, 3).where("dataset_id = 'src3' and chunk_id = 1")
    return chunks.read_chunks(records, plan).select("dataset_id", "record_id")


ODD = """'<record id="' || doc_id || '"><about>' || doc_id || '</about><title lang="' || lang
  || '">{0}</title><title>' || source || '</title><creator role="x"><name>  N  N</name></creator>'"""


@query("records_in_place", f"""
SELECT doc_id :: varchar AS record_id,
       CASE WHEN doc_id % 6 = 0 THEN '' ELSE {ODD.format("One &amp; two")} || '<link>u' || doc_id % 3 || '</link>'
         || CASE WHEN doc_id % 3 = 1 THEN '<resource>u1 image/png 5</resource><mainThumbnail>true</mainThumbnail>'
                 ELSE '<mainThumbnail>false</mainThumbnail>' END || '</record>' END AS record_data,
       CASE WHEN doc_id % 6 = 0 THEN 'malformed record' END AS exception
FROM documents""")
def _(tables):
    """Attributes, repeats, unknown and empty elements through normalization and media; every
    sixth record is cut off, between the two steps for every second of these."""
    body = F.concat(F.expr(ODD.format(" One  &amp; two ")), F.expr(
        "'<empty/><link>u' || doc_id % 3 || '</link><link> u' || doc_id % 3 || ' </link></record>'"))
    records = tables.documents.select(
        F.lit("d").alias("dataset_id"), F.col("doc_id").cast("string").alias("record_id"),
        F.when(F.col("doc_id") % 12 == 0, F.left(body, F.length(body) - 12)).otherwise(body).alias("record_data"))
    normal = steps.normalization().run(records, "E1")
    data, key = F.col("record_data"), F.col("record_id").cast("bigint")
    later = normal.withColumn("record_data", F.when(key % 6 == 0, F.left(data, F.length(data) - 5)).otherwise(data))
    metadata = tables.region.where("r_regionkey = 1").select(
        F.concat(F.lit("u"), F.col("r_regionkey").cast("string")).alias("resource"),
        F.lit("image/png").alias("mime"), F.lit(5).cast("bigint").alias("bytes"))
    return steps.media_step(metadata).run(later, "E2").select("record_id", "record_data", "exception")
