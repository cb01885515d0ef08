"""Media and index."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordflow.checks.fragments import (
    PAGE_RECORDS,
    RESOURCE_METADATA,
    TIERS,
    TURN_RECORDS,
    looked_up_links,
)
from recordflow.checks.registry import query
from recordflow.operators import index, media
from recordflow.params import PUBLISH
from recordflow.plans import bindings


def _media(tables):
    return bindings.page_records(tables), bindings.page_links(), bindings.resource_metadata(tables)


@query("media_main", f"""
SELECT dataset_id, record_id, resource, mime, bytes, m.resource IS NOT NULL
         AS has_main_thumbnail
FROM (SELECT *, regexp_extract(record_data, '<a href="([^"]*)"', 1) AS resource
      FROM ({PAGE_RECORDS})) LEFT JOIN ({RESOURCE_METADATA}) m USING (resource)""")
def _(tables):
    return media.main_resources(*_media(tables))


@query("media_resources", f"""
SELECT o.dataset_id, o.record_id, CAST(o.place AS INTEGER) AS place, o.resource, o.mime,
       o.bytes, o.extracted, m.extracted AS has_main_thumbnail
FROM ({looked_up_links()}) o JOIN ({looked_up_links()}) m
  ON m.dataset_id = o.dataset_id AND m.record_id = o.record_id AND m.place = 0
WHERE o.place > 0""")
def _(tables):
    return media.media_resources(*_media(tables))


@query("media_totals", f"SELECT * EXCLUDE (tier) FROM ({TIERS})")
def _(tables):
    return media.media_totals(*_media(tables))


@query("media_enriched", f"""
SELECT dataset_id, 'E6' AS execution_id, 'MEDIA' AS execution_name, record_id,
       record_data || coalesce(facts, '') AS record_data, CAST(NULL AS VARCHAR) AS exception
FROM ({PAGE_RECORDS}) LEFT JOIN (
  SELECT dataset_id, record_id,
         string_agg('<!-- ' || resource || ' ' || mime || ' ' || bytes || ' -->', ''
                    ORDER BY place) FILTER (WHERE extracted) AS facts
  FROM ({looked_up_links()}) GROUP BY 1, 2) USING (dataset_id, record_id)""")
def _(tables):
    facts = F.transform(
        F.filter("resources", lambda r: r["extracted"]),
        lambda r: F.concat(F.lit("<!-- "), r["resource"], F.lit(" "), r["mime"], F.lit(" "),
                           r["bytes"].cast("string"), F.lit(" -->")))
    return media.enrich_media(
        *_media(tables), F.concat("record_data", F.array_join(facts, "")), "E6")


def _tier():
    return index.media_tier(F.col("extracted"), F.col("has_main_thumbnail"))


def tiered(tables):
    """Pages with their tier."""
    totals = media.media_totals(*_media(tables)).withColumn("tier", _tier())
    return bindings.page_records(tables).join(
        totals.select("dataset_id", "record_id", "tier"), ["dataset_id", "record_id"])


@query("index_tier", f"SELECT dataset_id, record_id, tier FROM ({TIERS})")
def _(tables):
    return media.media_totals(*_media(tables)).select(
        "dataset_id", "record_id", _tier().alias("tier"))


@query("index_publishable", f"""
SELECT dataset_id, 'E8' AS execution_id, 'INDEXING' AS execution_name, record_id,
       CASE WHEN tier = 'T0' THEN '' ELSE record_data END AS record_data,
       CASE WHEN tier = 'T0' THEN 'Record deleted from database PUBLISH, cause it was in '
            || 'media tier 0! Id: ' || record_id END AS exception
FROM ({PAGE_RECORDS}) JOIN ({TIERS}) USING (dataset_id, record_id)""")
def _(tables):
    return index.index_step(tiered(tables), F.col("tier"), PUBLISH, "E8")


@query("index_upsert", f"""
SELECT record_id, 'new ' || record_data AS record_data, 2 AS version FROM ({TURN_RECORDS})
UNION ALL
SELECT CAST(page_id AS VARCHAR), CASE WHEN contains(url, '?') THEN 'new ' ELSE 'old ' END || html,
       CASE WHEN contains(url, '?') THEN 2 ELSE 1 END FROM pages""")
def _(tables):
    def rows(frame, word, version):
        return frame.select(
            "record_id", F.concat(F.lit(word + " "), "record_data").alias("record_data"),
            F.lit(version).alias("version"))

    pages = bindings.page_records(tables)
    changed = tables.pages.where("contains(url, '?')").select(
        F.col("page_id").cast("string").alias("record_id"), F.col("html").alias("record_data"))
    return index.index_upsert(
        rows(pages, "old", 1),
        bindings.union(rows(changed, "new", 2), rows(bindings.turn_records(tables), "new", 2)))


@query("index_remove", f"""
SELECT dataset_id, record_id, record_data
FROM ({PAGE_RECORDS}) JOIN ({TIERS}) USING (dataset_id, record_id) WHERE tier <> 'T0'""")
def _(tables):
    refused = media.media_totals(*_media(tables)).where(_tier() == "T0")
    return index.index_remove(bindings.page_records(tables), refused).select(
        "dataset_id", "record_id", "record_data")


@query("index_redirects", """
SELECT '/' || o.source || '/' || o.doc_id AS old_id, n.new_id
FROM documents o JOIN (
  SELECT sha256(text) AS local_id, min('/' || source || '/' || doc_id) AS new_id
  FROM documents WHERE source NOT IN ('src0', 'src1', 'src2', 'src3', 'src4') GROUP BY 1
) n ON n.local_id = sha256(o.text)
WHERE o.source IN ('src0', 'src1', 'src2', 'src3', 'src4')""")
def _(tables):
    rows = tables.documents.select(
        "source", F.concat(F.lit("/"), "source", F.lit("/"), "doc_id").alias("record_id"),
        F.sha2("text", 256).alias("local_id"))
    older = F.col("source").isin("src0", "src1", "src2", "src3", "src4")
    return index.redirects(rows.where(~older), rows.where(older), "local_id")


@query("index_timestamps", """
SELECT c_custkey AS record_id, CAST(coalesce(old, DATE '2024-05-06') AS VARCHAR) AS updated
FROM customer LEFT JOIN (
  SELECT o_custkey, CAST(max(o_orderdate) AS DATE) AS old FROM orders GROUP BY 1
) ON o_custkey = c_custkey""")
def _(tables):
    served = tables.orders.groupBy(F.col("o_custkey").alias("record_id")).agg(
        F.max("o_orderdate").cast("date").alias("updated"))
    incoming = tables.customer.select(F.col("c_custkey").alias("record_id"))
    return index.with_timestamps(
        incoming, served, F.lit("2024-05-06").cast("date"), preserve=True,
    ).withColumn("updated", F.col("updated").cast("string"))
