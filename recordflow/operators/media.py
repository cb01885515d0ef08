"""Media: the main resource of a record first, then the others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordflow import schema
from recordflow.functions import text
from recordflow.functions.keyed import null_safe_join
from recordflow.operators.project import step_result

KEY = ["dataset_id", "record_id"]


def resource_links(records: DataFrame, links: Column) -> DataFrame:
    """Rows (dataset_id, record_id, place, resource); place 0 is the main resource."""
    return text.numbered_items(records, KEY, links, "place", "resource")


def looked_up_links(links: DataFrame, metadata: DataFrame) -> DataFrame:
    """Links with the metadata of their resource and whether it could be extracted.

    ``metadata`` (resource, mime, bytes) has one row per resource.
    """
    return links.join(
        metadata.select("resource", "mime", "bytes").withColumn("extracted", F.lit(True)),
        "resource", "left",
    ).withColumn("extracted", F.coalesce("extracted", F.lit(False)))


def main_resources(records: DataFrame, links: Column, metadata: DataFrame) -> DataFrame:
    """Each record's main resource and whether it gave a thumbnail."""
    main = records.select(*KEY, F.get(links, F.lit(0)).alias("resource"))
    return looked_up_links(main, metadata).select(
        *KEY, "resource", "mime", "bytes", F.col("extracted").alias("has_main_thumbnail"))


def folded_links(looked_up: DataFrame) -> DataFrame:
    """Links back to one row per record, in order.

    All rows of a record come from one record's own links, which bounds the list.
    """
    return looked_up.groupBy(*KEY).agg(
        F.array_sort(F.collect_list(F.struct("place", "resource", "mime", "bytes", "extracted")))
        .alias("resources"))


def media_resources(records: DataFrame, links: Column, metadata: DataFrame) -> DataFrame:
    """The other resources, each with a flag whether the main one succeeded."""
    folded = folded_links(looked_up_links(resource_links(records, links), metadata))
    return folded.withColumn(
        "has_main_thumbnail", F.col("resources")[0]["extracted"],
    ).select(*KEY, "has_main_thumbnail", F.explode("resources").alias("r")).where(
        "r.place > 0").select(*KEY, "r.place", "r.resource", "r.mime", "r.bytes",
                              "r.extracted", "has_main_thumbnail")


def media_totals(records: DataFrame, links: Column, metadata: DataFrame) -> DataFrame:
    """Per record: resources extracted and failed, their size and the main flag.

    Only sums, so nothing is collected. Records without links stay, with zeros; a name of
    its own for each keeps them from meeting in one task of the join.
    """
    every = records.select(*KEY, F.posexplode_outer(links).alias("place", "resource"))
    named = every.withColumn(
        "resource", F.coalesce("resource", F.concat(F.lit("no link in "), "record_id")))
    is_link, extracted = F.col("place").isNotNull(), F.col("extracted")
    return looked_up_links(named, metadata).groupBy(*KEY).agg(
        F.count_if(is_link & extracted).alias("extracted"),
        F.count_if(is_link & ~extracted).alias("failed"),
        F.coalesce(F.sum(F.when(is_link, F.col("bytes"))), F.lit(0)).alias("bytes"),
        F.coalesce(F.bool_or(extracted & (F.col("place") == 0)), F.lit(False))
        .alias("has_main_thumbnail"),
    )


def enrich_media(records: DataFrame, links: Column, metadata: DataFrame, enriched: Column,
                 execution_id: str, failure: Column | None = None) -> DataFrame:
    """Records with their resources' metadata added; failed resources are skipped.

    ``enriched`` builds the new data from the record and the ``resources`` array, each
    (place, resource, mime, bytes, extracted).
    """
    folded = folded_links(looked_up_links(resource_links(records, links), metadata))
    empty = F.array().cast(
        "array<struct<place:int,resource:string,mime:string,bytes:bigint,extracted:boolean>>")
    joined = null_safe_join(records, folded, KEY, "left").withColumn(
        "resources", F.coalesce("resources", empty))
    return step_result(joined, execution_id, schema.MEDIA, enriched, failure)
