"""New representations, revisions and notifications of the message-topic job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def representation_version(sent: Column, record_id: Column) -> Column:
    """The same version for the same task time and record, so a retry writes it again."""
    return F.sha2(F.concat(F.unix_micros(sent).cast("string"), F.lit("|"), record_id), 256)


def write_representation(items: DataFrame, base_url: str) -> DataFrame:
    """Adds the version and the URL of each written item; deleted items get neither.

    Items have sent_date, cloud_id, new_representation_name, record_id and
    marked_as_deleted.
    """
    live = ~F.col("marked_as_deleted")
    version = F.when(live, representation_version(F.col("sent_date"), F.col("record_id")))
    return items.withColumn("new_version", version).withColumn(
        "new_resource_url",
        F.when(live, F.concat(
            F.lit(f"{base_url}/records/"), F.col("cloud_id"),
            F.lit("/representations/"), F.col("new_representation_name"),
            F.lit("/versions/"), F.col("new_version"))))


def add_revision(written: DataFrame, *keep: str) -> DataFrame:
    """One revision row per item: on the new resource, or on the old one as deleted.

    An item with an ``exception`` gets neither; its text is the ``info_text`` of the row.
    ``keep`` names columns of the items that are handed on.
    """
    deleted, failed = F.col("marked_as_deleted"), F.col("exception").isNotNull()
    target = F.when(deleted, F.col("resource_url")).otherwise(F.col("new_resource_url"))
    return written.select(
        *keep, "task_id",
        F.col("resource_url").alias("resource"),
        F.when(~failed & ~deleted, F.col("new_resource_url")).alias("result_resource"),
        F.coalesce("exception", F.lit("")).alias("info_text"),
        F.when(failed, "ERROR").otherwise("SUCCESS").alias("state"),
        F.when(~failed, target).alias("revision_resource"),
        "revision_provider_id", "revision_name", "revision_timestamp",
        deleted.alias("marked_as_deleted"),
    )


def notifications(revisions: DataFrame, job_name: str) -> DataFrame:
    """Revision rows as notifications."""
    return revisions.select(
        "task_id", "resource", "result_resource", "info_text",
        F.lit(job_name).alias("job_name"),
        "marked_as_deleted",
    )
