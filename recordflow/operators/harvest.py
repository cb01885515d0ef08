"""Listing, content and final ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordflow import schema
from recordflow.functions import text
from recordflow.operators.route import error_identity


def not_deleted(headers: DataFrame) -> DataFrame:
    return headers.where(~F.col("deleted"))


def harvest_content(headers: DataFrame, content: DataFrame) -> DataFrame:
    """Each header with its content, or with the reason why there is none.

    ``content`` has one row per identifier. A header without an id never joins.
    """
    found = headers.join(
        content.select("identifier", "content").withColumn("found", F.lit(True)),
        "identifier", "left")
    failure = (
        F.when(F.col("identifier").isNull(), F.lit("header has no identifier"))
        .when(F.col("found").isNull(), F.concat(F.lit("no record for "), F.col("identifier")))
        .when(F.col("content").isNull(), F.concat(F.lit("no content for "), F.col("identifier")))
    )
    return found.select(
        F.col("identifier").alias("external_id"),
        F.col("datestamp").alias("timestamp"),
        F.coalesce("content", F.lit("")).alias("content"),
        failure.alias("exception"),
    )


def final_id(dataset_id: Column, local_id: Column) -> Column:
    """``/<dataset>/<local id>``, null for a blank local id."""
    cleaned = F.regexp_replace(F.trim(local_id), "[^A-Za-z0-9_]", "_")
    return F.when(~text.is_blank(local_id), F.concat(F.lit("/"), dataset_id, F.lit("/"), cleaned))


def assign_id(harvested: DataFrame, dataset_id: Column, local_id: Column, execution_id: str,
              execution_name: str = schema.HARVEST) -> DataFrame:
    """Harvested rows as step results under their final id; earlier errors pass through."""
    assigned = final_id(dataset_id, local_id)
    failure = F.coalesce(
        F.col("exception"),
        F.when(assigned.isNull(), F.lit("record has no local id")))
    return harvested.select(
        dataset_id.alias("dataset_id"),
        F.lit(execution_id).alias("execution_id"),
        F.lit(execution_name).alias("execution_name"),
        # what could not be fetched is named by its listing, what got no id by its harvest
        F.when(F.col("exception").isNotNull(), error_identity(F.col("external_id"))).otherwise(
            error_identity(F.col("external_id"), assigned, harvested=True)).alias("record_id"),
        F.when(failure.isNull(), F.col("content")).otherwise(F.lit("")).alias("record_data"),
        failure.alias("exception"),
    )


def assign_unique_ids(harvested: DataFrame, dataset_id: Column, local_id: Column, execution_id: str,
                      execution_name: str = schema.HARVEST) -> DataFrame:
    """:func:`assign_id` with each final id given once: of several records that come to one id, the one
    with the least external id gets it, the others become errors under their external ids.

    A record that is listed twice is no collision. As many rows come out as went in. Only ids that
    several records share travel to the rows.
    """
    named = harvested.withColumn("_assigned", final_id(dataset_id, local_id)).withColumn("_dataset", dataset_id)
    shared = named.where(F.col("exception").isNull() & F.col("_assigned").isNotNull()).groupBy(
        F.col("_dataset").alias("_d"), F.col("_assigned").alias("_id")).agg(
        F.min("external_id").alias("_first"), F.max("external_id").alias("_last")).where("_first <> _last")
    met = named.join(
        shared, F.col("_dataset").eqNullSafe(F.col("_d")) & F.col("_assigned").eqNullSafe(F.col("_id")), "left")
    lost = F.col("exception").isNull() & F.col("_first").isNotNull() & ~F.col("external_id").eqNullSafe(F.col("_first"))
    failure = F.coalesce(
        F.col("exception"), F.when(F.col("_assigned").isNull(), F.lit("record has no local id")),
        F.when(lost, F.concat(F.lit("id is taken: "), F.col("_assigned"))))
    return met.select(
        F.col("_dataset").alias("dataset_id"),
        F.lit(execution_id).alias("execution_id"),
        F.lit(execution_name).alias("execution_name"),
        F.when(F.col("exception").isNotNull(), error_identity(F.col("external_id"))).otherwise(error_identity(
            F.col("external_id"), F.when(~lost, F.col("_assigned")), harvested=True)).alias("record_id"),
        F.when(failure.isNull(), F.col("content")).otherwise(F.lit("")).alias("record_data"),
        failure.alias("exception"),
    )


def id_collisions(assigned: DataFrame) -> DataFrame:
    """Final ids that several records of one execution ended up with."""
    return (
        assigned.where(F.col("exception").isNull())
        .groupBy("dataset_id", "record_id").agg(F.count(F.lit(1)).alias("records"))
        .where(F.col("records") > 1)
    )


def retrieve_file(items: DataFrame, content: DataFrame) -> DataFrame:
    """Adds the file of each item; items marked as deleted get none."""
    found = items.join(content.select("resource_url", "file_content"), "resource_url", "left")
    return found.select(
        *items.columns,
        F.when(~F.col("marked_as_deleted"), F.col("file_content")).alias("file_content"))


def file_content(tasks: DataFrame, files: DataFrame) -> DataFrame:
    """Adds the content of each task's file; an unknown file gives an exception."""
    return tasks.join(files.select("file_url", "content").withColumn("found", F.lit(True)),
                      "file_url", "left").select(
        *tasks.columns,
        F.coalesce("content", F.lit("")).alias("content"),
        F.when(F.col("found").isNull(), F.concat(F.lit("no file "), F.col("file_url")))
        .alias("exception"),
    )


def task_params_join(messages: DataFrame, params: DataFrame,
                     default_mime_type: str = "text/plain") -> DataFrame:
    """Adds each message's task parameters; an unknown task gives an exception.

    Serves a stream on the left side as well. The parameters are one row per task.
    """
    known = params.withColumn("known", F.lit(True))
    joined = messages.join(known, "task_id", "left")
    return joined.withColumns({
        "output_mime_type": F.when(
            F.col("known"), F.coalesce("output_mime_type", F.lit(default_mime_type))),
        "exception": F.when(F.col("known").isNull(), F.concat(
            F.lit("no parameters for task "),
            F.coalesce(F.col("task_id").cast("string"), F.lit("without an id")))),
    }).drop("known")
