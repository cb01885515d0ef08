"""Row shapes between steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordflow import schema
from recordflow.functions import text


def to_flight(records: DataFrame) -> DataFrame:
    """Stored rows to (record_id, file_content, error_message)."""
    return records.select(
        "record_id",
        text.utf8_bytes(F.col("record_data")).alias("file_content"),
        F.lit("").alias("error_message"),
    )


def to_record_rows(flight: DataFrame, dataset_id: str | Column, execution_id: str,
                   execution_name: str) -> DataFrame:
    """Rows in flight back to stored rows, stamped with the run."""
    return flight.select(
        _value(dataset_id).alias("dataset_id"),
        F.lit(execution_id).alias("execution_id"),
        F.lit(execution_name).alias("execution_name"),
        "record_id",
        text.utf8_text(F.col("file_content")).alias("record_data"),
    )


def to_error_rows(errors: DataFrame, dataset_id: str | Column, execution_id: str,
                  execution_name: str) -> DataFrame:
    return errors.select(
        _value(dataset_id).alias("dataset_id"),
        F.lit(execution_id).alias("execution_id"),
        F.lit(execution_name).alias("execution_name"),
        "record_id",
        "exception",
    )


def _value(value: str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def step_result(records: DataFrame, execution_id: str, execution_name: str,
                record_data: Column, exception: Column | None = None) -> DataFrame:
    """The contract of every step: one row in, one row out, under a new execution.

    A failed record has empty data and the exception's text.
    """
    # Both are computed in a projection of their own, so that neither runs twice.
    computed = records.select(
        "dataset_id", "record_id", record_data.alias("_data"),
        (F.lit(None).cast("string") if exception is None else exception).alias("_failure"))
    failure = F.col("_failure")
    return computed.select(
        "dataset_id",
        F.lit(execution_id).alias("execution_id"),
        F.lit(execution_name).alias("execution_name"),
        "record_id",
        F.when(failure.isNull(), F.col("_data")).otherwise(F.lit("")).alias("record_data"),
        failure.alias("exception"),
    )


def url_parts(messages: DataFrame, url: str = "record_id") -> DataFrame:
    """Adds the record, representation and version named in a resource URL."""
    return messages.withColumns({
        "cloud_id": text.url_part(F.col(url), "record"),
        "representation_name": text.url_part(F.col(url), "representation"),
        "representation_version": text.url_part(F.col(url), "version"),
    })


def keep_deleted(deleted: Column, before: Column, after: Column) -> Column:
    """A deleted item skips the step but stays in the flow."""
    return F.when(deleted, before).otherwise(after)


def notification_rows(notifications: DataFrame) -> DataFrame:
    return notifications.select("task_id", "resource", "result_resource", "info_text")


def spread(df: DataFrame, partitions: int) -> DataFrame:
    """Spreads the rows of a source that gives few partitions, before costly work."""
    return df.repartition(partitions)
