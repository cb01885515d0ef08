"""Record-set scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordflow import schema


def scan_execution(records: DataFrame, execution_id: str,
                   dataset_id: str | None = None) -> DataFrame:
    """All records of one execution; on a partitioned table this prunes partitions."""
    rows = records.where(F.col("execution_id") == execution_id)
    if dataset_id is not None:
        rows = rows.where(F.col("dataset_id") == dataset_id)
    return rows.select(*schema.RECORD_COLUMNS)


def range_predicates(dataset_id: str, execution_id: str, id_ranges: Sequence[tuple[str, str]]) -> list[str]:
    """SQL conditions, one per range of record ids of one execution.

    A range takes in its first and its last id, as a chunk of :func:`.chunks.chunk_plan` does.
    """
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    execution = f"dataset_id = {quoted(dataset_id)} and execution_id = {quoted(execution_id)}"
    return [f"{execution} and record_id >= {quoted(first)} and record_id <= {quoted(last)}" for first, last in id_ranges]


def read_database_records(spark: SparkSession, url: str, table: str, dataset_id: str,
                          execution_id: str, id_ranges: Sequence[tuple[str, str]],
                          **options: str) -> DataFrame:
    """Records of one execution from a relational store, one task per range of record ids
    (:func:`range_predicates`). The driver's jar must be on the class path."""
    predicates = range_predicates(dataset_id, execution_id, id_ranges)
    return spark.read.jdbc(url, table, predicates=predicates, properties=options).select(
        *schema.RECORD_COLUMNS)


def find_task(task_info: DataFrame, task_id: int) -> DataFrame:
    """The task's row, or none."""
    return task_info.where(F.col("task_id") == task_id)


def find_iteration_state(state: DataFrame, dataset_id: str, execution_id: str) -> DataFrame:
    return state.where(
        (F.col("dataset_id") == dataset_id) & (F.col("execution_id") == execution_id))
