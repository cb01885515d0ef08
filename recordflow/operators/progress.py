"""Counts, progress and counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordflow.functions.prefix import ROWS_PER_RANGE, running

EXECUTION = ["dataset_id", "execution_id"]


def count_per_execution(rows: DataFrame, name: str = "record_count") -> DataFrame:
    """Rows per execution, of records or of errors; no record data is read."""
    return rows.groupBy(*EXECUTION).agg(F.count(F.lit(1)).alias(name))


def count_execution(rows: DataFrame, dataset_id: str, execution_id: str) -> DataFrame:
    """One count, 0 when the execution has no rows."""
    return rows.where(
        (F.col("dataset_id") == dataset_id) & (F.col("execution_id") == execution_id)
    ).agg(F.count(F.lit(1)).alias("record_count"))


def progress_report(source: DataFrame, records: DataFrame, errors: DataFrame,
                    source_execution: dict[str, str] | None = None) -> DataFrame:
    """Per target execution: source total, successes, exceptions and their sum.

    ``source_execution`` maps a target to the execution it read. A target that is not
    named there is a harvest, whose own successes are its total.
    """
    done = count_per_execution(records, "success")
    failed = count_per_execution(errors, "exceptions")
    both = done.join(failed, EXECUTION, "full").select(
        *EXECUTION,
        F.coalesce("success", F.lit(0)).alias("success"),
        F.coalesce("exceptions", F.lit(0)).alias("exceptions"),
    )
    pairs = [F.lit(part) for pair in (source_execution or {}).items() for part in pair]
    read = F.try_element_at(F.create_map(*pairs), F.col("execution_id")) if pairs else (
        F.lit(None).cast("string"))
    totals = count_per_execution(source, "n").withColumnRenamed("execution_id", "source_id")
    return (
        both.withColumn("source_id", read)
        .join(totals, ["dataset_id", "source_id"], "left")
        .select(
            *EXECUTION,
            F.when(F.col("source_id").isNull(), F.col("success"))
            .otherwise(F.coalesce("n", F.lit(0))).alias("source_total"),
            "success", "exceptions",
            (F.col("success") + F.col("exceptions")).alias("processed"),
        )
    )


# The five counters of a notification stream.
COUNTERS = ("processed_records", "ignored_records", "deleted_records",
            "processed_errors", "deleted_errors")


def counter_flags(deleted: Column, ignored: Column, failed: Column) -> dict[str, Column]:
    """Which counter each row raises, as 0 or 1. A failed row raises an error counter only."""
    def flag(condition: Column) -> Column:
        return F.when(condition, F.lit(1)).otherwise(F.lit(0))

    return dict(zip(COUNTERS, (
        flag(~failed & ~deleted & ~ignored),
        flag(~failed & ~deleted & ignored),
        flag(~failed & deleted),
        flag(failed & ~deleted),
        flag(failed & deleted),
    ), strict=True))


def processed(prefix: str = "") -> Column:
    """What a task has processed so far: processed, ignored and deleted records."""
    return sum((F.col(prefix + name) for name in COUNTERS[1:3]), F.col(prefix + COUNTERS[0]))


def counter_totals(rows: DataFrame, flags: dict[str, Column],
                   key: str = "task_id") -> DataFrame:
    totals = rows.groupBy(key).agg(*[F.sum(flag).alias(n) for n, flag in flags.items()])
    return totals.withColumn("processed", processed())


def running_counters(rows: DataFrame, flags: dict[str, Column], order: Sequence[str],
                     key: str = "task_id", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Each row with its task's counters so far and its number within the task."""
    counted = running(rows, [key], order, sums=flags, rows_per_range=rows_per_range)
    return counted.withColumn("resource_num", processed())


# Fixed value: the status of a record that failed.
FAILED_STATUS = "STOP"


def statistics_flags(status: Column) -> dict[str, Column]:
    failed = F.coalesce(status == FAILED_STATUS, F.lit(False))
    return {
        "failed": F.when(failed, F.lit(1)).otherwise(F.lit(0)),
        "succeeded": F.when(failed, F.lit(0)).otherwise(F.lit(1)),
    }


def task_statistics(rows: DataFrame, status: Column, key: str = "task_id") -> DataFrame:
    return rows.groupBy(key).agg(
        *[F.sum(flag).alias(n) for n, flag in statistics_flags(status).items()])


def running_task_statistics(rows: DataFrame, status: Column, order: Sequence[str],
                            key: str = "task_id",
                            rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Each row with its task's totals so far."""
    return running(rows, [key], order, sums=statistics_flags(status),
                   rows_per_range=rows_per_range)


def progress_delta(snapshots: DataFrame, order: Sequence[str], key: str = "split_id",
                   count: str = "emitted_count",
                   rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Each snapshot with the increase since the one before it (0 before the first)."""
    stepped = running(snapshots, [key], order, previous={"_before": F.col(count)},
                      rows_per_range=rows_per_range)
    return stepped.withColumn(
        "increase", F.col(count) - F.coalesce("_before", F.lit(0))).drop("_before")


def progress_violations(snapshots: DataFrame, order: Sequence[str], key: str = "split_id",
                        count: str = "emitted_count",
                        rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Snapshots at which a split's progress went backward."""
    return progress_delta(snapshots, order, key, count, rows_per_range).where("increase < 0")


def progress_asof(commits: DataFrame, snapshots: DataFrame, key: str, at: str, tie: str,
                  count: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Each commit with the last count recorded at or before it.

    Both sides are put in one order, in which a snapshot comes before a commit of the
    same moment; ``tie`` orders the rows of one side.
    """
    both = commits.select(key, at, tie, F.lit(1).alias("_side"),
                          F.lit(None).cast(snapshots.schema[count].dataType).alias("_count")
                          ).unionByName(
        snapshots.select(key, at, tie, F.lit(0).alias("_side"), F.col(count).alias("_count")))
    return running(both, [key], [at, "_side", tie], lasts={count: F.col("_count")},
                   rows_per_range=rows_per_range).where("_side = 1").select(key, at, tie, count)


def chunk_status(chunks: DataFrame, by: Sequence[str]) -> DataFrame:
    """Chunks started, returned, executing and finished.

    Rows have ``status``; every row is a started chunk.
    """
    counted = chunks.groupBy(*by).agg(
        F.count(F.lit(1)).alias("started"),
        F.count_if(F.col("status") == "returned").alias("returned"),
        F.count_if(F.col("status") == "executing").alias("executing"),
    )
    return counted.withColumn(
        "finished", F.col("started") - F.col("returned") - F.col("executing"))


def progress_state(increments: DataFrame, key: str = "task_id") -> DataFrame:
    """Task progress from a log of commits: no row is ever read and changed."""
    return increments.groupBy(key).agg(
        F.count(F.lit(1)).alias("commit_count"), F.sum("written").alias("write_count"))


def cancel_filter(rows: DataFrame, cancelled: DataFrame, key: str = "task_id") -> DataFrame:
    """Rows of tasks that are not cancelled."""
    return rows.join(cancelled.select(key).distinct(), key, "left_anti")
