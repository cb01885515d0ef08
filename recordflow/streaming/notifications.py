"""Notifications and counters, written together per micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from recordflow.functions.keyed import null_safe_join
from recordflow.functions.prefix import ROWS_PER_RANGE
from recordflow.operators.progress import COUNTERS, counter_totals, processed, running_counters
from recordflow.sinks.tables import ChangeTable
from recordflow.streaming.settings import start, state_settings

COUNTER_STATE = T.StructType([
    T.StructField("task_id", T.LongType()), *[T.StructField(n, T.LongType()) for n in COUNTERS],
])


def counter_state(spark: SparkSession, path: str) -> ChangeTable:
    return ChangeTable(spark, path, COUNTER_STATE, ["task_id"])


def write_batch(batch: DataFrame, batch_id: int, flags: dict[str, Column],
                order: Sequence[str], counters: ChangeTable, folder: str,
                rows_per_range: int = ROWS_PER_RANGE, compact_every: int = 100) -> None:
    """One batch of rows that no stream keeps state for; the counters before it are read back.

    A batch that is run again writes the same rows and the same counters.
    """
    batch = batch.persist()
    try:
        before = counters.state(before=batch_id)
        sums = counter_totals(batch, flags).drop("processed")
        after = null_safe_join(sums, _prefixed(before), ["task_id"], "left").select(
            "task_id", *[(F.col(n) + F.coalesce(f"_{n}", F.lit(0))).alias(n) for n in COUNTERS])
        _write(batch, batch_id, flags, order, before, after, counters, folder, rows_per_range)
        if batch_id % compact_every == compact_every - 1:
            counters.compact(batch_id)
    finally:
        batch.unpersist()


def _prefixed(counters: DataFrame) -> DataFrame:
    return counters.select("task_id", *[F.col(n).alias(f"_{n}") for n in COUNTERS])


def _write(rows: DataFrame, batch_id: int, flags: dict[str, Column], order: Sequence[str],
           before: DataFrame, after: DataFrame, counters: ChangeTable, folder: str,
           rows_per_range: int) -> None:
    """Rows with their numbers, which go on from ``before``, then the counters ``after`` them."""
    numbered = running_counters(rows, flags, order, rows_per_range=rows_per_range).drop("resource_num")
    gone_on = {n: F.col(n) + F.coalesce(f"_{n}", F.lit(0)) for n in COUNTERS}
    numbered = null_safe_join(numbered, _prefixed(before), ["task_id"], "left").withColumns(gone_on).drop(
        *[f"_{n}" for n in COUNTERS])
    numbered.withColumn("resource_num", processed()).write.mode("overwrite").parquet(
        f"{folder}/batch_id={batch_id}")
    counters.write(after, batch_id)


def with_totals(rows: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """A stream of the rows (``is_total`` false) and, for each task of a micro-batch, its five
    counters up to and including that batch, as ``total_...`` (``is_total`` true).

    The counters are the engine's own reducing state: summed before the shuffle, one row a task.
    """
    totals = rows.groupBy("task_id").agg(*[F.sum(flag).alias(f"total_{n}") for n, flag in flags.items()])
    return rows.withColumn("is_total", F.lit(False)).unionByName(
        totals.withColumn("is_total", F.lit(True)), allowMissingColumns=True)


def start_notifications(rows: DataFrame, flags: dict[str, Column], order: Sequence[str],
                        counters: ChangeTable, folder: str, checkpoint: str,
                        interval: str | None = None,
                        rows_per_range: int = ROWS_PER_RANGE,
                        name: str = "notifications",
                        first: Callable[[DataFrame, int], None] = lambda rows, batch_id: None) -> StreamingQuery:
    """Numbers the rows of a stream within their tasks and writes them with the counters.

    What a task had before a batch is its state less the batch's own sums, so nothing written
    earlier is read or listed, and a batch run again starts from the same state. ``counters`` is
    written for readers only. ``first`` sees each batch's rows before they are written here.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # the state is asked once, however often the batch is read
        try:
            own = batch.where("not is_total").select(*rows.columns)
            first(own, batch_id)
            after = batch.where("is_total").select(
                "task_id", *[F.col(f"total_{n}").alias(n) for n in COUNTERS])
            sums = counter_totals(own, flags).drop("processed")
            before = null_safe_join(after, _prefixed(sums), ["task_id"], "inner").select(
                "task_id", *[(F.col(n) - F.col(f"_{n}")).alias(n) for n in COUNTERS])
            _write(own, batch_id, flags, order, before, after, counters, folder, rows_per_range)
        finally:
            batch.unpersist()

    with state_settings(rows.sparkSession):
        return start(with_totals(rows, flags).writeStream.outputMode("update").foreachBatch(write),
                     checkpoint, name, interval)


def running_totals(rows: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """A stream of each task's counters, for update mode: partial sums, then the state."""
    return counter_totals(rows, flags)
