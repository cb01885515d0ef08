"""Per-task statistics with expiring state."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from recordflow.operators.progress import statistics_flags
from recordflow.streaming.settings import start, state_settings

# The state class is sent to Python workers with its code, as they may lack this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: statistics that were not written for five minutes are forgotten.
TIME_TO_LIVE_MS = 300_000

STATISTICS = "task_id bigint, failed bigint, succeeded bigint"


class TaskStatistics(StatefulProcessor):
    """Adds up the rows of a task; expired totals start again from zero."""

    def __init__(self, ttl_ms: int = TIME_TO_LIVE_MS, each_row: bool = False):
        self.ttl_ms, self.each_row = ttl_ms, each_row

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getValueState(
            "statistics", "failed bigint, succeeded bigint", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        failed, succeeded = self.totals.get() if self.totals.exists() else (0, 0)
        for row in rows:
            failed, succeeded = failed + row.failed, succeeded + row.succeeded
            if self.each_row:
                yield Row(task_id=key[0], failed=failed, succeeded=succeeded)
        self.totals.update((failed, succeeded))
        if not self.each_row:
            yield Row(task_id=key[0], failed=failed, succeeded=succeeded)

    def close(self) -> None:
        pass


def _combined(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        yield rows.groupby("task_id", as_index=False)[["failed", "succeeded"]].sum()


def task_statistics(tasks: DataFrame, status: Column, ttl_ms: int = TIME_TO_LIVE_MS,
                    each_row: bool = False) -> DataFrame:
    """A stream of updated totals, one per task and micro-batch.

    Rows are added up before the shuffle, so a task with very many rows sends a few sums
    to its state. ``each_row`` gives one total per input row instead; then all rows of a
    task go through one state in turn.
    """
    counted = tasks.select(
        tasks["task_id"].try_cast("bigint").alias("task_id"),
        *[flag.cast("bigint").alias(name) for name, flag in statistics_flags(status).items()])
    if not each_row:
        counted = counted.mapInPandas(_combined, STATISTICS)
    return counted.groupBy("task_id").transformWithState(
        statefulProcessor=TaskStatistics(ttl_ms, each_row),
        outputStructType=STATISTICS, outputMode="Update", timeMode="ProcessingTime")


def start_statistics(statistics: DataFrame, folder: str, checkpoint: str,
                     keep=lambda batch: batch, interval: str | None = None) -> StreamingQuery:
    """Writes updated totals to ``folder``, one sub-folder per micro-batch.

    ``keep`` filters a batch, as by cancelled tasks, which are read anew each time.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        keep(batch).write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")

    with state_settings(statistics.sparkSession):
        return start(statistics.writeStream.outputMode("update").foreachBatch(write),
                     checkpoint, "task statistics", interval)


def start_print(frame: DataFrame, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Prints each micro-batch on the driver's console."""
    with state_settings(frame.sparkSession):
        return start(frame.writeStream.outputMode("update").format("console"), checkpoint,
                     interval=interval)
