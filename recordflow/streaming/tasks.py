"""Text-line tasks: cancellations, file content and enrichment per micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from recordflow.operators.harvest import file_content
from recordflow.operators.progress import cancel_filter
from recordflow.sinks.tables import ChangeTable
from recordflow.sources.messages import parse_cancelled_ids, parse_task_lines
from recordflow.streaming.settings import start

CANCELLED = T.StructType([T.StructField("task_id", T.StringType())])


def cancelled_tasks(spark: SparkSession, path: str) -> ChangeTable:
    return ChangeTable(spark, path, CANCELLED, ["task_id"])


def start_cancellations(lines: DataFrame, cancelled: ChangeTable, checkpoint: str,
                        interval: str | None = None) -> StreamingQuery:
    """Adds the task ids of cancellation lines to the set of cancelled tasks."""
    def write(batch: DataFrame, batch_id: int) -> None:
        cancelled.write(parse_cancelled_ids(batch).distinct(), batch_id)

    return start(lines.writeStream.foreachBatch(write), checkpoint, "cancellations", interval)


def without_cancelled(cancelled: ChangeTable) -> Callable[[DataFrame], DataFrame]:
    """A filter that reads the cancelled tasks each time it is used."""
    return lambda batch: not_cancelled(batch, cancelled.state())


def not_cancelled(batch: DataFrame, ids: DataFrame) -> DataFrame:
    """Without the tasks of ``ids``, text; an id that no task of the batch can have is passed over."""
    typed = F.col("task_id").try_cast(batch.schema["task_id"].dataType)
    return cancel_filter(batch, ids.select(typed.alias("task_id")).where("task_id is not null"))


def start_tasks(lines: DataFrame, files: Callable[[], DataFrame],
                enrich: Callable[[DataFrame], DataFrame], cancelled: ChangeTable, folder: str,
                checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Parses task lines, reads their files, enriches them and writes one folder per batch.

    Cancelled tasks are left out before the files are read and again after enrichment.
    ``enrich`` adds ``status``.
    """
    keep = without_cancelled(cancelled)

    def write(batch: DataFrame, batch_id: int) -> None:
        read = file_content(keep(parse_task_lines(batch)), files())
        keep(enrich(read)).write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")

    return start(lines.writeStream.foreachBatch(write), checkpoint, "tasks", interval)
