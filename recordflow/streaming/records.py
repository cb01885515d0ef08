"""A step over records that keep landing.

The keys seen so far live in the engine's keyed state, so a micro-batch reads nothing that earlier
ones wrote. A key that comes again, in its batch or in a later one, is counted and not stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from recordflow.plans.steps import Step
from recordflow.sinks.tables import ProgressLog, ResultTable
from recordflow.streaming.settings import start, state_settings

KEY = ["dataset_id", "record_id"]


def first_seen(records: DataFrame) -> DataFrame:
    """A stream of the records whose key comes for the first time (``seen_before`` false) and, for
    every record read, one narrow row (``seen_before`` null) to count them by.

    The state grows with the keys and never expires: first write wins for good. It lies in the
    executors' local stores and the checkpoint, not in memory.
    """
    fresh = records.dropDuplicates(KEY).withColumn("seen_before", F.lit(False))
    read = records.select(*KEY).withColumn("seen_before", F.lit(None).cast("boolean"))
    return fresh.unionByName(read, allowMissingColumns=True)


def start_step(records: DataFrame, step: Step, execution_id: str, results: ResultTable,
               progress: ProgressLog, task_id: int, checkpoint: str,
               interval: str | None = None) -> StreamingQuery:
    """Each micro-batch is one commit: results first, then its progress, rows stored and repeats.

    A batch that is run again starts from the state before it and replaces its own results and its
    own commit, so replay gives each record once and the right counts.
    """
    progress.register(task_id)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # the state is asked once, however often the batch is read
        try:
            fresh = batch.where("not seen_before").drop("seen_before")
            results.insert_batch(step.run(fresh, execution_id), execution_id, batch_id)
            counted = batch.agg(
                F.count_if(~F.col("seen_before")).alias("stored"),
                F.count_if(F.col("seen_before").isNull()).alias("read")).first()
            progress.add(task_id, batch_id + 1, counted["stored"], counted["read"] - counted["stored"])
        finally:
            batch.unpersist()

    with state_settings(records.sparkSession):
        return start(first_seen(records).writeStream.foreachBatch(write), checkpoint, step.name, interval)
