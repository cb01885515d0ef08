"""A chain of steps over one result table.

Each step reads what the one before it wrote, which also cuts the lineage: losing an
executor costs the tasks of the running step only.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordflow import params
from recordflow.operators import index
from recordflow.operators.progress import progress_report
from recordflow.plans.steps import Step
from recordflow.sinks.tables import ChangeTable, ProgressLog, ResultTable
from recordflow.sources.chunks import resume_pending

LOG = logging.getLogger(__name__)

SERVING = T.StructType([
    T.StructField("record_id", T.StringType()),
    T.StructField("dataset_id", T.StringType()),
    T.StructField("record_data", T.StringType()),
    T.StructField("updated", T.TimestampType()),
])
SERVED_RUNS = T.StructType([
    T.StructField("execution_id", T.StringType()), T.StructField("run", T.LongType()),
])
REDIRECTS = T.StructType([
    T.StructField("old_id", T.StringType()), T.StructField("new_id", T.StringType()),
])


@dataclass(frozen=True)
class Execution:
    execution_id: str
    step: str
    source_id: str | None


class Workflow:
    """Runs steps under ``root``, a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.results = ResultTable(spark, self.root)
        self.progress = ProgressLog(spark, f"{self.root}/progress")

    def run_step(self, step: Step, source_id: str | None, execution_id: str | None = None,
                 task_id: int | None = None, resume: bool = False,
                 dataset_id: str | None = None) -> Execution:
        """Runs one step and adds its commit to the task's progress.

        A step gives one row per source record, and stored records are unique, so only a
        harvest can bring repeats. With ``resume`` only records without a result are
        processed; give the interrupted run's ``execution_id`` and ``task_id``.
        ``dataset_id`` chooses one dataset of the source.
        """
        execution_id = execution_id or params.new_execution_id()
        is_new = task_id is None
        task_id = self.progress.register(task_id)
        source = None if source_id is None else self.results.records(source_id, dataset_id)
        if resume and source is not None:
            source = resume_pending(source, self.results.records(execution_id),
                                    self.results.errors(execution_id))
        self.spark.sparkContext.setJobDescription(
            params.run_label(step.name, dataset_id or "all", execution_id))
        try:
            self.results.insert(step.run(source, execution_id), execution_id,
                                balance=step.shuffles, unique=source is not None)
            written = self.results.written(execution_id)
            if is_new:
                self.progress.add(task_id, 1, written)
            else:
                self.progress.set_written(task_id, written)
        except Exception:
            LOG.exception("step %s failed, execution %s", step.name, execution_id)
            raise
        finally:
            self.spark.sparkContext.setJobDescription(None)
        return Execution(execution_id, step.name, source_id)

    def run(self, steps: Sequence[Step], execution_ids: Sequence[str] | None = None,
            resume: bool = False) -> list[Execution]:
        """Runs all steps in order; a step that fails stops the chain."""
        ids = execution_ids or [params.new_execution_id() for _ in steps]
        done: list[Execution] = []
        for step, execution_id in zip(steps, ids, strict=True):
            source_id = done[-1].execution_id if done else None
            done.append(self.run_step(step, source_id, execution_id, resume=resume))
        return done

    def report(self, executions: Sequence[Execution]) -> DataFrame:
        """Progress per dataset and execution."""
        sources = {e.execution_id: e.source_id for e in executions if e.source_id}
        mine = F.col("execution_id").isin(*[e.execution_id for e in executions])
        read = F.col("execution_id").isin(*sources.values())
        return progress_report(
            self.results.records().where(read), self.results.records().where(mine),
            self.results.errors().where(mine), sources)

    def serving(self, target: str) -> ChangeTable:
        return ChangeTable(self.spark, f"{self.root}/serving/{target}", SERVING, ["record_id"])

    def redirects(self, target: str) -> ChangeTable:
        return ChangeTable(self.spark, f"{self.root}/redirects/{target}", REDIRECTS, ["old_id"])

    def run_number(self, target: str, execution_id: str) -> int:
        """The place of an execution among those served to ``target``; the same each time."""
        runs = ChangeTable(
            self.spark, f"{self.root}/served/{target}", SERVED_RUNS, ["execution_id"])
        found = runs.state().agg(
            F.max(F.when(F.col("execution_id") == execution_id, F.col("run"))).alias("mine"),
            F.coalesce(F.max("run"), F.lit(0)).alias("last")).first()
        if found["mine"] is not None:
            return found["mine"]
        number = found["last"] + 1
        runs.write(self.spark.range(1).select(
            F.lit(execution_id).alias("execution_id"),
            F.lit(number).cast("bigint").alias("run")).coalesce(1), number)
        return number

    def serve(self, target: str, execution_id: str, version: int,
              record_date: datetime | Column, preserve_timestamps: bool = False) -> ChangeTable:
        """Takes an index execution over into the serving table of ``target``.

        Good records replace old ones, refused ones are removed, in one version. Serving
        a version again replaces it.
        """
        table = self.serving(target)
        good = self.results.records(execution_id).select("record_id", "dataset_id", "record_data")
        dated = index.with_timestamps(
            good, table.state(before=version, columns=["updated"]), record_date, preserve_timestamps)
        refused = self.results.errors(execution_id).select("record_id", "dataset_id")
        none = {"record_data": F.lit(None).cast("string"),
                "updated": F.lit(None).cast("timestamp")}
        changes = dated.withColumn("gone", F.lit(False)).unionByName(
            refused.withColumns(none).withColumn("gone", F.lit(True)))
        table.write(changes, version, removed=F.col("gone"))
        return table

    def redirect(self, target: str, execution_id: str, version: int,
                 redirect_from: Sequence[str], local_id: Column) -> ChangeTable:
        """Points records of older datasets to the records of an index execution.

        ``local_id`` is an expression over serving rows that old and new have in common.
        """
        table = self.redirects(target)
        new = self.results.records(execution_id).select("record_id", local_id.alias("local_id"))
        old = self.serving(target).state().where(
            F.col("dataset_id").isin(*redirect_from)).select(
            "record_id", local_id.alias("local_id"))
        table.write(index.redirects(new, old, "local_id").where("old_id <> new_id"), version)
        return table
