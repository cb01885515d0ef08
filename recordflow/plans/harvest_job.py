"""A harvest that goes on where the last run stopped.

The iteration state (how many headers were taken, and the last one) is written after the data. A crash
between the two leaves the older state: the next run takes the same headers again, and the insert
leaves out what is stored already.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordflow import schema
from recordflow.plans import steps
from recordflow.plans.workflow import Execution, Workflow
from recordflow.sinks.tables import ChangeTable
from recordflow.sources.chunks import headers_after


def iteration_states(workflow: Workflow) -> ChangeTable:
    return ChangeTable(
        workflow.spark, f"{workflow.root}/iterations", schema.ITERATION_STATE, ["dataset_id", "execution_id"])


def last_state(states: ChangeTable, dataset_id: str, execution_id: str) -> tuple[int, str | None]:
    """(headers taken, the last one) of a harvest; (0, None) before its first commit."""
    row = states.state().where(
        (F.col("dataset_id") == dataset_id) & (F.col("execution_id") == execution_id)).first()
    return (0, None) if row is None else (row["emitted_count"], row["last_identifier"])


def commit_state(states: ChangeTable, dataset_id: str, execution_id: str, emitted: int, last: str) -> None:
    """Replaces the state; the number of headers taken orders the commits."""
    states.write(states.spark.range(1).select(
        F.lit(dataset_id).alias("dataset_id"), F.lit(execution_id).alias("execution_id"),
        F.lit(emitted).cast("int").alias("emitted_count"), F.lit(last).alias("last_identifier")).coalesce(1), emitted)


def harvest_dataset(workflow: Workflow, headers: DataFrame, content: DataFrame, dataset_id: str, local_id: Column,
                    execution_id: str, order: Sequence[str] = ("datestamp", "identifier"),
                    task_id: int | None = None, commit: Callable[..., None] | None = None) -> Execution:
    """Takes all headers listed after the last one taken; deleted ones count as taken.

    ``order`` is the order of the listing, whose identifiers are unique. A last identifier that
    the listing no longer has fails the harvest. ``commit`` writes the state in another way.
    """
    states = iteration_states(workflow)
    emitted, last = last_state(states, dataset_id, execution_id)
    pending = headers if last is None else headers_after(headers, last, order)
    taken = pending.agg(
        F.count(F.lit(1)).alias("n"), F.max_by("identifier", F.struct(*order)).alias("last")).first()
    done = workflow.run_step(
        steps.harvest_step(pending, content, F.lit(dataset_id), local_id), None, execution_id, task_id)
    if taken["n"]:
        (commit or commit_state)(states, dataset_id, execution_id, emitted + taken["n"], taken["last"])
    return done
