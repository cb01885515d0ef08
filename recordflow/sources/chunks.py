"""Chunk planning, chunk reads and resuming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordflow.functions.keyed import null_safe_join
from recordflow.functions.prefix import ROWS_PER_RANGE, positions
from recordflow.params import DEFAULT_CHUNK_SIZE

EXECUTION = ["dataset_id", "execution_id"]


def with_chunk(records: DataFrame, size: int = DEFAULT_CHUNK_SIZE,
               rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Adds ``position`` and ``chunk_id``, ordered by record id within an execution."""
    placed = positions(records, EXECUTION, ["record_id"], rows_per_range=rows_per_range)
    return placed.withColumn("chunk_id", F.expr(f"(position - 1) div {size}"))


def chunk_plan(records: DataFrame, size: int = DEFAULT_CHUNK_SIZE,
               rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """One row per chunk: its bounds by position and by record id.

    Only the key columns are read.
    """
    keyed = with_chunk(records.select(*EXECUTION, "record_id"), size, rows_per_range)
    return keyed.groupBy(*EXECUTION, "chunk_id").agg(
        F.min("position").alias("first_pos"),
        F.max("position").alias("last_pos"),
        F.min("record_id").alias("first_id"),
        F.max("record_id").alias("last_id"),
        F.count(F.lit(1)).alias("record_count"),
    )


def chunk_counts(records: DataFrame, size: int = DEFAULT_CHUNK_SIZE) -> DataFrame:
    """Records and chunks per execution; the last chunk may be short."""
    return records.groupBy(*EXECUTION).agg(
        F.count(F.lit(1)).alias("record_count"),
        F.expr(f"(count(1) + {size - 1}) div {size}").alias("chunk_count"),
    )


def read_chunks(records: DataFrame, plan: DataFrame) -> DataFrame:
    """The records of the planned chunks, which all belong to one execution.

    The bounds become one filter on the record id, so the scan can skip files by
    their statistics. ``plan`` rows must be neighbours, as a range of chunk ids is.
    """
    bounds = {name: plan.agg(value).scalar() for name, value in (
        ("first", F.min("first_id")), ("last", F.max("last_id")),
        ("dataset", F.min("dataset_id")), ("execution", F.min("execution_id")))}
    return records.where(
        F.col("dataset_id").eqNullSafe(bounds["dataset"])
        & F.col("execution_id").eqNullSafe(bounds["execution"])
        & (F.col("record_id") >= bounds["first"]) & (F.col("record_id") <= bounds["last"]))


def resume_pending(source: DataFrame, done: DataFrame, errors: DataFrame) -> DataFrame:
    """Source records with neither a result nor an error yet.

    ``done`` and ``errors`` are the target execution. Exact after any crash, also
    one between the two writes.
    """
    key = ["dataset_id", "record_id"]
    finished = done.select(*key).unionByName(errors.select(*key))
    return null_safe_join(source, finished, key, "left_anti")


def resume_from_offset(source: DataFrame, write_count: DataFrame,
                       rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Source records after the first ``write_count`` of their execution.

    ``write_count`` has one row per execution; executions without one start at 0.
    """
    placed = positions(source, EXECUTION, ["record_id"], rows_per_range=rows_per_range)
    return (
        placed.join(write_count.select(*EXECUTION, "write_count"), EXECUTION, "left")
        .where(F.col("position") > F.coalesce("write_count", F.lit(0)))
        .drop("write_count")
    )


def headers_after(headers: DataFrame, last_identifier: str | Column,
                  order: Sequence[str]) -> DataFrame:
    """Headers listed after ``last_identifier``; fails when it was never listed.

    ``last_identifier`` may be a scalar subquery on the iteration state.
    """
    wanted = last_identifier if isinstance(last_identifier, Column) else F.lit(last_identifier)
    place = F.struct(*order)
    last = (
        headers.where(F.col("identifier") == wanted)
        .agg(F.max(place).alias("place"))
        .select(F.when(F.col("place").isNull(), F.raise_error(
            F.concat(F.lit("last identifier not in the listing: "), wanted)))
            .otherwise(F.col("place")).alias("place"))
        .scalar()
    )
    return headers.withColumn("_last", last).where(place > F.col("_last")).drop("_last")
