"""Index: publication tiers, the serving table, removals and redirects."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordflow import schema
from recordflow.functions.keyed import first_per_key, latest_per_key
from recordflow.operators.project import step_result
from recordflow.params import PREVIEW, PUBLISH

TIERS = ("T0", "T1", "T2", "T3")


def media_tier(extracted: Column, has_main: Column) -> Column:
    """T0 no usable resource, T1 some, T2 the main one, T3 the main one and three more."""
    return (
        F.when(extracted == 0, TIERS[0])
        .when(has_main & (extracted > 3), TIERS[3])
        .when(has_main, TIERS[2])
        .otherwise(TIERS[1])
    )


def publishable(tier: Column, target: str) -> Column:
    """Preview takes every record, publish those above T0."""
    if target == PREVIEW:
        return F.lit(True)
    if target != PUBLISH:
        raise ValueError(f"unknown target database: {target}")
    return tier != TIERS[0]


def index_step(records: DataFrame, tier: Column, target: str, execution_id: str,
               failure: Column | None = None) -> DataFrame:
    """Records that go to the index, the others as errors; ``failure`` first, where it is set."""
    # Fixed value: the text of a refusal.
    refused = F.concat(
        F.lit(f"Record deleted from database {target}, cause it was in media tier 0! Id: "),
        F.col("record_id"))
    return step_result(records, execution_id, schema.INDEXING, F.col("record_data"),
                       F.coalesce(F.lit(None).cast("string") if failure is None else failure,
                                  F.when(~publishable(tier, target), refused)))


def index_upsert(index: DataFrame, incoming: DataFrame) -> DataFrame:
    """The serving table after incoming rows replaced old ones.

    Of several incoming rows of one record, the highest ``version`` counts. Old rows are
    not grouped, only those that are replaced are taken out.
    """
    latest = latest_per_key(incoming, ["record_id"], ["version"])
    return index_remove(index, latest).select(*index.columns).unionByName(latest)


def index_remove(index: DataFrame, refused: DataFrame) -> DataFrame:
    """The serving table without the refused ids."""
    return index.join(refused.select("record_id"), "record_id", "left_anti")


def with_timestamps(incoming: DataFrame, index: DataFrame, record_date: datetime | Column,
                    preserve: bool) -> DataFrame:
    """Adds ``updated``: the old one where it must be preserved, else the record date.

    ``record_date`` is fixed once per run, on the driver.
    """
    date = record_date if isinstance(record_date, Column) else F.lit(record_date)
    if not preserve:
        return incoming.withColumn("updated", date)
    old = index.select("record_id", F.col("updated").alias("_old"))
    return incoming.join(old, "record_id", "left").withColumn(
        "updated", F.coalesce("_old", date)).drop("_old")


def redirects(new: DataFrame, old: DataFrame, local_id: str) -> DataFrame:
    """(old_id, new_id): records of older datasets that point to a new record.

    Where several new records share a local id, the first by record id is the target, so
    each old record gives one row at most, however often the local id occurs.
    """
    target = first_per_key(
        new.select(local_id, F.col("record_id").alias("new_id")), [local_id], ["new_id"])
    return old.select(local_id, F.col("record_id").alias("old_id")).join(
        target, local_id).select("old_id", "new_id")
