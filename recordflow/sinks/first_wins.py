"""Idempotent inserts: the first write of a key wins, repeats are counted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordflow.functions.keyed import first_per_key, null_safe_join
from recordflow.schema import RECORD_KEY


def rows_to_insert(incoming: DataFrame, existing: DataFrame, order: Sequence[str],
                   keys: Sequence[str] = RECORD_KEY, unique: bool = False) -> DataFrame:
    """Incoming rows whose key is new; of repeats in the batch, the first in ``order``.

    Only the key columns of ``existing`` are read, and ``incoming`` is computed once. Where
    nothing is stored yet the join falls away at planning. ``unique`` says that no key is
    repeated in the batch, which saves the grouping of whole rows. One writer per execution:
    two writers cannot see each other's rows. Null keys are equal to each other.
    """
    keys = list(keys)
    rows = incoming if unique else first_per_key(incoming, keys, order)
    return null_safe_join(rows, existing.select(*keys), keys, "left_anti").select(*incoming.columns)


def insert_first_wins(incoming: DataFrame, existing: DataFrame, order: Sequence[str],
                      keys: Sequence[str] = RECORD_KEY) -> DataFrame:
    """The table after the insert."""
    return existing.unionByName(rows_to_insert(incoming, existing, order, keys))


def insert_counts(incoming: DataFrame, existing: DataFrame,
                  keys: Sequence[str] = RECORD_KEY,
                  by: Sequence[str] = ("dataset_id", "execution_id")) -> DataFrame:
    """Per execution: rows inserted and rows skipped because their key was there."""
    per_key = incoming.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    known = existing.select(*keys).distinct().withColumn("known", F.lit(1))
    return null_safe_join(per_key, known, list(keys), "left").groupBy(*by).agg(
        F.count_if(F.col("known").isNull()).alias("inserted"),
        F.sum(F.when(F.col("known").isNull(), F.col("copies") - 1)
              .otherwise(F.col("copies"))).alias("skipped"),
    )
