"""Keyed upserts: the last write of a key wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordflow.functions.keyed import latest_per_key

SAVE_NULLS, IGNORE_NULLS = "save", "ignore"


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str],
           version: str = "version", nulls: str = SAVE_NULLS) -> DataFrame:
    """The table after the upsert; ``version`` orders all writes.

    ``nulls="save"`` stores a null like any value. ``nulls="ignore"`` keeps, column by
    column, the last value that is not null.
    """
    rows = existing.unionByName(incoming)
    if nulls == SAVE_NULLS:
        return latest_per_key(rows, keys, [version])
    if nulls != IGNORE_NULLS:
        raise ValueError(f"unknown null rule: {nulls}")
    values = [c for c in rows.columns if c not in (*keys, version)]
    merged = rows.groupBy(*keys).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(version))).alias(c) for c in values],
        F.max(version).alias(version),
    )
    return merged.select(*rows.columns)


def register_absent(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Incoming rows whose key is not there yet, one per key."""
    return incoming.dropDuplicates([key]).join(existing.select(key), key, "left_anti")
