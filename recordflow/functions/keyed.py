"""One row per key, combined on the map side before the shuffle.

A ``row_number`` window would send every copy of a key to one task. ``min_by`` and
``max_by`` keep one candidate per key and map task, so a key that is repeated in a
third of all rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    chosen = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_row"))
    return chosen.select(*[c if c in keys else F.col(f"_row.{c}") for c in df.columns])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row that comes first in ``order``, for each key."""
    return _one_per_key(df, keys, order, F.min_by)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row that comes last in ``order``, for each key."""
    return _one_per_key(df, keys, order, F.max_by)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """An equi join in which a null key meets a null key; the keys stay once.

    A blank dataset id is read back from its partition as null, and must still be found.
    """
    other = right.select(*[
        F.col(c).alias(f"_right_{c}") if c in keys else F.col(c) for c in right.columns])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(other, same, how).drop(*[f"_right_{k}" for k in keys])
