"""Keyed tables in hash buckets.

A row's bucket is a hash of its key, and each write is a version: one folder with a sub-folder per
bucket that it touches. A write reads the keys of those buckets only. Writing a version again starts
from the versions before it and replaces it, so a repeated batch changes nothing. Versions never
overwrite one another, so a crash in a write leaves the state before it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordflow.functions.keyed import first_per_key, null_safe_join
from recordflow.sinks.tables import _read_or_empty
from recordflow.sinks.upsert import SAVE_NULLS, upsert

BUCKETS = 64


class _Buckets:
    def __init__(self, spark: SparkSession, path: str, columns: T.StructType, keys: Sequence[str], buckets: int = BUCKETS):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets
        self.names = [f.name for f in columns.fields]
        self.stored = T.StructType([
            *columns.fields, T.StructField("version", T.LongType()), T.StructField("bucket", T.IntegerType())])

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[f"`{k}`" for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _versions(self, before: int | None = None) -> DataFrame:
        rows = _read_or_empty(self.spark, self.path, self.stored)
        return rows if before is None else rows.where(F.col("version") < before)

    def _touched(self, rows: DataFrame) -> list[int]:
        """The buckets of some rows: at most as many numbers as there are buckets."""
        return sorted(r[0] for r in rows.select(self._bucket().alias("bucket")).distinct().collect())

    def _write(self, rows: DataFrame, version: int) -> None:
        """One writer per bucket at least, more where adaptive execution splits a large one."""
        rows.select(*self.names).withColumn("bucket", self._bucket()).hint("rebalance", "bucket").write.mode(
            "overwrite").partitionBy("bucket").parquet(f"{self.path}/version={version}")


class MergeTable(_Buckets):
    """The last write of a key wins. A merge writes the buckets that it touches anew, with the rows
    that were there; a bucket's state is its latest version."""

    def _latest(self, before: int | None, buckets: Sequence[int] | None) -> Column:
        """Which (bucket, version) folders hold the state; found by listing, no file is read."""
        rows = self._versions(before)
        if buckets is not None:
            rows = rows.where(F.col("bucket").isin(*buckets))
        latest = rows.groupBy("bucket").agg(F.max("version").alias("version")).collect()
        return reduce(or_, [(F.col("bucket") == r["bucket"]) & (F.col("version") == r["version"]) for r in latest], F.lit(False))

    def state(self, before: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """One row per key. ``before`` leaves that version and later ones out."""
        return self._versions().where(self._latest(before, buckets)).select(*self.names)

    def merge(self, rows: DataFrame, version: int, nulls: str = SAVE_NULLS, order: Sequence[str] = ()) -> None:
        """Stores ``rows`` over what is there; ``nulls`` as in :func:`.upsert.upsert`.

        Of several rows of one key the first in ``order`` counts, by all columns if that is empty.
        """
        rows = rows.select(*self.names)
        rest = [c for c in self.names if c not in self.keys]
        touched = self._touched(rows)
        if not touched:
            return
        old = self.state(version, touched).withColumn("version", F.lit(0))
        new = first_per_key(rows, self.keys, list(order) or rest).withColumn("version", F.lit(1))
        self._write(upsert(old, new, self.keys, "version", nulls), version)


class AppendTable(_Buckets):
    """The first write of a key wins, and rows are never written again: a version holds what was new
    in it. For rows that are large, or that must not change."""

    def state(self, before: int | None = None) -> DataFrame:
        return self._versions(before).select(*self.names)

    def insert(self, rows: DataFrame, version: int, order: Sequence[str] = ()) -> None:
        """Stores the rows whose key is new. Keys are looked for in the touched buckets only."""
        rows = rows.select(*self.names)
        rest = [c for c in self.names if c not in self.keys]
        touched = self._touched(rows)
        if not touched:
            return
        known = self._versions(version).where(F.col("bucket").isin(*touched)).select(*self.keys)
        one = first_per_key(rows, self.keys, list(order) or rest)
        self._write(null_safe_join(one, known, self.keys, "left_anti"), version)
