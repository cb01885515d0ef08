"""Tables on a shared file system.

``ResultTable`` holds every step's output. Good and bad records of a run are written by
one job, parted by ``outcome``, so no crash can leave one without the other and the
result is computed once.

``ProgressLog`` holds the commits of tasks; nothing is ever read and changed.

``ChangeTable`` holds keyed state as a log of versions. A version is one folder, written
as a whole; writing it again replaces it, so a repeated batch changes nothing.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from recordflow import schema
from recordflow.functions.keyed import latest_per_key
from recordflow.params import new_task_id
from recordflow.sinks.first_wins import rows_to_insert

RECORD, ERROR = "record", "error"

# Partition values that are folder names as they stand, without escapes.
_PLAIN = re.compile("[A-Za-z0-9_-]+")


def _read_or_empty(spark: SparkSession, path: str, columns: T.StructType,
                   **options: str) -> DataFrame:
    try:
        return spark.read.options(**options).schema(columns).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        # Known to the optimizer as empty, so that joins with it fall away.
        return spark.range(1).where("false").select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in columns.fields])


def _replace_folder(spark: SparkSession, folder: str, content: bytes) -> None:
    """Leaves one Parquet file in ``folder``, which no reader sees before it is whole."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(path(folder), True)
    hidden, shown = path(f"{folder}/_part-00000"), path(f"{folder}/part-00000.parquet")
    out = files.create(hidden)
    try:
        out.write(content)
    finally:
        out.close()
    if not files.rename(hidden, shown):
        raise OSError(f"{hidden.toString()} could not be renamed")


class ResultTable:
    """Execution records and the exception log, as two views of one table."""

    COLUMNS = T.StructType([*schema.STEP_RESULT.fields, T.StructField("outcome", T.StringType())])
    PARTITIONS = ["execution_id", "dataset_id", "outcome"]
    BATCHES = T.StructType([*COLUMNS.fields, T.StructField("batch_id", T.LongType())])

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.path = f"{root.rstrip('/')}/results"
        self.batches = f"{root.rstrip('/')}/results_by_batch"

    def _rows(self, execution_id: str | None = None, dataset_id: str | None = None) -> DataFrame:
        """All rows, or those of one execution; then only its folder is listed."""
        folder, where, exact = self.path, F.lit(True), True
        for name, value in (("execution_id", execution_id), ("dataset_id", dataset_id)):
            if value is None:
                break
            where = where & (F.col(name) == value)
            if exact and _PLAIN.fullmatch(value):
                folder = f"{folder}/{name}={value}"
            else:
                exact = False
        rows = _read_or_empty(self.spark, folder, self.COLUMNS, basePath=self.path).where(where)
        by_batch = self.batches
        if execution_id is not None and _PLAIN.fullmatch(execution_id):
            by_batch = f"{by_batch}/execution_id={execution_id}"
        streamed = _read_or_empty(self.spark, by_batch, self.BATCHES, basePath=self.batches).where(where)
        return rows.unionByName(streamed.drop("batch_id"))

    def records(self, execution_id: str | None = None,
                dataset_id: str | None = None) -> DataFrame:
        return self._rows(execution_id, dataset_id).where(
            F.col("outcome") == RECORD).select(*schema.RECORD_COLUMNS)

    def errors(self, execution_id: str | None = None,
               dataset_id: str | None = None) -> DataFrame:
        return self._rows(execution_id, dataset_id).where(
            F.col("outcome") == ERROR).select(*schema.ERROR_COLUMNS)

    def written(self, execution_id: str) -> int:
        """Rows of one execution, good and bad; counted from file footers."""
        return self._rows(execution_id).count()

    def insert(self, results: DataFrame, execution_id: str, balance: bool = True,
               unique: bool = False) -> None:
        """Adds the step results of one execution; keys that are there stay as they are.

        Only the keys of that execution are compared. ``balance`` lets the writers follow
        the partitions, with large ones split and small ones joined, so that many datasets
        do not give many small files; results that still lie as they were read from this
        table need no such shuffle. ``unique`` says that no key is repeated in ``results``.
        """
        rows = self._parted(results, execution_id)
        fresh = rows_to_insert(
            rows, self._rows(execution_id), ["execution_name", "record_data", "exception"],
            [*schema.RECORD_KEY, "outcome"], unique)
        if balance:
            fresh = fresh.hint("rebalance", *self.PARTITIONS)
        fresh.write.mode("append").partitionBy(*self.PARTITIONS).parquet(self.path)

    @staticmethod
    def _parted(results: DataFrame, execution_id: str) -> DataFrame:
        return (
            results.where(F.col("execution_id") == execution_id)
            .select(*schema.RESULT_COLUMNS)
            # an empty partition name is read back as null: so it is compared as null
            .withColumn("dataset_id", F.nullif("dataset_id", F.lit("")))
            .withColumn("outcome", F.when(F.col("exception").isNull(), RECORD).otherwise(ERROR))
        )

    def insert_batch(self, results: DataFrame, execution_id: str, batch_id: int) -> None:
        """Adds the step results of one micro-batch of a stream, whose state keeps keys apart.

        Nothing that is stored is read. A batch written again replaces what it wrote.
        """
        rows = self._parted(results, execution_id).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        parts = ["execution_id", "batch_id", "dataset_id", "outcome"]
        rows.hint("rebalance", *self.PARTITIONS).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(self.batches)


class ProgressLog:
    """One small file per commit; the state of a task is a sum over its commits.

    Commit 0 registers the task and counts for nothing. Writing a commit again replaces it.
    """

    COLUMNS = T.StructType([
        T.StructField("written", T.LongType()),
        T.StructField("repeated", T.LongType()),
        T.StructField("task_id", T.LongType()),
        T.StructField("commit_id", T.LongType()),
    ])

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _write(self, task_id: int, commit_id: int, written: int, repeated: int = 0) -> None:
        self.spark.range(1).select(
            F.lit(written).cast("bigint").alias("written"),
            F.lit(repeated).cast("bigint").alias("repeated")).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/task_id={task_id}/commit_id={commit_id}")

    def _task(self, task_id: int) -> DataFrame:
        return _read_or_empty(
            self.spark, f"{self.path}/task_id={task_id}", self.COLUMNS, basePath=self.path)

    def find(self, task_id: int) -> tuple[int, int] | None:
        """(commits, written) of a task, or None."""
        row = self._task(task_id).agg(
            F.count(F.lit(1)).alias("rows"), F.sum("written").alias("written")).first()
        return (row["rows"] - 1, row["written"]) if row["rows"] else None

    def register(self, task_id: int | None = None) -> int:
        """Registers the task if it is absent; without an id, a new task.

        Gives the id back.
        """
        if task_id is None:
            task_id = new_task_id()
        elif self.find(task_id) is not None:
            return task_id
        self._write(task_id, 0, 0)
        return task_id

    def add(self, task_id: int, commit_id: int, written: int, repeated: int = 0) -> None:
        """Adds a commit, numbered from 1: rows stored, and rows left out because their key was there."""
        self._write(task_id, commit_id, written, repeated)

    def repeats(self) -> DataFrame:
        """(task_id, repeated): how many rows of each task came again and were not stored."""
        return _read_or_empty(self.spark, self.path, self.COLUMNS).groupBy("task_id").agg(
            F.coalesce(F.sum("repeated"), F.lit(0)).alias("repeated"))

    def set_written(self, task_id: int, total: int) -> None:
        """Adds the commit that brings the task to ``total`` rows."""
        commits, written = self.find(task_id) or (0, 0)
        self.add(task_id, commits + 1, total - written)

    def state(self) -> DataFrame:
        """(task_id, commit_count, write_count) of every task."""
        return _read_or_empty(self.spark, self.path, self.COLUMNS).groupBy("task_id").agg(
            F.count_if(F.col("commit_id") > 0).alias("commit_count"),
            F.sum("written").alias("write_count"))


class ChangeTable:
    """Keyed state: append versions, read the latest row per key.

    ``compact`` folds the versions so far into a base; from then on only later versions
    are merged with it. Versions are never deleted, so any of them can be written again.
    """

    def __init__(self, spark: SparkSession, path: str, columns: T.StructType,
                 keys: Sequence[str]):
        self.spark, self.keys = spark, list(keys)
        self.path = path.rstrip("/")
        self.names = [f.name for f in columns.fields]
        self.columns = T.StructType([
            *columns.fields,
            T.StructField("removed", T.BooleanType()),
            T.StructField("version", T.LongType()),
        ])
        self.base_columns = T.StructType([*columns.fields, T.StructField("upto", T.LongType())])

    def write(self, rows: DataFrame, version: int, removed: bool | Column = False) -> None:
        """Writes ``rows`` (one per key) as ``version``; a repeat replaces the version."""
        flag = removed if isinstance(removed, Column) else F.lit(removed)
        rows.select(*self.names, flag.alias("removed")).write.mode("overwrite").parquet(
            f"{self.path}/changes/version={version}")

    def write_one(self, row: Mapping[str, object], version: int, removed: bool = False) -> None:
        """The same of a single row that the driver holds: one file, and no job to write it."""
        columns = T.StructType([f for f in self.columns.fields if f.name != "version"])
        one = pa.Table.from_pylist([{**row, "removed": removed}], to_arrow_schema(columns))
        content = pa.BufferOutputStream()
        pq.write_table(one, content)
        _replace_folder(self.spark, f"{self.path}/changes/version={version}", content.getvalue().to_pybytes())

    def _bases(self) -> DataFrame:
        return _read_or_empty(self.spark, f"{self.path}/base", self.base_columns)

    def _base_version(self, before: int | None) -> int | None:
        bases = self._bases()
        if before is not None:
            bases = bases.where(F.col("upto") < before)
        return bases.agg(F.max("upto")).first()[0]

    def state(self, before: int | None = None, base_before: int | None = None,
              columns: Sequence[str] | None = None) -> DataFrame:
        """The latest row of each key, removed keys left out.

        ``before`` leaves out that version and later ones, which is how a repeated
        batch sees the state it saw the first time. ``base_before`` starts from an
        older base. With ``columns`` only those are read, and the keys.
        """
        names = self.names if columns is None else [n for n in self.names if n in columns or n in self.keys]
        changes = _read_or_empty(self.spark, f"{self.path}/changes", self.columns).select(
            *names, "removed", "version")
        if before is not None:
            changes = changes.where(F.col("version") < before)
        upto = self._base_version(before if base_before is None else base_before)
        if upto is not None:
            changes = changes.where(F.col("version") > upto)
        latest = latest_per_key(changes, self.keys, ["version"])
        there = latest.where(~F.col("removed")).select(*names)
        if upto is None:
            return there
        # The base is not grouped: only rows that changed since are taken out of it.
        base = self._bases().where(F.col("upto") == upto).select(*names)
        return base.join(latest.select(*self.keys), self.keys, "left_anti").select(
            *names).unionByName(there)

    def compact(self, upto: int) -> None:
        """Folds all versions up to ``upto`` into a new base; a repeat replaces it."""
        self.state(before=upto + 1, base_before=upto).write.mode("overwrite").parquet(
            f"{self.path}/base/upto={upto}")
