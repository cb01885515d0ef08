"""What the operators of this subpackage share: tables, lineage cuts, words."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of other characters than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers ``function(spark, folder)`` under ``name``, with the SQL that must match."""
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared checkpoint folder and read from there.

    Cuts lineage and fixes what was computed, also against lost executors. The folder is the
    session's ``spark.checkpoint.dir``; a session without one (tests) gets a temporary folder,
    and only a local session may.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(_shared(spark))
    return df.checkpoint()


def _shared(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoints-")
    return folder.rstrip("/")


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared one for tables between jobs; its owner may delete it
    when the result has been read."""
    return f"{_shared(spark)}/{purpose}-{uuid.uuid4().hex}"


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Sends whole texts to Python ``rows`` at a time instead of Spark's default of 10,000, which
    long texts would make a gigabyte. A session that has set its own number keeps it."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(rows))


#: What forgets the tables that a worker keeps, by their owner.
_KEPT: dict[str, Callable[[], object]] = {}


def take_over(owner: str, forget: Callable[[], object] | None = None) -> None:
    """Called in a worker before it works for ``owner``: tables that other operators left there are
    forgotten and their memory is given back, since Spark hands a worker on from stage to stage.
    ``forget`` empties the tables that ``owner`` will keep."""
    others = [name for name in _KEPT if name != owner]
    for name in others:
        _KEPT.pop(name)()
    if others:
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
        if trim is not None:
            trim(0)
    if forget is not None:
        _KEPT[owner] = forget


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that :func:`scratch` named."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def n_words(text: Column) -> Column:
    """Number of words; null texts have none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the frame does not have yet, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns of a row (maps as JSON, which the hash function doesn't take)."""
    return F.xxhash64(*[
        F.to_json(F.struct(f"`{f.name}`")) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`")
        for f in df.schema])
