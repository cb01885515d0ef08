"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Everything else is left to the cluster's own defaults.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # noting the caller's place costs two calls to the engine for each column expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


SHUFFLE_BYTES = 256 << 20


def size_settings(input_bytes: int, cores: int, most_partitions: int | None = None) -> dict[str, str]:
    """Partition counts for a job that shuffles about ``input_bytes``.

    Spark's default of 200 partitions would make each one 500 GB for 100 TB. Partitions
    start small enough for a task's memory; adaptive execution joins those that turn out
    small. There are at least two per core. ``most_partitions`` is for clusters whose driver can't
    track so many: partitions are larger then, and need the memory for it.
    """
    wanted = max(-(-input_bytes // SHUFFLE_BYTES), 2 * cores)
    return {
        "spark.sql.shuffle.partitions": str(min(wanted, most_partitions or wanted)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHUFFLE_BYTES),
    }


def build_session(app_name: str = "recordflow", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def task_count(spark: SparkSession) -> int:
    """Tasks for costly work on rows that a source gives in few partitions: some for each core, and no fewer than a shuffle has."""
    return max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), "recordflow")


def new_work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of the shared folder, never used before."""
    return f"{shared_folder(spark)}/recordflow/{purpose}-{uuid.uuid4().hex}"
