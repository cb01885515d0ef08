"""Messages and text lines; the same functions serve batch and stream frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE = "taskId bigint, recordId string, markedAsDeleted boolean"


def topic_messages(spark: SparkSession, servers: str, topics: list[str],
                   job_name: str, most: int = 100_000) -> DataFrame:
    """An unbounded frame of a message topic. The connector's jar must be on the class path.

    Committed offsets live in the query's checkpoint; a first run starts at the end. A
    micro-batch takes ``most`` messages at most, also after a pause.
    """
    return decode_messages(
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("groupIdPrefix", job_name)
        .option("startingOffsets", "latest")
        .option("maxOffsetsPerTrigger", most)
        .load())


def decode_messages(frame: DataFrame, *keep: str) -> DataFrame:
    """The ``value`` column, JSON as text or bytes, to (task_id, record_id, marked_as_deleted)."""
    message = F.from_json(F.col("value").cast("string"), MESSAGE)
    return frame.select(*keep, message.alias("m")).select(
        *keep,
        F.col("m.taskId").alias("task_id"),
        F.col("m.recordId").alias("record_id"),
        F.coalesce("m.markedAsDeleted", F.lit(False)).alias("marked_as_deleted"),
    )


def _tokens(frame: DataFrame) -> DataFrame:
    # Empty tokens at the end of a line do not count.
    return frame.withColumn("token", F.split(F.rtrim("value"), " "))


def parse_task_lines(frame: DataFrame) -> DataFrame:
    """``taskId taskName fileUrl`` lines; lines of any other length are left out."""
    return _tokens(frame).where(F.size("token") == 3).select(
        F.col("token")[0].alias("task_id"),
        F.col("token")[1].alias("task_name"),
        F.col("token")[2].alias("file_url"),
    )


def parse_cancelled_ids(frame: DataFrame) -> DataFrame:
    """One row per task id; a line may hold many."""
    return _tokens(frame).select(F.explode("token").alias("task_id")).where(F.col("task_id") != "")
