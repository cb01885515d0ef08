"""What the message-topic job stores: representations by version, and the log of revisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordflow.sinks.bucketed import AppendTable
from recordflow.sinks.tables import _read_or_empty

REPRESENTATION = T.StructType([
    T.StructField("cloud_id", T.StringType()), T.StructField("representation_name", T.StringType()),
    T.StructField("version", T.StringType()), T.StructField("mime_type", T.StringType()),
    T.StructField("file_content", T.BinaryType()),
])
REVISION = T.StructType([
    T.StructField("resource", T.StringType()), T.StructField("provider_id", T.StringType()),
    T.StructField("name", T.StringType()), T.StructField("timestamp", T.TimestampType()),
    T.StructField("deleted", T.BooleanType()), T.StructField("batch_id", T.LongType()),
])


class Representations:
    """Versioned files of records, keyed by record, name and version. The version follows from the
    task and the record, so a message that comes again names the same one and stores nothing."""

    KEY = ("cloud_id", "representation_name", "version_id")

    def __init__(self, spark: SparkSession, root: str):
        columns = T.StructType([
            T.StructField("version_id" if f.name == "version" else f.name, f.dataType) for f in REPRESENTATION.fields])
        self.table = AppendTable(spark, f"{root.rstrip('/')}/representations", columns, self.KEY)

    def write(self, written: DataFrame, batch_id: int) -> None:
        """Stores the files of written items (``new_version``, ``file_content``, ...); items without a
        version, deleted ones, have none."""
        self.table.insert(written.where(F.col("new_version").isNotNull()).select(
            "cloud_id", F.col("new_representation_name").alias("representation_name"), F.col("new_version").alias("version_id"),
            F.col("output_mime_type").alias("mime_type"), "file_content"), batch_id)

    def state(self) -> DataFrame:
        return self.table.state().withColumnRenamed("version_id", "version")


class Revisions:
    """An append-only log, one folder per batch; a batch that is run again replaces its own."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.path = spark, f"{root.rstrip('/')}/revisions"

    def write(self, revised: DataFrame, batch_id: int) -> None:
        """Stores the revision of each item that has one (:func:`.publish.add_revision`)."""
        revised.where(F.col("revision_resource").isNotNull()).select(
            F.col("revision_resource").alias("resource"), F.col("revision_provider_id").alias("provider_id"),
            F.col("revision_name").alias("name"), F.col("revision_timestamp").alias("timestamp"),
            F.col("marked_as_deleted").alias("deleted")).write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def rows(self) -> DataFrame:
        return _read_or_empty(self.spark, self.path, REVISION)
