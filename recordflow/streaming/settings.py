"""Running queries to the end of what has landed, and state store settings."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

# Keyed state with expiry needs this store. Without the second setting, a bounded run with
# a processing-time state would go on with empty batches for ever.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


# On a local disk Hadoop asks for links and sets permissions by commands: Spark's default manager starts ten
# processes for each file of a checkpoint, this one two. Both rename a file that is whole.
CHECKPOINT_MANAGER = "spark.sql.streaming.checkpointFileManagerClass"
LOCAL_MANAGER = "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"


@contextmanager
def _held(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextmanager
def state_settings(spark: SparkSession) -> Iterator[None]:
    """Holds while a stateful query is started; a query keeps what it was started with."""
    with _held(spark, STATE_SETTINGS):
        yield


@contextmanager
def checkpoint_settings(spark: SparkSession, folder: str) -> Iterator[None]:
    """Holds while bounded queries with checkpoints in ``folder`` are started and run: a source sets up its log
    after the start. Only a local disk has settings of its own; a manager that the session names stays."""
    files = spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    plain = files.getScheme() != "file" or spark.conf.get(CHECKPOINT_MANAGER, None)
    with _held(spark, {} if plain else {CHECKPOINT_MANAGER: LOCAL_MANAGER}):
        yield


def landed_stream(spark: SparkSession, folder: str, schema, max_files: int = 1000,
                  file_format: str = "parquet") -> DataFrame:
    """Files of a folder as an unbounded frame; ``max_files`` bounds one micro-batch."""
    return (
        spark.readStream.format(file_format).schema(schema)
        .option("maxFilesPerTrigger", max_files).load(folder)
    )


def start(writer: DataStreamWriter, checkpoint: str, name: str | None = None,
          interval: str | None = None) -> StreamingQuery:
    """Starts a query: every ``interval``, or over what has landed so far and then ends.

    The checkpoint holds offsets and state, so a query started again goes on.
    """
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if interval:
        return writer.trigger(processingTime=interval).start()
    return writer.trigger(availableNow=True).start()


def finish(query: StreamingQuery, seconds: int | None = None) -> None:
    """Waits for a bounded query, however long it takes.

    With ``seconds``, as in tests, a query that takes longer is stopped and fails.
    """
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()
        raise TimeoutError(f"query {query.name or query.id} still ran after {seconds} s")


def finish_all(starts: Iterable[Callable[[], StreamingQuery]], seconds: int | None = None) -> None:
    """Starts bounded queries side by side and waits for all; where one fails, the others are stopped."""
    queries = []
    try:
        queries.extend(one() for one in starts)
        for query in queries:
            finish(query, seconds)
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
