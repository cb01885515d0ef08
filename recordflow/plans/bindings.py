"""The given tables in the shapes of records, headers, references and messages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordflow import schema
from recordflow.functions import text

HARVEST_ID = "E0"
LINK = '<a href="([^"]*)"'


class Tables:
    """``Tables(spark, folder).documents`` reads ``folder/documents.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def document_records(tables: Tables, *more: str) -> DataFrame:
    """Documents as harvested records: source → dataset, doc_id → record id."""
    return tables.documents.select(
        F.col("source").alias("dataset_id"),
        F.lit(HARVEST_ID).alias("execution_id"),
        F.lit(schema.HARVEST).alias("execution_name"),
        F.col("doc_id").cast("string").alias("record_id"),
        F.col("text").alias("record_data"),
        *more,
    )


def turn_records(tables: Tables, execution_id: str = "E1") -> DataFrame:
    """Conversation turns as records of another execution."""
    return tables.conversations.select(
        F.concat(F.lit("turns_"), "role").alias("dataset_id"),
        F.lit(execution_id).alias("execution_id"),
        F.lit(schema.HARVEST).alias("execution_name"),
        F.concat_ws("/", "conv_id", "turn").alias("record_id"),
        F.col("text").alias("record_data"),
    )


def page_records(tables: Tables) -> DataFrame:
    """Pages as records: top-level domain → dataset, page_id → record id."""
    return tables.pages.select(
        F.regexp_extract("url", "example\\.([a-z]+)", 1).alias("dataset_id"),
        F.lit(HARVEST_ID).alias("execution_id"),
        F.lit(schema.HARVEST).alias("execution_name"),
        F.col("page_id").cast("string").alias("record_id"),
        F.col("html").alias("record_data"),
    )


def page_links() -> Column:
    """All link targets of a page, in order."""
    return F.regexp_extract_all("record_data", F.lit(LINK), 1)


def labelled(tables: Tables) -> DataFrame:
    """Documents with their labels; unlabelled ones have 0 for both."""
    return tables.documents.join(tables.labels, "doc_id", "left").withColumns({
        "quality": F.coalesce("quality", F.lit(0)), "toxic": F.coalesce("toxic", F.lit(0))})


def headers(tables: Tables) -> DataFrame:
    """Documents as a listing: one minute apart, toxic ones deleted."""
    return labelled(tables).select(
        F.format_string("doc:%08d", "doc_id").alias("identifier"),
        (F.col("toxic") == 1).alias("deleted"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("doc_id") * 60).alias("datestamp"),
    )


def document_content(tables: Tables) -> DataFrame:
    """The content side of the listing; Spanish documents cannot be fetched."""
    return tables.documents.where("lang <> 'es'").select(
        F.format_string("doc:%08d", "doc_id").alias("identifier"),
        F.col("text").alias("content"),
    )


def words(frame: DataFrame, *keep: str) -> DataFrame:
    """One row per word of ``text``."""
    return frame.select(*keep, F.explode(F.split(text.collapse_spaces(F.col("text")), " "))
                        .alias("word")).where("word <> ''")


def vocabulary(tables: Tables) -> DataFrame:
    """Entities (reference, label): the words of the benchmark items."""
    return words(tables.benchmark).groupBy(F.lower("word").alias("reference")).agg(
        F.min("word").alias("label"))


def resource_metadata(tables: Tables) -> DataFrame:
    """Metadata of resources: a word of a conversation is a page of that name."""
    return words(tables.conversations).groupBy("word").agg(
        F.count(F.lit(1)).alias("bytes")).select(
        F.concat(F.lit("/"), "word").alias("resource"),
        F.when(F.length("word") > 3, "text/html").otherwise("image/jpeg").alias("mime"),
        "bytes",
    )


def part_references(tables: Tables) -> DataFrame:
    """Order lines as references from an order to a part."""
    return tables.lineitem.select(
        F.col("l_orderkey").cast("string").alias("record_id"),
        F.col("l_partkey").alias("reference"),
    )


def part_entities(tables: Tables) -> DataFrame:
    """Parts as entities; those over size 45 are not known."""
    return tables.part.where("p_size <= 45").select(
        F.col("p_partkey").alias("reference"), F.col("p_name").alias("label"))


def raw_messages(tables: Tables) -> DataFrame:
    """Events as topic messages: JSON text in ``value``."""
    url = F.concat(
        F.lit("http://repository.test/records/R"), F.col("event_id").cast("string"),
        F.lit("/representations/"), F.col("event_type"),
        F.lit("/versions/V"), F.get_json_object("props", "$.k"))
    return tables.events.select("ts", "event_id", F.to_json(F.struct(
        F.col("user_id").alias("taskId"),
        url.alias("recordId"),
        (F.col("event_type") == "signup").alias("markedAsDeleted"),
    )).alias("value"))


def task_params(tables: Tables) -> DataFrame:
    """Suppliers as tasks; those in debt name no mime type."""
    return tables.supplier.select(
        F.col("s_suppkey").alias("task_id"),
        F.timestamp_seconds("s_suppkey").alias("sent_date"),
        F.when(F.col("s_acctbal") >= 1000, "application/xml").alias("output_mime_type"),
        F.concat(F.lit("provider"), F.col("s_nationkey").cast("string")).alias("provider_id"),
        F.concat(F.lit("set"), F.col("s_suppkey").cast("string")).alias("task_dataset_id"),
        F.lit("normalized").alias("new_representation_name"),
        F.col("s_name").alias("revision_provider_id"),
        F.lit("NORMALIZED").alias("revision_name"),
        F.timestamp_seconds("s_suppkey").alias("revision_timestamp"),
    )


def notification_events(tables: Tables) -> DataFrame:
    """Events as processed items of a task."""
    kind = F.col("event_type")
    return tables.events.select(
        F.col("user_id").alias("task_id"),
        "ts", "event_id",
        F.when(kind == "error", "STOP").otherwise("CONTINUE").alias("status"),
        (kind == "signup").alias("deleted"),
        (kind == "view").alias("ignored"),
        (kind == "error").alias("failed"),
    )


def task_lines(tables: Tables) -> DataFrame:
    """Events as text lines; errors lack the file, views have a word too many, signups
    end in blanks."""
    kind = F.col("event_type")
    head = F.concat_ws(" ", F.col("user_id").cast("string"), kind)
    full = F.concat(head, F.lit(" file"), F.col("event_id").cast("string"))
    return tables.events.select(
        F.when(kind == "error", head)
        .when(kind == "view", F.concat(full, F.lit(" more")))
        .when(kind == "signup", F.concat(full, F.lit("  ")))
        .otherwise(full).alias("value"))


def union(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
