"""Harvest pages and content files that have been landed on a shared file system."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordflow.functions import elements


def read_headers(spark: SparkSession, pages: str, set_spec: str | None = None) -> DataFrame:
    """Headers of all listing pages in a folder: identifier, deleted, datestamp, sets.

    ``set_spec`` chooses those of one set or of a set below it (``a:b`` lies below ``a``).
    """
    headers = (
        spark.read.schema("_status string, identifier string, datestamp string, setSpec array<string>")
        .xml(pages, rowTag="header")
        .select(
            "identifier",
            F.coalesce(F.col("_status") == "deleted", F.lit(False)).alias("deleted"),
            F.to_timestamp("datestamp").alias("datestamp"),
            F.coalesce("setSpec", F.array().cast("array<string>")).alias("sets"),
        )
    )
    return headers if set_spec is None else headers.where(in_set(F.col("sets"), set_spec))


def in_set(sets: Column, set_spec: str) -> Column:
    return F.exists(sets, lambda s: (s == set_spec) | s.startswith(F.lit(f"{set_spec}:")))


def read_records(spark: SparkSession, pages: str, set_spec: str | None = None, packed: bool = False) -> DataFrame:
    """Records of all landed pages: identifier, deleted, datestamp, sets, and the metadata part as it
    is written, with its entities, CDATA and namespaces.

    A page is one row, as large as its provider made it. A page that is no XML fails the harvest: its
    records would be missing without a word. A file is a page, or, if they are ``packed``
    (:func:`pack_pages`), a row of a Parquet file is one: many small pages are no small files then.
    """
    landed_pages = spark.read.schema("value string").parquet(pages) if packed else spark.read.text(pages, wholetext=True)
    page = landed_pages.select(
        F.col("_metadata.file_path").alias("page"), elements.scanned(F.col("value")).alias("scan"))
    page = page.withColumn("scan", F.when(F.col("scan").isNull(), F.raise_error(
        F.concat(F.lit("page is no listing: "), F.col("page")))).otherwise(F.col("scan")))
    # records lie below the root, or below the answer to a request
    lists = F.filter("scan.parts", lambda p: p["name"].isin("ListRecords", "GetRecord"))
    answers = F.transform(lists, lambda p: elements.scanned(elements.written(p))["parts"])
    records = page.select(F.explode(F.filter(
        F.flatten(F.concat(F.array("scan.parts"), answers)), lambda p: p["name"] == "record")).alias("record"))
    parts = records.select(elements.scanned(elements.written(F.col("record")))["parts"].alias("parts"))
    header = elements.scanned(elements.written(_named(F.col("parts"), "header")))["parts"]
    read = parts.select("parts", _named(F.col("parts"), "header")["open"].alias("open"), header.alias("header"))
    found = read.select(
        elements.value_of(_named(F.col("header"), "identifier")).alias("identifier"),
        F.col("open").rlike("\\sstatus\\s*=\\s*[\"']deleted[\"']").alias("deleted"),
        F.to_timestamp(elements.value_of(_named(F.col("header"), "datestamp"))).alias("datestamp"),
        F.transform(F.filter("header", lambda p: p["name"] == "setSpec"), elements.value_of).alias("sets"),
        F.trim(_named(F.col("parts"), "metadata")["inner"], F.lit(" \t\r\n")).alias("content"))
    return found if set_spec is None else found.where(in_set(F.col("sets"), set_spec))


def pack_pages(pages: DataFrame, folder: str) -> None:
    """Lands pages (``value``) as rows of Parquet files, as many files as ``pages`` has partitions."""
    pages.select("value").write.parquet(folder)


def _named(parts: Column, name: str) -> Column:
    """The first element of a name."""
    return F.get(F.filter(parts, lambda p: p["name"] == name), F.lit(0))


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every file of a folder as one row: its path and its whole content."""
    return spark.read.text(folder, wholetext=True).select(
        F.col("_metadata.file_path").alias("file_url"), F.col("value").alias("content"))
