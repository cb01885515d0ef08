"""From raw documents to training tokens.

``STAGES`` are (name, function): each function takes (spark, docs, folder of the tables) and
returns a DataFrame; it is written as Parquet and read again as the next one's docs. All but the
last return the columns of ``documents``.

Defined cases: a null text is an empty one to every stage, and has no ids at the end. Null and repeated
ids are rows like any other; of equal rows one stays, as near-duplicates. A null source is a source.
Columns beyond those of ``documents`` are dropped. Without labels no document is rejected; an empty table
gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordflow.llm import byte_bpe, mixing, pii, quality, simhash
from recordflow.llm.common import n_words, query, remove, scratch, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality classifier, learnt from labels of these documents, doesn't reject."""
    model = quality.fit(docs, table(spark, folder, "labels"))
    return quality.scored(docs, model).where("predicted = 1").select(*COLUMNS)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near-duplicates: fingerprints that differ in few bits."""
    return simhash.drop_near_copies(docs, width=simhash.WIDTH, radius=simhash.RADIUS).select(*COLUMNS)


def replace_private(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Personal data and secrets replaced; ``n_chars`` follows the text."""
    return pii.replaced(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in training order, each as often as the mix takes it. The order is that of the files written."""
    mixed = mixing.mix(docs, n_words(F.col("text")), mixing.order_key(F.col("doc_id"), F.col("text")))
    return mixing.training_order(mixed).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit integers, packed) and whether they decode to the text.

    ``part, place`` keep the training order: number of the file that a document was read from and
    its row there. Reading deals the files out in any order, so rows are told apart by these alone.
    """
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    file = F.col("_metadata.file_name")
    whole = docs.select(
        "doc_id", "source", "lang", F.coalesce("text", F.lit("")).alias("text"),
        F.regexp_extract(file, r"^part-(\d+)", 1).cast("long").alias("part"), F.col("_metadata.row_index").alias("place"))
    both = byte_bpe.round_trip(whole, path, pattern)
    return both.select(
        "doc_id", "source", "lang", F.col("both.ids").alias("ids"), (F.length("both.ids") / 4).cast("long").alias("n_tokens"),
        (F.col("both.decoded") == F.col("text")).alias("round_trip"), "part", "place")


STAGES = [
    ("quality classifier", keep_quality),
    ("simhash near-dedup", keep_one_of_near_copies),
    ("pii", replace_private),
    ("source mixing", mix_sources),
    ("byte-level bpe", encode),
]

#: Classifier, fingerprints and tokens have no form in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return out
        out.write.parquet(f"{folder}/{i}")
        if i:
            remove(spark, f"{folder}/{i - 1}")  # nothing reads it any more
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs


query("pipeline", ORACLE_SQL)(run)
