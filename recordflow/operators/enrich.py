"""Enrichment: references of a record are looked up in an entity table.

References are exploded without the record text, looked up by an equi join, folded back
per record and only then joined to the text. Spark broadcasts the entity table when it
is known to be small, and otherwise splits hot references (adaptive skew join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordflow import schema
from recordflow.functions import text
from recordflow.functions.keyed import null_safe_join
from recordflow.operators.project import step_result

CONTINUE, STOP = "CONTINUE", "STOP"
KEY = ["dataset_id", "record_id"]


def lookup_references(references: DataFrame, entities: DataFrame) -> DataFrame:
    """Adds ``label`` and ``resolved`` to rows with a ``reference`` column.

    ``entities`` (reference, label) has one row per reference.
    """
    known = entities.select("reference", "label").withColumn("resolved", F.lit(True))
    return references.join(known, "reference", "left").withColumn(
        "resolved", F.coalesce("resolved", F.lit(False)))


def enrich_entities(references: DataFrame, entities: DataFrame) -> DataFrame:
    """Each entity of each record once, with the number of references to it.

    Rows (record_id, reference). References are counted before the lookup, so a record
    or an entity with very many of them sends one row per map task. The result stays in
    rows: a record's entity list may be too long for one.
    """
    counted = references.groupBy("record_id", "reference").agg(
        F.count(F.lit(1)).alias("references"))
    return lookup_references(counted, entities)


def enrich_report(references: DataFrame, entities: DataFrame) -> DataFrame:
    """Per record: references found and not found, status and report."""
    looked_up = enrich_entities(references, entities)
    totals = looked_up.groupBy("record_id").agg(
        F.sum(F.when(F.col("resolved"), F.col("references")).otherwise(0)).alias("found"),
        F.sum(F.when(~F.col("resolved"), F.col("references")).otherwise(0)).alias("not_found"),
    )
    return totals.withColumns({
        "status": F.when(F.col("not_found") > 0, STOP).otherwise(CONTINUE),
        "exception": F.when(F.col("not_found") > 0, F.concat(
            F.col("not_found").cast("string"), F.lit(" of "),
            (F.col("found") + F.col("not_found")).cast("string"),
            F.lit(" references not found"))),
    })


def record_references(records: DataFrame, references: Column) -> DataFrame:
    """Rows (dataset_id, record_id, place, reference) of the references inside each record."""
    return text.numbered_items(records, KEY, references, "place", "reference")


def fold_references(looked_up: DataFrame) -> DataFrame:
    """Back to one row per record: the labels found, in order, and the report lines.

    All rows of a record come from one record's own text, which bounds the lists.
    """
    listed = looked_up.groupBy(*KEY).agg(
        F.array_sort(F.collect_list(F.struct("place", "reference", "label", "resolved")))
        .alias("item"))
    found = F.filter("item", lambda i: i["resolved"])
    lost = F.filter("item", lambda i: ~i["resolved"])
    return listed.select(
        *KEY,
        F.transform(found, lambda i: i["label"]).alias("labels"),
        F.transform(lost, lambda i: F.concat(F.lit("not found: "), i["reference"]))
        .alias("reports"),
    )


def enrich(records: DataFrame, references: Column, entities: DataFrame,
           enriched: Column, execution_id: str, tolerate: bool = False,
           failure: Column | None = None) -> DataFrame:
    """Records with their entities added.

    ``references`` is an array column of a record; ``enriched`` builds the new data from
    the record and the ``labels`` array. Unresolved references stop the record, with one
    report line each; with ``tolerate`` only a record of which none resolves is stopped.
    ``failure`` says of a record why it can't be enriched at all, null where it can.
    """
    folded = fold_references(lookup_references(record_references(records, references), entities))
    joined = null_safe_join(records, folded, KEY, "left").withColumns({
        "labels": F.coalesce("labels", F.array().cast("array<string>")),
        "reports": F.coalesce("reports", F.array().cast("array<string>")),
    })
    stopped = F.size("reports") > 0
    if tolerate:
        stopped = stopped & (F.size("labels") == 0)
    return step_result(
        joined, execution_id, schema.ENRICHMENT, enriched,
        F.coalesce(F.lit(None).cast("string") if failure is None else failure,
                   F.when(stopped, F.array_join("reports", "\n"))))
