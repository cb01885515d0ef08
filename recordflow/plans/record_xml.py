"""The XML form in which records pass from transformation to the index.

Steps read the fields they know from the parsed record, and change the record in place: what a
step does not know is carried on as it is written, what stands between elements too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordflow.functions import elements, text

SINGLE = ("about", "datasetName", "country", "language", "title", "description", "mainThumbnail")
MANY = ("link", "concept", "resource")
FIELDS = ", ".join(f"{name} string" for name in SINGLE)

MALFORMED = "malformed record"


def with_parsed(records: DataFrame) -> DataFrame:
    """Adds ``scan`` (the record in parts) and ``xml`` (its fields by name), each once for all uses.

    The parser says whether a record is well formed and reads single fields. Lists come from the parts,
    because the parser copies a list for each item. What the parser refuses is not cut into parts: it may have
    a mark at every third character, and its parts are of no use to a step.
    """
    data = F.col("record_data")
    parsed = records.withColumn("fields", text.parse_xml(data, FIELDS, {"ignoreNamespace": "true"}))
    refused = F.col("fields.malformed").isNotNull()
    scanned = parsed.withColumn("scan", F.when(~refused, elements.scanned(data)))
    broken = refused | F.col("scan").isNull()

    def values(name: str) -> Column:
        return F.when(~broken, F.transform(F.filter("scan.parts", lambda p: p["name"] == name), elements.value_of))

    return scanned.withColumn("xml", F.struct(
        *[F.col(f"fields.{name}") for name in SINGLE], *[values(name).alias(name) for name in MANY],
        F.when(broken, MALFORMED).alias("malformed"))).drop("fields")


def malformed() -> Column:
    return F.col("xml.malformed")


def name_of(part: Column) -> Column:
    """The local name of an element; empty for what stands between two."""
    return F.coalesce(part["name"], F.lit(""))


def rebuilt(parts: Column) -> Column:
    """The record in its own frame, of the given parts."""
    # put together in one go, as a text may be long; null where there are no parts
    texts = F.transform(parts, lambda p: F.array(p["open"], p["inner"], p["close"]))
    return F.when(F.col("scan").isNotNull(), F.concat_ws("", "scan.head", F.flatten(texts), "scan.tail"))


def with_added(data: Column, root: Column, tail: Column, added: Column) -> Column:
    """A record, given its root's name and what it ends with from the root's end tag on, with more
    elements before that."""
    body = F.left(data, F.length(data) - F.length(tail))
    # a root without anything in it has no end tag yet
    empty = body.endswith("/>") & ~tail.startswith("</")
    return F.when(added == "", data).when(empty, F.concat(
        F.left(body, F.length(body) - 2), F.lit(">"), added, F.lit("</"), root, F.lit(">"), tail)).otherwise(
        F.concat(body, added, tail))
