"""Good and bad records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordflow import schema

# How an error names a record that has no final id yet.
LISTED_PREFIX = "/oaiIdentifier/"
HARVESTED_PREFIX = "/externalIdentifier/"


def good_records(results: DataFrame) -> DataFrame:
    return results.where(F.col("exception").isNull()).select(*schema.RECORD_COLUMNS)


def bad_records(results: DataFrame) -> DataFrame:
    return results.where(F.col("exception").isNotNull()).select(*schema.ERROR_COLUMNS)


def error_union(*errors: DataFrame) -> DataFrame:
    """All errors of several steps; repeats stay."""
    first, *rest = errors
    for other in rest:
        first = first.unionByName(other)
    return first


def error_identity(external_id: Column, record_id: Column | None = None,
                   harvested: bool = False) -> Column:
    """The final record id, or a prefixed external id where there is none."""
    named = F.concat(F.lit(HARVESTED_PREFIX if harvested else LISTED_PREFIX),
                     F.coalesce(external_id, F.lit("")))
    return named if record_id is None else F.coalesce(record_id, named)


def error_text(message: Column, kind: str) -> Column:
    """The message of a failure; a failure without one is named by its kind."""
    return F.coalesce(F.nullif(message, F.lit("")), F.lit(kind))
