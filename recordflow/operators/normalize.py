"""Normalization of record text, statements, languages and dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordflow import schema
from recordflow.functions import text
from recordflow.operators.project import step_result

NOTHING_LEFT = "nothing left after normalization"


def normalized_statements(record_data: Column) -> Column:
    """Clean lines without empty ones and repeats, each where it first stood."""
    return F.nullif(F.array_join(text.distinct_lines(record_data), "\n"), F.lit(""))


def normalize(records: DataFrame, execution_id: str) -> DataFrame:
    """Records of plain lines, cleaned; a record with nothing left is an error."""
    cleaned = records.withColumn("_clean", normalized_statements(F.col("record_data")))
    return step_result(
        cleaned, execution_id, schema.NORMALIZATION, F.col("_clean"),
        F.when(F.col("_clean").isNull(), F.lit(NOTHING_LEFT)))


def clean_values(values: Column) -> Column:
    """Array items trimmed, white space collapsed, empty ones and repeats dropped."""
    cleaned = F.transform(values, text.collapse_spaces)
    return F.array_distinct(F.filter(cleaned, lambda v: v != ""))
