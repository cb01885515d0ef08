"""The rule tables and mapping that the checks apply to the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordflow import schema
from recordflow.functions import text
from recordflow.operators import validate
from recordflow.operators.transform import Rule
from recordflow.plans import bindings


def external_rules() -> dict:
    data = F.col("record_data")
    return {
        "R1 shorter than 100 characters": F.length(data) >= 100,
        "R2 one line only": F.contains(data, F.lit("\n")),
        "R3 language not supported": F.col("lang").isin("en", "fr", "de"),
    }


def internal_rules() -> dict:
    lines = text.lines(F.col("record_data"))
    return {
        "R4 line over 2000 characters": F.array_max(F.transform(lines, F.length)) <= 2000,
        "R5 repeated line": F.size(F.array_distinct(lines)) == F.size(lines),
        "R6 empty line": ~F.array_contains(lines, ""),
    }


def validated(tables: bindings.Tables) -> DataFrame:
    return validate.validate(
        bindings.document_records(tables, "lang"), schema.VALIDATION_EXTERNAL,
        external_rules(), "E1")


MAPPING = (
    Rule("title", "split(record_data, '\\n')[0]", required=True),
    Rule("size", "cast(length(record_data) as string)"),
    Rule("year", "nullif(regexp_extract(record_data, '\\\\b(1[0-9]{3}|20[0-9]{2})\\\\b', 1), '')",
         default="unknown"),
    Rule("line", "split(record_data, '\\n')", many=True),
)
