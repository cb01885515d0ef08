"""Transformation: a mapping from source expressions to the elements of a new record."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordflow import schema
from recordflow.functions import text
from recordflow.operators.project import step_result

ROOT = "record"


@dataclass(frozen=True)
class Rule:
    """One element of the target record.

    ``source`` is a SQL expression over the record frame. An array gives one element per
    item. A null becomes ``default``; without one, a required element fails the record
    and any other is left out.
    """

    target: str
    source: str
    default: str | None = None
    many: bool = False
    required: bool = False


def _element(rule: Rule) -> Column:
    value = F.expr(rule.source)
    if rule.many:
        return text.xml_elements(rule.target, value)
    if rule.default is not None:
        value = F.coalesce(value, F.lit(rule.default))
    return F.coalesce(text.xml_element(rule.target, value), F.lit(""))


def mapped_record(rules: Sequence[Rule], injected: Mapping[str, Column]) -> Column:
    """The record as XML: injected parameters first, then the rules in their order."""
    parts = [
        F.coalesce(text.xml_element(name, value), F.lit("")) for name, value in injected.items()
    ]
    return F.concat(
        F.lit(f"<{ROOT}>"), *parts, *[_element(rule) for rule in rules], F.lit(f"</{ROOT}>"))


def missing_values(rules: Sequence[Rule]) -> Column:
    missing = F.concat_ws(", ", *[
        F.when(text.is_blank(F.expr(rule.source)), F.lit(rule.target))
        for rule in rules if rule.required and rule.default is None
    ])
    return F.when(missing != "", F.concat(F.lit("no value for "), missing))


def transform(records: DataFrame, rules: Sequence[Rule], *, dataset_name: str | Column,
              country: str | Column, language: str | Column, execution_id: str) -> DataFrame:
    """Records mapped to the target form.

    The generated id is the record id; a record without a dataset id gets none.
    """
    def value(given: str | Column) -> Column:
        return given if isinstance(given, Column) else F.lit(given)

    injected = {
        "about": F.when(~text.is_blank(F.col("dataset_id")), F.col("record_id")),
        "datasetName": value(dataset_name),
        "country": value(country),
        "language": value(language),
    }
    return step_result(
        records, execution_id, schema.TRANSFORMATION, mapped_record(rules, injected),
        missing_values(rules))
