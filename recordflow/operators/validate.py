"""External and internal validation.

A profile is a table of named rules over the columns of a record frame. Rules only look
at a record; what is stored is the record as it came.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordflow import schema
from recordflow.functions import elements, text
from recordflow.operators.project import step_result

PROFILES = (schema.VALIDATION_EXTERNAL, schema.VALIDATION_INTERNAL)


def check_profile(profile: str) -> str:
    if profile not in PROFILES:
        raise ValueError(f"unknown validation type: {profile}")
    return profile


def canonical_text(record_data: Column) -> Column:
    """The record with its lines in canonical order, as the checks see it."""
    return F.array_join(text.sorted_lines(record_data), "\n")


def canonical_elements(record_data: Column, ranks: Mapping[str, int]) -> Column:
    """An XML record with its elements by (rank, name, place), as a schema with an order wants them.

    ``ranks`` gives the rank of local names; names without one come last. What stands between
    elements is left out, what is inside them stays as written. Null for text that is no record.
    """
    return canonical_scan(elements.scanned(record_data), ranks)


def canonical_scan(scan: Column, ranks: Mapping[str, int]) -> Column:
    """The same of a record that has been cut into its elements (:func:`.elements.scanned`)."""
    pairs = [F.lit(part) for pair in ranks.items() for part in pair]
    rank = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,int>")

    def ordered(scan: Column) -> Column:
        keyed = F.transform(
            F.filter(scan["parts"], lambda p: p["name"].isNotNull()),
            lambda p: F.struct(
                F.coalesce(F.try_element_at(rank, p["name"]), F.lit((1 << 31) - 1)).alias("rank"),
                p["name"].alias("name"), p["place"].alias("place"), elements.written(p).alias("written")))
        return F.concat(
            scan["head"], F.array_join(F.transform(F.array_sort(keyed), lambda k: k["written"]), ""), scan["tail"])

    return elements.let(scan, ordered)


def broken_rules(rules: Mapping[str, Column]) -> Column:
    """The ids of the rules a record breaks, joined by ``; ``; null when it is valid.

    A rule that gives null counts as broken.
    """
    broken = F.concat_ws("; ", F.array_compact(F.array(*[
        F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()
    ])))
    return F.nullif(broken, F.lit(""))


def validate(records: DataFrame, profile: str, rules: Mapping[str, Column],
             execution_id: str, reorder: Column | None = None) -> DataFrame:
    """Records under ``execution_id``, those that break a rule as errors.

    ``reorder`` puts a record into canonical order; rules see that as ``checked_text``.
    """
    return validate_all(records, profile, rules, execution_id, reorder)


def validate_all(records: DataFrame, profile: str, rules: Mapping[str, Column], execution_id: str,
                 reorder: Column | None = None, fields: str | None = None, xsd_file: str | None = None) -> DataFrame:
    """Rules and, with ``xsd_file``, an XML schema in one check of the same text: a record in
    canonical order where ``reorder`` says how, else as it came. What is stored is the record as it came.
    """
    check_profile(profile)
    seen = records if reorder is None else records.withColumn("checked_text", reorder)
    checked = F.col("record_data" if reorder is None else "checked_text")
    found = [broken_rules(rules)] if rules else []
    if xsd_file is not None:
        found.append(schema_violation(checked, fields or "", xsd_file))
    failure = F.nullif(F.concat_ws("; ", *found), F.lit("")) if found else None
    return step_result(seen, execution_id, profile, F.col("record_data"), failure)


def schema_violation(record_data: Column, fields: str, xsd_file: str) -> Column:
    """Why an XML record does not fit an XML schema, null when it does.

    ``xsd_file`` is the file name under which ``SparkContext.addFile`` sent the schema
    to the executors.
    """
    parsed = text.parse_xml(record_data, fields, {"rowValidationXSDPath": xsd_file})
    return F.when(parsed["malformed"].isNotNull(), F.lit("record does not fit the schema"))


def validate_schema(records: DataFrame, profile: str, fields: str, xsd_file: str,
                    execution_id: str, reorder: Column | None = None) -> DataFrame:
    """The same against an XML schema. What is stored is the record as it came."""
    return validate_all(records, profile, {}, execution_id, reorder, fields, xsd_file)
