"""The steps of a workflow, each a function (records, execution id) → step results."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordflow import schema
from recordflow.functions import dates, elements, text
from recordflow.operators import enrich, harvest, index, media, normalize, transform, validate
from recordflow.operators.project import step_result
from recordflow.params import PREVIEW, PUBLISH
from recordflow.plans import record_xml


@dataclass(frozen=True)
class Step:
    """``shuffles`` tells that the results no longer lie as the records were read."""

    name: str
    run: Callable[[DataFrame, str], DataFrame]
    shuffles: bool = False


def harvest_step(headers: DataFrame, content: DataFrame, dataset_id: Column,
                 local_id: Column) -> Step:
    """Listing → live headers → content → final id, each id once. Has no source records."""
    def run(_: DataFrame | None, execution_id: str) -> DataFrame:
        fetched = harvest.harvest_content(harvest.not_deleted(headers), content)
        return harvest.assign_unique_ids(fetched, dataset_id, local_id, execution_id)

    return Step(schema.HARVEST, run, shuffles=True)


@dataclass(frozen=True)
class Schema:
    """An XML schema sent to the executors (``SparkContext.addFile``), and the fields it knows."""

    file: str
    fields: str


def external_validation(rules: Mapping[str, Column], ranks: Mapping[str, int] | None = None,
                        schema_: Schema | None = None) -> Step:
    """With ``ranks`` rules and schema see the record in canonical order (rules as ``checked_text``)."""
    def run(records: DataFrame, execution_id: str) -> DataFrame:
        return validate.validate_all(
            records, schema.VALIDATION_EXTERNAL, rules, execution_id, _canonical(ranks),
            schema_ and schema_.fields, schema_ and schema_.file)

    return Step(schema.VALIDATION_EXTERNAL, run)


def _canonical(ranks: Mapping[str, int] | None) -> Column | None:
    return None if ranks is None else validate.canonical_elements(F.col("record_data"), ranks)


def transformation(rules: Sequence[transform.Rule], **params: str | Column) -> Step:
    return Step(schema.TRANSFORMATION, lambda records, execution_id: transform.transform(
        records, rules, execution_id=execution_id, **params))


def internal_validation(rules: Mapping[str, Column], ranks: Mapping[str, int] | None = None,
                        schema_: Schema | None = None) -> Step:
    """``rules`` see the parsed record as ``xml`` and, with ``ranks``, the record in canonical order
    as ``checked_text``."""
    def run(records: DataFrame, execution_id: str) -> DataFrame:
        parsed = record_xml.with_parsed(records)
        seen = parsed if ranks is None else parsed.withColumn(
            "checked_text", validate.canonical_scan(F.col("scan"), ranks))
        found = [validate.broken_rules(rules)] if rules else []
        if schema_ is not None:
            text_ = F.col("record_data" if ranks is None else "checked_text")
            found.append(validate.schema_violation(text_, schema_.fields, schema_.file))
        failure = F.nullif(F.concat_ws("; ", *found), F.lit("")) if found else F.lit(None).cast("string")
        return step_result(
            seen, execution_id, schema.VALIDATION_INTERNAL, F.col("record_data"),
            F.coalesce(record_xml.malformed(), failure))

    return Step(schema.VALIDATION_INTERNAL, run)


#: Elements whose text is a date.
DATES = ("date", "created", "issued", "temporal")


def normalized_parts(languages: Mapping[str, str] | None = None, date_names: Sequence[str] = DATES) -> Column:
    """Text values cleaned in place; elements left without content and repeated links dropped.

    A date that can be read becomes its range of years; others stay as text.
    """
    def clean(part: Column) -> Column:
        name, value = part["name"], part["inner"]
        plain = ~F.contains(value, F.lit("<"))  # elements inside and CDATA stay as they are
        cleaned = F.when(plain & (name == "language"), text.language_code(value, languages)).when(
            plain & name.isin(*date_names), _date(value)).when(
            plain & name.isin("title", "description", "link"), text.collapse_spaces(value)).otherwise(value)
        return part.withField("inner", cleaned)

    def has_content(part: Column) -> Column:
        return part["name"].isNull() | ~text.is_blank(part["inner"]) | F.contains(part["open"], F.lit("="))

    cleaned = F.filter(F.transform("scan.parts", clean), has_content)
    return elements.let(cleaned, lambda parts: _first_of_equal(parts, "link"))


def _date(value: Column) -> Column:
    return F.coalesce(
        elements.let(dates.year_range(value), lambda years: F.when(years.isNotNull(), dates.written_range(years))),
        text.collapse_spaces(value))


def _first_of_equal(parts: Column, name: str) -> Column:
    """The parts without repeats among the elements of one name."""
    def firsts(same: Column) -> Column:
        return F.filter(same, lambda x, i: (i == 0) | (F.get(same, i - 1)["written"] != x["written"]))

    named = F.transform(
        F.filter(parts, lambda p: record_xml.name_of(p) == name),
        lambda p: F.struct(elements.written(p).alias("written"), p.alias("part")))
    kept = F.transform(elements.let(F.array_sort(named), firsts), lambda x: x["part"])
    others = F.filter(parts, lambda p: record_xml.name_of(p) != name)
    return F.array_sort(F.concat(others, kept))  # by place


def normalization(languages: Mapping[str, str] | None = None, date_names: Sequence[str] = DATES) -> Step:
    """``languages`` maps codes to codes (:data:`.text.LANGUAGE_CODES` by default), ``date_names`` are
    the elements that hold dates."""
    def run(records: DataFrame, execution_id: str) -> DataFrame:
        parts = normalized_parts(languages, date_names)
        return step_result(record_xml.with_parsed(records), execution_id, schema.NORMALIZATION,
                           record_xml.rebuilt(parts), record_xml.malformed())

    return Step(schema.NORMALIZATION, run)


def _open_records(records: DataFrame, without: Sequence[str] = ()) -> DataFrame:
    """Records ready for more elements: ``record_data`` without those named, ``root`` (its name),
    ``tail`` (what it ends with), ``links`` and ``failure``. The parts stay behind, so what a join moves is one text."""
    parsed = record_xml.with_parsed(records)
    kept = F.filter("scan.parts", lambda p: ~record_xml.name_of(p).isin(*without)) if without else None
    return parsed.select(
        *[c for c in records.columns if c != "record_data"],
        (F.col("record_data") if kept is None else record_xml.rebuilt(kept)).alias("record_data"),
        F.col("scan.root").alias("root"), F.col("scan.tail").alias("tail"), F.col("xml.link").alias("links"), record_xml.malformed().alias("failure"))


def _with_added(added: Column) -> Column:
    return record_xml.with_added(F.col("record_data"), F.col("root"), F.col("tail"), added)


def enrichment(entities: DataFrame, reference: Callable[[Column], Column],
               tolerate: bool = False) -> Step:
    """``reference`` turns a link of the record into a key of ``entities``."""
    def run(records: DataFrame, execution_id: str) -> DataFrame:
        return enrich.enrich(
            _open_records(records), F.transform("links", reference), entities,
            _with_added(text.xml_elements("concept", F.col("labels"))),
            execution_id, tolerate, F.col("failure"))

    return Step(schema.ENRICHMENT, run, shuffles=True)


def media_step(metadata: DataFrame) -> Step:
    def run(records: DataFrame, execution_id: str) -> DataFrame:
        good = F.filter("resources", lambda r: r["extracted"])
        facts = F.transform(good, lambda r: F.concat_ws(
            " ", r["resource"], r["mime"], r["bytes"].cast("string")))
        has_main = F.coalesce(F.get("resources", F.lit(0))["extracted"], F.lit(False))
        added = F.concat(text.xml_elements("resource", facts),
                         text.xml_element("mainThumbnail", has_main.cast("string")))
        return media.enrich_media(
            _open_records(records, without=("resource", "mainThumbnail")), F.col("links"), metadata,
            _with_added(added), execution_id, F.col("failure"))

    return Step(schema.MEDIA, run, shuffles=True)


def record_tier() -> Column:
    """The media tier as found in the record itself."""
    extracted = F.coalesce(F.size("xml.resource"), F.lit(0))
    return index.media_tier(F.greatest(extracted, F.lit(0)),
                            F.coalesce(F.col("xml.mainThumbnail") == "true", F.lit(False)))


def indexing(target: str) -> Step:
    return Step(schema.INDEXING, lambda records, execution_id: index.index_step(
        record_xml.with_parsed(records), record_tier(), target, execution_id,
        record_xml.malformed()))


def index_both() -> tuple[Step, Step]:
    """Preview first, then publish."""
    return indexing(PREVIEW), indexing(PUBLISH)
