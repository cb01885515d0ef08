"""Column helpers for record text, XML and resource URLs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Three-letter language codes and the two-letter code each stands for.
LANGUAGE_CODES = {
    "bul": "bg", "cze": "cs", "ces": "cs", "dan": "da", "dut": "nl", "nld": "nl",
    "eng": "en", "est": "et", "fin": "fi", "fre": "fr", "fra": "fr", "ger": "de",
    "deu": "de", "gre": "el", "ell": "el", "hrv": "hr", "hun": "hu", "gle": "ga",
    "ita": "it", "lav": "lv", "lit": "lt", "mlt": "mt", "pol": "pl", "por": "pt",
    "rum": "ro", "ron": "ro", "slo": "sk", "slk": "sk", "slv": "sl", "spa": "es",
    "swe": "sv",
}

# The path part that comes before each piece of a resource URL.
URL_PARTS = {"record": "records", "representation": "representations", "version": "versions"}

SPACES = "[ \\t\\n\\r]+"
YEAR = "\\b(1[0-9]{3}|20[0-9]{2})\\b"


def is_blank(value: Column) -> Column:
    """True for null, empty and white-space-only text."""
    return value.isNull() | ~value.rlike("[^ \\t\\n\\r]")


def collapse_spaces(value: Column) -> Column:
    """Runs of white space as one space, none at the ends.

    Text with single spaces only, the usual line, is found by plain search, which is much
    cheaper than the pattern.
    """
    uneven = reduce(or_, [F.contains(value, F.lit(mark)) for mark in ("  ", "\t", "\n", "\r")])
    return F.trim(F.when(uneven, F.regexp_replace(value, SPACES, " ")).otherwise(value))


def lines(value: Column) -> Column:
    return F.split(value, "\n")


def distinct_lines(value: Column) -> Column:
    """Cleaned lines in their first order, without repeats and empty ones."""
    cleaned = F.transform(lines(value), collapse_spaces)
    return F.array_distinct(F.filter(cleaned, lambda line: line != ""))


def sorted_lines(value: Column) -> Column:
    """Lines ordered by text; equal lines keep their order."""
    return F.array_sort(lines(value))


def year_of(value: Column) -> Column:
    """The first year between 1000 and 2099 in free text, null if there is none."""
    return F.nullif(F.regexp_extract(value, YEAR, 1), F.lit("")).cast("int")


def language_code(value: Column, codes: Mapping[str, str] | None = None) -> Column:
    """Two-letter code for a two- or three-letter one; unknown codes stay. ``codes`` is another table."""
    pairs = [F.lit(part) for pair in (codes or LANGUAGE_CODES).items() for part in pair]
    code = F.lower(F.trim(value))
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), code)


def url_part(url: Column, part: str) -> Column:
    """One piece of a resource URL, null when the URL has no such piece."""
    return F.nullif(F.regexp_extract(url, f"/{URL_PARTS[part]}/([^/?#]+)", 1), F.lit(""))


def utf8_bytes(value: Column) -> Column:
    return F.encode(value, "UTF-8")


def utf8_text(value: Column) -> Column:
    """Bytes as text; what is no UTF-8 becomes U+FFFD, so that no row can stop a job."""
    return F.make_valid_utf8(value.cast("string"))


def xml_escape(value: Column) -> Column:
    escaped = value
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        escaped = F.replace(escaped, F.lit(plain), F.lit(entity))
    return escaped


def xml_element(name: str, value: Column) -> Column:
    """``<name>value</name>``, null for a null value."""
    return F.concat(F.lit(f"<{name}>"), xml_escape(value), F.lit(f"</{name}>"))


def xml_elements(name: str, values: Column) -> Column:
    """One element per array item, in order; empty text for an empty or null array."""
    return F.coalesce(
        F.array_join(F.transform(values, lambda v: xml_element(name, v)), ""), F.lit(""))


def numbered_items(frame: DataFrame, keys: Sequence[str], items: Column, place: str,
                   name: str) -> DataFrame:
    """One row per array item with its place; rows without items are left out.

    A plain ``posexplode`` would have the optimizer test the array's size in a filter of
    its own, which computes a costly array, such as one out of parsed XML, three times.
    """
    return frame.select(*keys, F.posexplode_outer(items).alias(place, name)).where(
        F.col(place).isNotNull())


def parse_xml(value: Column, fields: str, options: dict[str, str] | None = None) -> Column:
    """``fields`` read from an XML record, plus ``malformed`` for text that is no record.

    ``xpath`` would throw on such text and fail the whole stage.
    """
    return F.from_xml(
        F.coalesce(value, F.lit("")), f"{fields}, malformed string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "malformed",
         "ignoreSurroundingSpaces": "false", **(options or {})})
