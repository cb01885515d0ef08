"""Free-text dates as ranges of years.

A date is read as the first form that its whole text has: a day or a year, a range, a decade, a century
or a half of one, a limit on one side. Marks of doubt (``ca.``, brackets, question marks) make it
approximate. Years before the common era are negative. Text in no such form gives no range: nothing is
guessed from a number somewhere in a sentence.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordflow.functions.elements import let

RANGE = "struct<first: int, last: int, approximate: boolean>"

# Words around a date, and Roman numerals of centuries.
DOUBT = r"(?:c|ca|circa|about|around|um|vers|approx)\.? "
ROMAN = ("i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix", "x", "xi", "xii", "xiii", "xiv", "xv", "xvi", "xvii", "xviii", "xix", "xx", "xxi")
CENTURY = r"(?:century|cent\.?|c\.|jahrhundert|jh\.?|siècle|s\.)"
BEFORE_ERA = r"(?:b\.? ?c\.?(?: ?e\.?)?|v\. ?chr\.?)"
AFTER_ERA = r"(?:a\.? ?d\.?|c\.? ?e\.?|n\. ?chr\.?)"

_YEAR = r"(\d{3,4})"
_DAY = r"(?:\d{1,2}[./-]\d{1,2}[./-](\d{4})|(\d{4})[./-]\d{1,2}(?:[./-]\d{1,2}(?:t[\d:.]+z?)?)?)"
_TO = r" ?(?:-|–|—|/|to|and|until|bis|à) ?"


def year_range(value: Column) -> Column:
    """``first``, ``last`` (null on an open side) and ``approximate``; null for text in no known form."""
    lowered = F.lower(F.trim(F.regexp_replace(value, r"[ \t\r\n]+", " ")))
    bare = F.trim(F.regexp_replace(F.regexp_replace(lowered, r"[\[\]()?]", ""), rf"^{DOUBT}", ""))
    return let(F.struct(lowered.alias("as_written"), bare.alias("bare")), lambda t: _read(t["bare"], t["bare"] != t["as_written"]))


def _group(text: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(text, f"^(?:{pattern})$", group), F.lit(""))


def _number(text: Column, pattern: str, group: int = 1) -> Column:
    return _group(text, pattern, group).cast("int")


def _read(text: Column, doubtful: Column) -> Column:
    def years(first: Column, last: Column) -> Column:
        ordered = F.when(first <= last, F.struct(first.alias("first"), last.alias("last")))
        return F.when(first.isNull() | last.isNull(), F.struct(first.alias("first"), last.alias("last"))).otherwise(ordered)

    nothing = F.lit(None).cast("int")
    day = F.coalesce(_number(text, _DAY, 1), _number(text, _DAY, 2))
    year = _number(text, rf"{_YEAR} ?{AFTER_ERA}?")
    era = -_number(text, rf"(\d{{1,4}}) ?{BEFORE_ERA}")

    both = rf"(?:from |between |von |de )?{_YEAR}{_TO}(?:c\.? |ca\.? )?(\d{{2,4}}) ?{AFTER_ERA}?"
    begin, short = _number(text, both), _number(text, both, 2)
    end = F.when(F.length(_group(text, both, 2)) == 2, begin - begin % 100 + short).otherwise(short)
    before = rf"(\d{{1,4}}){_TO}(\d{{1,4}}) ?{BEFORE_ERA}"

    decade = F.coalesce(_number(text, r"(?:the )?(\d{3})0'?s"), _number(text, r"(\d{3})[-.x]"))
    hundred = _number(text, r"(\d{2})(?:\.\.|--|xx)")

    of = rf"(first half of |second half of |early |late )?(?:the )?(?:(\d{{1,2}})(?:st|nd|rd|th|e|\.)?|([ivx]+)e?\.?) ?{CENTURY}"
    roman = F.create_map(*[F.lit(x) for i, name in enumerate(ROMAN, 1) for x in (name, i)])
    century = F.coalesce(_number(text, of, 2), F.try_element_at(roman, _group(text, of, 3)))
    part = F.coalesce(_group(text, of, 1), F.lit(""))
    opens = (century - 1) * 100 + F.when(part.isin("second half of ", "late "), 51).otherwise(1)
    closes = (century - 1) * 100 + F.when(part.isin("first half of ", "early "), 50).otherwise(100)

    upto = _number(text, rf"(?:before|until|vor|avant|-|–) ?{_YEAR}")
    since = _number(text, rf"(?:(?:after|since|from|nach|après) ?)?{_YEAR} ?(?:-|–)?")
    forms = [
        (day, day), (year, year), (era, era), (begin, end), (-_number(text, before), -_number(text, before, 2)),
        (decade * 10, decade * 10 + 9), (hundred * 100, hundred * 100 + 99), (opens, closes)]
    found = F.coalesce(*[F.when(a.isNotNull() & b.isNotNull(), years(a, b)) for a, b in forms],
                       F.when(upto.isNotNull(), years(nothing, upto)), F.when(since.isNotNull(), years(since, nothing)))
    loose = part.isin("early ", "late ")
    return F.when(found.isNotNull(), F.struct(
        found["first"].alias("first"), found["last"].alias("last"), (doubtful | loose).alias("approximate")))


def written_range(years: Column) -> Column:
    """A range as text: ``1890``, ``1890/1895``, ``../1895``, ``1890/..``, with ``~`` if approximate."""
    first = F.coalesce(years["first"].cast("string"), F.lit(".."))
    last = F.coalesce(years["last"].cast("string"), F.lit(".."))
    plain = F.when(first == last, first).otherwise(F.concat_ws("/", first, last))
    return F.concat(plain, F.when(years["approximate"], "~").otherwise(""))
