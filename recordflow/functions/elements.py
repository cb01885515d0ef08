"""An XML record cut into the elements below its root, as they are written.

A record is split into tokens: tags, and all that stands between two tags (comments, processing
instructions, CDATA sections, text). Running sums of +1 for a start tag and -1 for an end tag give the depth at every token, and with it the tokens at
which children of the root begin and end. Nothing is matched across tags, so elements may nest in
elements of their own name, and marks inside comments or CDATA are no marks. All parts joined give the
record back, byte for byte.

Work grows with the record's length: patterns are possessive, and sums run in short blocks (an array that
grows item by item would be copied each time). A record whose start and end tags differ in number is none
before any sums.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The alternatives of a token, in the order in which they are tried. What is never closed ends with the record.
_COMMENT = r"<!--.*?(?:-->|\z)"
_CDATA = r"<!\[CDATA\[.*?(?:\]\]>|\z)"
_INSTRUCTION = r"<\?.*?(?:\?>|\z)"
_DOCTYPE = r"<!DOCTYPE[^\[<>]*+(?:\[.*?(?:\]\s*+>|\z)|>)"
_TAG = r"""<[^<>"']*+(?:"[^"]*+"[^<>"']*+|'[^']*+'[^<>"']*+)*+>"""
_DECLARATION = _TAG.replace("<", r"<!(?!\[CDATA\[)", 1)
# Text is greedy, not possessive: the group around it never gives anything back, and the engine runs over
# greedy characters in a loop of their own.
_TEXT = r"[^<]+"
_MARKS = f"{_COMMENT}|{_INSTRUCTION}|{_DOCTYPE}|{_DECLARATION}"
TOKEN = f"(?s)(?:{_TEXT}|{_COMMENT}|{_CDATA}|{_INSTRUCTION}|{_DOCTYPE}|{_DECLARATION})++|{_TAG}"

#: Items of an array that are summed one after the other, and how often blocks are made of blocks.
_BLOCK, _LEVELS = 32, 3

_OTHER, _OPEN, _EMPTY, _CLOSE = 0, 1, 2, 3


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is named.

    The value is the start of a fold over nothing, whose end is ``use``: as an array's item it would be copied, and
    so would what ``use`` gives, once for each ``let`` around it.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda kept, _: kept, use)


def _kind(token: Column) -> Column:
    tag = token.startswith("<") & ~token.startswith("<!") & ~token.startswith("<?")
    return F.when(~tag, _OTHER).when(token.startswith("</"), _CLOSE).when(token.endswith("/>"), _EMPTY).otherwise(_OPEN)


def running_sums(values: Column, levels: int = _LEVELS) -> Column:
    """Sums of an integer array up to and including each item."""

    def after(start: Column, items: Column) -> Column:
        sums = F.aggregate(items, F.array(start), lambda done, x: F.concat(done, F.array(F.get(done, F.size(done) - 1) + x)))
        return F.filter(sums, lambda _, i: i > 0)

    def blocks_of(items: Column) -> Column:
        last = F.size(items) - 1
        return F.transform(F.sequence(F.lit(0), F.floor(last / _BLOCK).cast("int")), lambda i: F.transform(
            F.sequence(i * _BLOCK, F.least(i * _BLOCK + _BLOCK - 1, last)), lambda j: F.get(items, j)))

    def blockwise(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda x, y: x + y))
        return let(running_sums(totals, levels - 1), lambda ends: F.flatten(F.transform(
            blocks, lambda b, i: after(F.coalesce(F.get(ends, i - 1), F.lit(0)), b))))

    if not levels:
        return after(F.lit(0), values)
    return let(values, lambda v: F.when(F.size(v) <= _BLOCK, after(F.lit(0), v)).otherwise(let(blocks_of(v), blockwise)))


def _joined(tokens: Column, first: Column, last: Column) -> Column:
    """The text of some tokens; empty where ``last`` is before ``first``."""
    return F.when(last < first, "").otherwise(
        F.array_join(F.slice(tokens, first + 1, F.greatest(last - first + 1, F.lit(0))), ""))


def local_name(tag: Column) -> Column:
    """The name in a tag, without its namespace prefix."""
    return F.regexp_extract(tag, r"^</?(?:[^\s:/<>]*:)?([^\s/<>]*)", 1)


def scanned(record: Column) -> Column:
    """``head`` (up to the root's start tag), ``root`` (its name as written), ``parts``, ``tail`` (from its end tag on); null for text that
    has not just one root. Each part has its ``place``, ``open`` (start tag, or all that stands between two
    elements), ``inner``, ``close``, and the element's local ``name``, null between elements.

    Whether names and attributes are well formed is the parser's business (:func:`.text.parse_xml`).
    """
    def cut(tokens: Column, kinds: Column, depths: Column) -> Column:
        def places(test: Callable[[Column, Column, Column], Column]) -> Column:
            """Tokens that pass ``test(kind, depth before, depth after)``."""
            found = F.transform(kinds, lambda kind, i: F.when(
                test(kind, F.coalesce(F.get(depths, i - 1), F.lit(0)), F.get(depths, i)), i))
            return F.array_compact(found)

        begins = places(lambda kind, before, _: (before == 1) & (kind != _CLOSE))
        ends = places(lambda kind, before, after: (after == 1) & ((before == 2) | (before == 1)))
        roots = places(lambda kind, before, after: (before == 0) & (kind != _OTHER) | (before == 1) & (after == 0))
        return let(F.struct(begins.alias("begins"), ends.alias("ends"), roots.alias("roots")), lambda at: parts(tokens, kinds, depths, at))

    def parts(tokens: Column, kinds: Column, depths: Column, at: Column) -> Column:
        def part(first: Column, place: Column) -> Column:
            last = F.get(at["ends"], place)
            opening, many = F.get(tokens, first), last > first
            return F.struct(
                place.alias("place"), F.when(F.get(kinds, first) != _OTHER, local_name(opening)).alias("name"), opening.alias("open"),
                F.when(many, _joined(tokens, first + 1, last - 1)).otherwise("").alias("inner"),
                F.when(many, F.get(tokens, last)).otherwise("").alias("close"))

        root, end = F.get(at["roots"], F.lit(0)), F.get(at["roots"], F.size(at["roots"]) - 1)
        # a root is one empty element, or a start tag and an end tag; comments may stand around it, text may not
        one = F.when(F.get(kinds, root) == _EMPTY, F.size(at["roots"]) == 1).otherwise(F.size(at["roots"]) == 2)
        around = F.concat(_joined(tokens, F.lit(0), root - 1), _joined(tokens, end + 1, F.size(tokens) - 1))
        text = F.regexp_replace(around, f"(?s){_MARKS}", "").rlike(r"[^ \t\r\n\x{FEFF}]")
        sound = one & (F.array_min(depths) >= 0) & (F.get(depths, F.size(depths) - 1) == 0) & ~text
        return F.when(sound, F.struct(
            _joined(tokens, F.lit(0), root).alias("head"),
            F.regexp_extract(F.get(tokens, root), r"^<([^\s/<>]*)", 1).alias("root"), F.transform(at["begins"], part).alias("parts"),
            F.when(root == end, _joined(tokens, end + 1, F.size(tokens) - 1)).otherwise(
                _joined(tokens, end, F.size(tokens) - 1)).alias("tail")))

    def of_tokens(tokens: Column) -> Column:
        def of_kinds(kinds: Column) -> Column:
            steps = F.transform(kinds, lambda k: F.when(k == _OPEN, 1).when(k == _CLOSE, -1).otherwise(0))
            return let(steps, lambda s: F.when(F.aggregate(s, F.lit(0), lambda x, y: x + y) == 0, let(
                running_sums(s), lambda depths: cut(tokens, kinds, depths))))

        found = F.aggregate(tokens, F.lit(0), lambda n, token: n + F.octet_length(token))
        return F.when(found == F.octet_length(record), let(F.transform(tokens, _kind), of_kinds))

    tokens = F.regexp_extract_all(record, F.lit(TOKEN), F.lit(0))
    return F.when(record != "", let(tokens, of_tokens))


def written(part: Column) -> Column:
    """A part as it stands in the record."""
    return F.concat(part["open"], part["inner"], part["close"])


def value_of(part: Column) -> Column:
    """The text inside an element, with entities and CDATA resolved."""
    inner = part["inner"]
    plain = inner
    for entity, mark in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        plain = F.replace(plain, F.lit(entity), F.lit(mark))
    return F.when(~F.contains(inner, F.lit("&")) & ~F.contains(inner, F.lit("<")), inner).when(
        F.contains(inner, F.lit("<")) | F.contains(inner, F.lit("&#")), F.xpath_string(written(part), F.lit("string(/*)"))).otherwise(plain)
