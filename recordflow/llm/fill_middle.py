"""Fill-in-middle: texts cut into prefix, middle and suffix at unit borders and put in another order.

A unit is a run of ASCII letters or any other single code point. One ``fullmatch`` of ``(unit)*`` keeps
the end of every repetition, so the number of units and both cut offsets are looked up in
``match.ends(1)``. The repetitions are possessive: nothing is ever tried twice. A text of more than
``STRETCH`` code points is matched in stretches that end between units, first for the numbers of
units alone, then once more in the stretch of each cut, so that the ends of a stretch at most are in
memory. Python sends back three numbers a text; cutting, joining and hashing are column functions.

Where the cuts fall and which form a document takes comes from a digest of a seed and the document's
key alone, so reruns agree. No shuffle.

Defined cases: a null text counts as empty, an empty one has no unit and stays plain. A null key has
the digest of the seed alone. Equal rows get equal results. Texts that hold a mark stay plain, so
every output can be undone. Other columns stay; columns of the output's names are replaced.
"""

from __future__ import annotations

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, small_batches

#: Marks before the prefix, the suffix and the middle.
MARKS = ("<P>", "<S>", "<M>")
#: Shares in percent: documents that stay as they are; of the others, those with the suffix first.
PLAIN, SUFFIX_FIRST = 10, 20
#: Code points that are matched at once.
STRETCH = 1 << 20

_UNITS = regex.compile(r"([A-Za-z]++|[^A-Za-z])*+")
_BORDER = regex.compile(r"(?<![A-Za-z])|(?![A-Za-z])")


def _stretches(text: str, size: int) -> list[tuple[int, int]]:
    """Begin and end of stretches of about ``size`` code points that end between two units."""
    places = [0]
    while len(text) - places[-1] > size:
        places.append(_BORDER.search(text, places[-1] + size).start())
    return list(zip(places, [*places[1:], len(text)], strict=True))


def cuts(text: str, first: int, second: int, size: int = STRETCH) -> tuple[int, int, int]:
    """Number of units, and where prefix and middle end: behind as many units as the smaller and
    the larger of both numbers modulo the number of units and one."""
    parts = _stretches(text, size)
    ends = _UNITS.fullmatch(text, *parts[0]).ends(1)
    if len(parts) == 1:
        n = len(ends)
        return n, *(ends[k - 1] if k else 0 for k in sorted((first % (n + 1), second % (n + 1))))
    numbers = [len(ends), *(len(_UNITS.fullmatch(text, *part).ends(1)) for part in parts[1:])]
    n, out = sum(numbers), []
    for k in sorted((first % (n + 1), second % (n + 1))):
        i = 0
        while k > numbers[i]:
            k -= numbers[i]
            i += 1
        out.append(_UNITS.fullmatch(text, *parts[i]).ends(1)[k - 1] if k else 0)
    return n, *out


def _cut(text: Column, first: Column, second: Column, size: int) -> Column:
    @F.arrow_udf("struct<n: bigint, one: bigint, two: bigint>")
    def work(texts: pa.Array, ones: pa.Array, twos: pa.Array) -> pa.Array:
        found = [cuts(t.as_py(), a.as_py(), b.as_py(), size) for t, a, b in zip(texts, ones, twos, strict=True)]
        return pa.StructArray.from_arrays(
            [pa.array([f[i] for f in found], pa.int64()) for i in range(3)], ["n", "one", "two"])

    return work.asNondeterministic()(text, first, second)  # it isn't: so Spark runs it once


def draws(key: Column, seed: int) -> list[Column]:
    """Four numbers below 2^32: the first 8-digit groups of the hex SHA-256 of ``seed:key``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def transformed(df: DataFrame, *, text: str = "text", key: str = "doc_id", seed: int = 1, plain: int = PLAIN,
                suffix_first: int = SUFFIX_FIRST, size: int = STRETCH) -> DataFrame:
    """Adds ``n`` (units), ``form`` (plain, psm or spm), ``prefix_chars`` and ``middle_chars`` (null if
    plain) and ``output``: plain, the text; psm, prefix, suffix and middle behind their marks; spm,
    suffix, prefix and middle."""
    small_batches(df.sparkSession)
    before, behind, last = map(F.lit, MARKS)
    h1, h2, h3, h4 = draws(F.col(f"`{key}`"), seed)
    work, drawn = free_name(df, "cut"), free_name(df, "drawn")
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    cut = df.withColumn(drawn, F.struct(h3.alias("h3"), h4.alias("h4"), h1.alias("h1"), h2.alias("h2")))
    cut = cut.withColumn(work, _cut(whole, F.col(drawn).h1, F.col(drawn).h2, size))
    marked = F.lit(False)
    for mark in MARKS:
        marked = marked | F.contains(whole, F.lit(mark))
    stays = (whole == "") | marked | (F.col(drawn).h3 % 100 >= 100 - plain)
    form = F.when(stays, "plain").when(F.col(drawn).h4 % 100 < suffix_first, "spm").otherwise("psm")
    one, two = F.col(work).one, F.col(work).two
    prefix = F.substr(whole, F.lit(1), one)
    middle = F.substr(whole, one + 1, two - one)
    suffix = F.substr(whole, two + 1)
    output = F.when(form == "plain", whole).when(
        form == "psm", F.concat(before, prefix, behind, suffix, last, middle)).otherwise(
        F.concat(behind, suffix, before, prefix, last, middle))
    return cut.withColumns({
        "n": F.col(work).n, "form": form, "prefix_chars": F.when(form != "plain", one),
        "middle_chars": F.when(form != "plain", two - one), "output": output}).drop(work, drawn)


def restored(output: Column, form: Column) -> Column:
    """The text that an output of :func:`transformed` was made of. Its parts hold no mark, and no
    mark can arise across the end of a part, so the marks alone tell the parts."""
    parts = F.split(output, "|".join(MARKS), -1)
    return F.when(form == "plain", output).when(
        form == "psm", F.concat(parts[1], parts[3], parts[2])).otherwise(F.concat(parts[2], parts[3], parts[1]))
