"""Document fingerprints: a Merkle tree over sections, paragraphs and phrases.

Sections end with a blank line, paragraphs with a line; both keep their line ends, so the tree
holds the whole text. A paragraph's node is the MD5 of its text, a section's that of its
paragraphs' nodes, the root the SHA-256 of the sections' nodes: equal roots are equal texts.
The fingerprint is ``root:section(paragraphs)...~phrases``, with the first 8 digits of the
inner nodes. Where two roots differ, the nodes below tell which branches do
(:func:`changed_paragraphs`). Phrases are runs of words that end where a word ends in a vowel or
in anything but a-z, so an edit moves no other phrase's borders; the ``KEPT`` smallest of their
hashes are a sample of the leaves that is drawn alike from every text (:func:`likeness`). Two texts
are as like as their trees prove by equal paragraphs, or as the sample says if that is more; only
equal roots are wholly alike (:func:`near`).

Columns and SQL functions only. :func:`with_next` sets each row beside the next in descending
order of id by one shuffle: rows are dealt to ranges of the sort order, the first row of a range
is also dealt to the range before, and a window in each range looks one row ahead. Ranges
grow in number with the rows; what the driver sees is two values a range.

Defined cases: a null text is an empty text; an empty text has one empty leaf and likeness 1 to
another. Null ids come last in descending order; rows of equal ids follow each other by the
hash of their texts. A table of one row is its own next. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name

#: Phrase hashes kept in a fingerprint.
KEPT = 64
_SECTIONS, _PARAGRAPHS, _PHRASES = r"(?<=\n\n)(?!\z)", r"(?<=\n)(?!\z)", r"(?<=[^a-z]|[aeiou])\s+"
ROWS_PER_RANGE, MOST_RANGES, SAMPLES = 4096, 1 << 16, 16


def phrases(text: Column) -> Column:
    """The kept phrase hashes, ascending."""
    hashed = F.transform(F.split(text, _PHRASES, -1), lambda p: F.hash(p))
    return F.slice(F.sort_array(F.array_distinct(hashed)), 1, KEPT)


def _tree(text: Column) -> Column:
    """Sections as structs of node and paragraph nodes."""
    def section(part: Column) -> Column:
        return F.transform(F.split(part, _PARAGRAPHS, -1), lambda p: F.md5(p))

    return F.transform(F.split(text, _SECTIONS, -1), section)


def _written(tree: Column, kept: Column) -> Column:
    def node(paragraphs: Column) -> Column:
        return F.md5(F.array_join(paragraphs, ""))

    root = F.sha2(F.array_join(F.transform(tree, node), ""), 256)
    inner = F.transform(tree, lambda s: F.concat(
        F.substring(node(s), 1, 8), F.lit("("),
        F.array_join(F.transform(s, lambda p: F.substring(p, 1, 8)), ","), F.lit(")")))
    sample = F.transform(kept, lambda h: F.lower(F.lpad(F.hex(h.cast("long").bitwiseAND(0xFFFFFFFF)), 8, "0")))
    return F.concat(root, F.lit(":"), F.array_join(inner, ""), F.lit("~"), F.array_join(sample, ""))


def fingerprint(text: Column, kept: Column | None = None) -> Column:
    """The fingerprint of a text as a string. ``kept``: its :func:`phrases`, if at hand."""
    whole = F.coalesce(text, F.lit(""))
    return _written(_tree(whole), phrases(whole) if kept is None else kept)


def likeness(one: Column, two: Column) -> Column:
    """0 to 1, of the :func:`phrases` of two texts: the share of phrases that they have in
    common (Dice), exact up to ``KEPT`` different phrases, from the sample beyond."""
    sample = F.slice(F.sort_array(F.array_union(one, two)), 1, KEPT)
    common = F.size(F.array_intersect(sample, F.array_intersect(one, two)))
    return (2.0 * common) / (F.size(sample) + common)


def marks(text: Column) -> Column:
    """The different paragraphs as numbers: a hash above 20 bits, below it the length (at most 2^20)."""
    return F.array_distinct(F.transform(F.split(text, _PARAGRAPHS, -1), lambda p: F.shiftleft(
        F.xxhash64(p), 20).bitwiseOR(F.least(F.length(p), F.lit((1 << 20) - 1)).cast("bigint"))))


def near(equal: Column, one: Column, two: Column, marks_one: Column, marks_two: Column) -> Column:
    """Likeness of two texts from their trees and samples: 1 if the roots are ``equal``. Else, the larger of
    what the trees prove (the share of equal paragraphs, by length) and what the sample of phrases says, and
    always below 1 by one character in all."""
    def size(some: Column) -> Column:
        return F.aggregate(some, F.lit(0).cast("bigint"), lambda a, x: a + x.bitwiseAND((1 << 20) - 1))

    whole = size(marks_one) + size(marks_two)
    tree = F.when(whole > 0, 2.0 * size(F.array_intersect(marks_one, marks_two)) / whole).otherwise(0.0)
    return F.when(equal, 1.0).otherwise(F.least(F.greatest(tree, likeness(one, two)), 1.0 - 1.0 / (whole + 1)))


def sample_of(fingerprint: Column) -> Column:
    """:func:`phrases` read back from a fingerprint, for fingerprints that were stored."""
    digits = F.substring_index(fingerprint, "~", -1)
    return F.transform(F.regexp_extract_all(digits, F.lit("[0-9a-f]{8}"), F.lit(0)),
                       lambda h: F.conv(h, 16, 10).cast("long")
                       - F.when(h >= "8", F.lit(1 << 32)).otherwise(F.lit(0)))


def changed_paragraphs(one: Column, two: Column) -> Column:
    """Where two fingerprints differ: ``first`` paragraph that does (from 0), and how many
    paragraphs from there on were replaced (``old``) by how many (``new``). Null if roots agree."""
    def nodes(f: Column) -> Column:
        return F.regexp_extract_all(F.substring_index(f, "~", 1), F.lit(r"(?<=[(,])[0-9a-f]{8}"), F.lit(0))

    def equal_from_start(x: Column, y: Column) -> Column:
        short = F.least(F.size(x), F.size(y))
        unlike = F.filter(F.sequence(F.lit(0), short), lambda i: (i == short) | ~F.get(x, i).eqNullSafe(F.get(y, i)))
        return unlike[0]

    a, b = nodes(one), nodes(two)
    first = equal_from_start(a, b)
    last = F.least(equal_from_start(F.reverse(a), F.reverse(b)), F.least(F.size(a), F.size(b)) - first)
    return F.when(F.substring_index(one, ":", 1) != F.substring_index(two, ":", 1), F.struct(
        first.alias("first"), (F.size(a) - last - first).alias("old"), (F.size(b) - last - first).alias("new")))


def _below(bounds: list, key: Column) -> Column:
    """How many of the ascending bounds are at most ``key``, by bisection."""
    if not bounds:
        return F.lit(0)
    ids = F.array(*[F.lit(b[0]).cast("long") for b in bounds])
    hashes = F.array(*[F.lit(b[1]).cast("long") for b in bounds])
    top = 1 << (len(bounds)).bit_length()
    steps = F.array(*[F.lit(top >> i) for i in range(top.bit_length())])

    def at(i: Column) -> Column:
        return F.struct(F.get(ids, i).alias("id"), F.get(hashes, i).alias("h"))

    def search(value: Column) -> Column:
        return F.aggregate(steps, F.lit(0), lambda low, step: low + F.when(
            (low + step <= len(bounds)) & (at(low + step - 1) <= value), step).otherwise(0))

    return F.transform(F.array(key), search)[0]


def with_next(df: DataFrame, doc_id: str, text: str, out: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Adds the text of the next row in descending order of id (after the last: the first)."""
    key, part, guard = (free_name(df, x) for x in ("sort_key", "range", "guard"))
    keyed = df.withColumn(key, F.struct(
        F.col(f"`{doc_id}`").cast("long").alias("id"), F.xxhash64(f"`{text}`").alias("h")))
    rows = df.count()
    if not rows:
        return df.withColumn(out, F.lit(None).cast("string"))
    ranges = min(MOST_RANGES, -(-rows // rows_per_range))
    bounds: list = []
    if ranges > 1:
        one_in = max(1, rows // (ranges * SAMPLES))
        drawn = keyed.where(F.pmod(F.xxhash64(key), F.lit(one_in)) == 0).agg(
            F.sort_array(F.collect_set(key)).alias("k")).select(F.filter(
                "k", lambda _, i: i % SAMPLES == SAMPLES - 1).alias("k")).first()
        bounds = drawn["k"]
    ranged = keyed.withColumn(part, _below(bounds, F.col(key)))
    # the first row of each range, in descending order; the range before needs it too
    tops = ranged.groupBy(part).agg(F.max(key).alias("top")).orderBy(part).collect()
    before = {r[part]: tops[(i + 1) % len(tops)][part] for i, r in enumerate(tops)}
    slots = len(bounds) + 1
    held = {r[part]: r["top"] for r in tops}
    ids = F.array(*[F.lit(held[i]["id"] if i in held else None).cast("long") for i in range(slots)])
    hashes = F.array(*[F.lit(held[i]["h"] if i in held else None).cast("long") for i in range(slots)])
    goes_to = F.array(*[F.lit(before.get(i, i)) for i in range(slots)])
    here = F.col(part)
    is_top = (F.get(ids, here).eqNullSafe(F.col(key)["id"])) & (F.get(hashes, here) == F.col(key)["h"])
    places = F.when(is_top, F.array(
        F.struct(here.alias("p"), F.lit(False).alias("g")),
        F.struct(F.get(goes_to, here).alias("p"), F.lit(True).alias("g")))).otherwise(
        F.array(F.struct(here.alias("p"), F.lit(False).alias("g"))))
    dealt = ranged.withColumn(guard, F.explode(places))
    order = Window.partitionBy(F.col(guard)["p"]).orderBy(
        F.col(guard)["g"], F.col(key)["id"].desc_nulls_last(), F.col(key)["h"].desc())
    seen = dealt.withColumn(out, F.lead(F.coalesce(F.col(f"`{text}`"), F.lit(""))).over(order))
    return seen.where(~F.col(guard)["g"]).drop(key, part, guard)


def fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Of every row: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``, ``edited`` being the text whose last half (rounded down) is replaced
    by as much of the next row's beginning."""
    whole = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    beside = with_next(whole, "doc_id", "text", "next", rows_per_range)
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 2) as int))"),
                      F.col("next").substr(F.lit(1), half))
    both = beside.withColumn("edited", edited)
    texts = F.array("text", "edited", "next")
    sampled = both.select(
        "doc_id", "text", "edited", (F.col("text") == F.col("edited")).alias("unedited"), (F.col("text") == F.col("next")).alias("same"),
        F.transform(texts, phrases).alias("kept"), F.transform(texts, marks).alias("marks"))
    own, other, after = (F.col("kept")[i] for i in range(3))
    own_marks, other_marks, after_marks = (F.col("marks")[i] for i in range(3))
    return sampled.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("text"), own).alias("fingerprint"),
        fingerprint(F.col("edited"), other).alias("edited_fingerprint"),
        near(F.col("unedited"), own, other, own_marks, other_marks).alias("near_edited"),
        near(F.col("same"), own, after, own_marks, after_marks).alias("near_next"))
