"""Language of web pages by fusion of evidence.

    log P(language | page) = text likelihood + log P(declared | language) + log P(language | host)

* **Text**: byte trigrams in ``BUCKETS`` hashed buckets, naive Bayes, learnt from at most
  ``per_language`` labelled documents (a parameter) of every language there is. The model holds the
  buckets that a language uses, some thousands of 12 bytes each; the driver collects and broadcasts
  them. Overlapping trigrams are not independent: the sum is divided by 3.
* **Declared** language of the markup (``<html lang=...>``), main part only: how often texts of each
  language declare it, over all pages.
* **Host** prior: shares of languages (by text) among a host's other pages, smoothed by
  ``strength`` imagined pages of its domain's shares, those by its address suffix's, those by all
  pages'. Each level is a grouped sum.

Text is read once, by an Arrow function; what follows are grouped sums, combined before the
shuffle, and equi joins of narrow rows. A host with a third of all pages is one row in its level.

Defined cases: null or empty markup has no text evidence and declares nothing; null addresses,
and those without a host, share one empty host. Without any evidence the language is the most
frequent one; ties go to the first in code-point order. Without labelled documents there are no
languages: all null. Null ids and repeated rows stay, each page is judged for itself. Other
columns take no part.
"""

from __future__ import annotations

import html as markup
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from .common import cut, small_batches

BUCKETS, PER_LANGUAGE, STRENGTH = 1 << 16, 400, 5.0
_HIDDEN = re.compile(r"<(?:!--|(script|style|template|noscript)\b)", re.I)
_ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "template", "noscript")} | {"": re.compile("-->")}
_TAG = re.compile(r"<[^>]*>")


def visible_text(page: str) -> str:
    """Without comments, hidden elements and tags. One scan forward: where the end of a kind is not
    found, no later beginning of it has one, and all of them stay."""
    parts, at, begin, endless = [], 0, 0, set()
    while (found := _HIDDEN.search(page, at)) is not None:
        kind = (found[1] or "").lower()
        end = None if kind in endless else _ENDS[kind].search(page, found.end())
        if end is None:
            endless.add(kind)
            at = found.end()
            continue
        parts += [page[begin : found.start()], " "]
        at = begin = end.end()
    shown = "".join([*parts, page[begin:]])
    last = shown.rfind(">") + 1  # behind it, no tag is ever closed
    return markup.unescape(_TAG.sub(" ", shown[:last]) + shown[last:])


def trigram_counts(text: str) -> np.ndarray:
    """Hashed byte trigrams of the lower-cased text with runs of white space as one blank."""
    data = np.frombuffer(" ".join(["", *text.lower().split(), ""]).encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.zeros(BUCKETS, np.int64)
    packed = data[:-2] << 16 | data[1:-1] << 8 | data[2:]
    return np.bincount((packed * np.uint32(2654435761)) >> np.uint32(16), minlength=BUCKETS)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name in batch.column(0).unique():
            counts = np.zeros(BUCKETS, np.int64)
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                if lang == name:
                    counts += trigram_counts(text.as_py())
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name.as_py()] * len(used)), pa.array(used.astype(np.int32)), pa.array(counts[used])], ["lang", "bucket", "n"])


class Logs:
    """Log probabilities (language x bucket): those of unused buckets, one per language, and what
    used ones have more, sorted by bucket."""

    def __init__(self, used: list[tuple[np.ndarray, np.ndarray]]):
        totals = np.array([n.sum() + 0.5 * BUCKETS for _, n in used])
        self.unused = np.log(0.5 / totals)
        buckets = np.concatenate([np.empty(0, np.int32), *[b for b, _ in used]])
        order = np.argsort(buckets, kind="stable")
        self.begin = np.searchsorted(buckets[order], np.arange(BUCKETS + 1))
        self.language = np.repeat(np.arange(len(used), dtype=np.int32), [len(b) for b, _ in used])[order]
        self.more = np.concatenate([np.empty(0), *[np.log(n / 0.5 + 1) for _, n in used]])[order]

    def __matmul__(self, counts: np.ndarray) -> np.ndarray:
        """Log likelihoods of a vector of bucket counts."""
        at = np.flatnonzero(counts)
        sizes = self.begin[at + 1] - self.begin[at]
        ends = np.cumsum(sizes)
        places = np.arange(sizes.sum()) + np.repeat(self.begin[at] - ends + sizes, sizes)
        return self.unused * counts.sum() + np.bincount(
            self.language[places], self.more[places] * np.repeat(counts[at], sizes), minlength=len(self.unused))


def fit(documents: DataFrame, *, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
        per_language: int = PER_LANGUAGE) -> tuple[list[str], Logs]:
    """Languages in code-point order and log probabilities (language x bucket)."""
    labelled = documents.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"), F.col(f"`{doc_id}`").alias("id")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull())
    found = sorted((r["lang"], r["count"]) for r in labelled.groupBy("lang").count().collect())
    if not found:
        return [], Logs([])
    # by hash of the id about twice as many as wanted, of these the first by hash
    share = documents.sparkSession.createDataFrame(
        [(name, min(1.0, 2.0 * per_language / n)) for name, n in found], "lang string, share double")
    some = labelled.join(F.broadcast(share), "lang").withColumn("h", F.xxhash64("id")).where(
        F.pmod("h", F.lit(1_000_000)) < F.col("share") * 1_000_000)
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "id"))
    sample = some.withColumn("place", place).where(F.col("place") <= per_language)
    small_batches(documents.sparkSession)
    counted = sample.select("lang", "text").mapInArrow(_counted, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n")).groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("used"))
    used = {r["lang"]: (np.array([x["bucket"] for x in r["used"]], np.int32), np.array([x["n"] for x in r["used"]], np.int64))
            for r in counted.toLocalIterator()}
    none = np.empty(0, np.int32), np.empty(0, np.int64)
    return [name for name, _ in found], Logs([used.get(name, none) for name, _ in found])


def text_evidence(page: Column, logs: object) -> Column:
    """Log likelihoods of a page's visible text, one per language; ``logs`` a broadcast."""

    @F.arrow_udf("array<double>")
    def work(pages: pa.Array) -> pa.Array:
        out = []
        for x in pages:
            out.append((logs.value @ trigram_counts(visible_text(x.as_py() or "")) / 3).tolist())
        return pa.array(out, pa.list_(pa.float64()))

    return work.asNondeterministic()(page)


def softmax(logs: Column) -> Column:
    def bound(value: Column, body) -> Column:  # put together once, not for each element
        return F.transform(F.array(value), body)[0]

    weights = bound(F.array_max(logs), lambda most: F.transform(logs, lambda x: F.exp(x - most)))
    return bound(weights, lambda ws: bound(F.aggregate(ws, F.lit(0.0), lambda a, x: a + x), lambda total: F.transform(ws, lambda w: w / total)))


def _host(url: Column) -> Column:
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.regexp_replace(host, r"\.+$", "")


def _declared(page: Column) -> Column:
    """The main part of the document's declared language, lower case; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(page, F.lit("")), r"(?is)<html\b[^>]*?\slang\s*=\s*[\"']?\s*([A-Za-z]{2,8})", 1))


def identify(pages: DataFrame, languages: list[str], logs: Logs, *, page_id: str = "page_id", url: str = "url",
             page: str = "html", strength: float = STRENGTH) -> DataFrame:
    """``page_id, lang, probability, text_lang, declared, host``."""
    small_batches(pages.sparkSession)
    sent = pages.sparkSession.sparkContext.broadcast(logs)
    seen = pages.select(
        F.col(f"`{page_id}`").alias("page_id"), _host(F.col(f"`{url}`")).alias("host"),
        _declared(F.col(f"`{page}`")).alias("declared"), text_evidence(F.col(f"`{page}`"), sent).alias("logs"))
    n = len(languages)
    if not n:
        return seen.select("page_id", F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("probability"),
                           F.lit(None).cast("string").alias("text_lang"), "declared", "host")
    labels = seen.withColumns({
        "domain": F.substring_index("host", ".", -2), "suffix": F.substring_index("host", ".", -1), "p": softmax(F.col("logs"))})
    labels = cut(labels)

    def summed(rows: DataFrame, keys: list[str], values: str, weight: Column, name: str = "") -> DataFrame:
        """Sums of arrays, place by place, of any length: one row per place before the shuffle."""
        places = rows.select(*keys, weight.alias("w"), F.posexplode(values).alias("k", "v"))
        sums = places.groupBy(*keys, "k").agg(F.sum("v").alias("v"), F.sum("w").alias("w"))
        whole = sums.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("k", "v"))).alias("s"), F.max("w").alias("w"))
        return whole.select(*keys, F.transform("s", lambda x: x["v"]).alias(f"{name}counts"), F.col("w").alias(f"{name}rows"))

    def smoothed(counts: Column, rows: Column, above: Column) -> Column:
        return F.zip_with(counts, above, lambda c, a: (F.greatest(c, F.lit(0.0)) + strength * a) / (rows + strength))

    hosts = cut(summed(labels, ["host", "domain", "suffix"], "p", F.lit(1)))

    def above(keys: list[str], name: str) -> DataFrame:
        return summed(hosts, keys, "counts", F.col("rows"), f"{name}_")

    everything: Row | None = summed(hosts, [], "counts", F.col("rows")).first()
    sums, total = (everything["counts"], everything["rows"]) if everything and everything["counts"] else ([0.0] * n, 0)
    general = F.lit([(x + 1) / (total + n) for x in sums])
    chain = hosts.join(above(["domain"], "domain"), "domain").join(above(["suffix"], "suffix"), "suffix").withColumn(
        "suffix_share", smoothed(F.col("suffix_counts"), F.col("suffix_rows"), general)).withColumn(
        "domain_share", smoothed(F.col("domain_counts"), F.col("domain_rows"), F.col("suffix_share")))
    priors = chain.select("host", F.col("counts").alias("host_counts"), F.col("rows").alias("host_rows"), "domain_share")
    # P(declared | language): a language's pages that declare it, over all its pages, smoothed
    declares = summed(labels, ["declared"], "p", F.lit(1)).select("declared", F.transform(F.col("counts"), lambda c, i: F.when(
        F.col("declared") == "", 0.0).otherwise(F.log((c + 0.1) / (F.get(F.lit(sums), i) + 1.0)))).alias("declared_logs"))
    joined = labels.join(priors, "host").join(declares, "declared")
    others = F.zip_with("host_counts", "p", lambda c, p: c - p)  # the page's own text is no prior of itself
    prior = smoothed(others, F.col("host_rows") - 1, F.col("domain_share"))
    fused = F.zip_with(F.zip_with("logs", prior, lambda a, b: a + F.log(b)), "declared_logs", lambda a, b: a + b)
    names = F.lit(languages)

    def best(values: Column) -> Column:
        return F.element_at(names, F.array_position(values, F.array_max(values)).cast("int"))

    judged = joined.withColumn("posterior", softmax(fused))
    return judged.select("page_id", best(F.col("posterior")).alias("lang"), F.array_max("posterior").alias("probability"),
                         best(F.col("p")).alias("text_lang"), "declared", "host")
