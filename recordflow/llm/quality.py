"""Quality by nearest-neighbour voting in a latent semantic space.

A text's terms are the shapes of its words (runs of capitals, small letters and digits, marks as
they are) and, for each word, whether it stands for the first time among its neighbours,
again, or right after itself. Longer words count as their pieces of 64 characters, so texts
without blanks are read whole, too. Term counts become shares, their square roots are weighted by
inverse document frequency, and the leading singular directions of a sample of labelled texts
turn them into short vectors of length 1.

The sample's vectors and labels are broadcast: at most ``sample`` rows (a parameter) of
``dimensions`` numbers, whatever the data. Every document is compared with every one of them:
exact cosine products, a block of documents at a time. Of its ``neighbours`` nearest, each votes
for its label with its similarity; the score is the share of the votes for label 1.

Learnt only from ids, labels and texts of rows with crc32(id as text) mod 5 not 0: half of the
sample from each label (all of them, if there are fewer), those of the smallest id hash. Labels,
language, source and id are no inputs of a score.

Memory: a block's products. No shuffle in scoring. Defined cases: null and blank texts, and
texts without any term of the sample, score the share of label 1 among all labels learnt from.
Labels with a null id or null label are left out, of several labels of an id all count. Without
any labels every score is 0.5. Repeated rows score alike. Other columns stay; ``held_out,
score, predicted`` replace columns of these names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, take_over

SAMPLE, DIMENSIONS, NEIGHBOURS, THRESHOLD = 4000, 48, 7, 0.3
_SHAPES = 2048  # buckets of word shapes
_TERMS = _SHAPES + 3  # and: first among its neighbours, again, right after itself
_AMONG, _BLOCK, _PIECE = 64, 256, 64
_RUNS = re.compile(r"([a0A])\1+")


def shape(word: str) -> int:
    """The bucket of a word's shape."""
    letters = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    return crc32(_RUNS.sub(r"\1", letters).encode("utf-8", "replace")) % _SHAPES


class _Shapes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= 100_000:
            self.clear()
        self[word] = out = shape(word)
        return out


_shapes = _Shapes()


def _forget() -> None:
    _shapes.clear()


def term_counts(text: str | None) -> np.ndarray:
    """Counts of the ``_TERMS`` terms; whole texts."""
    words = (text or "").split()
    if max(map(len, words), default=0) > _PIECE:
        words = [w[i : i + _PIECE] for w in words for i in range(0, len(w), _PIECE)]
    out = np.zeros(_TERMS)
    if not words:
        return out
    out[:_SHAPES] = np.bincount(np.fromiter(map(_shapes.__getitem__, words), np.int32, len(words)), minlength=_SHAPES)
    first = sum(len(set(words[i : i + _AMONG])) for i in range(0, len(words), _AMONG))
    out[_SHAPES:] = first, len(words) - first, sum(map(eq, words, words[1:]))
    return out


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows as vectors of length 1; zero stays zero."""
    size = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(size > 0, size, 1)


@dataclass
class Model:
    """``weights`` per term, ``axes`` (terms x dimensions), the sample's ``vectors`` and ``labels``."""

    weights: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float
    neighbours: int = NEIGHBOURS

    def embed(self, counts: np.ndarray) -> np.ndarray:
        """Rows of term counts as vectors of length 1 (or 0)."""
        total = counts[:, :_SHAPES].sum(axis=1, keepdims=True)
        shares = np.sqrt(counts / np.maximum(total, 1)) * self.weights
        return _unit(shares @ self.axes)

    def score(self, counts: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(counts), self.prior)
        likeness = self.embed(counts) @ self.vectors.T
        k = min(self.neighbours, len(self.labels))
        # ties at the border: by place in the sample, as everywhere
        best = np.argsort(-likeness, axis=1, kind="stable")[:, :k] if k == len(self.labels) else np.argpartition(-likeness, k - 1, axis=1)[:, :k]
        votes = np.maximum(np.take_along_axis(likeness, best, axis=1), 0)
        total = votes.sum(axis=1)
        share = (votes * self.labels[best]).sum(axis=1) / np.where(total > 0, total, 1)
        return np.clip(np.where(total > 1e-9, share, self.prior), 0, 1)


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning: crc32(id as text) mod 5 is 0. Null ids are."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(documents: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
        label: str = "quality", sample: int = SAMPLE, dimensions: int = DIMENSIONS,
        neighbours: int = NEIGHBOURS) -> Model:
    """Learns from at most ``sample`` labelled rows; that many are brought to the driver."""
    small_batches(documents.sparkSession)
    usable = labels.select(F.col(f"`{doc_id}`").alias("labelled_id"), F.col(f"`{label}`").cast("double").alias("label")).where(
        F.col("labelled_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("labelled_id")))
    prior = usable.agg(F.avg("label")).first()[0]
    drawn = [usable.where(F.col("label") > 0.5), usable.where(F.col("label") <= 0.5)]
    drawn = [x.orderBy(F.xxhash64("labelled_id"), "labelled_id").limit(sample // 2) for x in drawn]
    chosen = drawn[0].union(drawn[1])
    docs = documents.select(F.col(f"`{doc_id}`").alias("labelled_id"), F.col(f"`{text}`").alias("text"))
    joined = docs.join(chosen, "labelled_id").select("labelled_id", "label", counted(F.col("text")).alias("counts"))
    rows = joined.orderBy(F.xxhash64("labelled_id"), "labelled_id", "label").limit(2 * sample).collect()
    return learn([(r["label"], dict(zip(r["counts"]["term"], r["counts"]["n"], strict=True))) for r in rows],
                 0.5 if prior is None else prior, dimensions, neighbours)


def counted(text: Column) -> Column:
    """Terms that occur in a text, and how often."""

    @F.arrow_udf("struct<term: array<int>, n: array<int>>")
    def count(texts: pa.Array) -> pa.Array:
        take_over("quality", _forget)
        out = []
        for x in texts:
            counts = term_counts(x.as_py())
            terms = np.flatnonzero(counts)
            out.append({"term": terms.tolist(), "n": counts[terms].astype(int).tolist()})
        return pa.array(out, pa.struct([("term", pa.list_(pa.int32())), ("n", pa.list_(pa.int32()))]))

    return count(text)


def learn(rows: list[tuple[float, dict[int, int]]], prior: float, dimensions: int, neighbours: int) -> Model:
    """Latent semantic analysis of a sample: weights, axes by singular value, vectors.

    Only terms that the sample holds have a column: the driver needs a table of rows by used terms, twice.
    """
    used = np.array(sorted(set().union(*(terms for _, terms in rows))), np.int64)
    counts = np.zeros((len(rows), len(used)))
    for i, (_, terms) in enumerate(rows):
        counts[i, np.searchsorted(used, list(terms))] = list(terms.values())
    holders = np.zeros(_TERMS)
    holders[used] = np.count_nonzero(counts, axis=0)
    weights = np.log((1 + len(rows)) / (1 + holders)) + 1
    model = Model(weights, np.zeros((_TERMS, 0)), np.empty((0, 0)), np.array([r[0] for r in rows]), prior, neighbours)
    if len(rows):
        counts /= np.maximum(counts[:, used < _SHAPES].sum(axis=1, keepdims=True), 1)
        shares = np.sqrt(counts, out=counts)
        shares *= weights[used]
        strength, axes = np.linalg.eigh(shares.T @ shares)
        keep = [i for i in np.argsort(-strength)[:dimensions] if strength[i] > 1e-9]
        model.axes = np.zeros((_TERMS, len(keep)))
        model.axes[used] = axes[:, keep]
        model.vectors = _unit(shares @ model.axes[used])
    return model


def scored(df: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text",
           threshold: float = THRESHOLD) -> DataFrame:
    """Adds ``held_out, score, predicted``."""
    small_batches(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        take_over("quality", _forget)
        parts = [np.empty(0)]
        for i in range(0, len(texts), _BLOCK):
            counts = np.array([term_counts(x.as_py()) for x in texts[i : i + _BLOCK]])
            parts.append(sent.value.score(counts))
        return pa.array(np.concatenate(parts))

    out = df.withColumns({"held_out": held_out(F.col(f"`{doc_id}`")), "score": score.asNondeterministic()(F.col(f"`{text}`"))})
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
