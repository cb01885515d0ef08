"""Near-duplicate embeddings by Euclidean p-stable hashing and exact cosines.

Vectors are brought to length 1, where cosine c means distance sqrt(2 - 2c). Each of ``tables``
hash tables takes ``width`` random Gaussian projections plus an offset, quantised by ``step``;
vectors that agree in all of them share a bucket. In each bucket the cosines of all pairs are
computed in double precision, in blocks; a pair counts where it reaches ``at_least``, in the
first table that has it. With the defaults a pair at cosine 0.95 is in a common bucket with
probability 0.992, one at 0.99 with 0.9999; :func:`recall_at` gives it for any setting.

**At size.** Equal vectors are one before hashing. A class of them travels once per table. Buckets
of more than ``block`` vectors are cut into blocks by hash and compared block against block, so
neither a crowd of near copies nor a dense region is one task. A bucket gives one row per
vector with links (how many) and a spanning forest of its links, never all pairs.

Defined cases: null, empty and zero vectors and vectors with null or non-finite components link
with nothing, nor do vectors of different lengths. Null ids take part and are nobody's
component id; a component of null ids alone has a null one. Repeated rows and ids are vectors of
their own. Other columns take no part. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import erf, exp, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut
from .components import components

AT_LEAST, TABLES, WIDTH, STEP, BLOCK, SEED = 0.95, 18, 5, 1.0, 1024, 7


def recall_at(cosine: float, tables: int = TABLES, width: int = WIDTH, step: float = STEP) -> float:
    """The probability that a pair at a cosine shares a bucket in some table."""
    apart = sqrt(max(2 - 2 * cosine, 1e-12))
    r = step / apart
    one = erf(r / sqrt(2)) - 2 / (sqrt(2 * pi) * r) * (1 - exp(-r * r / 2))
    return 1 - (1 - one**width) ** tables


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    vectors /= np.abs(vectors).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def bucket_keys(unit: np.ndarray, tables: int, width: int, step: float, seed: int) -> np.ndarray:
    """A 32-bit key per vector and table. Two buckets of one key are compared as one: exact
    cosines follow, so that costs time and loses nothing."""
    draw = np.random.default_rng([seed, unit.shape[1]])
    directions = draw.standard_normal((unit.shape[1], tables * width))
    cells = np.floor((unit @ directions) / step + draw.random(tables * width)).astype(np.int64)
    mixed = np.zeros((len(unit), tables), np.uint64)
    for i in range(width):
        mixed = (mixed ^ cells.reshape(len(unit), tables, width)[:, :, i].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return (mixed >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _spread(classes: DataFrame, tables: int, width: int, step: float, seed: int) -> DataFrame:
    """``class_id, n, dim, vector`` (bytes of doubles), ``keys`` (one per table)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            lengths = np.asarray(lists.value_lengths())
            flat, start = lists.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(lengths)]
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                some = flat[(start[rows][:, None] + np.arange(length)).ravel()].reshape(len(rows), length)
                keys = bucket_keys(_unit(some), tables, width, step, seed)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows)),
                    pa.array(np.full(len(rows), length, np.int32)), pa.array([x.tobytes() for x in some], pa.binary()),
                    pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * tables, pa.array(keys.ravel())),
                ], ["class_id", "n", "dim", "vector", "keys"])

    return classes.select("class_id", "n", "embedding").mapInArrow(
        work, "class_id long, n long, dim int, vector binary, keys array<int>")


def _forest(near: np.ndarray) -> list[tuple[int, int]]:
    """Links that span the components of a symmetric matrix of links."""
    left, out = near.any(axis=1), []
    while left.any():
        front = [int(left.argmax())]
        left[front[0]] = False
        while front:
            here = front.pop()
            new = np.flatnonzero(near[here] & left)
            left[new] = False
            out += [(here, int(x)) for x in new]
            front += new.tolist()
    return out


def _compare(table: int, rows: dict[str, np.ndarray], at_least: float):
    """Of one bucket, or two blocks of it: links per row (other side's copies), forest links."""
    unit, keys, n = _unit(rows["vector"]), rows["keys"], rows["n"]
    near = unit @ unit.T >= at_least
    np.fill_diagonal(near, False)
    if rows["one"] != rows["two"]:  # pairs inside a block are counted where it meets itself
        near &= rows["own"][:, None] != rows["own"][None, :]
    a, b = np.nonzero(near)
    known = np.zeros(len(a), bool)
    for t in range(table):
        known |= keys[a, t] == keys[b, t]
    near[a[known], b[known]] = False
    return near @ n, _forest(near)


def found(spread: DataFrame, at_least: float, block: int) -> DataFrame:
    """Rows ``a, b, links``: b null, how many vectors class a links with; else a link."""
    narrow = spread.select("dim", F.posexplode("keys").alias("table", "key"))
    crowds = narrow.groupBy("dim", "table", "key").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    rows = spread.select("*", F.posexplode("keys").alias("table", "key")).join(crowds, ["dim", "table", "key"])
    blocks = F.ceil(F.col("rows") / block).cast("int")
    dealt = rows.withColumn("own", F.pmod(F.xxhash64("class_id"), blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select("dim", "table", "key", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"),
                         "own", "class_id", "n", "vector", "keys")
    group = ["dim", "table", "key", "one", "two"]
    dealt = dealt.repartition(*group).sortWithinPartitions(*group)
    names = [*group, "own", "class_id", "n"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def compared(whole: pa.Table, begins: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
            columns = {c: whole.column(c).to_numpy() for c in names}
            out: list[tuple[int, int | None, int]] = []
            for begin, end in zip(begins, ends, strict=True):
                if end - begin < 2:
                    continue
                part = whole.slice(begin, end - begin)
                ids = columns["class_id"][begin:end]
                rows = {c: columns[c][begin:end] for c in ("own", "n")} | {c: columns[c][begin] for c in ("one", "two")}
                kind = f"<f{part.column('vector')[0].as_buffer().size // columns['dim'][begin]}"
                rows["vector"] = np.frombuffer(b"".join(part.column("vector").to_pylist()), kind).reshape(end - begin, -1)
                rows["keys"] = part.column("keys").combine_chunks().flatten().to_numpy().reshape(end - begin, -1)
                counts, forest = _compare(int(columns["table"][begin]), rows, at_least)
                out += [(int(ids[i]), None, int(counts[i])) for i in np.flatnonzero(counts)]
                out += [(int(ids[i]), int(ids[j]), 0) for i, j in forest]
            a, b, links = zip(*out, strict=True) if out else ((), (), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(links, pa.int64())], ["a", "b", "links"])

        def runs(whole: pa.Table) -> np.ndarray:
            keys = np.column_stack([whole.column(c).to_numpy() for c in group])
            return np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])

        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            if all(held[0].column(c)[0] == batch.column(c)[len(batch) - 1] for c in group):
                continue  # one bucket so far
            whole = pa.Table.from_batches(held).combine_chunks()
            begins = runs(whole)
            yield compared(whole, begins[:-1], begins[1:])
            held = whole.slice(begins[-1]).to_batches()
        if held:
            whole = pa.Table.from_batches(held).combine_chunks()
            begins = runs(whole)
            yield compared(whole, begins, np.r_[begins[1:], len(whole)])

    return dealt.mapInArrow(work, "a long, b long, links long")


def near_vectors(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", *, at_least: float = AT_LEAST,
                 tables: int = TABLES, width: int = WIDTH, step: float = STEP, block: int = BLOCK,
                 seed: int = SEED) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``."""
    vector = F.col("embedding")
    fine = F.coalesce(
        (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(vector, lambda x: x != 0), F.lit(False))
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").alias("embedding"))
    # vectors that link with nothing have no class; a hash of all components names the others'
    rows = rows.withColumn("class_id", F.when(fine, F.xxhash64(vector)))
    classes = rows.where("class_id is not null").groupBy("class_id").agg(
        F.first("embedding").alias("embedding"), F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first"))
    spread = cut(_spread(classes, tables, width, step, seed))
    pairs = cut(found(spread, at_least, block))
    counts = pairs.where("b is null").groupBy("a").agg(F.sum("links").alias("links"))
    joined = components(pairs.where("b is not null").select("a", "b").distinct())
    named = cut(rows.where("class_id is not null").groupBy("class_id").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first"))
                .join(joined, F.col("class_id") == F.col("node"), "left")
                .select("class_id", "n", "first", F.coalesce("component", "class_id").alias("root"))
                .join(counts, F.col("class_id") == F.col("a"), "left")
                .select("class_id", "first", "root", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    known = named.join(least, "root").select("class_id", "n_links", "component_id")
    out = rows.drop("embedding").join(known, "class_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("class_id").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
