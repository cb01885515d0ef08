"""SimHash near-duplicates: fingerprints, links by segment bit counts, components.

**Fingerprint.** Words of the lower-cased (A-Z) text, shingles of ``width`` words, XXH64 of
each (seed 42); a bit is 1 if more than half of the shingles' hashes have it.

**Links** at ``radius`` 3 or fewer differing bits. A fingerprint is embedded as the bit counts
of its 32 two-bit segments. The Manhattan distance of two embeddings is never more than the
number of differing bits, so it is a lower bound. Of the two halves of the embedding, one is
at distance 1 or less for every pair within 3. Each half is a grid with cells of side one: a
fingerprint stands in its own cell and probes the cells one step up in one coordinate (one of
two points one step apart probes the other). Fingerprints that meet in a cell are compared
exactly, by XOR and bit count. No pair within the radius is missed and none beyond it kept.

**At size.** Equal fingerprints are one before anything else. Each gives 2 rows of its own and
at most 32 probes, narrow ones, whatever the data; cells with a single member go before the
sort. Cells of more than ``block`` members are cut into blocks by hash and compared block
against block, so no task gets a whole one. A crowded cell gives a spanning forest of its
links, never all pairs. Components come from :mod:`.components`.

Defined cases: null, empty and blank texts have the fingerprint zero, linked like any other.
Null ids take part; a component of null ids alone has a null id. Repeated rows and ids stay,
each row in its component. Other columns are kept by :func:`drop_near_copies` and take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import cut, free_name, row_hash, small_batches, take_over
from .components import components

WIDTH, SEED, RADIUS, BLOCK = 3, 42, 3, 4096
_AT_ONCE = 1 << 16  # hashes whose bits are spread out at once


def fingerprint_of(text: str, width: int = WIDTH, seed: int = SEED) -> int:
    """The 64 bits as an unsigned number."""
    words = text.encode("utf-8", "replace").lower().split()  # of bytes: A-Z, ASCII white space
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(seed)), np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _AT_ONCE):
        some = hashes[i : i + _AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprint(text: Column, width: int = WIDTH, seed: int = SEED) -> Column:
    """Fingerprints as signed longs; null texts count as empty."""

    @F.arrow_udf("long")
    def work(texts: pa.Array) -> pa.Array:
        take_over("simhash")
        values = [fingerprint_of(x.as_py() or "", width, seed) for x in texts]
        return pa.array(np.array(values, np.uint64).view(np.int64))

    return work(text)


def _cells(fp: Column) -> tuple[Column, Column]:
    """Keys of a fingerprint's own two cells, and of those that it probes.

    The counts of a half's 16 segments stand packed in 32 bits, two bits each: x - (x >> 1 &
    0101...) turns each pair of bits into its count.
    """
    own, probed, nothing = [], [], F.array().cast("array<bigint>")
    for half, bits in enumerate((fp.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(fp, 32))):
        counts = bits - F.shiftright(bits, 1).bitwiseAND(0x55555555) + F.lit(half << 32)
        own.append(counts)
        for j in range(16):
            up = counts + F.lit(1 << 2 * j)
            probed.append(F.when(F.shiftright(counts, 2 * j).bitwiseAND(3) < 2, F.array(up)).otherwise(nothing))
    return F.array(*own), F.concat(*probed)


def _forest(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the components of some fingerprints, found by exact comparison."""
    left, right = [], []
    rest = np.unique(fps)
    while len(rest):
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            here = front.pop()
            near = np.bitwise_count(rest ^ here) <= radius
            if near.any():
                found, rest = rest[near], rest[~near]
                left.append(np.full(len(found), here))
                right.append(found)
                front.extend(found)
    none = np.empty(0, np.uint64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _runs(groups: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin."""
    return np.flatnonzero(np.r_[True, (groups[1:] != groups[:-1]).any(axis=1)])


def _links_of(groups: np.ndarray, fps: np.ndarray, radius: int, few: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Links inside whole runs: runs of a few rows all at once, crowded ones as forests."""
    begin = _runs(groups)
    sizes = np.diff(np.r_[begin, len(fps)])
    left, right = [], []
    run = np.repeat(np.arange(len(begin)), sizes)
    small = sizes[run] <= few
    a, r = fps[small], run[small]
    for step in range(1, min(few, sizes.max(initial=1))):
        near = (r[step:] == r[:-step]) & (np.bitwise_count(a[step:] ^ a[:-step]) <= radius)
        left.append(a[:-step][near])
        right.append(a[step:][near])
    for k in np.flatnonzero(sizes > few):
        one, two = _forest(fps[begin[k] : begin[k] + sizes[k]], radius)
        left.append(one)
        right.append(two)
    none = [np.empty(0, np.uint64)]
    return np.concatenate(left or none), np.concatenate(right or none)


def links(fps: DataFrame, fp: str = "fp", radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints that connect exactly those at ``radius`` or
    fewer differing bits (directly or through others). ``fps`` holds each fingerprint once."""
    if radius > 3:
        raise ValueError("two halves prove a distance of 1 in one of them up to radius 3")
    own_cells, probed = _cells(F.col(fp))
    spread = fps.select(F.col(fp).alias("fp"), F.explode(own_cells).alias("cell"), F.lit(1).alias("lives")).union(
        fps.select(fp, F.explode(probed), F.lit(0)))
    # cells in which somebody lives and somebody else is met
    members = spread.groupBy("cell").agg(F.count("*").alias("n"), F.max("lives").alias("lived")).where("n > 1 and lived = 1")
    spread, members = spread.select("cell", "fp"), members.select("cell", "n")
    met = spread.join(members, "cell")
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    pairs = met.select(
        "cell", "fp", own.alias("own"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    grouped = pairs.select(
        "cell", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "fp")
    dealt = grouped.repartition("cell", "one", "two").sortWithinPartitions("cell", "one", "two", "fp")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("simhash")
        kept_groups, kept_fps = np.empty((0, 3), np.int64), np.empty(0, np.uint64)

        def out(groups, values):
            a, b = _links_of(groups, values, radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)]
            groups = np.concatenate([kept_groups, np.column_stack(columns[:3])])
            values = np.concatenate([kept_fps, columns[3].view(np.uint64)])
            if not len(values):
                continue
            last = _runs(groups)[-1]
            if last:
                yield out(groups[:last], values[:last])
            kept_groups, kept_fps = groups[last:], values[last:]
        if len(kept_fps):
            yield out(kept_groups, kept_fps)

    return dealt.mapInArrow(link, "a long, b long").distinct()


def near_copies(df: DataFrame, text: str = "text", doc_id: str = "doc_id", *, width: int = WIDTH,
                seed: int = SEED, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """One row per row of ``df``: ``doc_id, fp`` (signed long), ``component_id`` (smallest id
    reachable over links, its own included)."""
    small_batches(df.sparkSession)
    docs = cut(df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                         fingerprint(F.col(f"`{text}`"), width, seed).alias("fp")))
    return _grouped(docs, radius, block).drop("root")


def _grouped(docs: DataFrame, radius: int, block: int) -> DataFrame:
    """Adds ``root`` (smallest fingerprint of the component) and ``component_id`` to rows with
    ``doc_id, fp``."""
    fps = cut(docs.groupBy("fp").agg(F.min("doc_id").alias("first")))
    found = components(links(fps, "fp", radius, block))
    named = fps.join(found, fps.fp == found.node, "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("root"))
    named = cut(named)
    roots = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return docs.join(named.join(roots, "root"), "fp").select(*docs.columns, "root", "component_id")


def drop_near_copies(df: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """One row of each component stays: the smallest id, null ids last; of several rows with it,
    the one whose columns hash lowest, once. All columns of ``df`` stay."""
    small_batches(df.sparkSession)
    hashed, row = with_row_hash(df)
    width, seed = options.get("width", WIDTH), options.get("seed", SEED)
    docs = cut(hashed.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{row}`").alias("row"),
        fingerprint(F.col(f"`{text}`"), width, seed).alias("fp")))
    grouped = _grouped(docs, options.get("radius", RADIUS), options.get("block", BLOCK))
    return kept_rows(hashed, grouped, doc_id, row)


def with_row_hash(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` with a hash of each row, and that column's name."""
    row = free_name(df, "row_hash")
    return df.withColumn(row, row_hash(df)), row


def kept_rows(hashed: DataFrame, grouped: DataFrame, doc_id: str, row: str) -> DataFrame:
    """The rows of ``hashed`` that stay: one of each ``root`` in ``grouped`` (``doc_id, row, root``)."""
    keep_id, keep_row = free_name(hashed, "keep_id"), free_name(hashed, "keep_row")
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    keep = grouped.groupBy("root").agg(best.alias("best"))
    keep = keep.select(F.col("best.doc_id").alias(keep_id), F.col("best.row").alias(keep_row))
    own_id = F.col(f"`{doc_id}`").cast("long")
    chosen = hashed.join(keep, own_id.eqNullSafe(F.col(keep_id)) & (F.col(f"`{row}`") == F.col(keep_row)), "left_semi")
    return chosen.dropDuplicates([doc_id, row]).drop(row)
