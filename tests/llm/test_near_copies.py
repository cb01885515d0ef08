"""SimHash and embedding near-duplicates, and components, against brute force."""

from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash
from conftest import DATA
from pyspark.sql import functions as F

from recordflow.llm import embedding_dups, simhash
from recordflow.llm.common import cut
from recordflow.llm.components import components
from recordflow.llm.queries import QUERIES


def fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def grouped(n, linked):
    """Component labels of n items: the smallest member's place."""
    label = list(range(n))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, j in linked:
        a, b = find(i), find(j)
        label[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def bits_apart(values, radius):
    f = np.array(values, np.uint64)
    return [(i, int(j)) for i in range(len(f)) for j in np.flatnonzero(np.bitwise_count(f ^ f[i]) <= radius) if j > i]


def test_components(spark):
    random = np.random.default_rng(1)
    for n, m in ((50, 30), (200, 190), (300, 150), (40, 39)):
        links = [(int(a), int(b)) for a, b in random.integers(0, n, (m, 2))]
        if m == n - 1:  # one long chain
            links = [(i, i + 1) for i in range(n - 1)]
        frame = spark.createDataFrame([*links, (None, 1), (2, None), (3, 3)], "a long, b long")
        got = {r.node: r.component for r in components(frame).collect()}
        labels = grouped(n, links)
        named = {x for a, b in links if a != b for x in (a, b)}
        assert got == {x: labels[x] for x in named}
    assert components(frame.where("false")).count() == 0


def test_query_against_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op4_simhash_near_dedup"](spark, DATA).collect()}
    order = sorted(texts)
    prints = [fingerprint(texts[i]) for i in order]
    labels = grouped(len(order), bits_apart(prints, 3))
    assert len(got) == len(order)
    for place, key in enumerate(order):
        assert got[key].fingerprint == f"{prints[place]:016x}"
        assert got[key].component_id == order[labels[place]]
    assert len(set(labels)) < len(labels)


@pytest.mark.parametrize("block", [5, 4096])
def test_no_link_is_missed_and_none_made_up(spark, block):
    """Fingerprints at every distance, and a crowd around one of them; small blocks split it."""
    random = np.random.default_rng(2)
    base = [int(x) for x in random.integers(0, 1 << 63, 60)]
    values = set(base)
    for b in base:
        for n in (1, 2, 3, 4, 5, 6):
            values.add(b ^ sum(1 << int(i) for i in random.choice(64, n, replace=False)))
    for _ in range(150):
        values.add(base[0] ^ sum(1 << int(i) for i in random.choice(12, int(random.integers(1, 4)), replace=False)))
    values = sorted(values)
    signed = [(int(np.uint64(v).astype(np.int64)),) for v in values]
    links = simhash.links(spark.createDataFrame(signed, "fp long"), block=block).collect()
    assert all((r.a ^ r.b) & (1 << 64) - 1 and bin((r.a ^ r.b) & (1 << 64) - 1).count("1") <= 3 for r in links)
    at = {s[0]: i for i, s in enumerate(signed)}
    assert grouped(len(values), [(at[r.a], at[r.b]) for r in links]) == grouped(len(values), bits_apart(values, 3))
    assert len(links) < 20 * len(values)


def test_edge_cases(spark):
    long = "word " * 30000
    rows = [(5, None, "a"), (2, "", "b"), (9, " \n ", "c"), (None, "One two THREE four", "d"), (7, "one two three four", "e"),
            (7, "one two three four", "e"), (1, long, "f"), (None, "something quite different here and there", "g"),
            (3, "a", "h"), (4, "a b", "i")]
    df = spark.createDataFrame(rows, "doc_id long, text string, keep_id string").withColumn("fp", F.lit(1)).withColumn(
        "root", F.create_map(F.lit("a"), F.lit(1)))
    got = simhash.near_copies(df)
    assert got.count() == len(rows)
    found = {(r.doc_id, r.component_id) for r in got.collect()}
    assert {(5, 2), (2, 2), (9, 2), (None, 7), (7, 7), (None, None), (1, 1)} <= found
    kept = simhash.drop_near_copies(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "7", "None"]
    assert simhash.near_copies(df.where("false")).count() == 0
    assert simhash.drop_near_copies(df.where("false")).count() == 0


def vectors_linked(vectors):
    unit = [None if v is None else np.array(v, float) / np.linalg.norm(v) for v in vectors]
    return [(i, j) for i, a in enumerate(unit) for j in range(i + 1, len(unit)) if a is not None and unit[j] is not None
            and len(a) == len(unit[j]) and a @ unit[j] >= 0.95]


@pytest.mark.parametrize("block", [8, 1024])
def test_embeddings_against_brute_force(spark, block):
    random = np.random.default_rng(3)
    base = random.standard_normal((40, 16))
    vectors = [b.tolist() for b in base]
    for b in base[:20]:
        vectors += [(b + random.standard_normal(16) * s).tolist() for s in (0.05, 0.15, 0.3, 0.4)]
        vectors.append((b * 7).tolist())
    vectors += [(base[0] + random.standard_normal(16) * 0.1).tolist() for _ in range(60)]
    vectors += [base[1].tolist()] * 5
    frame = spark.createDataFrame([(100 - i if i < 50 else 100 + i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in embedding_dups.near_vectors(frame, block=block, tables=60).collect()}
    ids = [100 - i if i < 50 else 100 + i for i in range(len(vectors))]
    linked = vectors_linked(vectors)
    labels = grouped(len(ids), linked)
    least = {}
    for i, x in enumerate(ids):
        least[labels[i]] = min(least.get(labels[i], x), x)
    for i, x in enumerate(ids):
        assert got[x].n_links == sum(i in pair for pair in linked)
        assert got[x].component_id == least[labels[i]]
        assert got[x].kept == (x == least[labels[i]])


def test_recall_of_the_production_setting():
    assert embedding_dups.recall_at(0.95) > 0.99
    random = np.random.default_rng(4)
    a = random.standard_normal((2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = random.standard_normal((2000, 64))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    keys = [embedding_dups.bucket_keys(x, 18, 5, 1.0, 7) for x in (a, 0.95 * a + (1 - 0.95**2) ** 0.5 * b)]
    assert (keys[0] == keys[1]).any(axis=1).mean() > 0.98


def test_embedding_edge_cases(spark):
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, None], 0), (5, [float("nan"), 1.0], 0), (6, [float("inf"), 1.0], 0),
            (7, [1.0, 2.0], 0), (7, [1.0, 2.0], 0), (None, [2.0, 4.0], 1), (8, [1.0, 2.0, 0.0], 0), (9, [1e-30, 2e-30], 0), (None, [-1.0, 0.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, class_id int")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in embedding_dups.near_vectors(df).collect())
    assert got == [(0, 0, 0, False), (0, 3, 7, False), (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True),
                   (6, 0, 6, True), (7, 3, 7, True), (7, 3, 7, True), (8, 0, 8, True), (9, 3, 7, False)]
    assert embedding_dups.near_vectors(df.where("false")).count() == 0


def test_cut_writes_to_the_shared_folder(spark):
    assert cut(spark.range(10)).count() == 10
    assert spark.sparkContext.getCheckpointDir().startswith(("file:" + spark.conf.get("spark.checkpoint.dir"), spark.conf.get("spark.checkpoint.dir")))
