"""Byte-level BPE and token counts against the libraries, piece by piece and in frames."""

from __future__ import annotations

import hashlib
import sys
from random import Random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import DATA
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from recordflow.llm import byte_bpe, token_counts
from recordflow.llm.byte_bpe import Codec, Utf8Stream
from recordflow.llm.queries import LISTED, PATTERN, QUERIES, RANKS
from recordflow.llm.token_counts import Counter
from recordflow.llm.transducer import MergeRules, Transducer, stretches

CODEC, COUNTER = Codec.of(RANKS, PATTERN), Counter.of(LISTED, PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=CODEC.machine.rules.tokens, special_tokens={})
TOKENIZER = Tokenizer.from_file(LISTED)
PARTS = ["a", "aa", "é", "日本", "😀", "x", "  ", "\n", " ", "1", "12", "!", "--", "'s", "'ll", "'", "\t", "zz", "A",
         "<|endoftext|>", "<|end", "ñ", "́", " the", "ing"]
TEXTS = st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=4)), max_size=25).map("".join)


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_ids_are_the_library_s_and_decode_to_the_text(text):
    text = text.encode("utf-8", "replace").decode()
    packed = CODEC.encode(text)
    assert ids(packed) == LIBRARY.encode_ordinary(text)
    assert CODEC.decode(packed) == text


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.integers(1, 9))
def test_counts_are_the_library_s_for_any_chunk(text, size):
    text = text.encode("utf-8", "replace").decode()
    assert COUNTER.count(text, size) == len(TOKENIZER.encode(text, add_special_tokens=False).ids)


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.integers(1, 9), st.data())
def test_state_maps_compose_in_any_order(text, size, data):
    maps = [COUNTER.state_map(text[i : i + size]) for i in range(0, len(text), size)]
    prefixes = COUNTER.scan(maps)
    for i, one in enumerate(prefixes):
        assert COUNTER.between(one.head) + (one.count or 0) + (COUNTER.between(one.tail) if one.tail else 0) == \
            COUNTER.count(text[: (i + 1) * size], sys.maxsize)


@pytest.mark.parametrize("text", ["a" * 5000, " " * 3001, "=" * 2001, "é" * 999, "ab" * 2000, "\n " * 700, "日" * 3000])
def test_long_runs(text):
    assert ids(CODEC.encode(text)) == LIBRARY.encode_ordinary(text)
    assert COUNTER.count(text, 64) == len(TOKENIZER.encode(text).ids)


def test_small_tables_change_no_result():
    small = Transducer(CODEC.machine.rules, most=50)
    for piece in ("antidisestablishment", "xyzzy" * 40, "é" * 30, "unbelievable", "antidis"):
        assert small.run(piece.encode()) == CODEC.machine.run(piece.encode())
        assert small.count(piece.encode()) == len(CODEC.machine.run(piece.encode()))
    assert len(small.steps) <= 110


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "ab", "ba", "aa", "abb", "bab"]), min_size=1, max_size=12), st.integers(0, 1 << 30))
def test_the_machine_is_the_merges_for_any_order_of_merges(parts, seed):
    """Against the merges by definition, over small vocabularies grown by random merges."""
    tokens, merges, random = {bytes([b]): b for b in range(256)}, {}, Random(seed)
    while len(merges) < 8:
        left, right = random.choice([t for t in tokens if set(t) <= set(b"ab")]), random.choice([t for t in tokens if set(t) <= set(b"ab")])
        if left + right not in tokens and len(left + right) <= 6:
            tokens[left + right] = 256 + len(merges)
            merges[tokens[left], tokens[right]] = (len(merges), tokens[left + right])
    rules = MergeRules(tokens, merges)
    piece = "".join(parts).encode()
    assert Transducer(rules).run(piece) == rules.apply(piece)[0]


def test_stretches_join_to_the_text():
    text = "one two  three\n\nfour five " * 50
    assert "".join(stretches(text, 7)) == text
    assert [i for part in stretches(text, 7) for i in LIBRARY.encode_ordinary(part)] == LIBRARY.encode_ordinary(text)
    assert list(stretches("x" * 100, 7)) == ["x" * 100]


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=30), st.integers(1, 5))
def test_stream_decodes_as_the_standard_says(data, size):
    stream = Utf8Stream()
    out = "".join(stream.feed(data[i : i + size]) for i in range(0, len(data), size)) + stream.end()
    assert out == data.decode("utf-8", "replace")


def test_query_gives_the_library_s_digests(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = QUERIES["op3_byte_bpe"](spark, DATA).collect()
    assert len(got) == len(texts)
    for r in got:
        wanted = LIBRARY.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(wanted)
        assert r.ids_sha256 == hashlib.sha256(np.array(wanted, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    counted = {r.doc_id: r for r in QUERIES["op6_token_counts"](spark, DATA).collect()}
    for key, text in texts.items():
        n = len(TOKENIZER.encode(text, add_special_tokens=False).ids)
        assert (counted[key].n_tokens, counted[key].n_bytes, counted[key].over_limit) == (n, len(text.encode()), n > 1024)


def test_frames_with_nulls_repeats_and_clashing_names(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "hello world" * 9000, None), (3, "hello world" * 9000, None), (None, "a", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_ids string")
    out = byte_bpe.encode_texts(df, RANKS, PATTERN)
    back = byte_bpe.decode_ids(out, RANKS, PATTERN)
    assert back.columns == ["doc_id", "text", "n_ids", "ids", "decoded"]
    for r in back.collect():
        assert r.decoded == r.text
        assert r.n_ids == (None if r.text is None else len(LIBRARY.encode_ordinary(r.text)))
    counted = token_counts.with_token_counts(df.withColumn("n_tokens", F.lit("old")), LISTED, PATTERN)
    assert sorted((r.doc_id or 0, r.n_tokens, r.n_bytes) for r in counted.collect())[:2] == [(0, 1, 1), (1, 0, 0)]
    kept = token_counts.with_token_counts(df, LISTED, PATTERN, null_as_empty=False).where("doc_id = 1").first()
    assert kept.n_tokens is None
    empty = df.where("false")
    assert byte_bpe.decode_ids(byte_bpe.encode_texts(empty, RANKS, PATTERN), RANKS, PATTERN).count() == 0
    assert token_counts.with_token_counts(empty, LISTED, PATTERN).count() == 0


def test_path_is_a_parameter():
    assert Codec.of(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), PATTERN).decode(
        Codec.of(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), PATTERN).encode("été 日本 x")) == "été 日本 x"


def test_a_long_text_without_blanks_takes_little_memory():
    import resource
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    assert COUNTER.count("x1" * 2_000_000) == len(TOKENIZER.encode("x1" * 1000, add_special_tokens=False).ids) * 2000
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 300_000


def test_a_worker_keeps_the_tables_of_one_operator_at_a_time():
    from recordflow.llm import common

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    first = byte_bpe.Codec.of(path, pattern)
    ids = first.encode("some text, some more")
    assert byte_bpe.Codec.of(path, pattern) is first
    common.take_over("another")
    assert not byte_bpe.Codec._made and "byte_bpe" not in common._KEPT
    again = byte_bpe.Codec.of(path, pattern)
    assert again is not first and again.encode("some text, some more") == ids
