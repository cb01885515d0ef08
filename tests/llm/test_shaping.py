"""Conversation repair, fill-in-middle and packing against brute force."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import product
from random import Random

import numpy as np
import pytest
from conftest import DATA, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from recordflow.llm import fill_middle, packing, repair
from recordflow.llm.queries import LISTED, PATTERN, QUERIES

TOKENIZER = Tokenizer.from_file(LISTED)

# conversation repair

WORD_CHARACTER = re.compile(r"[^\x20\x09-\x0D]")


def by_hand(role, fault):
    """The edits of a row: cost, letter, initial that stays."""
    if fault not in ("blank", "duplicate"):
        more = 3 * (fault == "truncated")
        if role:
            yield more, "K", role[:1], role
        for new in ("user", "assistant"):
            yield 3 + more, "R", new[0], new
    yield 4, "D", "", None


def all_repairs(faulty):
    """The cheapest (cost, audit, repaired roles) over every repair with up to two insertions in a gap."""
    inserted = [[(3, "I", x[0], x) for x in new] for new in ((), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user"))]
    best = None
    parts = [inserted]
    for row in faulty:
        parts += [[[x] for x in by_hand(*row)], inserted]
    for choice in product(*parts):
        steps = [x for part in choice for x in part]
        if re.fullmatch(r"(s?(ua)+)?", "".join(x[2] for x in steps)):
            found = sum(x[0] for x in steps), "".join(x[1] for x in steps), [x[3] for x in steps if x[3] is not None]
            best = found if best is None else min(best, found, key=lambda f: f[:2])
    return best


def left_to_right(faulty):
    """The same row after row, by the last initial so far: least (cost, audit, steps) of each state."""
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}

    def closed(states):
        for _ in range(4):
            for last, (cost, audit, out) in list(states.items()):
                for new in ("user", "assistant"):
                    if new[0] in follows[last]:
                        put(states, new[0], cost + 3, audit + "I", [*out, (new, None)])
        return states

    def put(states, last, *found):
        if last not in states or found[:2] < states[last][:2]:
            states[last] = found

    states = closed({"": (0, "", [])})
    for i, row in enumerate(faulty):
        after = {}
        for last, (cost, audit, out) in states.items():
            for more, letter, initial, role in by_hand(*row):
                if letter == "D":
                    put(after, last, cost + more, audit + "D", out)
                elif initial in follows[last]:
                    put(after, initial, cost + more, audit + letter, [*out, (role, i)])
        states = closed(after)
    return min((states[x] for x in ("", "a") if x in states), key=lambda f: f[:2])


ROWS = st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "bot", " ", ""]), st.sampled_from([None, "blank", "truncated", "duplicate"])), max_size=3)


def kinds(faulty):
    return "".join("-" if f in ("blank", "duplicate") else (r[:1] if r[:1] in set("sua") else "x").upper() if f else
                   (r[:1] if r[:1] in set("sua") else "x") for r, f in faulty)


@settings(max_examples=40, deadline=None)
@given(ROWS)
def test_cells_are_the_cheapest_of_all_repairs(faulty):
    best = all_repairs(faulty)
    assert repair.cheapest(repair.Chart().span(kinds(faulty)))[:2] == best[:2] == left_to_right(faulty)[:2]


@settings(max_examples=150, deadline=None)
@given(st.text("suaxSUAX-", max_size=30), st.integers(1, 9))
def test_any_split_gives_the_same_table(text, block):
    chart = repair.Chart()
    whole = chart.span(text, 1)
    assert whole == chart.span(text, block)
    for k in range(len(text) + 1):
        assert repair.joined((chart.span(text[:k]), chart.span(text[k:]))) == whole
    faulty = [({"s": "system", "u": "user", "a": "assistant"}.get(c.lower(), "bot"), "blank" if c == "-" else "truncated" if c.isupper() else None) for c in text]
    assert repair.cheapest(whole)[:2] == left_to_right(faulty)[:2]


def conversation(turns):
    """Result of one conversation's rows (turn, role, text), in order."""
    faulty, seen = [], set()
    for _, role, text in turns:
        last = WORD_CHARACTER.findall(text)[-1:]
        fault = "blank" if not last else "duplicate" if (role, text) in seen else None if last[0] in ".!?" else "truncated"
        seen.add((role, text))
        faulty.append((role, fault))
    numbers = [t for t, *_ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
    cost, audit, out = left_to_right(faulty)
    lines = [f"{role}:{'' if i is None else turns[i][2]}" for role, i in out]
    found = Counter(f for _, f in faulty)
    return (gaps, found["blank"], found["duplicate"], found["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def expected(data):
    """Damage and repair of rows (conv_id, turn, role, text)."""
    convs = {c: [] for c, *_ in data}
    for conv, turn, role, text in data:
        spelt = [" " if x is None else x for x in (conv, turn)]
        how = zlib.crc32(f"{spelt[0]}:{spelt[1]}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        convs[conv] += [(turn, "user" if how == 4 else role, text)] * (0 if how == 0 else 2 if how == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    return {c: conversation(sorted(t, key=order)) for c, t in convs.items()}


COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


@pytest.fixture
def write(spark, folder):
    def put(name, data, schema, **extra):
        frame = spark.createDataFrame(data, schema)
        for column, value in extra.items():
            frame = frame.withColumn(column, F.lit(value))
        frame.write.parquet(f"{folder}/{name}.parquet")
        return folder

    return put


CONVERSATION = "conv_id long, turn long, role string, text string"


def test_repair_of_the_given_conversations(spark):
    data = [tuple(r) for r in spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in QUERIES["op11_conversation_repair"](spark, DATA).select(*COLUMNS).collect()}
    assert got == expected(data)


def test_repair_of_odd_rows(spark, write):
    """Nulls everywhere, tied turns, repeats, other roles, a conversation over many parts."""
    random = Random(3)
    data = [(None, None, None, None), (None, 4, "user", "a."), (None, 4, "assistant", "b."), (1, None, "system", "s."), (1, 2, "", ""), (1, 2, "user", "é 日本."),
            (1, 2, "user", "é 日本."), (2, -5, "bot", "\x85."), (2, 9, "usher", "x　"), (3, None, None, "\x1c"), (4, 1, "User", "y!")]
    roles = ["user", "assistant", "system", "bot", None]
    data += [(5, random.choice([None, *range(900)]), random.choice(roles), random.choice(["hm", "yes.", "no!", "", f"text {i}?"])) for i in range(1500)]
    data += [(6, 3, "user", "the same.")] * 700 + [(c, t, random.choice(roles), "w " * random.randint(0, 9) + ".") for c in range(7, 60) for t in range(random.randint(1, 5))]
    folder = write("conversations", data, CONVERSATION, place=1, part="p", fault=2, same="x")
    got = QUERIES["op11_conversation_repair"](spark, folder).select(*COLUMNS).collect()
    want = expected(data)
    assert len(got) == len(want) and {r.conv_id: tuple(r)[1:] for r in got} == want


def test_repair_of_empty_tables_and_long_texts(spark, write, tmp_path):
    folder = write("conversations", [], CONVERSATION)
    assert QUERIES["op11_conversation_repair"](spark, folder).count() == 0
    long = [(1, 0, "user", "w" * 3_000_000 + " "), (1, 1, "assistant", ". " * 1_000_000)]
    frame = spark.createDataFrame(long, CONVERSATION)
    found, after = repair.repaired(frame)
    assert rows(found) == [(1, 0, 0, 0, 1, 0, 3, "KK")]
    assert [(r.role, r.text) for r in after.orderBy("place", "sub").collect()] == [(x[2], x[3]) for x in long]


# fill in the middle


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aB \n.é😀z1_"), max_size=40), st.integers(0, 1 << 32), st.integers(0, 1 << 32), st.sampled_from([1, 2, 5, 1 << 20]))
def test_cuts_fall_between_units(text, first, second, size):
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    small, large = sorted((first % (n + 1), second % (n + 1)))
    assert fill_middle.cuts(text, first, second, size) == (n, len("".join(units[:small])), len("".join(units[:large])))


def test_very_long_texts_are_cut_in_linear_time(spark):
    for text in ("a1" * 1_500_000, "a" * 3_000_000, " " * 3_000_000):
        n, one, two = fill_middle.cuts(text, 5, 1_234_567)
        assert n in (1, len(text)) and one <= two <= len(text)


def test_fill_middle_of_odd_rows(spark):
    texts = [None, "", "one <P> mark", "<S>", "a<M>b", "<", "ends with <", "S>begins", "é日本😀 word\nnext\ttab", "x" * 100_000, "word, " * 30_000, "same", "same"]
    data = [(i if i % 3 else None, t, "kept") for i, t in enumerate(texts * 9)]
    df = spark.createDataFrame(data, "doc_id long, text string, cut string").withColumn("Drawn", F.lit(3))
    out = fill_middle.transformed(df).withColumn("back", fill_middle.restored(F.col("output"), F.col("form")))
    got = out.collect()
    assert out.columns[:4] == df.columns and len(got) == len(data)
    forms = Counter()
    for r in got:
        text = r.text or ""
        digest = hashlib.sha256(f"1:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()
        h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
        units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
        n = len(units)
        one, two = (len("".join(units[:k])) for k in sorted((h[0] % (n + 1), h[1] % (n + 1))))
        plain = not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90
        form = "plain" if plain else "spm" if h[3] % 100 < 20 else "psm"
        p, m, s = text[:one], text[one:two], text[two:]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, *((None, None) if plain else (one, two - one)))
        assert r.output == {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
        assert r.back == text and r.cut == "kept" and r.Drawn == 3
        forms[form] += 1
    assert len(forms) == 3
    assert fill_middle.transformed(df.where("false")).count() == 0


# packing

LENGTHS = st.lists(st.integers(1, 20), max_size=60)


def lengths_of(plan):
    return Counter(x for held, times in plan for x in held for _ in range(times))


@settings(max_examples=150, deadline=None)
@given(LENGTHS, st.integers(20, 40))
def test_plans_hold_every_length_once(lengths, room):
    counts = np.bincount(lengths, minlength=room + 1)
    for plan in (packing.best_fit(counts, room), packing.complete(counts, room)):
        assert lengths_of(plan) == Counter(lengths) and all(sum(held) <= room and times > 0 for held, times in plan)
    assert packing.least_bins(counts, room) <= packing.n_bins(packing.complete(counts, room)) <= packing.n_bins(packing.best_fit(counts, room))


def fewest(lengths, room):
    """By trying every sequence for every piece."""
    best = len(lengths)

    def put(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for k in {b: k for k, b in enumerate(bins) if b >= lengths[i]}.values():
            put(i + 1, bins[:k] + [bins[k] - lengths[i]] + bins[k + 1 :])
        put(i + 1, [*bins, room - lengths[i]])

    lengths = sorted(lengths, reverse=True)
    put(0, [])
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_bounds_never_exceed_the_fewest_sequences(lengths):
    counts = np.bincount(lengths, minlength=21)
    assert packing.least_bins(counts, 20) <= fewest(lengths, 20) <= packing.n_bins(packing.complete(counts, 20))


def test_bin_completion_beats_best_fit():
    """Three lengths a sequence, and sizes around a third, where longest-first is poor."""
    random = np.random.default_rng(5)
    for n in (1000, 10_000, 100_000):
        counts = np.bincount(random.integers(250, 400, n), minlength=1025)
        assert packing.n_bins(packing.complete(counts, 1024)) <= 0.98 * packing.n_bins(packing.best_fit(counts, 1024))
    exact = 0
    for _ in range(30):
        lengths = random.integers(15, 51, 11).tolist()
        exact += packing.n_bins(packing.complete(np.bincount(lengths, minlength=101), 100)) == fewest(lengths, 100)
    assert exact >= 29


def check_packing(got, texts, room=1024):
    """Rows (doc_id, piece, start, length, ids_crc32, sequence_id, offset) of texts by id."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(docs) == set(texts)
    for key, text in texts.items():
        ids = np.array([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        parts = sorted(docs[key], key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(len(parts))) and all(r.length == room for r in parts[1:])
        assert sum(r.length for r in parts) == len(ids) and 1 <= parts[0].length <= room
        at = 0
        for r in parts:
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= room
    assert set(sequences) == set(range(len(sequences)))
    return len(sequences)


def test_packing_of_the_given_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = QUERIES["op13_best_fit_packing"](spark, DATA).collect()
    n = check_packing(got, {r.doc_id: r.text for r in docs.collect()})
    assert n <= -(-sum(r.length for r in got) // 1024) * 1.02 + 1


def test_packing_of_odd_rows(spark, write):
    texts = {1: None, 2: "", 3: "<|endoftext|> and <|endof", 4: " " * 60_000 + "x", 5: "é😀日本 " * 3000, 6: "x" * 20_000, 7: "a b", None: "nobody's"}
    data = list(texts.items()) + [(7, "a b")] * 300 + [(i, "w " * (i % 700)) for i in range(100, 400)]
    folder = write("documents", data, "doc_id long, text string", part=1, number="n", begin=0.5, sequence_id=1, offset="o")
    got = QUERIES["op13_best_fit_packing"](spark, folder).collect()
    assert sum(r.doc_id == 7 for r in got) == 301
    first = {}
    rest = [r for r in got if r.doc_id != 7 or first.setdefault("row", r) is r]
    texts |= {i: "w " * (i % 700) for i in range(100, 400)}
    for key, text in texts.items():
        assert sum(r.length for r in rest if r.doc_id == key) == len(TOKENIZER.encode(text or "", add_special_tokens=False).ids) + 1
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for held in places.values():
        held.sort()
        assert [o for o, _ in held] == [sum(n for _, n in held[:i]) for i in range(len(held))] and sum(n for _, n in held) <= 1024
    pieces = packing.pieces(spark.read.parquet(f"{folder}/documents.parquet"), LISTED, PATTERN)
    for r in pieces.where("doc_id in (3, 4, 5, 6)").collect():
        ids = [*TOKENIZER.encode(texts[r.doc_id], add_special_tokens=False).ids, 2]
        assert np.frombuffer(r.ids, "<u4").tolist() == ids[r.start : r.start + r.length]


def test_packing_keeps_columns_and_takes_empty_tables(spark):
    frame = spark.createDataFrame([(i, 0, 1 + i % 10, "x") for i in range(200)], "doc_id long, piece int, length int, part string").withColumn("begin", F.lit(1))
    out = packing.packed(frame, room=10)
    assert out.columns == [*frame.columns, "sequence_id", "offset"]
    got = out.collect()
    assert len(got) == 200 and len({r.sequence_id for r in got}) == 110
    assert packing.packed(frame.where("false"), room=10).count() == 0
    with pytest.raises(ValueError):
        packing.packed(frame, room=9)
