"""Token counts of whole texts by a compiled tokenizer, without making the tokens.

Two deterministic machines stand one in the other: the pattern cuts a text into pieces, the
merges' transducer (:mod:`.transducer`) reads a piece, and each of its transitions carries
the number of tokens it writes. A text is cut into chunks of fixed length. A chunk's state
map says, for any state it may be entered in, how many tokens it writes and in which state
it ends. All entry states meet at the first place where a piece surely ends (white space
after another character), so the map is kept in three parts: the stretch up to that place,
whose count waits for the entry state; the count from there to the last such place; the
stretch after it, which is the state that the chunk ends in. Maps compose associatively, and
a parallel prefix scan gives the map of every prefix; that of the whole text is its count.

An Arrow function on a column: no shuffle, memory bounded by a batch and the tables.

Defined cases: null texts count null (:func:`with_token_counts` with ``null_as_empty``: zero),
empty texts zero. Strings of special tokens inside a text are one token each. Repeated rows
count the same. Other columns stay; columns of the output's names are replaced.
"""

from __future__ import annotations

import gc
from dataclasses import dataclass, field

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches
from .transducer import SURE, SURE_LAST, kept, listed

#: Code points of a chunk.
CHUNK = 1 << 16


@dataclass
class StateMap:
    """``count`` None: no sure place inside, all of the chunk is the head. Open stretches are kept as the
    chunks' own texts, which are joined when they are counted and never before."""

    heads: list[str]
    count: int | None = None
    tails: list[str] = field(default_factory=list)

    @property
    def head(self) -> str:
        return "".join(self.heads)

    @property
    def tail(self) -> str:
        return "".join(self.tails)


class Counter:
    """Counts the tokens of a byte-level vocabulary with listed merges; one per worker and file."""

    _made: dict[tuple[str, str], Counter] = {}

    def __init__(self, path: str, pattern: str):
        self.machine, self.special = listed(path)
        self.pieces = regex.compile(pattern).findall
        self.known = kept(lambda piece: self.machine.count(piece.encode("utf-8", "replace")))
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    @classmethod
    def of(cls, path: str, pattern: str) -> Counter:
        if (path, pattern) not in cls._made:
            cls._made[path, pattern] = cls(path, pattern)
        return cls._made[path, pattern]

    def between(self, text: str) -> int:
        """Tokens from one sure place to another."""
        parts = self.cut.split(text) if self.cut else [text]
        return len(parts) - 1 + sum(sum(map(self.known.__getitem__, self.pieces(x))) for x in parts)

    def state_map(self, chunk: str) -> StateMap:
        if (first := SURE.search(chunk)) is None:
            return StateMap([chunk])
        a, b = first.start(), SURE_LAST.search(chunk).start()
        return StateMap([chunk[:a]], self.between(chunk[a:b]), [chunk[b:]])

    def compose(self, one: StateMap, two: StateMap) -> StateMap:
        left = one.heads if one.count is None else one.tails
        sure = SURE.search(left[-1][-1:] + two.heads[0][:1]) is not None  # the border itself may be a sure place
        if one.count is None and two.count is None:
            return StateMap(one.heads, 0, two.heads) if sure else StateMap(one.heads + two.heads)
        if one.count is None:
            if sure:
                return StateMap(one.heads, self.between(two.head) + two.count, two.tails)
            return StateMap(one.heads + two.heads, two.count, two.tails)
        if two.count is None:
            if sure:
                return StateMap(one.heads, one.count + self.between(one.tail), two.heads)
            return StateMap(one.heads, one.count, one.tails + two.heads)
        met = self.between(one.tail) + self.between(two.head) if sure else self.between(one.tail + two.head)
        return StateMap(one.heads, one.count + met + two.count, two.tails)

    def scan(self, maps: list[StateMap]) -> list[StateMap]:
        """Prefix scan: the maps of the first chunk, the first two, and so on. Neighbours are
        composed in pairs, the pairs scanned, the gaps filled: two compositions a chunk."""
        if len(maps) < 2:
            return maps
        pairs = self.scan([self.compose(maps[i], maps[i + 1]) for i in range(0, len(maps) - 1, 2)])
        out = [maps[0]]
        for i in range(1, len(maps)):
            out.append(pairs[i // 2] if i % 2 else self.compose(pairs[i // 2 - 1], maps[i]))
        return out

    def count(self, text: str, size: int = CHUNK) -> int:
        if len(text) <= size:
            return self.between(text)
        maps = [self.state_map(text[i : i + size]) for i in range(0, len(text), size)]
        while len(maps) > 1:  # of the scan, only its last prefix: pairs, pairs of pairs, and so on
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        whole = maps[0]
        # a text begins and ends at a sure place
        return self.between(whole.head) + (whole.count or 0) + (self.between(whole.tail) if whole.tail else 0)


def token_count(text: Column, path: str, pattern: str, size: int = CHUNK) -> Column:
    """Number of tokens of each text."""

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        counter = Counter.of(path, pattern)
        was = gc.isenabled()
        gc.disable()  # the tables hold many tuples and no cycles
        try:
            return pa.array([None if x is None else counter.count(x, size) for x in (y.as_py() for y in texts)], pa.int64())
        finally:
            if was:
                gc.enable()

    return count(text)


def with_token_counts(df: DataFrame, path: str, pattern: str, *, text: str = "text", limit: int = 1024,
                      null_as_empty: bool = True) -> DataFrame:
    """Adds ``n_bytes`` (of UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens)."""
    small_batches(df.sparkSession)
    whole = F.coalesce(F.col(f"`{text}`"), F.lit("")) if null_as_empty else F.col(f"`{text}`")
    out = df.withColumns({"n_bytes": F.octet_length(whole).cast("long"), "n_tokens": token_count(whole, path, pattern)})
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
