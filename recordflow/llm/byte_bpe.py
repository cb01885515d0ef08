"""Byte-level BPE: texts to token ids and back.

Encoding splits a text into pieces by a pattern and runs each through the merges, compiled
into a lazily determinised transducer (:mod:`.transducer`). Decoding is a stream over ids:
an incremental UTF-8 state machine takes the tokens' bytes as they come, so that a
character may be cut by any number of token borders.

Both are Arrow functions on a column: no shuffle, memory bounded by a batch and by the
transducer's tables, nothing to redo but the lost task. Ids are a binary column of
little-endian unsigned 32-bit integers, four bytes a token.

Defined cases: a null text has null ids, a null id column a null text; an empty text has
empty ids. Repeated rows are worked on each for itself, in every order with the same result.
Other columns stay as they are; a column of the output's name is replaced.
"""

from __future__ import annotations

import gc
from collections.abc import Iterable, Iterator
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, take_over
from .transducer import Transducer, kept, ranked, stretches

#: Code points of a text that are split into pieces at once.
STRETCH = 1 << 20
#: Rows of a batch that are worked on at once.
FEW = 64


def utf8_ranges() -> dict[int, tuple[int, int, int]]:
    """For each first byte of a longer character: bytes to come, and bounds of the next one
    (well-formed UTF-8: no overlong form, no surrogate, nothing above U+10FFFF)."""
    table = {}
    for first in range(0xC2, 0xF5):
        more = 1 + (first >= 0xE0) + (first >= 0xF0)
        low = {0xE0: 0xA0, 0xF0: 0x90}.get(first, 0x80)
        high = {0xED: 0x9F, 0xF4: 0x8F}.get(first, 0xBF)
        table[first] = (more, low, high)
    return table


class Utf8Stream:
    """An incremental UTF-8 state machine. State: the bytes of the open character, how many are
    to come and the bounds of the next. A sequence that goes wrong gives U+FFFD."""

    FIRST = utf8_ranges()

    def __init__(self):
        self.open, self.more, self.low, self.high = b"", 0, 0x80, 0xBF

    def feed(self, part: bytes) -> str:
        out = []
        for byte in part:
            if self.more and not self.low <= byte <= self.high:
                out.append("�")
                self.open, self.more = b"", 0
            if self.more:
                self.open += bytes([byte])
                self.more, self.low, self.high = self.more - 1, 0x80, 0xBF
                if not self.more:
                    out.append(self.open.decode())
                    self.open = b""
            elif byte < 0x80:
                out.append(chr(byte))
            elif byte in self.FIRST:
                self.open, (self.more, self.low, self.high) = bytes([byte]), self.FIRST[byte]
            else:
                out.append("�")
        return "".join(out)

    def end(self) -> str:
        """What an open character leaves."""
        out = "�" if self.more else ""
        self.open, self.more = b"", 0
        return out


class Codec:
    """Encoder and decoder of one vocabulary; one per worker and file."""

    _made: dict[tuple[str, str], Codec] = {}

    def __init__(self, machine: Transducer, pattern: str):
        self.machine, self.pieces = machine, regex.compile(pattern).findall
        self.known = kept(self._packed)
        # tokens that begin and end between characters, as text; the rest go through the machine
        self.whole: dict[int, str | None] = {}
        for token, spelt in machine.rules.spelt.items():
            try:
                self.whole[token] = spelt.decode()
            except UnicodeDecodeError:
                self.whole[token] = None

    @classmethod
    def of(cls, path: str, pattern: str) -> Codec:
        take_over("byte_bpe", cls._forget)
        if (path, pattern) not in cls._made:
            cls._made[path, pattern] = cls(ranked(path), pattern)
        return cls._made[path, pattern]

    @classmethod
    def _forget(cls) -> None:
        cls._made.clear()
        ranked.cache_clear()

    def _packed(self, piece: str) -> bytes:
        spelt = piece.encode("utf-8", "replace")
        token = self.machine.rules.tokens.get(spelt)  # a piece that is a token is that token
        ids = self.machine.run(spelt) if token is None else [token]
        return pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids of a text, packed."""
        known = self.known.__getitem__
        return b"".join(b"".join(map(known, self.pieces(part))) for part in stretches(text, STRETCH))

    def decode(self, packed: bytes) -> str:
        """The text of packed ids, token by token. An id outside the vocabulary is an error."""
        ids = np.frombuffer(packed, "<u4").tolist()
        parts = list(map(self.whole.__getitem__, ids))
        if None in parts:
            parts = list(self._stream(ids, parts))
        return "".join(parts)

    def _stream(self, ids: list[int], parts: Iterable[str | None]) -> Iterator[str]:
        stream, spelt = Utf8Stream(), self.machine.rules.spelt
        for token, text in zip(ids, parts, strict=True):
            yield text if text is not None and not stream.more else stream.feed(spelt[token])
        yield stream.end()


def _each(texts: pa.Array, work, kind: pa.DataType) -> pa.Array:
    """A few rows at a time, so that Python objects of few rows live at once. Without the cycle
    collector: the tables hold many tuples and no cycles."""
    was = gc.isenabled()
    gc.disable()
    try:
        parts = [pa.array([None if x is None else work(x) for x in texts.slice(i, FEW).to_pylist()], kind)
                 for i in range(0, len(texts), FEW)]
        return pa.concat_arrays(parts) if parts else pa.array([], kind)
    finally:
        if was:
            gc.enable()


def encoded(text: Column, path: str, pattern: str) -> Column:
    """Packed ids of a text column, as bytes."""

    @F.arrow_udf("binary")
    def encode(texts: pa.Array) -> pa.Array:
        return _each(texts, Codec.of(path, pattern).encode, pa.binary())

    return encode.asNondeterministic()(text)  # it isn't: so Spark runs it once, however often it is named


def decoded(ids: Column, path: str, pattern: str) -> Column:
    """The text of a column of packed ids."""

    @F.arrow_udf("string")
    def decode(packed: pa.Array) -> pa.Array:
        return _each(packed, Codec.of(path, pattern).decode, pa.string())

    return decode.asNondeterministic()(ids)


def round_trip(df: DataFrame, path: str, pattern: str, text: str = "text", out: str = "both") -> DataFrame:
    """Adds packed ids of a text and the text that they decode to, as a struct ``ids, decoded``:
    both ways in one pass over the rows and one set of tables."""
    small_batches(df.sparkSession)

    @F.arrow_udf("struct<ids: binary, decoded: string>")
    def both(texts: pa.Array) -> pa.Array:
        codec = Codec.of(path, pattern)
        ids = _each(texts, codec.encode, pa.binary())
        return pa.StructArray.from_arrays([ids, _each(ids, codec.decode, pa.string())], ["ids", "decoded"])

    return df.withColumn(out, both.asNondeterministic()(F.col(f"`{text}`")))


def encode_texts(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds packed ids and, as ``n_<ids>``, their number."""
    small_batches(df.sparkSession)
    out = df.withColumn(ids, encoded(F.col(f"`{text}`"), path, pattern))
    return out.withColumn(f"n_{ids}", (F.length(F.col(f"`{ids}`")) / 4).cast("long"))


def decode_ids(df: DataFrame, path: str, pattern: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds the text of packed ids."""
    small_batches(df.sparkSession)
    return df.withColumn(text, decoded(F.col(f"`{ids}`"), path, pattern))
