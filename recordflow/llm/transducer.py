"""Byte-pair merges as a lazily determinised finite-state transducer.

A sequence of tokens is what the merges make of a text exactly if every two neighbours are
(:meth:`MergeRules.meets`): no merge across their border comes before the merges that made
them. So the merges are a nondeterministic transducer: a state is the last token written and
the place in the token trie that the bytes since then have reached. :class:`Transducer`
determinises it while it reads. A state is the set of all live guesses; what they agree on
is written at once, which takes a bounded lookahead (at most the longest token), and each
transition is worked out once and kept.

Memory is bounded: the tables are emptied when they pass ``most`` entries, which costs time
but changes no result.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator
from functools import lru_cache

import regex

_OPEN = -1  # a guess that ends on a token's end


class MergeRules:
    """Tokens, their bytes, and which two tokens merge, at which rank.

    ``merges`` maps two token ids to (rank, merged id); None: any two whose joined bytes are
    a token merge, at that token's id as rank (rank files).
    """

    def __init__(self, tokens: dict[bytes, int], merges: dict | None = None):
        self.tokens = tokens
        self.spelt = {i: b for b, i in tokens.items()}
        self._merges = merges
        self._parts: dict[int, tuple[int, int] | None] = {}
        self._meets: dict[int, bool] = {}
        self._edges: dict[int, list[tuple[int, float, float]]] = {}
        self._ranks: dict[int, float] = {}

    def merge(self, left: int, right: int) -> tuple[float, int] | None:
        if self._merges is not None:
            return self._merges.get((left, right))
        made = self.tokens.get(self.spelt[left] + self.spelt[right])
        return None if made is None else (made, made)

    def apply(self, piece: bytes) -> tuple[list[int], list[tuple[int, int, int]]]:
        """The merges by definition: tokens of a short piece, and (left, right, made) in order."""
        row, made = [self.tokens[bytes([b])] for b in piece], []
        while len(row) > 1:
            found = [(m[0], i, m[1]) for i in range(len(row) - 1) if (m := self.merge(row[i], row[i + 1]))]
            if not found:
                break
            _, i, token = min(found)
            made.append((row[i], row[i + 1], token))
            row[i : i + 2] = [token]
        return row, made

    def parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens of the last merge that makes a token; None for a byte or a token
        that the merges never make of its own bytes (:meth:`reached` tells these apart)."""
        if token not in self._parts:
            row, made = self.apply(self.spelt[token])
            self._parts[token] = made[-1][:2] if made and row == [token] else None
            self._ranks[token] = self.merge(*made[-1][:2])[0] if made and row == [token] else -1.0
        return self._parts[token]

    def rank(self, token: int) -> float:
        """When a token is made; -1 for a byte, which is there from the start."""
        self.parts(token)
        return self._ranks[token]

    def reached(self, token: int) -> bool:
        return len(self.spelt[token]) == 1 or self.parts(token) is not None

    def _edge(self, token: int, side: int) -> list[tuple[int, float, float]]:
        """The tokens that stand at one edge while a token is being made: (token, made at, used at)."""
        key = token << 1 | side
        if (known := self._edges.get(key)) is None:
            known, used = [], float("inf")
            while (parts := self.parts(token)) is not None:
                known.append((token, self.rank(token), used))
                used, token = self.rank(token), parts[side]
            known.append((token, self.rank(token), used))
            self._edges[key] = known
        return known

    def meets(self, left: int, right: int) -> bool:
        """Whether the two stay apart when their bytes stand side by side.

        They don't if, at some time, the tokens at the border merge first. Of equal ranks
        the leftmost merge goes first: the one inside ``left``, then the one across.
        """
        key = left << 32 | right
        known = self._meets.get(key)
        if known is None:
            known = True
            for a, made_a, used_a in self._edge(left, 1):
                for b, made_b, used_b in self._edge(right, 0):
                    found = self.merge(a, b)
                    if found and made_a < found[0] < used_a and made_b < found[0] <= used_b:
                        known = False
            self._meets[key] = known
        return known

    def forget(self) -> None:
        self._meets.clear()


def _packed(last: int, guesses) -> tuple[int, ...]:
    """A state as one flat row of numbers: there may be hundreds of thousands."""
    flat = [last]
    for written, node in guesses:
        flat.append(node)
        flat.append(len(written))
        flat += written
    return tuple(flat)


def _unpacked(flat: tuple[int, ...]) -> tuple[int, list[tuple[tuple[int, ...], int]]]:
    guesses, at, whole = [], 1, len(flat)
    while at < whole:
        end = at + 2 + flat[at + 1]
        guesses.append((flat[at + 2 : end], flat[at]))
        at = end
    return flat[0], guesses


class Transducer:
    """Reads bytes of one piece, writes tokens. State 0 is the start of a piece."""

    def __init__(self, rules: MergeRules, most: int = 500_000):
        self.rules, self.most = rules, most
        child: dict[int, int] = {}
        ends: dict[int, int] = {0: _OPEN}
        inner = set()
        for spelt, token in rules.tokens.items():
            node = 0
            for byte in spelt:
                inner.add(node)
                node = child.setdefault(node << 8 | byte, len(child) + 1)
            ends[node] = token
        # (node, byte) -> node there, whether tokens go on from it, token that ends there
        self._child = {key: (n, n in inner, ends.get(n, _OPEN)) for key, n in child.items()}
        self._clear()

    def _clear(self) -> None:
        start = _packed(_OPEN, (((), 0),))
        self.states, self._number = [start], {start: 0}
        # (state, byte) -> next state and, above 32 bits, which of `writes` is written
        self.steps: dict[int, int] = {}
        self.writes: list[tuple[int, ...]] = [()]
        self._write: dict[tuple[int, ...], int] = {(): 0}
        self.rests: dict[int, tuple[int, ...]] = {}

    def step(self, state: int, byte: int) -> int:
        """The transition, which is kept."""
        key = state << 8 | byte
        if (known := self.steps.get(key)) is None:
            state, out = self._determine(*_unpacked(self.states[state]), byte)
            number = self._write.setdefault(out, len(self.writes))
            if number == len(self.writes):
                self.writes.append(out)
            known = self.steps[key] = state | number << 32
        return known

    def _determine(self, last: int, guesses: tuple, byte: int) -> tuple[int, tuple[int, ...]]:
        alive, whole, child, meets = [], None, self._child, self.rules.meets
        shared = 1 << 30
        for written, node in guesses:
            found = child.get(node << 8 | byte)
            if found is None:
                continue
            there, inner, token = found
            if inner:
                alive.append((written, there))
                if len(written) < shared:
                    shared = len(written)
            if token >= 0 and whole is None:
                before = written[-1] if written else last
                if (before < 0 or meets(before, token)) and self.rules.reached(token):
                    whole = (*written, token)
        if whole is None:
            raise ValueError("these merges leave a text without tokens")
        sure = min(shared, len(whole))
        if sure:
            for written, _ in alive:
                while written[:sure] != whole[:sure]:
                    sure -= 1
        if sure:
            out, last = whole[:sure], whole[sure - 1]
            alive = [(w[sure:], n) for w, n in alive]
            whole = whole[sure:]
        else:
            out = ()
            if shared and whole:  # every guess has a token of its own last: what stands before no longer counts
                last = _OPEN
        alive.append((whole, 0))
        state = _packed(last, alive)
        number = self._number.get(state)
        if number is None:
            number = self._number[state] = len(self.states)
            self.states.append(state)
        return number, out

    def rest(self, state: int) -> tuple[int, ...]:
        """What is written when the piece ends here: that of the guess that ends on a token."""
        if (known := self.rests.get(state)) is None:
            guesses = _unpacked(self.states[state])[1]
            known = self.rests[state] = next((w for w, n in guesses if n == 0), ())
        return known

    def run(self, piece: bytes) -> list[int]:
        """The tokens of one piece."""
        if len(self.steps) > self.most:
            self._clear()
            self.rules.forget()
        out: list[int] = []
        state, steps = 0, self.steps
        known = steps.get
        for byte in piece:
            found = known(state << 8 | byte)
            if found is None:
                if len(steps) > 2 * self.most:  # one endless piece: start the tables anew where we are
                    here = self.states[state]
                    self._clear()
                    steps, state = self.steps, len(self.states)
                    known = steps.get
                    self.states.append(here)
                    self._number[here] = state
                found = self.step(state, byte)
            state = found & 0xFFFFFFFF
            if found > 0xFFFFFFFF:
                out += self.writes[found >> 32]
        out += self.rest(state)
        return out

    def count(self, piece: bytes) -> int:
        """How many tokens :meth:`run` writes: the counts of the transitions, added up."""
        if len(self.steps) > self.most:
            self._clear()
            self.rules.forget()
        total = state = 0
        for byte in piece:
            if (found := self.steps.get(state << 8 | byte)) is None:
                if len(self.steps) > 2 * self.most:
                    return len(self.run(piece))  # one endless piece
                found = self.step(state, byte)
            state = found & 0xFFFFFFFF
            if found > 0xFFFFFFFF:
                total += len(self.writes[found >> 32])
        return total + len(self.rest(state))


class _Kept(dict):
    """What a function gives for each piece, kept up to a bound."""

    def __init__(self, work, most: int = 300_000):
        super().__init__()
        self.work, self.most = work, most

    def __missing__(self, piece: str):
        if len(self) >= self.most:
            self.clear()
        out = self.work(piece)
        if len(piece) <= 64:
            self[piece] = out
        return out


def kept(work, most: int = 300_000) -> dict:
    return _Kept(work, most)


#: Between a character and white space after it, no piece goes on, whatever stands around.
SURE = regex.compile(r"(?<=\S)(?=\s)")
SURE_LAST = regex.compile(r"(?r)(?<=\S)(?=\s)")


def stretches(text: str, size: int) -> Iterator[str]:
    """A text in stretches of about ``size`` code points that end where a piece surely ends, so
    that each is split into pieces by itself. A text without such a place is one stretch."""
    begin = 0
    while len(text) - begin > size:
        place = SURE.search(text, begin + size)
        if place is None:
            break
        yield text[begin : place.start()]
        begin = place.start()
    yield text[begin:] if begin else text


@lru_cache(maxsize=2)
def ranked(path: str) -> Transducer:
    """From a rank file: lines of base64 bytes and rank. Kept for the life of a worker."""
    with open(path, "rb") as lines:
        tokens = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
    return Transducer(MergeRules(tokens))


def printable_bytes() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: printable Latin-1
    for itself, the others by code points from 256 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def listed(path: str) -> tuple[Transducer, tuple[str, ...]]:
    """From a JSON file of a byte-level vocabulary with a list of merges: the transducer and
    the strings that stand for special tokens."""
    with open(path, encoding="utf-8") as source:
        file = json.load(source)
    spell = printable_bytes()
    vocab = {text: i for text, i in file["model"]["vocab"].items() if all(c in spell for c in text)}
    tokens = {bytes(spell[c] for c in text): i for text, i in vocab.items()}
    pairs = (tuple(m) if isinstance(m, list) else tuple(m.split(" ", 1)) for m in file["model"]["merges"])
    merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
    special = tuple(t["content"] for t in file.get("added_tokens") or () if not t.get("normalized"))
    return Transducer(MergeRules(tokens, merges)), special
