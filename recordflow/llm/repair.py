"""Conversation structure repair by weighted interval parsing.

A repaired conversation's role initials are ``(s?(ua)+)?``. Each row is kept (0), given the role user
or assistant (3) or deleted (4; rows with nothing in them and repeats must be), rows without text may be
put in anywhere (3), and a row that breaks off costs 3 if it stays. Of the cheapest repairs the one whose
edit initials (its *audit*) sort first is taken.

**Grammar.** In Chomsky normal form, over non-terminals named by the first and last initial of what they
span: nothing, s..s, u..u, u..a, a..u, a..a, s..u, s..a; ``X -> Y Z`` holds where Z may follow Y, and
nothing may stand at either side of anything. A cell of the chart is the least (cost, audit) with which
a span of rows becomes a non-terminal. Insertions are a closure: the cells of the empty span, put around
each single row. Two audits of one cost never begin one another (the cost is a function of the audit and
every insertion costs), so the least parts make the least whole.

**Chart.** Spans of up to ``BLOCK`` rows are combined bottom-up by length over all splits; tables of spans
with the same kinds of rows are kept. The non-terminals are closed under concatenation, so all splits of a
longer span give the same table: from there on, neighbours are combined in pairs, pairs in fours, and so on.

**At size.** A conversation may hold a third of all rows. Rows are range-sorted by (conversation, turn) with
their texts once and written; a part of that table holds a stretch of a long conversation. Each part gives,
per conversation, one row with the table of its stretch (:func:`_stretches`); these meet per conversation,
one row a part, without texts. The audit goes back in slices, one per stretch, as edits of single rows, which
meet their texts by place. Repeats are found by grouping hashes. What grows with a conversation in one task is
its audit, one letter a row, which is one value of the result.

Defined cases: null roles and texts are one space; null turns come first and count for no gap; null ids are
one conversation. An empty role has no initial and can't stay. Rows of one turn go by role, then text. Empty tables give empty results. Other columns
take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, scratch, small_batches

#: Costs of edits, and of a row that breaks off and stays.
REROLE, DELETE, INSERT, BROKEN = 3, 4, 3, 3
#: Rows of a span that is combined over all splits.
BLOCK = 8
_KEPT_SPANS = 1 << 16

_BLANKS = " \t\n\x0b\x0c\r"
_NAMES = ("", "ss", "uu", "ua", "au", "aa", "su", "sa")
_WHOLE = tuple(_NAMES.index(x) for x in ("", "ua", "sa"))
_FOLLOWS = ("su", "ua", "au")
_RULES = [
    (_NAMES.index(y or z if not (y and z) else y[0] + z[1]), _NAMES.index(y), _NAMES.index(z))
    for y in _NAMES for z in _NAMES if not y or not z or y[1] + z[0] in _FOLLOWS]

Table = tuple[tuple[int, str] | None, ...]


# the chart


def joined(*pairs: tuple[Table, Table]) -> Table:
    """The table of a span, from those of its two parts, for each given split."""
    best: list[tuple[int, str] | None] = [None] * len(_NAMES)
    for left, right in pairs:
        for made, y, z in _RULES:
            if left[y] is not None and right[z] is not None:
                cell = (left[y][0] + right[z][0], left[y][1] + right[z][1])
                if best[made] is None or cell < best[made]:
                    best[made] = cell
    return tuple(best)


def _table(**cells: tuple[int, str]) -> Table:
    return tuple(cells.get(name or "nothing") for name in _NAMES)


def _closure() -> Table:
    """The empty span: what insertions alone make."""
    table, before = _table(nothing=(0, ""), uu=(INSERT, "I"), aa=(INSERT, "I")), None
    while table != before:
        table, before = joined((table, table)), table
    return table


_EMPTY = _closure()


def row_table(kind: str) -> Table:
    """The span of one row. Kinds are the initial s, u, a or x for any other, in capitals if the row
    breaks off, and ``-`` for a row that must go."""
    cells = {"nothing": (DELETE, "D")}
    if kind != "-":
        more, initial = BROKEN * kind.isupper(), kind.lower()
        for name in "ua":
            cells[name * 2] = (more, "K") if name == initial else (REROLE + more, "R")
        if initial == "s":
            cells["ss"] = (more, "K")
    return joined((joined((_EMPTY, _table(**cells))), _EMPTY))


class Chart:
    """Tables of spans by their rows' kinds; one per worker."""

    def __init__(self):
        self.known: dict[str, Table] = {}

    def block(self, kinds: str) -> Table:
        """All spans of a block, bottom-up by length, over all splits."""
        if len(self.known) > _KEPT_SPANS:
            self.known.clear()
        for length in range(1, len(kinds) + 1):
            for i in range(len(kinds) - length + 1):
                span = kinds[i : i + length]
                if span not in self.known:
                    self.known[span] = row_table(span) if length == 1 else joined(*(
                        (self.known[span[:k]], self.known[span[k:]]) for k in range(1, length)))
        return self.known[kinds]

    def span(self, kinds: str, block: int = BLOCK) -> Table:
        return combined([self.block(kinds[i : i + block]) for i in range(0, len(kinds), block)])


def combined(tables: list[Table]) -> Table:
    """The table of neighbouring spans: pairs, pairs of pairs, and so on."""
    while len(tables) > 1:
        tables = [joined(tuple(tables[i : i + 2])) if i + 1 < len(tables) else tables[i] for i in range(0, len(tables), 2)]
    return tables[0] if tables else _EMPTY


def cheapest(table: Table) -> tuple[int, str, bool]:
    """Cost, audit, and whether the repair begins with a system row."""
    cell, i = min((table[i], i) for i in _WHOLE if table[i] is not None)
    return *cell, _NAMES[i] == "sa"


# rows


def damaged(df: DataFrame) -> DataFrame:
    """Rows ``conv_id, turn, role, text`` with faults put in by a checksum of ``conv_id:turn`` modulo 20:
    0 drops the row, 1 empties its text, 2 takes its ``.!?`` away, 3 repeats it, 4 makes it a user's."""
    spelt = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    how = F.crc32(F.concat(spelt[0], F.lit(":"), spelt[1])) % 20
    text = F.when(how == 1, "").when(how == 2, F.translate(spelt[3], ".!?", "")).otherwise(spelt[3])
    rows = df.select("conv_id", "turn", F.when(how == 4, "user").otherwise(spelt[2]).alias("role"), text.alias("text"),
                     F.when(how == 0, 0).when(how == 3, 2).otherwise(1).alias("copies"))
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(True), F.col("copies")))).drop("col")


def _sorted_rows(df: DataFrame) -> DataFrame:
    """The rows in order, written once: ``part``, ``place`` (rising over the whole table, without gaps in a
    part), and what an edit needs to know of a text."""
    rows = df.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    # rows that are equal in all columns are told apart by a number, so that no range has to hold them all
    dealt = rows.repartitionByRange(*order, F.rand(1)).sortWithinPartitions(*order)
    end = F.rtrim(F.col("text"), F.lit(_BLANKS))
    path = scratch(df.sparkSession, "conversations")
    dealt.select(
        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"), *order, F.md5("text").alias("same"),
        (end == "").alias("blank"), (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("breaks_off")).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def with_faults(rows: DataFrame) -> DataFrame:
    """Rows without texts, with their first fault (blank, duplicate, truncated or null)."""
    narrow = rows.select("part", "place", "conv_id", "turn", "role", "same", "blank", "breaks_off")
    again = narrow.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("same").alias("s")).agg(
        F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    met = narrow.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("same") == F.col("s")), "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("place") > F.col("first"), "duplicate").when(F.col("breaks_off"), "truncated")
    return met.select("part", "place", "conv_id", "turn", F.left("role", F.lit(1)).alias("initial"), fault.alias("fault"))


_COUNTS = ("blank", "duplicate", "truncated", "illegal", "distinct_turns")
_STRETCH = ("first long, n long, low long, high long, before string, after string, "
            + ", ".join(f"{c} long" for c in _COUNTS) + ", costs array<long>, audits array<string>")


def _runs(batches: Iterable[pa.RecordBatch], same: int) -> Iterator[list[dict]]:
    """Rows of sorted batches in lists of equal values in the first ``same`` columns, a batch at a time:
    ``None`` ends a run."""
    open_, names = None, None
    for batch in batches:
        names = batch.schema.names[:same]
        run: list[dict] = []
        for row in batch.to_pylist():
            key = [row[c] for c in names]
            if open_ is not None and key != open_:
                if run:
                    yield run
                    run = []
                yield None
            open_ = key
            run.append(row)
        if run:
            yield run
    if open_ is not None:
        yield None


def _link(total: dict, one: dict) -> None:
    """Adds the counts of the following rows to those of a stretch, with what lies across their border."""
    for c in _COUNTS:
        total[c] += one[c]
    if total["after"] is not None:
        total["illegal"] += total["after"] + one["before"] not in _FOLLOWS
    if total["high"] is not None and total["high"] == one["low"]:
        total["distinct_turns"] -= 1
    total["before"] = one["before"] if total["before"] is None else total["before"]
    total["after"] = one["after"]
    total["low"] = one["low"] if total["low"] is None else total["low"]
    total["high"] = total["high"] if one["high"] is None else one["high"]


def _nothing() -> dict:
    return dict.fromkeys(_COUNTS, 0) | dict.fromkeys(("before", "after", "low", "high"))


def _stretches(rows: DataFrame, kind: str) -> DataFrame:
    """One row per part and conversation: counts, first and last turn and initial, and the table of cells."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chart, total, kinds, conv, out = Chart(), None, [], None, []

        def sent(out: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(out, schema=schema)

        fields = {"first": pa.int64(), "n": pa.int64(), "low": pa.int64(), "high": pa.int64(), "before": pa.string(), "after": pa.string()}
        fields |= dict.fromkeys(_COUNTS, pa.int64()) | {"costs": pa.list_(pa.int64()), "audits": pa.list_(pa.string())}
        schema = None
        for run in _runs(_typed(batches, holder := []), 2):
            schema = schema or pa.schema([("conv_id", holder[0].field("conv_id").type), *fields.items()])
            if run is not None:
                if total is None:
                    total, conv = _nothing() | {"first": run[0]["place"], "n": 0}, run[0]["conv_id"]
                for r in run:
                    initial, fault, turn = r["initial"], r["fault"], r["turn"]
                    _link(total, dict.fromkeys(_COUNTS, 0) | {"before": initial, "after": initial, "low": turn, "high": turn}
                          | {"distinct_turns": int(turn is not None)} | ({fault: 1} if fault else {}))
                    initial = initial if initial in ("s", "u", "a") else "x"
                    kinds.append("-" if fault in ("blank", "duplicate") else initial.upper() if fault else initial)
                total["n"] += len(run)
                continue
            table = chart.span("".join(kinds))
            out.append(total | {"conv_id": conv, "costs": [c and c[0] for c in table], "audits": [c and c[1] for c in table]})
            total, kinds = None, []
            if len(out) >= 1000 or len(out[-1]["audits"][0]) > 1 << 20:
                yield sent(out)
                out = []
        if out:
            yield sent(out)

    ordered = rows.select("part", "conv_id", "place", "turn", "initial", "fault").repartition("part").sortWithinPartitions("part", "place")
    return ordered.mapInArrow(work, f"conv_id {kind}, {_STRETCH}")


def _typed(batches: Iterable[pa.RecordBatch], holder: list) -> Iterator[pa.RecordBatch]:
    """The batches, their schema noted in ``holder``."""
    for batch in batches:
        holder.append(batch.schema) if not holder else None
        yield batch


def _repairs(stretches: DataFrame, kind: str) -> DataFrame:
    """One row per stretch: its ``slice`` of the audit, rows in the repair ``before_it``, and ``system`` (the
    repair begins with one). The first stretch of a conversation carries its counts, cost and audit."""
    fields = [("gaps", "long"), ("blank", "long"), ("duplicate", "long"), ("truncated", "long"), ("illegal", "long"), ("cost", "long"), ("audit", "string")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for run in _runs(_typed(batches, holder := []), 1):
            if run is not None:
                held += run
                continue
            total = _nothing()
            for one in held:
                _link(total, one)
            tables = [tuple(None if c is None else (c, a) for c, a in zip(x["costs"], x["audits"], strict=True)) for x in held]
            cost, audit, system = cheapest(combined(tables))
            gaps = 0 if total["low"] is None else total["high"] - total["low"] + 1 - total["distinct_turns"]
            whole = {"gaps": gaps, "cost": cost, "audit": audit} | {c: total[c] for c in _COUNTS[:4]}
            at, before = 0, 0
            out = []
            for k, one in enumerate(held):
                end = _after(audit, at, one["n"]) if k + 1 < len(held) else len(audit)
                out.append({"conv_id": one["conv_id"], "first": one["first"], "slice": audit[at:end], "before_it": before, "system": system}
                           | (dict.fromkeys(whole) if k else whole))
                before += end - at - audit.count("D", at, end)
                at = end
            schema = pa.schema([
                ("conv_id", holder[0].field("conv_id").type), ("first", pa.int64()), ("slice", pa.string()), ("before_it", pa.int64()),
                ("system", pa.bool_()), *((n, pa.int64() if t == "long" else pa.string()) for n, t in fields)])
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            held = []

    ordered = stretches.repartition("conv_id").sortWithinPartitions("conv_id", "first")
    return ordered.mapInArrow(
        work, f"conv_id {kind}, first long, slice string, before_it long, system boolean, " + ", ".join(f"{n} {t}" for n, t in fields))


def _after(audit: str, at: int, n: int) -> int:
    """Where the letters of ``n`` rows end, from ``at`` on."""
    while n:
        n -= audit[at] != "I"
        at += 1
    return at


def _edits(repairs: DataFrame, kind: str) -> DataFrame:
    """One row per letter: ``place`` of the row (of the row before, for an insertion), ``sub``, ``edit``,
    ``new_role`` (null where the role stays)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.to_pylist()):
                for begin in range(0, len(row["slice"]), 1 << 16):
                    if not begin:
                        place, sub, out = row["first"] - 1, 0, row["before_it"]
                    columns = [[], [], [], []]
                    for letter in row["slice"][begin : begin + (1 << 16)]:
                        place, sub = (place, sub + 1) if letter == "I" else (place + 1, 0)
                        role = None if letter in "KD" else ("user", "assistant")[(out - row["system"]) % 2]
                        out += letter != "D"
                        for column, value in zip(columns, (place, sub, letter, role), strict=True):
                            column.append(value)
                    ids = batch.column(0).take(pa.array([i] * len(columns[0])))
                    kinds = (pa.int64(), pa.int32(), pa.string(), pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [ids, *map(pa.array, columns, kinds)], ["conv_id", "place", "sub", "edit", "new_role"])

    return repairs.select("conv_id", "first", "slice", "before_it", "system").mapInArrow(
        work, f"conv_id {kind}, place long, sub int, edit string, new_role string")


def repaired(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of rows ``conv_id, turn, role, text``: one row per conversation (``conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit``), and the rows of the repaired conversations (``conv_id, place, sub,
    edit, role, text``), in order of ``place, sub``."""
    small_batches(df.sparkSession)
    kind = df.schema["conv_id"].dataType.simpleString()
    rows = _sorted_rows(df)
    repairs = cut(_repairs(_stretches(with_faults(rows), kind), kind))
    edits = _edits(repairs, kind).where("edit <> 'D'")
    stay = edits.where("edit <> 'I'").join(rows.select("place", "role", "text"), "place").select(
        "conv_id", "place", "sub", "edit", F.coalesce("new_role", "role").alias("role"), "text")
    new = edits.where("edit = 'I'").select("conv_id", "place", "sub", "edit", F.col("new_role").alias("role"), F.lit("").alias("text"))
    found = repairs.where("cost is not null").select("conv_id", "gaps", *_COUNTS[:4], "cost", "audit")
    return found, stay.union(new)


def digests(rows: DataFrame, line: Column) -> DataFrame:
    """``conv_id, repaired_sha256`` of each conversation's lines, joined by newlines. A digest reads a
    conversation from its beginning to its end, so one task streams over it, a batch at a time."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, conv = None, None
        for run in _runs(_typed(batches, holder := []), 1):
            if run is None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([conv], holder[0].field("conv_id").type), pa.array([state.hexdigest()])], ["conv_id", "repaired_sha256"])
                state = None
                continue
            for r in run:
                if state is None:
                    state, conv = hashlib.sha256(), r["conv_id"]
                else:
                    state.update(b"\n")
                state.update(r["line"].encode())

    ordered = rows.select("conv_id", "place", "sub", line.alias("line")).repartition("conv_id").sortWithinPartitions("conv_id", "place", "sub")
    return ordered.mapInArrow(work, f"conv_id {kind}, repaired_sha256 string")
