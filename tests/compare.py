"""Runs a query and its SQL on the same tables and compares the rows as bags."""

from __future__ import annotations

import hashlib
from collections import Counter
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _cell(value) -> str:
    if isinstance(value, float):
        return repr(round(value, 6))
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return repr(value)


def _digest(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(
        hashlib.md5("\x1f".join(_cell(row[i]) for i in order).encode()).hexdigest()
        for row in rows)


def difference(connection, sql: str, frame) -> str | None:
    """Why the two differ, or None."""
    wanted = connection.execute(sql)
    names = [column[0] for column in wanted.description]
    expected = wanted.fetchall()
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} instead of {sorted(names)}"
    rows = [tuple(row) for row in frame.collect()]
    if len(rows) != len(expected):
        return f"{len(rows)} rows instead of {len(expected)}"
    got, want = _digest(frame.columns, rows), _digest(names, expected)
    if got != want:
        by_name = [names.index(c) for c in frame.columns]
        only = [r for r in rows if _digest(frame.columns, [r]) - want][:2]
        lost = [tuple(r[i] for i in by_name) for r in expected
                if _digest(names, [r]) - got][:2]
        return f"{sum((got - want).values())} rows differ: {str(only)[:600]} / {str(lost)[:600]}"
    return None
