"""Free-text dates."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from recordflow.functions import dates

CASES = {
    "1890": (1890, 1890, False), " 1890 ": (1890, 1890, False), "987": (987, 987, False), "1890-05-12": (1890, 1890, False), "1890-05": (1890, 1890, False),
    "12/05/1890": (1890, 1890, False), "1890-05-12T10:11:12Z": (1890, 1890, False), "1890 AD": (1890, 1890, False), "300 BC": (-300, -300, False),
    "300-250 B.C.": (-300, -250, False), "1890-1895": (1890, 1895, False), "1890–95": (1890, 1895, False), "1890 to 1895": (1890, 1895, False),
    "between 1890 and 1895": (1890, 1895, False), "1890/1895": (1890, 1895, False), "c. 1890": (1890, 1890, True), "circa 1890-1900": (1890, 1900, True),
    "[1890]": (1890, 1890, True), "1890?": (1890, 1890, True), "(about 1890)": (1890, 1890, True), "1890s": (1890, 1899, False), "the 1890's": (1890, 1899, False),
    "189-": (1890, 1899, False), "18..": (1800, 1899, False), "18--": (1800, 1899, False), "19th century": (1801, 1900, False), "XIX century": (1801, 1900, False),
    "19. Jh.": (1801, 1900, False), "XIXe siècle": (1801, 1900, False), "first half of the 19th century": (1801, 1850, False), "late 1st century": (51, 100, True),
    "before 1890": (None, 1890, False), "-1890": (None, 1890, False), "after 1890": (1890, None, False), "1890-": (1890, None, False), "since 1890": (1890, None, False),
}
NONE = ["", "   ", "unknown", "1895-1890", "room 1890 of the house", "18900", "99th thing", "12:30", "iiii century", "1890-1895-1900-1", "1" * 50, "-" * 1000, None]


def test_forms(spark):
    frame = spark.createDataFrame([(c,) for c in [*CASES, *NONE]], "written string")
    got = {r.written: None if r.y is None else tuple(r.y) for r in frame.select("written", dates.year_range(F.col("written")).alias("y")).collect()}
    wrong = {k: (got[k], v) for k, v in (CASES | dict.fromkeys(NONE)).items() if got[k] != v}
    assert not wrong


@pytest.mark.parametrize("text", ["1 " * 500_000, "[" * 1_000_000, "1890-" * 200_000, "x" * 1_000_000, "ca. " * 250_000])
def test_long_texts_are_no_dates(spark, text):
    frame = spark.createDataFrame([(text,)], "written string").repartition(1)
    assert frame.select(dates.year_range(F.col("written")).alias("y")).first().y is None
