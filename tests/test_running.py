"""Ordered running values against a plain window, with one key that holds most rows."""

from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from recordflow.functions.keyed import first_per_key, latest_per_key
from recordflow.functions.prefix import positions, running, with_range
from recordflow.sources.chunks import chunk_plan, read_chunks


@pytest.fixture(scope="module")
def hot(spark):
    draw = random.Random(5)
    data = []
    for i in range(3000):
        key = None if i % 97 == 0 else ("hot" if draw.random() < 0.6 else f"k{draw.randrange(20)}")
        data.append((key, draw.randrange(500), i, draw.choice([None, 1, 2, 3])))
    return spark.createDataFrame(data, "k string, at int, id int, x int").repartition(5).cache()


@pytest.mark.parametrize("rows_per_range", [16, 100, 700, 10**6])
def test_running_equals_window(hot, rows_per_range):
    window = Window.partitionBy("k").orderBy("at", "id")
    up_to = window.rowsBetween(Window.unboundedPreceding, 0)
    plain = hot.select(
        "id", F.coalesce(F.sum("x").over(up_to), F.lit(0)).alias("total"),
        F.last("x", True).over(up_to).alias("seen"), F.lag("x").over(window).alias("before"),
        F.row_number().over(window).alias("n"))
    ours = running(
        hot, ["k"], ["at", "id"], sums={"total": F.col("x"), "n": F.lit(1)},
        lasts={"seen": F.col("x")}, previous={"before": F.col("x")},
        rows_per_range=rows_per_range)
    assert rows(ours, "id", "total", "seen", "before", "n") == rows(
        plain, "id", "total", "seen", "before", "n")


def test_ranges_are_bounded_and_ordered(hot):
    sizes = with_range(hot, ["k", "at", "id"], 100).groupBy("_range").agg(
        F.count("*").alias("n"), F.min(F.struct("k", "at", "id")).alias("lo"),
        F.max(F.struct("k", "at", "id")).alias("hi")).orderBy("_range").collect()
    assert len(sizes) > 15
    assert max(r.n for r in sizes) < 400
    assert sum(r.n for r in sizes) == 3000


def test_positions_of_an_empty_frame(spark):
    empty = spark.createDataFrame([], "k string, id string")
    assert positions(empty, ["k"], ["id"]).collect() == []


def test_chunks_are_read_by_their_bounds(spark):
    records = spark.range(100).select(
        F.lit("d").alias("dataset_id"), F.lit("e").alias("execution_id"),
        F.format_string("r%03d", "id").alias("record_id"))
    plan = chunk_plan(records, 30, 16)
    assert rows(plan, "chunk_id", "first_pos", "last_pos", "first_id", "record_count") == [
        (0, 1, 30, "r000", 30), (1, 31, 60, "r030", 30), (2, 61, 90, "r060", 30),
        (3, 91, 100, "r090", 10)]
    third = read_chunks(records, plan.where("chunk_id = 2"))
    assert rows(third, "record_id") == [(f"r{i:03d}",) for i in range(60, 90)]


def test_first_and_latest_per_key(spark):
    frame = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, None), ("b", 5, "y"), ("b", 4, "z")], "k string, v int, d string")
    assert rows(first_per_key(frame, ["k"], ["v"])) == [("a", 1, "x"), ("b", 4, "z")]
    assert rows(latest_per_key(frame, ["k"], ["v"])) == [("a", 2, None), ("b", 5, "y")]


def test_cut_points_are_no_part_of_a_row(hot):
    """A row with all cut points would grow with the table."""
    ours = running(hot, ["k"], ["at", "id"], sums={"n": F.lit(1)}, rows_per_range=16)
    for plan in (ours, with_range(hot, ["k", "at", "id"], 16)):
        assert "_bounds#" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_running_carries_over_ranges_without_an_entry(spark):
    """Groups that end with their range leave gaps among what is carried."""
    data = spark.range(4000).select(
        F.when(F.col("id") % 4000 < 2500, F.col("id")).otherwise(F.lit(9999)).alias("k"), "id")
    ours = positions(data, ["k"], ["id"], rows_per_range=16)
    assert ours.where("k < 9999").agg(F.min("position"), F.max("position")).first() == (1, 1)
    assert ours.where("k = 9999 and position <> id - 2499").count() == 0
