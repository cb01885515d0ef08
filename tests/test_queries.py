"""Every query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from compare import connect, difference
from conftest import DATA

import __spark_entry__ as entry_point  # noqa: E402  registers the queries
from recordflow.checks.registry import QUERIES, SQL  # noqa: E402  the text operators have tests of their own


@pytest.fixture(scope="module")
def connection():
    return connect(DATA)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    assert difference(connection, SQL[name], QUERIES[name](spark, DATA)) is None


def test_entry_gives_the_progress_of_all_datasets(spark):
    report = entry_point.entry(spark)
    assert report.columns == [
        "dataset_id", "execution_id", "source_total", "success", "exceptions", "processed"]
    assert report.count() == 20
