from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(Path(__file__).parent)]

from recordflow.session import build_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", **{
        "spark.master": "local[4]",
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "6g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def rows(frame, *columns):
    """The rows of a small frame, sorted."""
    return sorted(
        (tuple(r) for r in frame.select(*(columns or frame.columns)).collect()), key=repr)
