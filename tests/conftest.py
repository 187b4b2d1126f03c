from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false", "spark.driver.memory": "6g",
           "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Small table from rows and a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def records(df):
    return [r.asDict(recursive=True) for r in df.collect()]
