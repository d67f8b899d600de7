from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from tenderlake.session import local_session

    session = local_session("4", "4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """Rows as dicts or tuples -> DataFrame with an explicit schema string."""

    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make
