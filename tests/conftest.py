from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tallymint.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Build a DataFrame from tuples and a DDL schema."""
    def make(data, schema):
        return spark.createDataFrame(data, schema)

    return make
