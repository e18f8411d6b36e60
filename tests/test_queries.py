"""Every registered query runs, and gives the rows and types of its SQL where it has one."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracles import compare, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    ok, note = compare(spark, con, queries()[name], oracle_sql().get(name), FOLDER)
    assert ok, note


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["condition", "week_start", "simple_asp"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
