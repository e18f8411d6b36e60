"""The list of queries; each may carry the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import configure
from .views import Views

QUERIES: dict[str, Callable[[Views], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name, with its SQL where there is one."""
    def add(fn: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = " ".join(sql.split("\n")) if "--" not in sql else sql
        return fn

    return add


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """A registered query as a function of session and data folder."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return QUERIES[name](Views(configure(spark), folder))

    return run
