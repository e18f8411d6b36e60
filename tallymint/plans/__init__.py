"""Domain views over the test tables, and the registered queries with their reference SQL."""

from . import (  # noqa: F401  (importing a module registers its queries)
    auction_queries, audit_queries, post_queries, price_queries, series_queries, storage_queries,
)
from .registry import ORACLES, QUERIES, runner

__all__ = ["ORACLES", "QUERIES", "runner"]
