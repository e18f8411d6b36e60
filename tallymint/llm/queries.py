"""Importing this module registers the queries of every operator."""

from . import (  # noqa: F401
    divergence, idfiles, mixing, packing, passages, personal, pieces, quality, quotient, repair, similar, warc, whitening,
)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
