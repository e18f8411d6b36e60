"""Batch and incremental analytics over collectible-market data, written for Spark DataFrames."""

__version__ = "0.1.0"
