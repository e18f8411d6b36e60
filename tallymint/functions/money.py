"""Exact money arithmetic.

Prices are DOUBLE columns, but a distributed double sum depends on the order in which tasks finish.
Summing in DECIMAL makes totals and means the same on every run, retry and cluster size; results go
back to DOUBLE at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(24,6)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money_sum(c: Column | str) -> Column:
    """Exact sum of a price column, as a DECIMAL to be combined further."""
    return F.sum(_col(c).cast(MONEY))


def money_total(c: Column | str) -> Column:
    """Exact sum of a price column as DOUBLE."""
    return money_sum(c).cast("double")


def money_mean(c: Column | str) -> Column:
    """Mean of the non-null prices: exact sum, then one division."""
    return F.try_divide(money_total(c), F.count(_col(c)))


def cents(c: Column | str) -> Column:
    """A price rounded half up to cents, in DECIMAL so that ties do not depend on binary fractions."""
    return F.round(_col(c).cast(MONEY), 2).cast("double")


def percentage(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``; NULL when ``whole`` is 0."""
    return F.try_divide(part * F.lit(100.0), whole)
