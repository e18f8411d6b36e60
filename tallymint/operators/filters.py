"""Row filters with the meaning of the reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import parse_us_date

DELETED = "[deleted]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def filled(c: Column | str) -> Column:
    """Neither NULL nor empty text."""
    return _col(c).isNotNull() & (_col(c) != "")


def snapshot_day(df: DataFrame, day: dt.date, ts: str = "scraped_at", partition: str | None = None) -> DataFrame:
    """Rows scraped on one day, as a half-open range on the timestamp.

    Name the ``partition`` column of a table laid out by day: equality on it prunes folders, which a
    range on the timestamp cannot.
    """
    start = dt.datetime(day.year, day.month, day.day)
    kept = df.filter((F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(start + dt.timedelta(days=1))))
    return kept.filter(F.col(partition) == F.lit(day)) if partition else kept


def usable_sales(auctions: DataFrame, since: dt.date) -> DataFrame:
    """Auction sales fit for analysis, with ``auction_date`` parsed from the ``m/d/yyyy`` text."""
    return (
        auctions.filter(
            (F.col("record_type") == "sale")
            & (F.col("sale_price") > 0)
            & filled("card_name")
            & F.col("grade").isNotNull()
            & filled("sale_date")
        )
        .withColumn("auction_date", parse_us_date("sale_date"))
        .filter(F.col("auction_date") >= F.lit(since))
    )


def month_window(df: DataFrame, day: Column, first: dt.date, last: dt.date) -> DataFrame:
    """Rows whose day lies between two days, both included."""
    return df.filter(day.between(F.lit(first), F.lit(last)))


def last_days(df: DataFrame, day: str, days: int, as_of: dt.date | None = None) -> DataFrame:
    """Rows of the last ``days`` days before ``as_of`` (default: today)."""
    end = F.lit(as_of) if as_of else F.current_date()
    return df.filter(F.col(day) >= F.date_sub(end, days))


def last_days_of_data(df: DataFrame, ts: str, days: int) -> DataFrame:
    """Rows of the last ``days`` days before the newest timestamp in the data itself."""
    newest = df.agg(F.max(ts)).scalar()
    return df.filter(F.col(ts) >= newest - F.make_dt_interval(days=F.lit(days)))


def only(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows whose ``column`` is in a short list."""
    return df.filter(F.col(column).isin(values))


def exclude(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows whose ``column`` is not in a short list (NULL is dropped)."""
    return df.filter(~F.col(column).isin(values))


def live_comments(comments: DataFrame) -> DataFrame:
    """Comments whose text and author still exist."""
    return comments.filter((F.col("body") != DELETED) & (F.col("author") != DELETED))


def live_submissions(submissions: DataFrame) -> DataFrame:
    """Submissions whose author still exists; the text may be missing but not deleted."""
    return submissions.filter(
        (F.col("author") != DELETED) & (F.col("selftext").isNull() | (F.col("selftext") != DELETED))
    )


def in_both(fields: list[Column], test_a, test_b) -> Column:
    """Test A holds in some field and test B holds in some field, NULL fields counting as no match."""
    def some(test) -> Column:
        hit = F.lit(False)
        for f in fields:
            hit = hit | F.coalesce(test(f), F.lit(False))
        return hit

    return some(test_a) & some(test_b)
