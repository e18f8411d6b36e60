"""Integrity checks and profiles of the auction and price tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import composite_key
from .filters import last_days, month_window


def scrape_day() -> Column:
    """Day of the scrape."""
    return F.col("scraped_at").cast("date")


def _by_combo(auctions: DataFrame, *extra: Column) -> DataFrame:
    """Auction rows shrunk to one row per card and grade (and the extra keys) with count and time range."""
    return auctions.groupBy(*extra, "item_id", "grade").agg(
        F.count("*").alias("n"), F.min("scraped_at").alias("lo"), F.max("scraped_at").alias("hi")
    )


def _profile(combos: DataFrame, by: list[str], items: bool) -> DataFrame:
    measures = [F.coalesce(F.sum("n"), F.lit(0)).alias("record_count")]
    if items:
        measures.append(F.countDistinct("item_id").alias("unique_items"))
    measures += [
        # A pair with a NULL part is no pair.
        F.count(composite_key("item_id", "grade")).alias("unique_card_grades"),
        F.min("lo").alias("earliest_time"),
        F.max("hi").alias("latest_time"),
    ]
    return combos.groupBy(*by).agg(*measures)


def daily_profile(auctions: DataFrame) -> DataFrame:
    """Rows, card-grade pairs and time range per scrape day, newest first."""
    combos = _by_combo(auctions, scrape_day().alias("scrape_date"))
    return _profile(combos, ["scrape_date"], items=False).orderBy(F.desc("scrape_date"))


def period_check(auctions: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Rows, cards, card-grade pairs and time range between two scrape days (one row)."""
    return _profile(_by_combo(month_window(auctions, scrape_day(), first, last)), [], items=True)


def point_history(auctions: DataFrame, item: str, grade: str) -> DataFrame:
    """Scrape days and rows of one card and grade."""
    per_day = (
        auctions.filter((F.col("item_id") == item) & (F.col("grade") == grade))
        .groupBy("item_id", "grade", scrape_day().alias("day")).agg(F.count("*").alias("n"))
    )
    return per_day.groupBy("item_id", "grade").agg(
        F.count("day").alias("scrape_days"),
        F.sum("n").alias("total_records"),
        F.array_sort(F.collect_list("day")).alias("dates"),
    )


def record_type_counts(auctions: DataFrame) -> DataFrame:
    """Rows, cards, pairs, and rows of either kind (one row)."""
    combos = auctions.groupBy("item_id", "grade").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("record_type") == "summary").alias("summaries"),
        F.count_if(F.col("record_type") == "sale").alias("sales"),
    )
    return combos.agg(
        F.sum("n").alias("total_records"),
        F.countDistinct("item_id").alias("unique_items"),
        F.count(composite_key("item_id", "grade")).alias("unique_card_grades"),
        F.sum("summaries").alias("summary_records"),
        F.sum("sales").alias("sale_records"),
    )


def rows_per_day(auctions: DataFrame) -> DataFrame:
    """Rows per scrape day, newest first."""
    return auctions.groupBy(scrape_day().alias("scrape_date")).agg(F.count("*").alias("record_count")) \
        .orderBy(F.desc("scrape_date"))


def item_sales(auctions: DataFrame, item: str, grade: str) -> DataFrame:
    """Sale rows and distinct sale dates of one card and grade (one row)."""
    return auctions.filter(
        (F.col("item_id") == item) & (F.col("grade") == grade) & (F.col("record_type") == "sale")
    ).agg(F.count("*").alias("total_records"), F.countDistinct("sale_date").alias("unique_sales"))


def price_profile(prices: DataFrame) -> DataFrame:
    """Rows, date range, products, categories and groups of the daily prices (one row)."""
    per_product = prices.groupBy("category_id", "group_id", "product_id").agg(
        F.count("*").alias("n"), F.min("price_date").alias("lo"), F.max("price_date").alias("hi")
    )
    return per_product.agg(
        F.sum("n").alias("total_records"),
        F.min("lo").alias("earliest_date"),
        F.max("hi").alias("latest_date"),
        F.countDistinct("product_id").alias("unique_products"),
        F.countDistinct("category_id").alias("categories"),
        F.countDistinct("group_id").alias("group_count"),
    )


def top_prices(prices: DataFrame, limit: int = 3, ties: tuple[str, ...] = ()) -> DataFrame:
    """Rows with the highest market price."""
    return prices.filter("market_price IS NOT NULL").orderBy(F.desc("market_price"), *ties).limit(limit)


def daily_listing(prices: DataFrame, day: dt.date) -> DataFrame:
    """All prices of one day in catalog order."""
    return prices.filter(F.col("price_date") == F.lit(day)).orderBy(
        "category_id", "group_id", "product_id", "sub_type_name"
    )


def price_trend(prices: DataFrame, product_id: int, days: int = 7, as_of: dt.date | None = None) -> DataFrame:
    """Prices of one product over the last days, newest first."""
    return last_days(prices.filter(F.col("product_id") == product_id), "price_date", days, as_of).select(
        "price_date", "sub_type_name", "low_price", "market_price", "high_price"
    ).orderBy(F.desc("price_date"), "sub_type_name")


def available_dates(prices: DataFrame, day: str = "scrape_date", limit: int = 10) -> DataFrame:
    """Newest load days with their rows."""
    return prices.groupBy(day).agg(F.count("*").alias("record_count")).orderBy(F.desc(day)).limit(limit)


def has_rows(prices: DataFrame, day: dt.date, column: str = "scrape_date") -> DataFrame:
    """Whether a day has any row (one row); stops at the first one found."""
    found = prices.filter(F.col(column) == F.lit(day)).select(F.lit(1).alias("one")).limit(1)
    return found.agg((F.count("*") > 0).alias("has_rows"))
