"""De-duplication and duplicate reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import MapType

from ..functions.dates import minutes_between
from ..functions.money import percentage

# What makes two auction rows the same, over all scrapes and inside one.
HISTORY_KEYS = ("item_id", "grade", "record_type", "sale_date", "sale_price", "total_sales_count")
SESSION_KEYS = ("card_name", "psa_level", "auction_date", "auction_price")


def keep_one(df: DataFrame, keys, order: str, keep: str = "newest", tie_break=None) -> DataFrame:
    """One row per key: the one with the largest (``newest``) or smallest (``earliest``) ``order``.

    NULL keys form groups of their own. Rows equal in ``order`` are told apart by ``tie_break``
    (default: every other column), so the result does not depend on the run. Ranking to 1 lets
    Spark drop all but one row per key in each map task, before the shuffle, however hot a key is.
    """
    if tie_break is None:
        taken = {*keys, order}
        tie_break = [f.name for f in df.schema.fields
                     if f.name not in taken and not isinstance(f.dataType, MapType)]
    first = F.col(order).desc() if keep == "newest" else F.col(order).asc()
    ranking = Window.partitionBy(*keys).orderBy(first, *[F.col(c) for c in tie_break])
    return df.withColumn("_rank", F.row_number().over(ranking)).filter("_rank = 1").drop("_rank")


def duplicate_groups(df: DataFrame, keys, day: Column, limit: int = 20) -> DataFrame:
    """The largest groups of rows equal in ``keys``, largest first, with their count and ordered distinct days.

    The table is read once: rows shrink to one per key and day in each task, and a group's days are bounded by the
    calendar.
    """
    per_day = df.groupBy(*keys, day.alias("_day")).agg(F.count("*").alias("_rows"))
    groups = per_day.groupBy(*keys).agg(
        F.sum("_rows").alias("duplicate_count"), F.array_sort(F.collect_set("_day")).alias("scrape_dates"))
    return groups.filter("duplicate_count > 1").orderBy(F.desc("duplicate_count"), *keys).limit(limit)


def duplication_rate(df: DataFrame, keys) -> DataFrame:
    """Total rows, distinct keys, surplus rows and the surplus in percent (one row)."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    total, unique = F.coalesce(F.sum("n"), F.lit(0)), F.count("*")
    return per_key.agg(
        total.alias("total_records"),
        unique.alias("unique_records"),
        (total - unique).alias("duplicates"),
        percentage(total - unique, total).alias("duplication_pct"),
    )


def duplicate_examples(df: DataFrame, keys, scraped: str, url: str, limit: int = 5) -> DataFrame:
    """The largest duplicate groups: occurrences, first and last scrape, minutes between, distinct urls."""
    per_url = df.groupBy(*keys, url).agg(
        F.count("*").alias("n"), F.min(scraped).alias("lo"), F.max(scraped).alias("hi")
    )
    groups = per_url.groupBy(*keys).agg(
        F.sum("n").alias("duplicate_count"),
        F.min("lo").alias("earliest_scrape"),
        F.max("hi").alias("latest_scrape"),
        F.count(url).alias("unique_urls"),
    ).filter("duplicate_count > 1")
    return groups.withColumn(
        "minutes_between", F.round(minutes_between("earliest_scrape", "latest_scrape"), 1)
    ).orderBy(F.desc("duplicate_count"), *keys).limit(limit)


def duplicate_impact(df: DataFrame, keys, card: str, grade: str, price: str) -> DataFrame:
    """What removing duplicates changes (one row): counts and price range before and after.

    Everything follows from one count per key, so no group is ever held together.
    """
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    per_combo = per_key.groupBy(card, grade).agg(
        F.sum("n").alias("rows"),
        F.count("*").alias("keys"),
        F.count_if(F.col("n") > 1).alias("groups"),
        F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("in_groups"),
        F.min(price).alias("lo"),
        F.max(price).alias("hi"),
    )
    rows, kept = F.sum("rows"), F.sum("keys")
    return per_combo.agg(
        rows.alias("rows_before"),
        kept.alias("rows_after"),
        F.sum("groups").alias("duplicate_groups"),
        F.sum("in_groups").alias("rows_in_groups"),
        (rows - kept).alias("rows_removed"),
        percentage(rows - kept, rows).alias("removed_pct"),
        F.countDistinct(card).alias("cards"),
        F.count("*").alias("combos"),
        F.min("lo").alias("min_price"),
        F.max("hi").alias("max_price"),
    )
