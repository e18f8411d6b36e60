"""Weekly price and volume reports over price buckets and the product catalog."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.dates import week_start
from ..functions.money import cents, money_mean, money_sum
from ..functions.text import display_name
from .catalog import latest_catalog
from .filters import filled
from .joins import rollup_listed

# Fixed value: reports start here unless told otherwise.
SINCE = dt.date(2024, 1, 1)


def _buckets(prices: DataFrame, scrape_date: dt.date | None, since: dt.date) -> DataFrame:
    kept = prices.filter(F.col("bucket_start_date") >= F.lit(since))
    if scrape_date is not None:
        kept = kept.filter(F.col("scrape_date") == F.lit(scrape_date))
    return kept.withColumn("week_start", week_start("bucket_start_date"))


def _listed(catalog: DataFrame, categories: list, raw_catalog: bool) -> tuple[DataFrame, str]:
    """Products of some categories and the join to use with them.

    A product counts once, by its newest catalog row. ``raw_catalog`` keeps every catalog row, so a
    product listed on several load dates counts several times.
    """
    rows = catalog if raw_catalog else latest_catalog(catalog, ["category_id"])
    listed = rows.filter(F.col("category_id").isin(categories)).select("product_id")
    return listed, "inner" if raw_catalog else "left_semi"


def weekly_asp_simple(prices: DataFrame, catalog: DataFrame, categories: list, scrape_date: dt.date | None = None,
                      since: dt.date = SINCE, raw_catalog: bool = False) -> DataFrame:
    """Plain average price by condition and week, in that order."""
    buckets = _buckets(prices, scrape_date, since).filter((F.col("market_price") > 0) & filled("condition"))
    listed, how = _listed(catalog, categories, raw_catalog)
    sums = rollup_listed(
        buckets.select("product_id", "condition", "week_start", "market_price"), listed, "product_id",
        ["condition", "week_start"], {"value": money_sum("market_price"), "n": F.count("market_price")},
        how,
    )
    return sums.select("condition", "week_start", (F.col("value").cast("double") / F.col("n")).alias("simple_asp")) \
        .orderBy("condition", "week_start")


def weekly_volume(prices: DataFrame, catalog: DataFrame, categories: list, scrape_date: dt.date | None = None,
                  since: dt.date = SINCE, raw_catalog: bool = False) -> DataFrame:
    """Quantity sold by condition and week, in that order."""
    buckets = _buckets(prices, scrape_date, since).filter(F.col("quantity_sold").isNotNull() & filled("condition"))
    listed, how = _listed(catalog, categories, raw_catalog)
    return rollup_listed(
        buckets.select("product_id", "condition", "week_start", "quantity_sold"), listed, "product_id",
        ["condition", "week_start"], {"trading_volume": F.sum("quantity_sold")}, how,
    ).orderBy("condition", "week_start")


def weekly_unique(prices: DataFrame, catalog: DataFrame, categories: list, scrape_date: dt.date | None = None,
                  since: dt.date = SINCE, metric: str = "Products with sales") -> DataFrame:
    """Products with sales per week, in order of the weeks.

    Sales shrink to one row per week and product, which also makes a hot product small.
    """
    sold = _buckets(prices, scrape_date, since).filter(F.col("quantity_sold") > 0).select("week_start", "product_id")
    listed, _ = _listed(catalog, categories, raw_catalog=False)
    pairs = sold.distinct().join(listed, "product_id", "left_semi")
    counted = pairs.groupBy("week_start").agg(F.count("*").alias("unique_products"))
    return counted.select(F.lit(metric).alias("metric"), "week_start", "unique_products").orderBy("week_start")


#: Registers of a sketch, as a power of two: a standard error of about 0.8 %.
SKETCH_BITS = 14


def unique_sketches(prices: DataFrame, catalog: DataFrame, categories: list, scrape_date: dt.date | None = None,
                    since: dt.date = SINCE, bits: int = SKETCH_BITS) -> DataFrame:
    """A sketch of the products with sales for each week and day of load, to be stored beside the table.

    Sketches are built from the rows, in each task before anything moves; no product is counted exactly.
    """
    sold = _buckets(prices, scrape_date, since).filter(F.col("quantity_sold") > 0)
    listed, _ = _listed(catalog, categories, raw_catalog=False)
    return sold.join(listed, "product_id", "left_semi").groupBy("week_start", "scrape_date").agg(
        F.hll_sketch_agg("product_id", F.lit(bits)).alias("products"))


def weekly_unique_stored(sketches: DataFrame, metric: str = "Products with sales") -> DataFrame:
    """Products with sales per week, about, from stored sketches of any days of load; no price row is read."""
    merged = sketches.groupBy("week_start").agg(F.hll_sketch_estimate(F.hll_union_agg("products")).alias("unique_products"))
    return merged.select(F.lit(metric).alias("metric"), "week_start", "unique_products").orderBy("week_start")


def weighted_price(value: Column, quantity: Column) -> Column:
    """Value over quantity, 0 where nothing was sold."""
    return F.when(quantity > 0, value.cast("double") / quantity).otherwise(F.lit(0.0))


def _named(catalog: DataFrame, columns: dict[str, str], raw_catalog: bool) -> DataFrame:
    """One row per product: its names, and how many catalog rows it has for the join to count."""
    if raw_catalog:
        return catalog.groupBy("product_id").agg(
            F.count("*").alias("_copies"), *[F.max(c).alias(name) for name, c in columns.items()]
        )
    newest = latest_catalog(catalog, list(columns.values()))
    return newest.select("product_id", F.lit(1).cast("bigint").alias("_copies"),
                         *[F.col(c).alias(name) for name, c in columns.items()])


def weekly_asp_weighted(prices: DataFrame, catalog: DataFrame, products: DataFrame | None = None,
                        scrape_date: dt.date | None = None, since: dt.date = SINCE,
                        raw_catalog: bool = False) -> DataFrame:
    """Volume-weighted price and volume by product and week, in that order; unlisted products keep a NULL name.

    ``products`` limits the report to the ids of a list. Weeks are summed before names are joined.
    """
    buckets = _buckets(prices, scrape_date, since).filter(
        (F.col("market_price") > 0) & F.col("quantity_sold").isNotNull()
    )
    if products is not None:
        buckets = buckets.join(products.select("product_id"), "product_id", "left_semi")
    weeks = buckets.groupBy("product_id", "week_start").agg(
        money_sum(F.col("quantity_sold") * F.col("market_price")).alias("value"),
        F.sum("quantity_sold").alias("quantity"),
    )
    names = _named(catalog, {"product_name": "product_clean_name"}, raw_catalog)
    return weeks.join(names, "product_id", "left").select(
        "product_id", "product_name", "week_start",
        weighted_price(F.col("value"), F.col("quantity")).alias("weighted_asp"),
        (F.col("quantity") * F.coalesce("_copies", F.lit(1))).alias("total_volume"),
    ).orderBy("product_id", "week_start")


def product_lifetime(prices: DataFrame, catalog: DataFrame, products: DataFrame | None = None,
                     scrape_date: dt.date | None = None, since: dt.date = SINCE,
                     raw_catalog: bool = False) -> DataFrame:
    """Names, total quantity and volume-weighted price per listed product, the most sold first."""
    buckets = _buckets(prices, scrape_date, since)
    if products is not None:
        buckets = buckets.join(products.select("product_id"), "product_id", "left_semi")
    totals = buckets.groupBy("product_id").agg(
        money_sum(F.col("quantity_sold") * F.col("market_price")).alias("value"),
        F.sum("quantity_sold").alias("quantity"),
    )
    names = _named(catalog, {"product_name": "product_name", "product_clean_name": "product_clean_name",
                             "group_name": "group_name"}, raw_catalog)
    return totals.join(names, "product_id").select(
        "product_id", "product_name", "product_clean_name", "group_name",
        (F.col("quantity") * F.col("_copies")).alias("lifecycle_quantity_sold"),
        weighted_price(F.col("value"), F.col("quantity")).alias("lifecycle_asp"),
    ).orderBy(F.desc("lifecycle_quantity_sold"), "product_id")


def summary_stats(asp: DataFrame, volume: DataFrame, unique: DataFrame) -> DataFrame:
    """Key figures as (metric, value): mean over weeks of the mean price, total volume, mean products."""
    per_week = asp.groupBy("week_start").agg(money_mean("simple_asp").alias("asp"))
    return (
        per_week.agg(cents(money_mean("asp")).alias("value")).select(F.lit("overall_asp").alias("metric"), "value")
        .unionByName(volume.agg(F.sum("trading_volume").cast("double").alias("value"))
                     .select(F.lit("total_volume").alias("metric"), "value"))
        .unionByName(unique.agg(F.round(F.avg("unique_products"), 0).alias("value"))
                     .select(F.lit("avg_unique_products").alias("metric"), "value"))
    )


def pivot_weeks(long: DataFrame, index: list[str], week: str, value: str, weeks: list[dt.date],
                fill=None, aggregate=F.first) -> DataFrame:
    """Weeks as columns named ``yyyy-mm-dd``.

    The week list is given, which saves a job and fixes the layout. ``fill`` replaces missing cells.
    """
    names = [w.isoformat() for w in weeks]
    wide = (
        long.withColumn("_week", F.date_format(week, "yyyy-MM-dd"))
        .groupBy(*index).pivot("_week", names).agg(aggregate(value))
    )
    return wide if fill is None else wide.fillna(fill, subset=names)


def pivot_condition_week(long: DataFrame, value: str, weeks: list[dt.date], price: bool) -> DataFrame:
    """Condition by week. Missing prices stay NULL and are rounded to cents; missing counts are 0."""
    cell = cents(value) if price else F.col(value)
    return pivot_weeks(long.withColumn(value, cell), ["condition"], "week_start", value, weeks,
                       fill=None if price else 0)


def pivot_product_week(long: DataFrame, value: str, weeks: list[dt.date], price: bool,
                       listing: DataFrame | None = None) -> DataFrame:
    """Product by week with missing cells 0; products without a name are dropped.

    With a ``listing`` (``pos`` and ``product_id``) the products come in its order, with their ``rank`` and the display
    name ``product`` in place of the plain one.
    """
    cell = cents(value) if price else F.col(value)
    named = long.filter("product_name IS NOT NULL").withColumn(value, cell)
    wide = pivot_weeks(named, ["product_id", "product_name"], "week_start", value, weeks, fill=0)
    if listing is None:
        return wide
    names = [w.isoformat() for w in weeks]
    return custom_order(wide, listing).select("rank", "product", "product_id", *names).orderBy("rank")


def list_ranks(listing: DataFrame, key: str = "product_id") -> DataFrame:
    """Positions of a list of any length turned into ranks from 1: ``key`` and ``rank``.

    Ranges of positions are counted and then ranked side by side, so no task sorts the whole list.
    """
    ranges = 256
    width = F.greatest(F.lit(1.0), (F.max("pos") - F.min("pos") + 1) / F.lit(float(ranges)))
    bounds = listing.agg(F.min("pos").alias("low"), width.alias("width"))
    placed = listing.select("pos", key).crossJoin(F.broadcast(bounds)) \
        .select("pos", key, F.floor((F.col("pos") - F.col("low")) / F.col("width")).alias("range"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # at most `ranges` rows
    starts = placed.groupBy("range").agg(F.count("*").alias("n")) \
        .select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("range").orderBy("pos", key))
    return placed.join(F.broadcast(starts), "range").select(key, (F.col("start") + place).cast("int").alias("rank"))


def custom_order(rows: DataFrame, listing: DataFrame, key: str = "product_id", name: str = "product_name") -> DataFrame:
    """Rows ranked by their position in a list, with a display name.

    ``listing`` holds ``pos`` and the key, each key once; only listed keys that occur in the rows are ranked.
    """
    ranks = list_ranks(listing.select("pos", key).join(rows.select(key), key, "left_semi"), key)
    return rows.join(ranks, key).withColumn("product", display_name(name, key))


def spine_fill(counts: DataFrame, spine: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Every row of the spine, with missing values 0."""
    return spine.join(counts, keys, "left").select(
        *keys, *[F.coalesce(v, F.lit(0)).alias(v) for v in values]
    )


def spine_union(*parts: DataFrame, key: str = "week_start") -> DataFrame:
    """Distinct keys seen in any of the parts; each part shrinks before the union."""
    keys = [p.select(key).distinct() for p in parts]
    spine = keys[0]
    for k in keys[1:]:
        spine = spine.unionByName(k)
    return spine.distinct()

