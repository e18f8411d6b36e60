"""Queries over price buckets, daily prices and the catalog."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions.cleaning import normalise_values
from ..functions.dates import calendar_weeks
from ..operators import audit, catalog, filters, profile, weekly
from ..sources import documents
from ..sources.tables import limit_per_group
from ..session import workspace
from .registry import query
from .views import CATEGORIES, DAY, DAY_BEFORE, SINCE, Views, with_views

WEEKS = calendar_weeks(SINCE, dt.date(2001, 12, 31))
IN_CATEGORIES = f"category_id IN ({', '.join(map(str, CATEGORIES))})"
LISTED = f"product_id IN (SELECT product_id FROM newest WHERE {IN_CATEGORIES})"
EXACT_AVG = "CAST(SUM(CAST({0} AS DECIMAL(24,6))) AS DOUBLE) / COUNT({0})"
CENTS = "CAST(ROUND(CAST({0} AS DECIMAL(24,6)), 2) AS DOUBLE)"
WEIGHTED = ("CASE WHEN SUM(quantity_sold) > 0 THEN CAST(SUM(CAST(quantity_sold * market_price AS DECIMAL(24,6))) "
            "AS DOUBLE) / SUM(quantity_sold) ELSE 0 END")
SNAPSHOT = "scrape_date = DATE '2001-12-02' AND bucket_start_date >= DATE '1995-01-01'"

ASP_SQL = f"""SELECT condition, week_start, {EXACT_AVG.format('market_price')} AS simple_asp
    FROM prices WHERE {SNAPSHOT} AND market_price > 0 AND condition <> '' AND {LISTED}
    GROUP BY condition, week_start"""
VOLUME_SQL = f"""SELECT condition, week_start, CAST(SUM(quantity_sold) AS BIGINT) AS trading_volume
    FROM prices WHERE {SNAPSHOT} AND quantity_sold IS NOT NULL AND condition <> '' AND {LISTED}
    GROUP BY condition, week_start"""
UNIQUE_SQL = f"""SELECT 'Products with sales' AS metric, week_start, COUNT(DISTINCT product_id) AS unique_products
    FROM prices WHERE {SNAPSHOT} AND quantity_sold > 0 AND {LISTED} GROUP BY week_start"""


def asp(v: Views) -> DataFrame:
    return weekly.weekly_asp_simple(v.prices, v.catalog, CATEGORIES, DAY, SINCE)


def volume(v: Views) -> DataFrame:
    return weekly.weekly_volume(v.prices, v.catalog, CATEGORIES, DAY, SINCE)


def unique(v: Views) -> DataFrame:
    return weekly.weekly_unique(v.prices, v.catalog, CATEGORIES, DAY, SINCE)


def best_sellers(v: Views) -> DataFrame:
    """The 15 products sold most, as the list that the product report follows."""
    return v.prices.groupBy("product_id").agg(F.sum("quantity_sold").alias("q")) \
        .orderBy(F.desc("q"), "product_id").limit(15) \
        .select("product_id", F.concat(F.lit("https://shop.example/product/"), "product_id", F.lit("/x")).alias("url"),
                (-F.col("q")).alias("pos"))


SELLERS_SQL = """SELECT product_id, -SUM(quantity_sold) AS pos FROM prices GROUP BY product_id
    ORDER BY SUM(quantity_sold) DESC, product_id LIMIT 15"""

query("weekly_asp_simple", with_views("prices", "catalog", "newest") + ASP_SQL)(asp)
query("weekly_volume", with_views("prices", "catalog", "newest") + VOLUME_SQL)(volume)
query("weekly_unique", with_views("prices", "catalog", "newest") + UNIQUE_SQL)(unique)


@query("weekly_unique_approx", with_views("prices", "catalog", "newest") + f"""
    SELECT 'Products with sales' AS metric, week_start, COUNT(DISTINCT product_id) AS exact, TRUE AS close
    FROM prices WHERE bucket_start_date >= DATE '1995-01-01' AND quantity_sold > 0 AND {LISTED} GROUP BY week_start""")
def weekly_unique_approx(v: Views) -> DataFrame:
    """Weekly figures of all days of load from stored sketches: within 5 % of the exact ones."""
    path = workspace(v.spark, "sketches")
    for day in (DAY_BEFORE, DAY):  # each load adds its own sketches
        weekly.unique_sketches(v.prices, v.catalog, CATEGORIES, day, SINCE).write.mode("append").parquet(path)
    stored = weekly.weekly_unique_stored(v.spark.read.parquet(path))
    exact = weekly.weekly_unique(v.prices, v.catalog, CATEGORIES, None, SINCE)
    near = F.abs(F.col("unique_products") - F.col("exact")) <= 0.05 * F.col("exact")
    return stored.join(exact.select("week_start", F.col("unique_products").alias("exact")), "week_start", "full_outer") \
        .select("metric", "week_start", "exact", F.coalesce(near, F.lit(False)).alias("close"))


@query("weekly_asp_raw_catalog", with_views("prices", "catalog") + f"""
    SELECT condition, week_start, {EXACT_AVG.format('market_price')} AS simple_asp
    FROM prices JOIN catalog USING (product_id)
    WHERE {SNAPSHOT} AND market_price > 0 AND condition <> '' AND {IN_CATEGORIES} GROUP BY condition, week_start""")
def weekly_asp_raw_catalog(v: Views) -> DataFrame:
    return weekly.weekly_asp_simple(v.prices, v.catalog, CATEGORIES, DAY, SINCE, raw_catalog=True)


@query("weekly_asp_weighted", with_views("prices", "catalog", "newest") + f"""
    SELECT product_id, MAX(product_clean_name) AS product_name, week_start, {WEIGHTED} AS weighted_asp,
           CAST(SUM(quantity_sold) AS BIGINT) AS total_volume
    FROM prices LEFT JOIN newest USING (product_id)
    WHERE {SNAPSHOT} AND market_price > 0 AND quantity_sold IS NOT NULL GROUP BY product_id, week_start""")
def weekly_asp_weighted(v: Views) -> DataFrame:
    return weekly.weekly_asp_weighted(v.prices, v.catalog, None, DAY, SINCE)


LIFETIME_SQL = f"""SELECT product_id, MAX(product_name) AS product_name, MAX(product_clean_name) AS product_clean_name,
           MAX(group_name) AS group_name, CAST(SUM(quantity_sold) AS BIGINT) AS lifecycle_quantity_sold,
           {WEIGHTED} AS lifecycle_asp
    FROM prices JOIN newest USING (product_id) WHERE {SNAPSHOT} GROUP BY product_id"""


@query("product_lifetime", with_views("prices", "catalog", "newest") + LIFETIME_SQL)
def product_lifetime(v: Views) -> DataFrame:
    return weekly.product_lifetime(v.prices, v.catalog, None, DAY, SINCE)


@query("product_lifetime_raw_catalog", with_views("prices", "catalog") + f"""
    SELECT product_id, MAX(product_name) AS product_name, MAX(product_clean_name) AS product_clean_name,
           MAX(group_name) AS group_name, CAST(SUM(quantity_sold) AS BIGINT) AS lifecycle_quantity_sold,
           {WEIGHTED} AS lifecycle_asp
    FROM prices JOIN catalog USING (product_id) WHERE {SNAPSHOT} GROUP BY product_id""")
def product_lifetime_raw_catalog(v: Views) -> DataFrame:
    return weekly.product_lifetime(v.prices, v.catalog, None, DAY, SINCE, raw_catalog=True)


@query("summary_stats", with_views("prices", "catalog", "newest")[:-1] + f""",
    asp AS ({ASP_SQL}), volume AS ({VOLUME_SQL}), uniq AS ({UNIQUE_SQL}),
    asp_week AS (SELECT week_start, {EXACT_AVG.format('simple_asp')} AS asp FROM asp GROUP BY week_start)
    SELECT 'overall_asp' AS metric, {CENTS.format('(' + EXACT_AVG.format('asp') + ')')} AS value FROM asp_week
    UNION ALL SELECT 'total_volume', CAST(SUM(trading_volume) AS DOUBLE) FROM volume
    UNION ALL SELECT 'avg_unique_products', ROUND(AVG(unique_products), 0) FROM uniq""")
def summary_stats(v: Views) -> DataFrame:
    return weekly.summary_stats(asp(v), volume(v), unique(v))


def wide(cell: str, missing: str = "NULL") -> str:
    """One SQL column per week."""
    return ", ".join(
        f"COALESCE(MAX(CASE WHEN week_start = DATE '{w}' THEN {cell} END), {missing}) AS \"{w}\"" for w in WEEKS
    )


@query("pivot_condition_week", with_views("prices", "catalog", "newest")[:-1]
       + f", asp AS ({ASP_SQL}) SELECT condition, {wide(CENTS.format('simple_asp'))} FROM asp GROUP BY condition")
def pivot_condition_week(v: Views) -> DataFrame:
    return weekly.pivot_condition_week(asp(v), "simple_asp", WEEKS, price=True)


@query("pivot_condition_week_volume", with_views("prices", "catalog", "newest")[:-1]
       + f", volume AS ({VOLUME_SQL}) SELECT condition, {wide('trading_volume', '0')} FROM volume GROUP BY condition")
def pivot_condition_week_volume(v: Views) -> DataFrame:
    return weekly.pivot_condition_week(volume(v), "trading_volume", WEEKS, price=False)


@query("pivot_product_week", with_views("prices", "catalog", "newest")[:-1] + f""",
    sellers AS ({SELLERS_SQL}),
    long AS (SELECT product_id, MAX(product_clean_name) AS product_name, week_start, {WEIGHTED} AS weighted_asp
             FROM prices JOIN sellers USING (product_id) LEFT JOIN newest USING (product_id)
             WHERE {SNAPSHOT} AND market_price > 0 AND quantity_sold IS NOT NULL GROUP BY product_id, week_start)
    SELECT product_id, product_name, {wide(CENTS.format('weighted_asp'), '0')} FROM long
    WHERE product_name IS NOT NULL GROUP BY product_id, product_name""")
def pivot_product_week(v: Views) -> DataFrame:
    long = weekly.weekly_asp_weighted(v.prices, v.catalog, best_sellers(v), DAY, SINCE)
    return weekly.pivot_product_week(long, "weighted_asp", WEEKS, price=True)


VOLUME_CELL = "CAST(SUM(quantity_sold) AS BIGINT)"


@query("pivot_product_week_volume", with_views("prices", "catalog", "newest")[:-1] + f""",
    sellers AS (SELECT product_id, ROW_NUMBER() OVER (ORDER BY pos, product_id) AS pos FROM ({SELLERS_SQL})),
    long AS (SELECT product_id, MAX(product_clean_name) AS product_name, week_start, {VOLUME_CELL} AS total_volume
             FROM prices JOIN sellers USING (product_id) LEFT JOIN newest USING (product_id)
             WHERE {SNAPSHOT} AND market_price > 0 AND quantity_sold IS NOT NULL GROUP BY product_id, week_start),
    wide AS (SELECT product_id, product_name, {wide('total_volume', '0')} FROM long
             WHERE product_name IS NOT NULL GROUP BY product_id, product_name)
    SELECT CAST(ROW_NUMBER() OVER (ORDER BY s.pos) AS INTEGER) AS rank,
      CASE WHEN length(product_name) > 40 THEN substr(product_name, 1, 40) || '...' ELSE product_name END
        || ' (' || product_id || ')' AS product, product_id, """ + ", ".join(f'"{w}"' for w in WEEKS)
       + " FROM wide JOIN sellers s USING (product_id)")
def pivot_product_week_volume(v: Views) -> DataFrame:
    """Volumes by product and week, in the order of the list, with display names."""
    listing = best_seller_list(v)
    long = weekly.weekly_asp_weighted(v.prices, v.catalog, listing, DAY, SINCE)
    return weekly.pivot_product_week(long, "total_volume", WEEKS, price=False, listing=listing)


def best_seller_list(v: Views) -> DataFrame:
    """The best sellers as they stand in a list of addresses."""
    text = best_sellers(v).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("pos", "product_id", "url"))), lambda s: s["url"]), "\n").alias("value"))
    return documents.url_ids(text)


@query("custom_order", with_views("prices", "catalog", "newest")[:-1] + f""",
    sellers AS ({SELLERS_SQL}), life AS ({LIFETIME_SQL})
    SELECT l.*, CAST(ROW_NUMBER() OVER (ORDER BY s.pos, l.product_id) AS INTEGER) AS rank,
           CASE WHEN length(l.product_name) > 40 THEN substr(l.product_name, 1, 40) || '...' ELSE l.product_name END
             || ' (' || l.product_id || ')' AS product
    FROM life l JOIN (SELECT product_id, ROW_NUMBER() OVER (ORDER BY pos, product_id) AS pos FROM sellers) s
         USING (product_id)""")
def custom_order(v: Views) -> DataFrame:
    listing = best_seller_list(v)
    return weekly.custom_order(
        weekly.product_lifetime(v.prices, v.catalog, listing, DAY, SINCE), listing)


@query("spine_fill", with_views("prices") + """, spine AS (SELECT DISTINCT week_start FROM prices)
    SELECT week_start, CAST(COALESCE(SUM(quantity_sold) FILTER (WHERE market_price > 100000), 0) AS BIGINT) AS volume
    FROM spine LEFT JOIN prices USING (week_start) GROUP BY week_start""")
def spine_fill(v: Views) -> DataFrame:
    weeks = v.prices.withColumn("week_start", F.date_trunc("week", "bucket_start_date").cast("date"))
    dear = weeks.filter("market_price > 100000").groupBy("week_start").agg(F.sum("quantity_sold").alias("volume"))
    return weekly.spine_fill(dear, weekly.spine_union(weeks), ["week_start"], ["volume"])


@query("snapshot_day", with_views("prices") + """SELECT condition, COUNT(*) AS n,
        CAST(SUM(quantity_sold) AS BIGINT) AS quantity
    FROM prices WHERE bucket_start_date = DATE '1998-03-02' GROUP BY condition""")
def snapshot_day(v: Views) -> DataFrame:
    stamped = v.prices.withColumn("scraped_at", F.col("bucket_start_date").cast("timestamp_ntz"))
    return filters.snapshot_day(stamped, dt.date(1998, 3, 2), partition="bucket_start_date") \
        .groupBy("condition").agg(F.count("*").alias("n"), F.sum("quantity_sold").alias("quantity"))


# --- daily prices ------------------------------------------------------------------------------

TIES = ("product_id", "price_date", "sub_type_name", "category_id", "group_id", "low_price", "high_price")


@query("price_profile", with_views("daily") + """SELECT COUNT(*) AS total_records, MIN(price_date) AS earliest_date,
    MAX(price_date) AS latest_date, COUNT(DISTINCT product_id) AS unique_products,
    COUNT(DISTINCT category_id) AS categories, COUNT(DISTINCT group_id) AS group_count FROM daily""")
def price_profile(v: Views) -> DataFrame:
    return profile.price_profile(v.daily)


@query("top_prices", with_views("daily") + """SELECT * FROM daily WHERE market_price IS NOT NULL
    ORDER BY market_price DESC, product_id, price_date, sub_type_name, category_id, group_id, low_price, high_price
    LIMIT 3""")
def top_prices(v: Views) -> DataFrame:
    return profile.top_prices(v.daily, 3, TIES)


@query("daily_listing", with_views("daily") + "SELECT * FROM daily WHERE price_date = DATE '1998-03-02'")
def daily_listing(v: Views) -> DataFrame:
    return profile.daily_listing(v.daily, dt.date(1998, 3, 2))


@query("price_trend", with_views("daily") + """SELECT price_date, sub_type_name, low_price, market_price, high_price
    FROM daily WHERE product_id = 42 AND price_date >= DATE '1998-12-31' - 1000""")
def price_trend(v: Views) -> DataFrame:
    return profile.price_trend(v.daily, 42, 1000, dt.date(1998, 12, 31))


@query("available_dates", with_views("daily") + """SELECT price_date, COUNT(*) AS record_count FROM daily
    GROUP BY price_date ORDER BY price_date DESC LIMIT 10""")
def available_dates(v: Views) -> DataFrame:
    return profile.available_dates(v.daily, "price_date")


@query("has_rows", with_views("prices") + """SELECT COUNT(*) > 0 AS has_rows FROM prices
    WHERE scrape_date = DATE '2001-12-02'""")
def has_rows(v: Views) -> DataFrame:
    return profile.has_rows(v.prices, DAY)


@query("validate_batch", with_views("daily") + """
    SELECT price_date, record_count, out_of_range, issues, issues = '' AS validation_passed FROM (
      SELECT price_date, COUNT(*) AS record_count,
        COUNT(*) FILTER (WHERE market_price < 0.01 OR market_price > 100000) AS out_of_range,
        concat_ws('; ', CASE WHEN COUNT(*) < 20 THEN 'Low record count: ' || COUNT(*)
                             WHEN COUNT(*) > 30 THEN 'High record count: ' || COUNT(*) END,
          CASE WHEN COUNT(*) FILTER (WHERE market_price IS NULL) > 0
               THEN 'Missing market_price: ' || COUNT(*) FILTER (WHERE market_price IS NULL) END,
          CASE WHEN COUNT(*) FILTER (WHERE market_price < 0.01 OR market_price > 100000) > 0
               THEN 'Price out of range: ' || COUNT(*) FILTER (WHERE market_price < 0.01 OR market_price > 100000) END
        ) AS issues
      FROM daily GROUP BY price_date)""")
def validate_batch(v: Views) -> DataFrame:
    return audit.validate_batch(v.daily, least=20, most=30).withColumn("issues", F.array_join("issues", "; "))


@query("limit_per_group", with_views("daily") + """SELECT category_id, group_id, COUNT(*) AS n FROM daily
    WHERE category_id IN (SELECT category_id FROM daily GROUP BY 1 ORDER BY 1 LIMIT 3)
      AND (category_id, group_id) IN (SELECT (category_id, group_id) FROM (
            SELECT category_id, group_id, ROW_NUMBER() OVER (PARTITION BY category_id ORDER BY group_id) AS rn
            FROM (SELECT DISTINCT category_id, group_id FROM daily)) WHERE rn <= 2)
    GROUP BY ALL""")
def limited(v: Views) -> DataFrame:
    return limit_per_group(v.daily, "category_id", "group_id", 3, 2) \
        .groupBy("category_id", "group_id").agg(F.count("*").alias("n"))


# --- catalog -----------------------------------------------------------------------------------

@query("catalog_denorm", """SELECT CAST(s.s_suppkey AS BIGINT) AS "product_productId", s.s_name AS product_name,
        s.s_nationkey AS "product_groupId", s.s_acctbal AS product_balance,
        '[{"name":"Key","value":' || s.s_suppkey || '}]' AS "product_extendedData",
        CASE WHEN s.s_acctbal < 0 THEN 'true' ELSE 'false' END AS "product_isPresale",
        n.n_nationkey AS "group_groupId", n.n_name AS group_name, n.n_regionkey AS "group_categoryId",
        r.r_regionkey AS "category_categoryId", r.r_name AS category_name, DATE '2001-12-02' AS update_date
    FROM supplier s JOIN nation n ON s_nationkey = n_nationkey JOIN region r ON n_regionkey = r_regionkey""")
def catalog_denorm(v: Views) -> DataFrame:
    return catalog.denormalise(v.categories, v.groups, v.products, F.lit(DAY))


@query("scan_catalog_pages", """SELECT n_regionkey AS "categoryId", CAST(n_nationkey AS BIGINT) AS "groupId",
    n_name AS name FROM nation""")
def scan_catalog_pages(v: Views) -> DataFrame:
    entry = F.struct(F.col("n_nationkey").alias("groupId"), F.col("n_name").alias("name"))
    pages = v.table("nation").select(
        F.col("n_regionkey").alias("categoryId"),
        F.to_json(F.struct(F.array(entry).alias("results"))).alias("value"))
    return documents.page_results(pages, "STRUCT<groupId: BIGINT, name: STRING>", keep=("categoryId",))


@query("normalise_values", """SELECT CAST(event_id AS BIGINT) AS event_id, value,
        CASE WHEN value > 10 THEN 'true' ELSE 'false' END AS dear,
        '{"user":' || user_id || ',"tags":["' || event_type || '"]}' AS detail,
        strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day
    FROM events""")
def normalised(v: Views) -> DataFrame:
    return normalise_values(v.table("events").select(
        "event_id", "value", (F.col("value") > 10).alias("dear"),
        F.struct(F.col("user_id").alias("user"), F.array("event_type").alias("tags")).alias("detail"),
        F.col("ts").cast("date").alias("day")))


@query("category_summary", with_views("catalog") + """SELECT category_id, category_name,
    COUNT(DISTINCT group_id) AS groups_count, COUNT(*) AS products_count, MIN(update_date) AS first_update,
    MAX(update_date) AS last_update FROM catalog GROUP BY ALL""")
def category_summary(v: Views) -> DataFrame:
    return catalog.category_summary(v.catalog)


@query("recent_activity", with_views("catalog") + """SELECT update_date, COUNT(*) AS products_added,
    COUNT(DISTINCT category_id) AS categories_updated, COUNT(DISTINCT group_id) AS groups_updated,
    (SELECT COUNT(*) FROM catalog WHERE update_date >= DATE '2001-11-24') AS total_products
    FROM catalog WHERE update_date >= DATE '2001-11-24' GROUP BY update_date""")
def recent_activity(v: Views) -> DataFrame:
    return catalog.recent_activity(v.catalog, 7, dt.date(2001, 12, 1))


@query("top_categories", with_views("catalog") + """SELECT category_name, COUNT(*) AS product_count FROM catalog
    GROUP BY ALL ORDER BY product_count DESC, category_name LIMIT 5""")
def top_categories(v: Views) -> DataFrame:
    return catalog.top_categories(v.catalog)


@query("recent_groups", with_views("catalog") + """SELECT category_name, group_name, COUNT(*) AS products,
    MAX(update_date) AS last_update FROM catalog GROUP BY ALL
    ORDER BY last_update DESC, products DESC, category_name, group_name LIMIT 5""")
def recent_groups(v: Views) -> DataFrame:
    return catalog.recent_groups(v.catalog)


@query("largest_groups", with_views("catalog") + """SELECT category_name, group_name, COUNT(*) AS product_count
    FROM catalog GROUP BY ALL ORDER BY product_count DESC, category_name, group_name LIMIT 5""")
def largest_groups(v: Views) -> DataFrame:
    return catalog.largest_groups(v.catalog)


@query("category_exclude", with_views("catalog", "newest") + f"""SELECT category_name, COUNT(*) AS n FROM newest
    WHERE NOT {IN_CATEGORIES} GROUP BY ALL""")
def category_exclude(v: Views) -> DataFrame:
    newest = catalog.latest_catalog(v.catalog, ["category_id", "category_name"])
    return filters.exclude(newest, "category_id", CATEGORIES).groupBy("category_name").agg(F.count("*").alias("n"))


@query("latest_catalog", with_views("catalog", "newest") + """SELECT product_id, update_date, product_name, group_name
    FROM newest""")
def latest_catalog(v: Views) -> DataFrame:
    return catalog.latest_catalog(v.catalog, ["product_name", "group_name"])


@query("sample_with_total", with_views("catalog") + """SELECT category_name, category_id, group_name, group_id,
    product_name, product_id, update_date, (SELECT COUNT(*) FROM catalog) AS total_rows FROM catalog
    ORDER BY category_id, group_id, product_id, update_date LIMIT 10""")
def sample_with_total(v: Views) -> DataFrame:
    rows = v.catalog.select("category_name", "category_id", "group_name", "group_id", "product_name", "product_id",
                            "update_date")
    return catalog.sample_with_total(rows, ["category_id", "group_id", "product_id", "update_date"])
