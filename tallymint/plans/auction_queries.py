"""Queries over graded-card auctions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import calendar_weeks
from ..operators import auctions, dedup, filters, profile
from ..schemas import GRADES
from ..sources import documents
from .registry import query
from .views import DAY, LINE_GRADES, SINCE, Views, case, dealt, sql_case, with_views

SALES = with_views("auctions", "sales")
SESSION = with_views("auctions", "sales", "session")
WEEKLY = with_views("auctions", "sales", "totals", "session", "weekly")
TOP = with_views("auctions", "sales", "totals", "session", "weekly", "best", "top_weekly")
HISTORY = ", ".join(dedup.HISTORY_KEYS)


def session(v: Views) -> DataFrame:
    return auctions.session_sales(v.auctions, DAY, SINCE)


def weeks(v: Views) -> DataFrame:
    return auctions.weekly(v.auctions, DAY, SINCE)


def top_weekly(v: Views) -> DataFrame:
    return auctions.top_cards_report(v.auctions, DAY, SINCE)


def dates_text(c: str):
    """A date array as text, so that every engine prints it alike."""
    return F.array_join(F.transform(c, lambda d: d.cast("string")), ",")


@query("auction_union", f"""
    SELECT item_id, grade, 'PSA ' || grade AS grade_label, record_type, total_sales_count, average_price, min_price,
           sale_date, sale_price, 'Card ' || item_id AS card_name, lifecycle_sales_count
    FROM (SELECT CAST(l_partkey AS VARCHAR) AS item_id, {sql_case("l_linenumber", LINE_GRADES)} AS grade, * FROM lineitem)
    CROSS JOIN LATERAL (
      SELECT 'summary' AS record_type, CAST(l_quantity AS BIGINT) AS total_sales_count, l_extendedprice AS average_price,
             l_extendedprice AS min_price, NULL AS sale_date, CAST(NULL AS DOUBLE) AS sale_price,
             CAST(l_quantity AS BIGINT) AS lifecycle_sales_count WHERE l_returnflag <> 'N'
      UNION ALL SELECT 'sale', NULL, NULL, NULL, strftime(l_shipdate, '%m/%d/%Y'), l_extendedprice, NULL
      WHERE l_returnflag <> 'A'
      UNION ALL SELECT 'sale', NULL, NULL, NULL, strftime(l_shipdate + INTERVAL 1 DAY, '%m/%d/%Y'), l_extendedprice, NULL
      WHERE l_returnflag <> 'A') r""")
def auction_union(v: Views) -> DataFrame:
    price = F.col("l_extendedprice")
    summary = F.struct(F.col("l_quantity").cast("bigint").alias("numberOfSales"), price.alias("averagePrice"),
                       price.alias("minPrice"))

    def sale(day):
        return F.struct(F.date_format(day, "MM/dd/yyyy").alias("dateOfSale"), price.alias("price"))

    sales = F.array(sale(F.col("l_shipdate")), sale(F.date_add("l_shipdate", 1)))
    doc = F.to_json(F.struct(
        F.when(F.col("l_returnflag") != "N", summary).alias("historicalItemAuctionSummary"),
        F.when(F.col("l_returnflag") != "A", F.struct(sales.alias("highestDailySales"))).alias("historicalAuctionInfo")))
    item = F.col("l_partkey").cast("string")
    docs = dealt(v.table("lineitem")).select(
        item.alias("item_id"), case(F.col("l_linenumber"), LINE_GRADES).alias("grade"),
        F.concat(F.lit("Card "), item).alias("card_name"), doc.alias("value"))
    at = F.lit(dt.datetime(2001, 12, 2, 8)).cast("timestamp_ntz")
    return documents.auction_rows(docs, at).select(
        "item_id", "grade", "grade_label", "record_type", "total_sales_count", "average_price", "min_price",
        "sale_date", "sale_price", "card_name", "lifecycle_sales_count")


@query("daily_profile", with_views("auctions") + """SELECT CAST(scraped_at AS DATE) AS scrape_date,
    COUNT(*) AS record_count, COUNT(DISTINCT item_id || '_' || grade) AS unique_card_grades,
    MIN(scraped_at) AS earliest_time, MAX(scraped_at) AS latest_time FROM auctions GROUP BY 1""")
def daily_profile(v: Views) -> DataFrame:
    return profile.daily_profile(v.auctions)


@query("duplicate_groups", with_views("auctions") + """SELECT item_id, grade, sale_date, sale_price, record_type,
    COUNT(*) AS duplicate_count, string_agg(DISTINCT CAST(CAST(scraped_at AS DATE) AS VARCHAR), ','
        ORDER BY CAST(CAST(scraped_at AS DATE) AS VARCHAR)) AS scrape_dates
    FROM auctions WHERE record_type = 'sale' GROUP BY item_id, grade, sale_date, sale_price, record_type
    HAVING COUNT(*) > 1 ORDER BY duplicate_count DESC, item_id, grade, sale_date, sale_price, record_type LIMIT 20""")
def duplicate_groups(v: Views) -> DataFrame:
    keys = ["item_id", "grade", "sale_date", "sale_price", "record_type"]
    found = dedup.duplicate_groups(v.auctions.filter("record_type = 'sale'"), keys, profile.scrape_day())
    return found.withColumn("scrape_dates", dates_text("scrape_dates"))


@query("period_check", with_views("auctions") + """SELECT COUNT(*) AS record_count,
    COUNT(DISTINCT item_id) AS unique_items, COUNT(DISTINCT item_id || '_' || grade) AS unique_card_grades,
    MIN(scraped_at) AS earliest_time, MAX(scraped_at) AS latest_time
    FROM auctions WHERE CAST(scraped_at AS DATE) BETWEEN DATE '2001-12-02' AND DATE '2001-12-31'""")
def period_check(v: Views) -> DataFrame:
    return profile.period_check(v.auctions, DAY, dt.date(2001, 12, 31))


@query("point_history", with_views("auctions") + """SELECT item_id, grade,
    COUNT(DISTINCT CAST(scraped_at AS DATE)) AS scrape_days, COUNT(*) AS total_records,
    string_agg(DISTINCT CAST(CAST(scraped_at AS DATE) AS VARCHAR), ','
        ORDER BY CAST(CAST(scraped_at AS DATE) AS VARCHAR)) AS dates
    FROM auctions WHERE item_id = '42' AND grade = '10' GROUP BY item_id, grade""")
def point_history(v: Views) -> DataFrame:
    return profile.point_history(v.auctions, "42", "10").withColumn("dates", dates_text("dates"))


@query("dup_rate", with_views("auctions") + f"""SELECT total_records, unique_records,
    total_records - unique_records AS duplicates,
    (total_records - unique_records) * 100.0::DOUBLE / total_records AS duplication_pct
    FROM (SELECT CAST(SUM(n) AS BIGINT) AS total_records, COUNT(*) AS unique_records
          FROM (SELECT COUNT(*) AS n FROM auctions GROUP BY {HISTORY}))""")
def dup_rate(v: Views) -> DataFrame:
    return dedup.duplication_rate(v.auctions, dedup.HISTORY_KEYS)


@query("record_type_counts", with_views("auctions") + """SELECT COUNT(*) AS total_records,
    COUNT(DISTINCT item_id) AS unique_items, COUNT(DISTINCT item_id || '_' || grade) AS unique_card_grades,
    COUNT(*) FILTER (WHERE record_type = 'summary') AS summary_records,
    COUNT(*) FILTER (WHERE record_type = 'sale') AS sale_records FROM auctions""")
def record_type_counts(v: Views) -> DataFrame:
    return profile.record_type_counts(v.auctions)


DEDUPED = f"""SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {HISTORY}
    ORDER BY scraped_at DESC, min_price, max_price, card_name, psa_url NULLS FIRST) AS rn FROM auctions) WHERE rn = 1"""


def deduped(v: Views) -> DataFrame:
    return dedup.keep_one(v.auctions, dedup.HISTORY_KEYS, "scraped_at")


@query("dedup_latest", with_views("auctions") + f"""SELECT item_id, grade, record_type, total_sales_count, min_price,
    max_price, sale_date, sale_price, card_name, psa_url, scraped_at FROM ({DEDUPED})""")
def dedup_latest(v: Views) -> DataFrame:
    return deduped(v).select("item_id", "grade", "record_type", "total_sales_count", "min_price", "max_price",
                             "sale_date", "sale_price", "card_name", "psa_url", "scraped_at")


@query("post_dedup_counts", with_views("auctions") + f"""SELECT CAST(scraped_at AS DATE) AS scrape_date,
    COUNT(*) AS record_count FROM ({DEDUPED}) GROUP BY 1""")
def post_dedup_counts(v: Views) -> DataFrame:
    return profile.rows_per_day(deduped(v))


@query("item_sales", with_views("auctions") + f"""SELECT COUNT(*) AS total_records,
    COUNT(DISTINCT sale_date) AS unique_sales FROM ({DEDUPED})
    WHERE item_id = '42' AND grade = '10' AND record_type = 'sale'""")
def item_sales(v: Views) -> DataFrame:
    return profile.item_sales(deduped(v), "42", "10")


@query("dedup_first", SESSION + """SELECT card_name, psa_level, auction_price, psa_url, auction_date, week_start,
    scraped_at FROM session""")
def dedup_first(v: Views) -> DataFrame:
    return session(v)


@query("dup_impact", SALES + """, keyed AS (SELECT card_name, psa_level, auction_price, COUNT(*) AS n FROM sales
      GROUP BY card_name, psa_level, auction_date, auction_price)
    SELECT CAST(SUM(n) AS BIGINT) AS rows_before, COUNT(*) AS rows_after,
      COUNT(*) FILTER (WHERE n > 1) AS duplicate_groups,
      CAST(COALESCE(SUM(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS rows_in_groups,
      CAST(SUM(n) - COUNT(*) AS BIGINT) AS rows_removed,
      CAST(SUM(n) - COUNT(*) AS DOUBLE) * 100 / SUM(n) AS removed_pct,
      COUNT(DISTINCT card_name) AS cards, COUNT(DISTINCT (card_name, psa_level)) AS combos,
      MIN(auction_price) AS min_price, MAX(auction_price) AS max_price FROM keyed""")
def dup_impact(v: Views) -> DataFrame:
    return dedup.duplicate_impact(auctions.sales(v.auctions, DAY, SINCE), dedup.SESSION_KEYS,
                                  "card_name", "psa_level", "auction_price")


@query("dup_examples", SALES + """SELECT card_name, psa_level, auction_date, auction_price,
      COUNT(*) AS duplicate_count, MIN(scraped_at) AS earliest_scrape, MAX(scraped_at) AS latest_scrape,
      COUNT(DISTINCT psa_url) AS unique_urls,
      date_diff('second', MIN(scraped_at), MAX(scraped_at)) / 60.0 AS minutes_between
    FROM sales GROUP BY ALL HAVING COUNT(*) > 1
    ORDER BY duplicate_count DESC, card_name, psa_level, auction_date, auction_price LIMIT 5""")
def dup_examples(v: Views) -> DataFrame:
    return dedup.duplicate_examples(auctions.sales(v.auctions, DAY, SINCE), dedup.SESSION_KEYS, "scraped_at", "psa_url")


@query("quality_filter", with_views("auctions") + """SELECT grade, COUNT(*) AS n,
      MIN(CAST(strptime(sale_date, '%m/%d/%Y') AS DATE)) AS first_sale,
      MAX(CAST(strptime(sale_date, '%m/%d/%Y') AS DATE)) AS last_sale
    FROM auctions WHERE record_type = 'sale' AND sale_price > 0 AND strptime(sale_date, '%m/%d/%Y') >= DATE '1998-01-01'
    GROUP BY grade""")
def quality_filter(v: Views) -> DataFrame:
    return filters.usable_sales(v.auctions, dt.date(1998, 1, 1)).groupBy("grade").agg(
        F.count("*").alias("n"), F.min("auction_date").alias("first_sale"), F.max("auction_date").alias("last_sale"))


@query("sales_with_summary", with_views("auctions", "sales", "totals") + """SELECT card_name, psa_level, auction_price,
    COALESCE(total_sales_count, 0) AS total_sales_count, psa_url, auction_date, week_start, scraped_at
    FROM sales LEFT JOIN totals USING (card_name, psa_level)""")
def sales_with_summary(v: Views) -> DataFrame:
    return auctions.sales_with_summary(v.auctions, DAY, SINCE)


@query("auction_weekly", WEEKLY + "SELECT * FROM weekly")
def auction_weekly(v: Views) -> DataFrame:
    return weeks(v)


@query("weekly_averages", WEEKLY + """SELECT COUNT(DISTINCT (card_name, psa_level)) AS combos,
    COUNT(DISTINCT week_start) AS weeks, AVG(transaction_count) AS avg_transactions FROM weekly""")
def weekly_averages(v: Views) -> DataFrame:
    return auctions.weekly_averages(weeks(v))


@query("price_point_counts", SESSION + """SELECT card_name, psa_level, COUNT(DISTINCT week_start) AS weeks_with_prices,
    COUNT(*) AS psa_price_point_count,
    CAST(SUM(COUNT(*)) OVER (PARTITION BY card_name) AS BIGINT) AS card_price_point_count
    FROM session GROUP BY card_name, psa_level""")
def price_point_counts(v: Views) -> DataFrame:
    return auctions.price_point_counts(session(v))


@query("top_cards", with_views("auctions", "sales", "totals", "session", "weekly", "best")
       + """SELECT card_name, lifecycle_sales AS total_sales_count,
            CAST(ROW_NUMBER() OVER (ORDER BY lifecycle_sales DESC, card_name) - 1 AS INTEGER) AS card_order FROM best""")
def top_cards(v: Views) -> DataFrame:
    return auctions.top_cards(weeks(v))


@query("top_cards_by_sum", WEEKLY + """SELECT card_name, CAST(SUM(t) AS BIGINT) AS total_sales_count,
    CAST(ROW_NUMBER() OVER (ORDER BY SUM(t) DESC, card_name) - 1 AS INTEGER) AS card_order
    FROM (SELECT card_name, psa_level, MAX(total_sales_count) AS t FROM weekly GROUP BY ALL)
    GROUP BY card_name ORDER BY total_sales_count DESC, card_name LIMIT 10""")
def top_cards_by_sum(v: Views) -> DataFrame:
    return auctions.top_cards(weeks(v), rank="sum")


query("top_cards_weekly", TOP + "SELECT * FROM top_weekly")(top_weekly)


WEEKS = calendar_weeks(SINCE, dt.date(2001, 12, 31))


@query("top_cards_pivot", TOP + "SELECT psa_level, card_name, price_points, lifecycle_sales, psa_url, " + ", ".join(
    f"MAX(CASE WHEN week_start = DATE '{w}' THEN avg_price END) AS \"{w}\"" for w in WEEKS)
    + " FROM top_weekly GROUP BY psa_level, card_name, price_points, lifecycle_sales, psa_url")
def top_cards_pivot(v: Views) -> DataFrame:
    return auctions.top_cards_pivot(top_weekly(v), WEEKS)


@query("ranked_cards", with_views("auctions", "sales", "totals", "session", "weekly", "best")
       + """SELECT card_name, lifecycle_sales AS total_sales_count,
            CAST(ROW_NUMBER() OVER (ORDER BY lifecycle_sales DESC, card_name) - 1 AS INTEGER) AS card_order FROM best""")
def ranked_cards(v: Views) -> DataFrame:
    return auctions.ranked_cards(v.auctions, DAY, SINCE)


@query("single_grade_weekly", TOP + "SELECT * EXCLUDE (psa_level) FROM top_weekly WHERE psa_level = '9'")
def single_grade_weekly(v: Views) -> DataFrame:
    return auctions.single_grade(top_weekly(v), "9")


@query("top_latest_week", TOP + """SELECT 'PSA ' || psa_level || ' - ' || card_name AS combo, week_start, avg_price
    FROM top_weekly WHERE week_start = (SELECT MAX(week_start) FROM top_weekly)
    ORDER BY avg_price DESC, combo LIMIT 10""")
def top_latest_week(v: Views) -> DataFrame:
    return auctions.top_latest_week(top_weekly(v))


@query("nested_report")
def nested_report(v: Views) -> DataFrame:
    return auctions.nested_report(top_weekly(v))


@query("nested_report_unfolded", TOP + """SELECT card_order, card_name, lifecycle_sales, psa_level, price_points, psa_url,
    week_start, avg_price FROM top_weekly""")
def nested_report_unfolded(v: Views) -> DataFrame:
    """The nested report taken apart again: the same rows as the long form."""
    grades = auctions.nested_report(top_weekly(v)).select(
        "card_order", "card_name", "lifecycle_sales", F.inline("grades"))
    return grades.select("card_order", "card_name", "lifecycle_sales", "psa_level", "price_points", "psa_url",
                         F.inline("weeks"))


@query("snapshot_profile", SESSION + """SELECT COUNT(DISTINCT card_name) AS unique_cards,
    string_agg(DISTINCT psa_level, ',' ORDER BY psa_level) AS psa_levels, MIN(auction_price) AS min_price,
    MAX(auction_price) AS max_price, MIN(auction_date) AS first_sale, MAX(auction_date) AS last_sale,
    MIN(scraped_at) AS first_scrape, MAX(scraped_at) AS last_scrape FROM session""")
def snapshot_profile(v: Views) -> DataFrame:
    return auctions.snapshot_profile(session(v)).withColumn("psa_levels", F.array_join("psa_levels", ","))


@query("latest_snapshot", with_views("auctions") + "SELECT CAST(MAX(scraped_at) AS DATE) AS latest_date FROM auctions")
def latest_snapshot(v: Views) -> DataFrame:
    return auctions.latest_snapshot(v.auctions)


@query("auction_dates", with_views("auctions") + """SELECT CAST(scraped_at AS DATE) AS scrape_date,
    COUNT(*) AS record_count, COUNT(DISTINCT card_name) AS unique_cards FROM auctions GROUP BY 1
    ORDER BY 1 DESC LIMIT 10""")
def auction_dates(v: Views) -> DataFrame:
    return auctions.available_dates(v.auctions)


@query("coverage_gaps", with_views("auctions") + f"""SELECT item_id, grade
    FROM (SELECT CAST(p_partkey AS VARCHAR) AS item_id, unnest({GRADES}) AS grade FROM part)
    WHERE (item_id, grade) NOT IN (SELECT (item_id, grade) FROM auctions)""")
def coverage_gaps(v: Views) -> DataFrame:
    cards = v.table("part").select(F.col("p_partkey").cast("string").alias("item_id"))
    return auctions.coverage_gaps(cards, v.auctions)
