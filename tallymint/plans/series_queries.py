"""Queries over price series, search trends, names and text values."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions import cleaning, dates, text
from ..operators import filters, series
from ..session import workspace
from ..sources import documents, files
from .registry import query
from .views import SERIES_NAMES, Views, with_views

POINTS = with_views("ticks", "points")
KINDS = list(SERIES_NAMES.values())
ORDER = ["event_id", "pos"]


def points(v: Views) -> DataFrame:
    products = documents.packed_products(v.packed_documents, keep=("event_id",))
    return documents.packed_points(products, keys=("asin", "event_id"))


def trend_points(v: Views) -> DataFrame:
    return documents.trend_points(v.trend_lines)


@query("packed_series_decode", POINTS + "SELECT asin, event_id, price_type, pos, ts, price FROM points")
def packed_series_decode(v: Views) -> DataFrame:
    return points(v)


@query("series_align", POINTS + "SELECT asin, ts, " + ", ".join(
    f"arg_min(price, (event_id, pos)) FILTER (WHERE price_type = '{k}') AS {k}" for k in KINDS
) + " FROM points GROUP BY asin, ts")
def series_align(v: Views) -> DataFrame:
    return series.align_series(points(v), ["asin"], KINDS, ORDER)


@query("series_summary", POINTS + """SELECT asin, price_type, COUNT(*) AS points, MIN(ts) AS first_ts,
    arg_min(price, (ts, event_id, pos)) AS first_price, MAX(ts) AS last_ts,
    arg_max(price, (ts, event_id, pos)) AS last_price FROM points GROUP BY asin, price_type""")
def series_summary(v: Views) -> DataFrame:
    return series.series_summary(points(v), ["asin"], ORDER)


@query("series_stats", POINTS + """SELECT price_type, COUNT(*) AS points, MIN(price) AS min_price,
    MAX(price) AS max_price, CAST(SUM(CAST(price AS DECIMAL(24,6))) AS DOUBLE) / COUNT(*) AS mean_price,
    ROUND(median(price), 4) AS median_price FROM points GROUP BY price_type""")
def series_stats(v: Views) -> DataFrame:
    return series.series_stats(points(v)).withColumn("median_price", F.round("median_price", 4))


@query("price_histogram", POINTS + """, edges AS (SELECT price_type, MIN(price) AS lo, MAX(price) AS hi FROM points
      GROUP BY price_type),
    binned AS (SELECT price_type, least(CAST(floor(20.0::DOUBLE * (price - lo) / (hi - lo)) AS INTEGER) + 1, 20) AS bin,
      COUNT(*) AS n FROM points JOIN edges USING (price_type) GROUP BY ALL)
    SELECT e.price_type, b.bin, lo + (hi - lo) / 20 * (b.bin - 1) AS bin_start, COALESCE(n, 0) AS n
    FROM (SELECT *, unnest(range(1, 21)) AS bin_no FROM edges) e
    JOIN LATERAL (SELECT CAST(e.bin_no AS INTEGER) AS bin) b ON TRUE
    LEFT JOIN binned ON binned.price_type = e.price_type AND binned.bin = b.bin""")
def price_histogram(v: Views) -> DataFrame:
    return series.price_histogram(points(v), KINDS)


@query("recent_window", POINTS + """SELECT asin, event_id, price_type, ts, price FROM points
    WHERE ts >= (SELECT MAX(ts) FROM points) - INTERVAL 7 DAY""")
def recent_window(v: Views) -> DataFrame:
    return filters.last_days_of_data(points(v).drop("pos"), "ts", 7)


@query("trend_series_explode", with_views("ticks") + """
    SELECT 'kw_' || user_id AS keyword, event_id AS line_no, s.series, CAST(ts AS DATE) AS date,
           CASE s.series WHEN 'averageSold' THEN value ELSE CAST(k AS DOUBLE) END AS value
    FROM ticks CROSS JOIN (VALUES ('averageSold'), ('quantity')) AS s(series)
    WHERE event_type NOT IN ('error', 'signup')""")
def trend_series_explode(v: Views) -> DataFrame:
    return trend_points(v).drop("pos")


KEYWORDS = 40


def trend_files(v: Views) -> DataFrame:
    """Trend lines of files: one file for each of some keywords, its lines in the order of the events."""
    path = workspace(v.spark, "trends")
    keyword = F.pmod(F.regexp_extract("keyword", r"(\d+)$", 1).cast("bigint"), F.lit(KEYWORDS)).cast("string")
    lines = v.trend_lines.select("value", "line_no", F.concat(F.lpad(keyword, 4, "0"), F.lit("_kw_"), keyword).alias("stem"))
    lines.repartition("stem").sortWithinPartitions("stem", "line_no").select("value", "stem").write.partitionBy("stem").text(path)
    return files.scan_trend_lines(v.spark, path, "*.txt", F.regexp_extract("path", "/stem=([^/]+)/", 1))


@query("trend_files", with_views("ticks") + f"""
    SELECT 'kw_' || (user_id % {KEYWORDS}) AS keyword, CAST(ts AS DATE) AS date,
      arg_max(value, event_id) AS price, arg_max(CAST(k AS DOUBLE), event_id) AS quantity, COUNT(*) AS lines
    FROM ticks WHERE event_type NOT IN ('error', 'signup') GROUP BY ALL""")
def last_of_trend_files(v: Views) -> DataFrame:
    """Written files, read line by line: of several points on a date the last line counts."""
    points = documents.trend_points(trend_files(v))
    found = points.filter("series = 'quantity'").groupBy("keyword", "date").agg(F.count("*").alias("lines"))
    return series.trend_values(points).join(found, ["keyword", "date"])


@query("trend_grid", with_views("ticks", "trend_values") + """SELECT keyword, date, price, quantity
    FROM (SELECT DISTINCT 'kw_' || user_id AS keyword FROM ticks) CROSS JOIN (SELECT DISTINCT date FROM trend_values)
    LEFT JOIN trend_values USING (keyword, date)""")
def trend_grid(v: Views) -> DataFrame:
    return series.trend_grid(trend_points(v), v.trend_lines)


MONTH = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(31)]


@query("trend_pivot", with_views("ticks", "trend_values") + "SELECT keyword, " + ", ".join(
    f"MAX(price) FILTER (WHERE date = DATE '{d}') AS \"{d}\"" for d in MONTH) + " FROM trend_values GROUP BY keyword")
def trend_pivot(v: Views) -> DataFrame:
    return series.trend_pivot(trend_points(v), "price", MONTH)


@query("latest_folder", "SELECT MAX(strftime(ts, '%y%m%d')) AS stamp FROM events")
def latest_folder(v: Views) -> DataFrame:
    return files.latest_folder(v.table("events").select(
        F.concat(F.lit("data/"), F.date_format("ts", "yyMMdd"), F.lit("_raw_jsons/0001_x.json")).alias("path")))


@query("json_field", """SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k, COALESCE(props->>'$.k.deep', 'none') AS deep,
    CASE WHEN event_type = 'view' THEN 'nothing' ELSE CAST(props->>'$.k' AS VARCHAR) END AS nested FROM events""")
def json_field(v: Views) -> DataFrame:
    """Fields of JSON text with defaults; a nested one is written as JSON first."""
    k = text.json_get("props", "k")
    whole = F.to_json(F.struct(F.struct(F.struct(F.when(F.col("event_type") != "view", k).alias("c")).alias("b")).alias("a")))
    return v.table("events").select("event_id", k.cast("bigint").alias("k"),
                                    text.json_get("props", "k", "deep", default="none").alias("deep"),
                                    text.json_get(whole, "a", "b", "c", default="nothing").alias("nested"))


@query("keyword_grid", with_views("ticks", "trend_values") + """SELECT keyword, date, price, quantity
    FROM (SELECT DISTINCT 'kw_' || user_id AS keyword FROM ticks UNION SELECT 'kw_unseen')
    CROSS JOIN (SELECT DISTINCT date FROM trend_values) LEFT JOIN trend_values USING (keyword, date)""")
def keyword_grid(v: Views) -> DataFrame:
    """The grid of the keywords of a list file, which has blank lines, stray white space and a keyword without points."""
    path = workspace(v.spark, "keywords")
    listed = v.trend_lines.select("keyword").distinct().unionByName(v.spark.createDataFrame([("kw_unseen",)], "keyword STRING"))
    listed.select(F.concat(F.lit("  "), "keyword", F.lit(" \n\n   "))).write.text(path)
    return series.trend_grid(trend_points(v), files.read_keywords(v.spark, path))


# --- names and values --------------------------------------------------------------------------

@query("date_from_name", """SELECT o_orderkey, CASE
      WHEN o_orderstatus IN ('P', 'F') THEN CAST(o_orderdate AS DATE)
      WHEN o_orderpriority[1] = '4' THEN CAST(o_orderdate AS DATE)
      WHEN o_orderpriority[1] IN ('5', '3') THEN CAST(date_trunc('month', o_orderdate) AS DATE)
      ELSE CAST(o_orderdate AS DATE) + 1 END AS scrape_date FROM orders""")
def date_from_name(v: Views) -> DataFrame:
    return v.archive_names.select(
        "o_orderkey", dates.date_from_name("name", F.col("modified")).alias("scrape_date"))


@query("id_from_url", """SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS product_id FROM part WHERE p_type <> 'PROMO'""")
def id_from_url(v: Views) -> DataFrame:
    ident = F.col("p_partkey").cast("string")
    listed = F.concat(F.lit("https://shop.example/product/"), ident, F.lit("/"), F.replace("p_name", F.lit(" "), F.lit("-")))
    other = F.concat(F.lit("https://shop.example/offer/"), ident)
    lists = v.table("part").select("p_partkey", F.concat(
        F.lit("\n"), F.when(F.col("p_type") == "PROMO", other).otherwise(listed), F.lit("\r\nno address\n")).alias("value"))
    return documents.url_ids(lists, keep=("p_partkey",)).drop("pos")


@query("safe_name", r"""SELECT doc_id, substr(regexp_replace(split_part(text, chr(10), 1), '[^\p{L}\p{N}]', '_', 'g'), 1, 50)
    AS safe FROM documents""")
def safe_name(v: Views) -> DataFrame:
    return v.table("documents").select("doc_id", text.safe_name(F.substring_index("text", "\n", 1)).alias("safe"))


@query("display_name", """SELECT doc_id, CASE WHEN length(title) > 40 THEN substr(title, 1, 40) || '...' ELSE title END
    || ' (' || doc_id || ')' AS product FROM (SELECT doc_id, split_part(text, chr(10), 1) AS title FROM documents)""")
def display_name(v: Views) -> DataFrame:
    return v.table("documents").select(
        "doc_id", text.display_name(F.substring_index("text", "\n", 1), "doc_id").alias("product"))


@query("coerce_types", """SELECT l_orderkey, l_linenumber, l_extendedprice,
    CASE l_returnflag WHEN 'A' THEN CAST(l_quantity AS BIGINT) WHEN 'N' THEN NULL ELSE NULL END AS quantity,
    CASE l_linestatus WHEN 'F' THEN CAST(l_shipdate AS DATE) END AS day,
    CASE l_returnflag WHEN 'R' THEN TRUE ELSE FALSE END AS rejected FROM lineitem""")
def coerce_types(v: Views) -> DataFrame:
    whole = F.col("l_quantity").cast("bigint").cast("string")
    raw = v.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice",
        F.when(F.col("l_returnflag") == "A", F.concat(whole, F.lit(".0")))
        .when(F.col("l_returnflag") == "N", F.lit("n/a")).otherwise(F.concat(whole, F.lit(".5"))).alias("quantity"),
        F.when(F.col("l_linestatus") == "F", F.date_format("l_shipdate", "yyyy-MM-dd"))
        .otherwise(F.lit("not a date")).alias("day"))
    return cleaning.coerce(raw, wholes=("quantity",), days=("day",), flag="rejected")
