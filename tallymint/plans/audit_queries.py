"""Queries over run, failure and request logs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..operators import audit, backfill, versions
from ..session import workspace
from ..streaming.ingest import not_loaded
from .registry import query
from .views import Views, sql_case, with_views

FAILURES = with_views("ticks", "failures")
RUNS = with_views("ticks", "run_log", "run_status")
AT = ("event_time", "event_id")


@query("failures_by_type", with_views("ticks", "failures", "by_type") + "SELECT * FROM by_type")
def failures_by_type(v: Views) -> DataFrame:
    return audit.failures_by_type(v.failures)


@query("failure_clusters", with_views("ticks", "failures", "clusters") + "SELECT * FROM clusters")
def failure_clusters(v: Views) -> DataFrame:
    return audit.failure_clusters(v.failures)


@query("error_patterns", with_views("ticks", "failures", "error_groups") + "SELECT * FROM error_groups")
def error_patterns(v: Views) -> DataFrame:
    return audit.error_patterns(v.failures)


@query("failed_dates", FAILURES + "SELECT DISTINCT date FROM failures")
def failed_dates(v: Views) -> DataFrame:
    return audit.failed_dates(v.failures)


@query("failure_counts", FAILURES + """SELECT failure_type, COUNT(*) AS failures,
    (SELECT COUNT(*) FROM failures) AS total_failures, (SELECT COUNT(DISTINCT date) FROM failures) AS failed_dates
    FROM failures GROUP BY failure_type""")
def failure_counts(v: Views) -> DataFrame:
    return audit.failure_counts(v.failures)


WORDS_SQL = "CASE " + " ".join(
    f"WHEN contains(lower(common_error), '{word}') THEN '{text}'" for word, text in audit.WORD_ADVICE.items()) + " ELSE '' END"
KIND_SQL = f"COALESCE({sql_case('failure_type', audit.TYPE_ADVICE)}, '{audit.OTHER_TYPE_ADVICE}') || {WORDS_SQL}"
ERROR_SQL = f"COALESCE({sql_case('error_key', audit.ERROR_ADVICE)}, '{audit.OTHER_ERROR_ADVICE}')"


@query("recovery_report", with_views("ticks", "failures", "by_type", "error_groups", "clusters") + f"""
    SELECT pattern_type, severity, frequency, dates_affected, common_error, recommendation,
      CASE severity WHEN 'critical' THEN 4 WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END AS severity_rank,
      (SELECT COUNT(*) FROM failures) AS total_failures, (SELECT COUNT(DISTINCT date) FROM failures) AS failed_dates
    FROM (SELECT pattern_type, severity, frequency, dates_affected, common_error, {KIND_SQL} AS recommendation FROM by_type
      UNION ALL SELECT pattern_type, severity, frequency, dates_affected, '{audit.CLUSTER_ERROR}', '{audit.CLUSTER_ADVICE}'
        FROM clusters
      UNION ALL SELECT 'error_pattern', severity, frequency, dates_affected, error_key, {ERROR_SQL} FROM error_groups)""")
def recovery_report(v: Views) -> DataFrame:
    return audit.recovery_report(v.failures)


@query("run_status", RUNS + "SELECT * FROM run_status")
def run_status(v: Views) -> DataFrame:
    return audit.run_status(v.run_log, order=AT)


@query("run_report", RUNS + """SELECT total_dates, completed_dates, failed_dates, total_records, total_time,
      completed_dates * 100.0::DOUBLE / total_dates AS success_rate, total_time / completed_runs AS average_time_per_date,
      CAST(total_records AS DOUBLE) / completed_dates AS average_records_per_date,
      total_records / total_time AS records_per_second, completed_runs / (total_time / 3600) AS dates_per_hour
    FROM (SELECT COUNT(*) AS total_dates, COUNT(*) FILTER (WHERE status = 'completed') AS completed_dates,
        COUNT(*) FILTER (WHERE status = 'failed') AS failed_dates, CAST(SUM(record_count) AS BIGINT) AS total_records,
        CAST(SUM(CAST(processing_time AS DECIMAL(24,6))) AS DOUBLE) AS total_time,
        CAST(SUM(completed_runs) AS BIGINT) AS completed_runs FROM run_status)""")
def run_report(v: Views) -> DataFrame:
    return audit.run_report(audit.run_status(v.run_log, order=AT))


def spine(v: Views, **how) -> DataFrame:
    bounds = v.run_log.agg(F.date_sub(F.min("date"), 5).alias("first"), F.date_add(F.max("date"), 9).alias("last"))
    return audit.date_spine(bounds, F.col("first"), F.col("last"), **how)


SPINE = """, spine AS (SELECT CAST(unnest(range(MIN(date) - 5, MAX(date) + 10, INTERVAL 1 DAY)) AS DATE) AS date
    FROM run_log) """


@query("missing_dates", RUNS[:-1] + SPINE + """SELECT date FROM spine
    WHERE date NOT IN (SELECT date FROM run_status WHERE status = 'completed')""")
def missing_dates(v: Views) -> DataFrame:
    return audit.missing_dates(spine(v), audit.run_status(v.run_log, order=AT))


@query("missing_weekdays", RUNS[:-1] + SPINE + """SELECT date FROM spine WHERE isodow(date) < 6
    AND date NOT IN (SELECT date FROM run_status WHERE status = 'completed')""")
def missing_weekdays(v: Views) -> DataFrame:
    return audit.missing_dates(spine(v, skip_weekends=True), audit.run_status(v.run_log, order=AT))


# Days of the backfill below are months of the daily prices; one with more or fewer rows than this fails its check.
MONTH_ROWS = {"least": 5, "most": 100_000}
FIRST_RUN = 30


@query("backfill_days", with_views("daily") + f""", by_month AS (SELECT CAST(date_trunc('month', price_date) AS DATE) AS day,
      COUNT(*) AS n, COUNT(*) FILTER (WHERE market_price IS NULL AND category_id = 7) AS gaps FROM daily GROUP BY 1),
    spine AS (SELECT CAST(unnest(range(DATE '1991-12-01', DATE '1998-12-31', INTERVAL 1 MONTH)) AS DATE) AS day),
    judged AS (SELECT day, COALESCE(n, 0) AS n, row_number() OVER (ORDER BY day) AS place,
      COALESCE(n BETWEEN {MONTH_ROWS['least']} AND {MONTH_ROWS['most']} AND gaps = 0, FALSE) AS ok
      FROM spine LEFT JOIN by_month USING (day))
    SELECT day, CASE WHEN ok THEN n ELSE 0 END AS rows_in_table, CASE WHEN ok THEN n ELSE 0 END AS rows_in_log,
      CASE WHEN ok THEN 'completed' ELSE 'failed' END AS status,
      CAST(CASE WHEN ok THEN 1 ELSE 0 END AS BIGINT) AS completed_runs,
      CAST(CASE WHEN ok THEN 0 WHEN place <= {FIRST_RUN} THEN 3 ELSE 2 END AS BIGINT) AS failures,
      CASE WHEN n = 0 THEN 'download' WHEN NOT ok THEN 'process' END AS failure_type FROM judged""")
def backfill_days(v: Views) -> DataFrame:
    """A backfill that stops after some days and is run again, twice: what table and logs hold of each day."""
    out = workspace(v.spark, "backfill")
    table, log = f"{out}/table", f"{out}/log"
    # Prices of the last category are required, so months in which one is missing fail.
    months = v.daily.withColumn("price_date", F.trunc("price_date", "month")) \
        .withColumn("needed", F.coalesce("market_price", F.when(F.col("category_id") != 7, F.lit(0.0))))
    spine = v.spark.createDataFrame([(dt.date(1991, 12, 1), dt.date(1998, 12, 31))], "first DATE, last DATE") \
        .select(F.explode(F.expr("sequence(first, last, INTERVAL 1 MONTH)")).alias("date"))
    for run, limit in (("a", FIRST_RUN), ("b", None), ("c", None)):
        backfill.backfill(v.spark, months, spine, table, log, run, limit=limit, required=("needed",), high=1e9, **MONTH_ROWS)
    status = audit.run_status(backfill.run_log(v.spark, log), order=("event_time", "run_id"))
    failures = backfill.failure_log(v.spark, log).groupBy(F.col("date").alias("day")).agg(
        F.count("*").alias("failures"), F.max("failure_type").alias("failure_type"))
    rows = versions.read(v.spark, table).groupBy(F.col("price_date").alias("day")).agg(F.count("*").alias("rows_in_table"))
    known = status.select(F.col("date").alias("day"), "status", F.col("record_count").alias("rows_in_log"), "completed_runs")
    return known.join(rows, "day", "left").join(failures, "day", "left").fillna(0, ["rows_in_table", "failures"])


@query("endpoint_health", with_views("ticks") + """, log AS (
      SELECT CAST(user_id AS VARCHAR) AS endpoint, ts, event_id, value,
             event_type NOT IN ('error', 'signup') AS ok, event_type = 'signup' AS limited FROM ticks),
    marked AS (SELECT *, COUNT(*) FILTER (WHERE ok) OVER (PARTITION BY endpoint ORDER BY ts DESC, event_id DESC) AS later
               FROM log)
    SELECT endpoint, COUNT(*) AS total_requests, COUNT(*) FILTER (WHERE ok) AS success_count,
      COUNT(*) FILTER (WHERE limited) AS rate_limited_count,
      COUNT(*) FILTER (WHERE ok) * 100.0::DOUBLE / COUNT(*) AS success_rate,
      COALESCE(CAST(SUM(CAST(value AS DECIMAL(24,6))) FILTER (WHERE ok) AS DOUBLE) / COUNT(*) FILTER (WHERE ok), 0)
        AS avg_response_time,
      COUNT(*) FILTER (WHERE later = 0) AS consecutive_failures,
      COUNT(*) FILTER (WHERE later = 0) < 3 AS is_healthy,
      MAX(ts) FILTER (WHERE ok) AS last_success, MAX(ts) FILTER (WHERE NOT ok) AS last_failure
    FROM marked GROUP BY endpoint""")
def endpoint_health(v: Views) -> DataFrame:
    return audit.endpoint_health(v.requests, order=AT)


def group_events(v: Views) -> DataFrame:
    """Orders as load events of groups (customers) in categories (priorities)."""
    return v.table("orders").select(
        F.col("o_orderpriority").alias("category_id"), F.col("o_custkey").alias("group_id"),
        F.when(F.col("o_orderstatus") == "F", "failed").otherwise("completed").alias("status"),
        F.floor("o_totalprice").cast("bigint").alias("record_count"),
        F.col("o_orderdate").alias("event_time"), F.col("o_orderkey").alias("event_id"))


GROUPS = """WITH last AS (SELECT o_orderpriority AS category_id, o_custkey AS group_id,
      arg_max(CASE WHEN o_orderstatus = 'F' THEN 'failed' ELSE 'completed' END, (o_orderdate, o_orderkey)) AS status,
      arg_max(CAST(floor(o_totalprice) AS BIGINT), (o_orderdate, o_orderkey)) AS record_count
    FROM orders GROUP BY ALL) """


@query("category_status", GROUPS + """SELECT category_id, COUNT(*) FILTER (WHERE status <> 'failed') AS completed_groups,
    COUNT(*) FILTER (WHERE status = 'failed') AS failed_groups,
    CAST(COALESCE(SUM(record_count) FILTER (WHERE status <> 'failed'), 0) AS BIGINT) AS products,
    CASE WHEN bool_and(status <> 'failed') THEN 'completed' ELSE 'partial' END AS status FROM last GROUP BY category_id""")
def category_status(v: Views) -> DataFrame:
    return audit.category_status(audit.group_status(group_events(v), order=AT))


@query("retry_list", """SELECT group_key, CAST(s_nationkey AS VARCHAR) AS category_id,
    CAST(s_suppkey AS VARCHAR) AS group_id, n_name AS category_name, s_name AS group_name
    FROM (SELECT c_nationkey || ':' || c_custkey AS group_key FROM customer
      UNION SELECT s_nationkey || ':' || s_suppkey FROM supplier WHERE s_acctbal < 0)
    JOIN supplier ON group_key = s_nationkey || ':' || s_suppkey JOIN nation ON s_nationkey = n_nationkey""")
def retry_list(v: Views) -> DataFrame:
    failed = v.table("customer").select(
        F.concat(F.col("c_nationkey").cast("string"), F.lit(":"), F.col("c_custkey").cast("string")).alias("group_key")
    ).unionByName(v.table("supplier").filter("s_acctbal < 0").select(
        F.concat(F.col("s_nationkey").cast("string"), F.lit(":"), F.col("s_suppkey").cast("string")).alias("group_key")
    )).distinct()
    categories = v.table("nation").select(
        F.col("n_nationkey").cast("string").alias("category_id"), F.col("n_name").alias("category_name"))
    known = v.table("supplier").select(
        F.col("s_nationkey").cast("string").alias("category_id"), F.col("s_suppkey").cast("string").alias("group_id"),
        F.col("s_name").alias("group_name"))
    return audit.retry_list(failed, categories, known)


@query("manifest_anti", """SELECT DISTINCT CAST(l_partkey AS VARCHAR) || '.json' AS filepath,
      CASE WHEN l_linestatus = 'F' THEN DATE '2001-12-01' ELSE DATE '2001-12-02' END AS scrape_date
    FROM lineitem EXCEPT
    SELECT CAST(l_partkey AS VARCHAR) || '.json',
      CASE WHEN l_linestatus = 'F' THEN DATE '2001-12-01' ELSE DATE '2001-12-02' END
    FROM lineitem WHERE l_returnflag = 'R' AND l_discount > 0.05""")
def manifest_anti(v: Views) -> DataFrame:
    path = F.concat("product_id", F.lit(".json")).alias("filepath")
    done = v.prices.filter((F.col("condition") == "R") & (F.col("low_sale_price") < F.col("market_price") * 0.9499999))
    return not_loaded(v.prices.select(path, "scrape_date").distinct(), done.select(path, "scrape_date").distinct())


