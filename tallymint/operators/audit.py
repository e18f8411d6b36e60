"""Reports on the ingest itself: failures, runs, load checks, resume lists, endpoint health."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.money import money_sum, money_total, percentage

# Advice by kind of failure and by error key.
TYPE_ADVICE = {
    "download": "Check network connectivity and source availability. Consider increasing retry delays.",
    "extract": "Verify 7z installation and file integrity. Check disk space.",
    "process": "Check data format consistency. Verify memory availability.",
    "upload": "Verify BigQuery credentials and quotas. Check network connectivity to GCP.",
}
WORD_ADVICE = {
    "timeout": " Increase timeout values.",
    "memory": " Increase memory limits or reduce batch size.",
    "permission": " Check file permissions and credentials.",
}
ERROR_ADVICE = {
    "connection_error": "Check network stability and implement connection pooling",
    "file_not_found": "Verify date ranges and data availability on source",
    "permission_error": "Review authentication and authorization settings",
    "memory_error": "Reduce batch size and implement memory optimization",
    "extraction_error": "Verify archive integrity and 7z installation",
    "bigquery_error": "Check BigQuery quotas and authentication",
}
OTHER_TYPE_ADVICE = "Manual investigation required"
OTHER_ERROR_ADVICE = "Manual investigation and debugging required"
CLUSTER_ERROR = "Multiple failures on same dates"
CLUSTER_ADVICE = "Check for systematic issues on these dates, consider manual intervention"
SEVERITY_RANK = {"critical": 4, "high": 3, "medium": 2, "low": 1}


def _lookup(c: Column, table: dict, default) -> Column:
    out = None
    for key, value in table.items():
        out = F.when(c == key, F.lit(value)) if out is None else out.when(c == key, F.lit(value))
    return out.otherwise(F.lit(default))


def severity(kind: Column, frequency: Column, dates: Column) -> Column:
    """How bad a kind of failure is, from its frequency and the dates it hit."""
    return (
        F.when(kind.isin("download", "extract") & (frequency > 20), "critical")
        .when((kind == "upload") & (frequency > 10), "high")
        .when(dates > 10, "high")
        .when(frequency > 5, "medium")
        .otherwise("low")
    )


def error_key(message: Column) -> Column:
    """Class of an error message; the first rule that fits decides, else its first three words."""
    def has(*words: str) -> Column:
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(message, F.lit(w))
        return hit

    def has_any_case(word: str) -> Column:
        return F.contains(F.lower(message), F.lit(word))

    words = F.slice(F.split(F.trim(message), r"\s+"), 1, 3)
    # The rules, in order.
    return (
        F.when(has("Connection") | has_any_case("timeout"), "connection_error")
        .when(has("404", "Not Found"), "file_not_found")
        .when(has("Permission", "Forbidden"), "permission_error")
        .when(has("Memory"), "memory_error")
        .when(has("7z") | has_any_case("extract"), "extraction_error")
        .when(has("BigQuery", "GCP"), "bigquery_error")
        .otherwise(F.lower(F.array_join(words, "_")))
    )


def count_failures(failures: DataFrame) -> DataFrame:
    """Failures per day, kind and message, as ``n``.

    All reports start from this one aggregation, so a report made of several scans the log once.
    """
    return failures.groupBy("date", "failure_type", "error_message").agg(F.count("*").alias("n"))


def failures_by_type(failures: DataFrame, least: int = 2) -> DataFrame:
    """Per kind of failure: frequency, dates, most common message (ties: the smallest) and severity."""
    counted = count_failures(failures)
    per_message = counted.groupBy("failure_type", "error_message").agg(F.sum("n").alias("n"))
    common = per_message.groupBy("failure_type").agg(
        F.sum("n").alias("frequency"),
        F.min_by("error_message", F.struct(-F.col("n"), "error_message")).alias("common_error"),
    )
    per_day = counted.groupBy("failure_type", "date").agg(F.sum("n").alias("n")).filter("n > 0")
    dates = per_day.groupBy("failure_type").agg(F.count("date").alias("dates_affected"))
    return common.join(dates, "failure_type").filter(F.col("frequency") >= least).select(
        F.concat("failure_type", F.lit("_failures")).alias("pattern_type"),
        "failure_type", "frequency", "dates_affected", "common_error",
        severity(F.col("failure_type"), F.col("frequency"), F.col("dates_affected")).alias("severity"),
    )


def failure_counts(failures: DataFrame) -> DataFrame:
    """Failures per kind, the most frequent first, beside all failures and failed days."""
    counted = count_failures(failures)
    kinds = counted.groupBy("failure_type").agg(F.sum("n").alias("failures"))
    days = counted.groupBy("date").agg(F.sum("n").alias("n"))
    return kinds.withColumns({
        "total_failures": days.agg(F.sum("n")).scalar(), "failed_dates": days.agg(F.count("date")).scalar(),
    }).orderBy(F.desc("failures"), "failure_type")


def failure_clusters(failures: DataFrame) -> DataFrame:
    """Days with more than two failures, reported when there are at least two such days."""
    bad = count_failures(failures).groupBy("date").agg(F.sum("n").alias("n")).filter("n > 2")
    return bad.agg(F.count("*").alias("frequency")).filter("frequency >= 2").select(
        F.lit("temporal_clustering").alias("pattern_type"), "frequency",
        F.col("frequency").alias("dates_affected"),
        F.when(F.col("frequency") < 5, "medium").otherwise("high").alias("severity"),
    )


def error_patterns(failures: DataFrame, least: int = 3) -> DataFrame:
    """Classes of messages that occur at least ``least`` times."""
    per_day = count_failures(failures).groupBy(error_key(F.col("error_message")).alias("error_key"), "date") \
        .agg(F.sum("n").alias("n"))
    return per_day.groupBy("error_key").agg(
        F.sum("n").alias("frequency"), F.count("date").alias("dates_affected")
    ).filter(F.col("frequency") >= least).withColumn(
        "severity", F.when(F.col("frequency") > 10, "high").otherwise("medium")
    )


def recovery_report(failures: DataFrame) -> DataFrame:
    """All patterns with advice, the worst first, beside total failures and failed days."""
    by_type = failures_by_type(failures)
    text = F.lower("common_error")
    advice = F.concat(
        _lookup(F.col("failure_type"), TYPE_ADVICE, OTHER_TYPE_ADVICE),
        F.when(F.contains(text, F.lit("timeout")), WORD_ADVICE["timeout"])
        .when(F.contains(text, F.lit("memory")), WORD_ADVICE["memory"])
        .when(F.contains(text, F.lit("permission")), WORD_ADVICE["permission"])
        .otherwise(""),
    )
    columns = ["pattern_type", "severity", "frequency", "dates_affected", "common_error", "recommendation"]
    patterns = (
        by_type.withColumn("recommendation", advice).select(*columns)
        .unionByName(failure_clusters(failures)
                     .withColumns({"common_error": F.lit(CLUSTER_ERROR), "recommendation": F.lit(CLUSTER_ADVICE)})
                     .select(*columns))
        .unionByName(error_patterns(failures)
                     .withColumns({"pattern_type": F.lit("error_pattern"), "common_error": F.col("error_key"),
                                   "recommendation": _lookup(F.col("error_key"), ERROR_ADVICE, OTHER_ERROR_ADVICE)})
                     .select(*columns))
    )
    days = count_failures(failures).groupBy("date").agg(F.sum("n").alias("n"))
    return patterns.withColumns({
        "severity_rank": _lookup(F.col("severity"), SEVERITY_RANK, 0),
        "total_failures": days.agg(F.sum("n")).scalar(),
        "failed_dates": days.agg(F.count("date")).scalar(),
    }).orderBy(F.desc("severity_rank"), F.desc("frequency"), "pattern_type", "common_error")


def failed_dates(failures: DataFrame) -> DataFrame:
    """Days that had failures, in order."""
    return failures.select("date").distinct().orderBy("date")


def run_status(events: DataFrame, key: str = "date", order: tuple[str, ...] = ("event_time",)) -> DataFrame:
    """Last outcome per key, with the records and time of its completed runs."""
    done = F.col("status") == "completed"
    return events.groupBy(key).agg(
        F.max_by("status", F.struct(*order)).alias("status"),
        F.coalesce(F.sum(F.when(done, F.col("record_count"))), F.lit(0)).alias("record_count"),
        F.coalesce(money_total(F.when(done, F.col("processing_time"))), F.lit(0.0)).alias("processing_time"),
        F.count_if(done).alias("completed_runs"),
    )


def run_report(status: DataFrame) -> DataFrame:
    """Totals of a run and its rates (one row); rates without a base are 0."""
    done = F.count_if(F.col("status") == "completed")
    totals = status.agg(
        F.count("*").alias("total_dates"),
        done.alias("completed_dates"),
        F.count_if(F.col("status") == "failed").alias("failed_dates"),
        F.sum("record_count").alias("total_records"),
        money_total("processing_time").alias("total_time"),
        F.sum("completed_runs").alias("completed_runs"),
    )

    def rate(x: Column, per: Column) -> Column:
        return F.coalesce(F.try_divide(x, per), F.lit(0.0))

    records, time = F.col("total_records"), F.col("total_time")
    return totals.select(
        "total_dates", "completed_dates", "failed_dates", "total_records", "total_time",
        F.coalesce(percentage(F.col("completed_dates"), F.col("total_dates")), F.lit(0.0)).alias("success_rate"),
        rate(time, F.col("completed_runs")).alias("average_time_per_date"),
        rate(records, F.col("completed_dates")).alias("average_records_per_date"),
        rate(records, time).alias("records_per_second"),
        rate(F.col("completed_runs"), time / 3600).alias("dates_per_hour"),
    )


def date_spine(df: DataFrame, first: Column, last: Column, skip_weekends: bool = False) -> DataFrame:
    """Days from ``first`` to ``last`` for each row of ``df`` (usually one row of bounds)."""
    days = df.select(F.explode(F.sequence(first, last, F.expr("INTERVAL 1 DAY"))).alias("date"))
    return days.filter(F.weekday("date") < 5) if skip_weekends else days


def missing_dates(spine: DataFrame, status: DataFrame) -> DataFrame:
    """Days of the spine that have not been completed, in order."""
    done = status.filter(F.col("status") == "completed").select("date")
    return spine.join(done, "date", "left_anti").orderBy("date")


# What a day of prices must look like.
MIN_ROWS, MAX_ROWS = 100_000, 1_000_000
MIN_PRICE, MAX_PRICE = 0.01, 100_000.0
REQUIRED = ("price_date", "product_id", "sub_type_name", "market_price", "category_id", "group_id")


def validate_batch(prices: DataFrame, day: str = "price_date", least: int = MIN_ROWS, most: int = MAX_ROWS,
                   required=REQUIRED, price: str = "market_price", low: float = MIN_PRICE,
                   high: float = MAX_PRICE) -> DataFrame:
    """Checks per day: row count, required columns filled, prices in range; the issues as an array."""
    checks = prices.groupBy(day).agg(
        F.count("*").alias("record_count"),
        *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in required if c != day],
        F.count_if((F.col(price) < low) | (F.col(price) > high)).alias("out_of_range"),
    )
    issues = [
        F.when(F.col("record_count") < least, F.concat(F.lit("Low record count: "), F.col("record_count")))
        .when(F.col("record_count") > most, F.concat(F.lit("High record count: "), F.col("record_count")))
    ]
    issues += [
        F.when(F.col(f"missing_{c}") > 0, F.concat(F.lit(f"Missing {c}: "), F.col(f"missing_{c}")))
        for c in required if c != day
    ]
    issues.append(F.when(F.col("out_of_range") > 0, F.concat(F.lit("Price out of range: "), F.col("out_of_range"))))
    return checks.select(day, "record_count", "out_of_range", F.array_compact(F.array(*issues)).alias("issues")) \
        .withColumn("validation_passed", F.size("issues") == 0)


def group_status(events: DataFrame, order: tuple[str, ...] = ("event_time",)) -> DataFrame:
    """Last outcome per category and group, with its record count."""
    at = F.struct(*order)
    return events.groupBy("category_id", "group_id").agg(
        F.max_by("status", at).alias("status"), F.max_by("record_count", at).alias("record_count")
    )


def category_status(groups: DataFrame) -> DataFrame:
    """Per category: finished and failed groups, products, and whether it is complete."""
    failed = F.col("status") == "failed"
    return groups.groupBy("category_id").agg(
        F.count_if(~failed).alias("completed_groups"),
        F.count_if(failed).alias("failed_groups"),
        F.coalesce(F.sum(F.when(~failed, F.col("record_count"))), F.lit(0)).alias("products"),
        F.when(F.bool_and(~failed), "completed").otherwise("partial").alias("status"),
    )


def retry_list(failed: DataFrame, categories: DataFrame, groups: DataFrame, key: str = "group_key") -> DataFrame:
    """Failed groups, given as ``category:group``, with their names; unknown ones are dropped."""
    parts = F.split(key, ":")
    wanted = failed.select(key, F.get(parts, F.lit(0)).alias("category_id"), F.get(parts, F.lit(1)).alias("group_id"))
    return wanted.join(categories, "category_id").join(groups, ["category_id", "group_id"])


def endpoint_health(requests: DataFrame, order: tuple[str, ...] = ("event_time",), unhealthy: int = 3,
                    slot: Column | None = None) -> DataFrame:
    """Per endpoint: rates, mean response time, failures since the last success, health and rank key.

    The log is read once. Each endpoint's requests of an hour (or another ``slot`` of the order) become one small state:
    its counts, the last success and the failures after it. States are then folded: the failures that count are those
    of all slots after the one with the last success, and those after it within that slot. So a hot endpoint is many
    small states, and nobody puts its whole log in order.
    """
    if slot is None:
        timed = dict(requests.dtypes)[order[0]].startswith(("timestamp", "date"))
        slot = F.date_trunc("hour", order[0]) if timed else F.floor(F.col(order[0]) / 3600)
    at, ok = F.struct(*order), F.col("status") == "success"
    within = Window.partitionBy("endpoint", "slot")
    marked = requests.withColumn("slot", slot).select(
        "endpoint", "slot", "status", "response_time", at.alias("at"), ok.alias("ok"), F.col(order[0]).alias("moment")
    ).withColumn("ok_at", F.max(F.when(F.col("ok"), F.col("at"))).over(within))
    failed = ~F.col("ok")
    states = marked.groupBy("endpoint", "slot").agg(
        F.count("*").alias("requests"), F.count_if("ok").alias("good"), F.count_if(failed).alias("bad"),
        F.count_if(F.col("status") == "rate_limited").alias("limited"),
        money_sum(F.when(F.col("ok"), F.col("response_time"))).alias("time"),
        F.count(F.when(F.col("ok"), F.col("response_time"))).alias("timed"),
        F.max("ok_at").alias("ok_at"), F.max(F.when(F.col("ok"), F.col("moment"))).alias("last_success"),
        F.max(F.when(failed, F.col("moment"))).alias("last_failure"),
        F.count_if(failed & (F.col("ok_at").isNull() | (F.col("at") > F.col("ok_at")))).alias("since"),
    )
    last = F.max("ok_at").over(Window.partitionBy("endpoint"))
    last_slot = F.max(F.when(F.col("good") > 0, F.col("slot"))).over(Window.partitionBy("endpoint"))
    trailing = F.when(last.isNull() | (F.col("slot") > last_slot), F.col("bad")) \
        .when(F.col("ok_at") == last, F.col("since")).otherwise(F.lit(0))
    folded = states.withColumn("trailing", trailing).groupBy("endpoint").agg(
        F.sum("requests").alias("total_requests"), F.sum("good").alias("success_count"),
        F.sum("limited").alias("rate_limited_count"),
        F.coalesce(F.sum("time").cast("double") / F.nullif(F.sum("timed"), F.lit(0)), F.lit(0.0)).alias("avg_response_time"),
        F.sum("trailing").alias("consecutive_failures"),
        F.max("last_success").alias("last_success"), F.max("last_failure").alias("last_failure"),
    )
    return folded.select(
        "endpoint", "total_requests", "success_count", "rate_limited_count",
        percentage(F.col("success_count"), F.col("total_requests")).alias("success_rate"),
        "avg_response_time", "consecutive_failures",
        (F.col("consecutive_failures") < unhealthy).alias("is_healthy"), "last_success", "last_failure",
    ).orderBy(F.desc("success_rate"), "avg_response_time", "rate_limited_count", "endpoint")
