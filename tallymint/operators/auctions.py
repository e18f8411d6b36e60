"""Graded-card auctions: sales beside their summary, weekly prices by grade, top cards."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.dates import week_start
from ..functions.money import cents, money_mean
from ..schemas import GRADES
from .dedup import keep_one
from .filters import snapshot_day, usable_sales
from .weekly import pivot_weeks

# Fixed value: sales before this day are not analysed.
SINCE = dt.date(2016, 1, 1)


def sales(auctions: DataFrame, day: dt.date, since: dt.date = SINCE, partition: str | None = None) -> DataFrame:
    """Usable sales of one scrape day under their report names."""
    return usable_sales(snapshot_day(auctions, day, partition=partition), since).select(
        "card_name",
        F.col("grade").alias("psa_level"),
        F.col("sale_price").alias("auction_price"),
        "psa_url",
        "auction_date",
        week_start("auction_date").alias("week_start"),
        "scraped_at",
    )


def summaries(auctions: DataFrame, day: dt.date, partition: str | None = None) -> DataFrame:
    """The newest summary of the day per card and grade."""
    rows = snapshot_day(auctions, day, partition=partition).filter(
        (F.col("record_type") == "summary") & F.col("total_sales_count").isNotNull()
    ).select("card_name", F.col("grade").alias("psa_level"), "total_sales_count", "psa_url", "scraped_at")
    return keep_one(rows, ["card_name", "psa_level"], "scraped_at").drop("scraped_at")


def sales_with_summary(auctions: DataFrame, day: dt.date, since: dt.date = SINCE,
                       partition: str | None = None) -> DataFrame:
    """Sales of a day with the sales total of their card and grade (0 when there is no summary)."""
    totals = summaries(auctions, day, partition).withColumnRenamed("psa_url", "summary_url")
    return sales(auctions, day, since, partition).join(totals, ["card_name", "psa_level"], "left").select(
        "card_name", "psa_level", "auction_price",
        F.coalesce("total_sales_count", F.lit(0)).alias("total_sales_count"),
        F.coalesce("psa_url", "summary_url").alias("psa_url"),
        "auction_date", "week_start", "scraped_at",
    )


def session_sales(auctions: DataFrame, day: dt.date, since: dt.date = SINCE,
                  partition: str | None = None, cards: DataFrame | None = None) -> DataFrame:
    """Sales of a day without repeats: the earliest scrape of each card, grade, date and price.

    The week follows from the date; naming it as a key too leaves the rows in the order that weekly
    sums need, so they are not sorted a second time. ``cards`` limits the sales before repeats are looked for.
    """
    keys = ["card_name", "psa_level", "week_start", "auction_date", "auction_price"]
    found = sales(auctions, day, since, partition)
    if cards is not None:
        found = found.join(cards.select("card_name"), "card_name", "left_semi")
    return keep_one(found, keys, "scraped_at", keep="earliest")


def weekly(auctions: DataFrame, day: dt.date, since: dt.date = SINCE, partition: str | None = None,
           cards: DataFrame | None = None) -> DataFrame:
    """Mean price, sales, total and url per card, grade and week; of the listed ``cards`` only, if given.

    Sales become weeks before they meet the summaries, so the join sees one row per group. The url is
    the first one present when sales are read by date and price, each falling back to the summary's.
    """
    position = F.struct("auction_date", "auction_price", "scraped_at")
    weeks = session_sales(auctions, day, since, partition, cards).groupBy("card_name", "psa_level", "week_start").agg(
        cents(money_mean("auction_price")).alias("avg_price"),
        F.count("*").alias("transaction_count"),
        F.min_by("psa_url", position).alias("first_url"),
        F.min_by("psa_url", F.when(F.col("psa_url").isNotNull(), position)).alias("any_url"),
    )
    totals = summaries(auctions, day, partition).withColumnRenamed("psa_url", "summary_url")
    return weeks.join(totals, ["card_name", "psa_level"], "left").select(
        "card_name", "psa_level", "week_start", "avg_price", "transaction_count",
        F.coalesce("total_sales_count", F.lit(0)).alias("total_sales_count"),
        F.when(F.col("summary_url").isNotNull(), F.coalesce("first_url", "summary_url"))
        .otherwise(F.col("any_url")).alias("psa_url"),
    )


def price_point_counts(session: DataFrame) -> DataFrame:
    """Per card and grade: weeks with a price and sales; beside them the sales of the card."""
    per_week = session.groupBy("card_name", "psa_level", "week_start").agg(F.count("*").alias("n"))
    per_grade = per_week.groupBy("card_name", "psa_level").agg(
        F.count("*").alias("weeks_with_prices"), F.sum("n").alias("psa_price_point_count")
    )
    # One row per grade of a card reaches the window.
    return per_grade.withColumn(
        "card_price_point_count", F.sum("psa_price_point_count").over(Window.partitionBy("card_name"))
    )


def top_cards(weeks: DataFrame, limit: int = 10, rank: str = "first_grade") -> DataFrame:
    """Cards by lifecycle sales, with their order from 0.

    ``first_grade`` takes the total of the card's first grade in text order; ``sum`` adds all grades.
    """
    if rank == "first_grade":
        totals = weeks.groupBy("card_name").agg(
            F.min_by("total_sales_count", F.struct("psa_level", "week_start")).alias("total_sales_count")
        )
    else:
        totals = weeks.groupBy("card_name", "psa_level").agg(F.max("total_sales_count").alias("t")) \
            .groupBy("card_name").agg(F.sum("t").alias("total_sales_count"))
    best = totals.orderBy(F.desc("total_sales_count"), "card_name").limit(limit)
    # The window sees at most `limit` rows.
    order = Window.orderBy(F.desc("total_sales_count"), "card_name")
    return best.withColumn("card_order", F.row_number().over(order) - 1)


def ranked_cards(auctions: DataFrame, day: dt.date, since: dt.date = SINCE, limit: int = 10,
                 rank: str = "first_grade", partition: str | None = None) -> DataFrame:
    """The cards that ``top_cards`` finds in the weekly report, without that report.

    Which cards and grades have sales doesn't depend on repeats, so the ranking needs neither their removal nor weeks.
    """
    pairs = sales(auctions, day, since, partition).select("card_name", "psa_level").distinct()
    totals = summaries(auctions, day, partition).select("card_name", "psa_level", "total_sales_count")
    known = pairs.join(totals, ["card_name", "psa_level"], "left").select(
        "card_name", "psa_level", F.coalesce("total_sales_count", F.lit(0)).alias("total_sales_count"),
        F.lit(None).cast("date").alias("week_start"))
    return top_cards(known, limit, rank)


def psa_numeric(grade="psa_level"):
    """Grade as a number for ordering; 0 when it is none."""
    return F.coalesce(F.col(grade).try_cast("double"), F.lit(0.0))


def top_cards_report(auctions: DataFrame, day: dt.date, since: dt.date = SINCE, limit: int = 10,
                     rank: str = "first_grade", partition: str | None = None) -> DataFrame:
    """The weekly report of the top cards: cards are ranked first, and only their sales are freed of repeats."""
    best = ranked_cards(auctions, day, since, limit, rank, partition)
    weeks = weekly(auctions, day, since, partition, cards=F.broadcast(best))  # at most `limit` rows
    return top_cards_weekly(weeks, limit, rank, best)


def top_cards_weekly(weeks: DataFrame, limit: int = 10, rank: str = "first_grade",
                     best: DataFrame | None = None) -> DataFrame:
    """Weekly prices of the top cards with price points, lifecycle sales and url, one row per week.

    ``best`` gives the cards, if they are ranked already.
    """
    best = (top_cards(weeks, limit, rank) if best is None else best).withColumnRenamed("total_sales_count", "lifecycle_sales")
    # At most `limit` cards are broadcast, and a window sees the weeks of one card and grade.
    chosen = weeks.join(F.broadcast(best), "card_name")
    one = Window.partitionBy("card_name", "psa_level")
    url = F.min_by("psa_url", F.when(F.col("psa_url").isNotNull(), F.col("week_start"))).over(one)
    return chosen.select(
        "card_order", "card_name", "psa_level", psa_numeric().alias("psa_numeric"),
        F.count("avg_price").over(one).alias("price_points"),
        "lifecycle_sales", F.coalesce(url, F.lit("")).alias("psa_url"), "week_start", "avg_price",
    ).orderBy("card_order", F.desc("psa_numeric"), "psa_level", "week_start")


def top_cards_pivot(long: DataFrame, weeks: list[dt.date]) -> DataFrame:
    """The top-card report with one column per week; empty weeks stay NULL."""
    wide = pivot_weeks(long, ["card_order", "psa_numeric", "psa_level", "card_name", "price_points",
                              "lifecycle_sales", "psa_url"], "week_start", "avg_price", weeks, aggregate=F.avg)
    return wide.orderBy("card_order", F.desc("psa_numeric")).drop("card_order", "psa_numeric")


def single_grade(report: DataFrame, grade: str = "9") -> DataFrame:
    """The part of a report about one grade."""
    return report.filter(F.col("psa_level") == grade).drop("psa_level")


def top_latest_week(long: DataFrame, limit: int = 10) -> DataFrame:
    """Card and grade pairs with the highest price in the newest week of the report."""
    newest = long.agg(F.max("week_start")).scalar()
    pair = F.concat(F.lit("PSA "), F.col("psa_level"), F.lit(" - "), F.col("card_name"))
    return long.filter((F.col("week_start") == newest) & F.col("avg_price").isNotNull()).select(
        pair.alias("combo"), "week_start", "avg_price"
    ).orderBy(F.desc("avg_price"), "combo").limit(limit)


def nested_report(long: DataFrame) -> DataFrame:
    """One row per top card holding its grades, best first, each with its weeks in order.

    Lists are bounded by the number of grades and of calendar weeks.
    """
    per_grade = long.groupBy("card_order", "card_name", "lifecycle_sales", "psa_numeric", "psa_level",
                             "price_points", "psa_url").agg(
        F.array_sort(F.collect_list(F.struct("week_start", "avg_price"))).alias("weeks")
    )
    return per_grade.groupBy("card_order", "card_name", "lifecycle_sales").agg(
        F.sort_array(F.collect_list(
            F.struct("psa_numeric", "psa_level", "price_points", "psa_url", "weeks")
        ), asc=False).alias("grades")
    ).orderBy("card_order")


def snapshot_profile(session: DataFrame) -> DataFrame:
    """Scope of a session: cards, grades seen, price, sale-date and scrape-time ranges (one row)."""
    per_combo = session.groupBy("card_name", "psa_level").agg(
        F.min("auction_price").alias("p0"), F.max("auction_price").alias("p1"),
        F.min("auction_date").alias("d0"), F.max("auction_date").alias("d1"),
        F.min("scraped_at").alias("s0"), F.max("scraped_at").alias("s1"),
    )
    return per_combo.agg(
        F.countDistinct("card_name").alias("unique_cards"),
        F.array_sort(F.collect_set("psa_level")).alias("psa_levels"),
        F.min("p0").alias("min_price"), F.max("p1").alias("max_price"),
        F.min("d0").alias("first_sale"), F.max("d1").alias("last_sale"),
        F.min("s0").alias("first_scrape"), F.max("s1").alias("last_scrape"),
    )


def weekly_averages(weeks: DataFrame) -> DataFrame:
    """Card and grade pairs, weeks covered and mean sales per row of the weekly report (one row)."""
    return weeks.agg(
        F.countDistinct("card_name", "psa_level").alias("combos"),
        F.countDistinct("week_start").alias("weeks"),
        F.avg("transaction_count").alias("avg_transactions"),
    )


def coverage_gaps(cards: DataFrame, seen: DataFrame, grades: list[str] | None = None) -> DataFrame:
    """Card and grade pairs that have not been seen: the remaining work list.

    The grade list is a literal of fixed length, so every card simply unfolds into its grades.
    """
    wanted = cards.select("item_id", F.explode(F.array(*map(F.lit, grades or GRADES))).alias("grade"))
    return wanted.join(seen.select("item_id", "grade").distinct(), ["item_id", "grade"], "left_anti")


def available_dates(auctions: DataFrame, limit: int = 10) -> DataFrame:
    """Newest scrape days with their rows and cards."""
    per_card = auctions.filter("scraped_at IS NOT NULL").groupBy(
        F.col("scraped_at").cast("date").alias("scrape_date"), "card_name"
    ).agg(F.count("*").alias("n"))
    return per_card.groupBy("scrape_date").agg(
        F.sum("n").alias("record_count"), F.count("card_name").alias("unique_cards")
    ).orderBy(F.desc("scrape_date")).limit(limit)


def latest_snapshot(auctions: DataFrame) -> DataFrame:
    """The newest scrape day (one row)."""
    return auctions.agg(F.max("scraped_at").cast("date").alias("latest_date"))


