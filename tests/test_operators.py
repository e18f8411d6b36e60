from __future__ import annotations

import datetime as dt
import uuid

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tallymint.operators import (
    auctions, audit, catalog, dedup, filters, joins, mentions, profile, series, tables, weekly,
)
from tallymint.schemas import AUCTION

D, T = dt.date, dt.datetime
DAY = D(2025, 1, 10)
SALE = "card_name string, psa_level string, auction_date date, auction_price double, scraped_at timestamp_ntz, psa_url string"


def tuples(df):
    return [tuple(r) for r in df.collect()]


# --- de-duplication ----------------------------------------------------------------------------

def test_keep_newest_and_earliest(rows):
    df = rows([("a", None, T(2025, 1, 1), 1), ("a", None, T(2025, 1, 2), 2), ("a", "x", T(2025, 1, 1), 3),
               ("a", None, T(2025, 1, 2), 9)], "k string, n string, at timestamp_ntz, v int")
    newest = dedup.keep_one(df, ["k", "n"], "at")
    assert sorted(r.v for r in newest.collect()) == [2, 3]
    earliest = dedup.keep_one(df, ["k", "n"], "at", keep="earliest")
    assert sorted(r.v for r in earliest.collect()) == [1, 3]
    assert tuples(dedup.keep_one(newest, ["k", "n"], "at").orderBy("v")) == tuples(newest.orderBy("v"))


def test_ranking_happens_before_the_shuffle(rows):
    df = rows([("a", 1, 2)], "k string, at int, v int")
    plan = dedup.keep_one(df, ["k"], "at")._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange hashpartitioning", 1)
    assert "Final" in above and "WindowGroupLimit" in below and "Partial" in below


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 3), st.integers(0, 5)), min_size=1, max_size=12))
def test_dedup_matches_a_plain_loop(spark, data):
    df = spark.createDataFrame(data, "k int, at int, v int")
    best = {}
    for k, at, v in data:
        if k not in best or (-at, v) < best[k]:
            best[k] = (-at, v)
    got = {r.k: (-r["at"], r.v) for r in dedup.keep_one(df, ["k"], "at").collect()}
    assert got == best
    rate = dedup.duplication_rate(df, ["k"]).first()
    assert (rate.total_records, rate.unique_records) == (len(data), len(best))


def test_duplicate_reports(rows):
    one = ("c", "10", D(2025, 1, 1), 5.0)
    df = rows([(*one, T(2025, 1, 10, 8), "u"), (*one, T(2025, 1, 10, 8, 30), "w"), (*one, T(2025, 1, 11, 8), None),
               ("c", "9", D(2025, 1, 1), 7.0, T(2025, 1, 10, 8), None)], SALE)
    group = dedup.duplicate_groups(df, dedup.SESSION_KEYS, F.col("scraped_at").cast("date")).first()
    assert (group.duplicate_count, group.scrape_dates) == (3, [D(2025, 1, 10), D(2025, 1, 11)])
    example = dedup.duplicate_examples(df, dedup.SESSION_KEYS, "scraped_at", "psa_url").first()
    assert (example.duplicate_count, example.unique_urls, example.minutes_between) == (3, 2, 1440.0)
    impact = dedup.duplicate_impact(df, dedup.SESSION_KEYS, "card_name", "psa_level", "auction_price").first()
    assert (impact.rows_before, impact.rows_after, impact.duplicate_groups, impact.rows_in_groups, impact.combos,
            impact.min_price, impact.max_price) == (4, 2, 1, 3, 2, 5.0, 7.0)


def test_duplicate_groups_with_null_keys(rows):
    df = rows([("a", None, 1), ("a", None, 1)], "k string, n string, d int")
    assert dedup.duplicate_groups(df, ["k", "n"], F.col("d")).first().scrape_dates == [1]


# --- weekly reports ----------------------------------------------------------------------------

PRICES = "product_id string, condition string, bucket_start_date date, market_price double, quantity_sold bigint, scrape_date date"
CATALOG = ("product_id string, product_name string, product_clean_name string, category_id bigint, category_name string, "
           "group_id bigint, group_name string, update_date date")


@pytest.fixture
def prices(rows):
    return rows([
        ("1", "NM", D(2025, 1, 6), 2.0, 4, DAY), ("1", "NM", D(2025, 1, 12), 4.0, 1, DAY),
        ("1", "NM", D(2025, 1, 13), 10.0, 0, DAY), ("2", "NM", D(2025, 1, 6), 6.0, None, DAY),
        ("2", "", D(2025, 1, 6), 6.0, 1, DAY), ("2", None, D(2025, 1, 6), 6.0, 1, DAY),
        ("3", "NM", D(2025, 1, 6), 0.0, 5, DAY), ("1", "NM", D(2023, 1, 2), 50.0, 50, DAY),
        ("1", "NM", D(2025, 1, 6), 99.0, 9, D(2025, 1, 9)), ("9", "NM", D(2025, 1, 6), 7.0, 2, DAY),
    ], PRICES)


@pytest.fixture
def listing(rows):
    return rows([
        ("1", "Old", "old", 3, "c", 1, "g", D(2025, 1, 1)), ("1", "New", "new", 3, "c", 1, "g", D(2025, 1, 8)),
        ("2", "Two", "two", 85, "d", 2, "h", D(2025, 1, 1)), ("3", "Three", None, 3, "c", 1, "g", D(2025, 1, 1)),
    ], CATALOG)


def test_weekly_price_counts_a_product_once(prices, listing):
    got = weekly.weekly_asp_simple(prices, listing, [3, 85], DAY).orderBy("week_start")
    assert tuples(got) == [("NM", D(2025, 1, 6), 4.0), ("NM", D(2025, 1, 13), 10.0)]
    raw = weekly.weekly_asp_simple(prices, listing, [3, 85], DAY, raw_catalog=True).orderBy("week_start")
    assert raw.first().simple_asp == (2.0 * 2 + 4.0 * 2 + 6.0) / 5


def jobs(spark, build):
    """How many jobs run while ``build`` makes a DataFrame."""
    group = str(uuid.uuid4())
    spark.sparkContext.setJobGroup(group, group)
    try:
        build()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_weekly_reports_run_no_job_before_they_are_asked(spark, prices, listing):
    assert jobs(spark, lambda: prices.count()) > 0
    for report in (weekly.weekly_asp_simple, weekly.weekly_volume, weekly.weekly_unique, weekly.unique_sketches):
        assert jobs(spark, lambda: report(prices, listing, [3, 85], DAY)) == 0


def test_reports_come_in_order(prices, listing):
    asp = tuples(weekly.weekly_asp_simple(prices, listing, [3, 85], DAY))
    assert asp == sorted(asp)
    life = [r.lifecycle_quantity_sold for r in weekly.product_lifetime(prices, listing, None, DAY, D(2024, 1, 1)).collect()]
    assert life == sorted(life, reverse=True)


def test_stored_sketches(spark, prices, listing, tmp_path):
    path = str(tmp_path / "sketches")
    for day in (DAY, D(2025, 1, 9)):
        weekly.unique_sketches(prices, listing, [3, 85], day).write.mode("append").parquet(path)
    stored = weekly.weekly_unique_stored(spark.read.parquet(path), "m")
    assert tuples(stored) == tuples(weekly.weekly_unique(prices, listing, [3, 85], None, metric="m"))


def test_list_ranks(spark):
    listing = spark.range(5000).select((F.col("id") * F.col("id")).alias("pos"), F.col("id").cast("string").alias("product_id"))
    got = weekly.list_ranks(listing).collect()
    assert len(got) == 5000 and all(int(r.product_id) + 1 == r["rank"] for r in got)
    assert weekly.list_ranks(listing.limit(0)).count() == 0


def test_volume_and_unique(prices, listing):
    assert sorted(tuples(weekly.weekly_volume(prices, listing, [3, 85], DAY))) == [
        ("NM", D(2025, 1, 6), 10), ("NM", D(2025, 1, 13), 0)]
    assert tuples(weekly.weekly_unique(prices, listing, [3, 85], DAY, metric="m")) == [("m", D(2025, 1, 6), 3)]


def test_weighted_price(prices, listing, rows):
    got = {(r.product_id, r.week_start): r for r in weekly.weekly_asp_weighted(prices, listing, None, DAY).collect()}
    first = got["1", D(2025, 1, 6)]
    assert (first.weighted_asp, first.total_volume, first.product_name) == (12.0 / 5, 5, "new")
    assert got["1", D(2025, 1, 13)].weighted_asp == 0.0
    assert got["9", D(2025, 1, 6)].product_name is None and ("3", D(2025, 1, 6)) not in got
    only = weekly.weekly_asp_weighted(prices, listing, rows([("9",)], "product_id string"), DAY)
    assert {r.product_id for r in only.collect()} == {"9"}
    raw = weekly.weekly_asp_weighted(prices, listing, None, DAY, raw_catalog=True).filter("product_id = '1'")
    assert {r.total_volume for r in raw.collect()} == {10, 0}


def test_product_pivot_drops_unnamed_and_fills_zero(prices, listing):
    long = weekly.weekly_asp_weighted(prices, listing, None, DAY)
    weeks = [D(2025, 1, 6), D(2025, 1, 13), D(2025, 1, 20)]
    wide = weekly.pivot_product_week(long, "weighted_asp", weeks, price=True).orderBy("product_id").collect()
    assert [r.product_id for r in wide] == ["1", "2"]
    assert (wide[0]["2025-01-06"], wide[0]["2025-01-13"], wide[0]["2025-01-20"]) == (2.4, 0.0, 0.0)


def test_condition_pivot_keeps_missing_prices_null(prices, listing):
    weeks = [D(2025, 1, 6), D(2025, 1, 20)]
    asp = weekly.pivot_condition_week(weekly.weekly_asp_simple(prices, listing, [3], DAY), "simple_asp", weeks, price=True)
    assert tuples(asp) == [("NM", 3.0, None)]
    volume = weekly.weekly_volume(prices, listing, [3], DAY)
    wide = weekly.pivot_condition_week(volume, "trading_volume", weeks, price=False)
    assert tuples(wide) == [("NM", 10, 0)]


def test_lifetime_in_list_order(prices, listing, rows):
    ids = rows([(0, "2"), (1, "7"), (2, "1")], "pos int, product_id string")
    life = weekly.product_lifetime(prices, listing, ids, DAY)
    got = weekly.custom_order(life, ids).orderBy("rank").collect()
    assert [(r["rank"], r.product_id, r.product) for r in got] == [(1, "2", "Two (2)"), (2, "1", "New (1)")]
    assert got[1].lifecycle_quantity_sold == 5 and got[1].lifecycle_asp == 12.0 / 5


def test_weeks_add_up_and_pivots_turn_back(spark, prices, listing):
    volume = weekly.weekly_volume(prices, listing, [3, 85], DAY)
    kept = prices.filter((F.col("scrape_date") == F.lit(DAY)) & filters.filled("condition")
                         & (F.col("bucket_start_date") >= "2024-01-01") & F.col("product_id").isin("1", "2", "3"))
    assert volume.agg(F.sum("trading_volume")).first()[0] == kept.agg(F.sum("quantity_sold")).first()[0]
    weeks = [D(2025, 1, 6), D(2025, 1, 13)]
    wide = weekly.pivot_condition_week(volume, "trading_volume", weeks, price=False)
    back = wide.unpivot("condition", [w.isoformat() for w in weeks], "week_start", "trading_volume")
    assert sorted((r.condition, r.week_start, r.trading_volume) for r in back.collect()) == sorted(
        (r.condition, r.week_start.isoformat(), r.trading_volume) for r in volume.collect())


def test_spine(rows):
    a, b = rows([(1, 5)], "w int, n int"), rows([(2, 1), (1, 1)], "w int, n int")
    spine = weekly.spine_union(a, b, key="w")
    assert sorted(tuples(weekly.spine_fill(a, spine, ["w"], ["n"]))) == [(1, 5), (2, 0)]


# --- catalog -----------------------------------------------------------------------------------

def test_catalog_denormalised(rows):
    c = rows([(3, "Cats", True)], "categoryId int, name string, hot boolean")
    g = rows([(7, "Set", 3), (8, "Lost", 4)], "groupId int, name string, categoryId int")
    p = rows([(1, "P", 7, [("k", "v")]), (2, "Q", 8, None)],
             "productId int, name string, groupId int, extendedData array<struct<name:string,value:string>>")
    got = catalog.denormalise(c, g, p, F.lit(DAY)).collect()
    assert len(got) == 1 and got[0].category_hot == "true" and got[0].update_date == DAY
    assert got[0].product_extendedData == '[{"name":"k","value":"v"}]' and got[0].group_name == "Set"


def test_catalog_listings(listing):
    assert tuples(catalog.top_categories(listing, 1)) == [("c", 3)]
    assert tuples(catalog.recent_activity(listing, 3, D(2025, 1, 9))) == [(D(2025, 1, 8), 1, 1, 1, 1)]
    assert catalog.latest_catalog(listing, ["product_name"]).filter("product_id = '1'").first().product_name == "New"
    assert [r.total_rows for r in catalog.sample_with_total(listing, ["product_id", "update_date"], 2).collect()] == [4, 4]


# --- auctions ----------------------------------------------------------------------------------

def auction_rows(rows, data):
    columns = "record_type, card_name, grade, sale_date, sale_price, scraped_at, psa_url, total_sales_count, item_id".split(", ")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for c in columns for f in AUCTION.fields if f.name == c)
    return tables.conform(rows(data, schema), AUCTION)


@pytest.fixture
def auction_data(rows):
    at = T(2025, 1, 10, 8)
    late = T(2025, 1, 10, 9)
    return auction_rows(rows, [
        ("sale", "A", "10", "1/6/2025", 100.0, at, None, None, "1"), ("sale", "A", "10", "01/06/2025", 100.0, late, "s", None, "1"),
        ("sale", "A", "10", "1/7/2025", 100.01, at, None, None, "1"), ("sale", "A", "8.5", "1/7/2025", 50.0, at, None, None, "1"),
        ("sale", "B", "9", "1/7/2025", 70.0, at, "b", None, "2"), ("sale", "B", "9", "1/7/2010", 1.0, at, None, None, "2"),
        ("sale", "", "9", "1/7/2025", 1.0, at, None, None, "3"), ("sale", "C", None, "1/7/2025", 1.0, at, None, None, "3"),
        ("sale", "C", "9", "bad", 1.0, at, None, None, "3"), ("sale", "C", "9", "1/7/2025", 0.0, at, None, None, "3"),
        ("sale", "B", "9", "1/8/2025", 80.0, T(2025, 1, 11), None, None, "2"),
        ("summary", "A", "10", None, None, at, "u", 5, "1"), ("summary", "A", "10", None, None, late, "u", 7, "1"),
        ("summary", "A", "8.5", None, None, at, None, 20, "1"),
    ])


def test_sales_with_summary_takes_the_newest_summary_once(auction_data):
    got = auctions.sales_with_summary(auction_data, DAY).collect()
    assert len(got) == 5
    assert {(r.card_name, r.psa_level): r.total_sales_count for r in got} == {("A", "10"): 7, ("A", "8.5"): 20, ("B", "9"): 0}
    assert {r.psa_url for r in got if r.psa_level == "10"} == {"u", "s"}


def test_weekly_auctions(auction_data):
    got = {(r.card_name, r.psa_level): r for r in auctions.weekly(auction_data, DAY).collect()}
    a = got["A", "10"]
    # The mean of 100.00 and 100.01 is a tie, rounded up.
    assert (a.week_start, a.avg_price, a.transaction_count, a.total_sales_count, a.psa_url) == (D(2025, 1, 6), 100.01, 2, 7, "u")
    assert got["B", "9"].psa_url == "b" and got["A", "8.5"].psa_url is None


def test_top_cards_rank(auction_data):
    weeks = auctions.weekly(auction_data, DAY)
    # '10' comes before '8.5' in text order, so its total ranks the card.
    assert tuples(auctions.top_cards(weeks)) == [("A", 7, 0), ("B", 0, 1)]
    assert tuples(auctions.top_cards(weeks, rank="sum")) == [("A", 27, 0), ("B", 0, 1)]
    long = auctions.top_cards_weekly(weeks)
    for rank in ("first_grade", "sum"):
        assert tuples(auctions.ranked_cards(auction_data, DAY, rank=rank)) == tuples(auctions.top_cards(weeks, rank=rank))
        assert tuples(auctions.top_cards_report(auction_data, DAY, rank=rank)) == tuples(auctions.top_cards_weekly(weeks, rank=rank))
    assert tuples(auctions.top_cards_report(auction_data, DAY, limit=1)) == [t for t in tuples(long) if t[0] == 0]
    # Repeats of sales are looked for once, among the sales of the chosen cards.
    plan = auctions.top_cards_report(auction_data, DAY)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "row_number()" in line and "auction_price" in line and "WindowGroupLimit" not in line]
    assert len(windows) == 1
    assert [(r.card_name, r.psa_level, r.price_points, r.psa_url) for r in long.collect()] == [
        ("A", "10", 1, "u"), ("A", "8.5", 1, ""), ("B", "9", 1, "b")]
    assert [r.combo for r in auctions.top_latest_week(long, 2).collect()] == ["PSA 10 - A", "PSA 9 - B"]
    assert "psa_level" not in auctions.single_grade(long, "9").columns
    nested = auctions.nested_report(long).collect()
    assert [[g.psa_level for g in r.grades] for r in nested] == [["10", "8.5"], ["9"]]
    wide = auctions.top_cards_pivot(long, [D(2025, 1, 6), D(2025, 1, 13)]).collect()
    assert [(r.card_name, r["2025-01-06"], r["2025-01-13"]) for r in wide] == [("A", 100.01, None), ("A", 50.0, None), ("B", 70.0, None)]


def test_auction_profiles(auction_data):
    assert auctions.latest_snapshot(auction_data).first().latest_date == D(2025, 1, 11)
    day = profile.daily_profile(auction_data).collect()
    assert [(r.scrape_date, r.record_count, r.unique_card_grades) for r in day] == [(D(2025, 1, 11), 1, 1), (DAY, 13, 4)]
    assert profile.period_check(auction_data, DAY, DAY).first().unique_items == 3
    assert profile.period_check(auction_data, D(2020, 1, 1), D(2020, 1, 2)).first().record_count == 0
    assert profile.point_history(auction_data, "2", "9").first().dates == [DAY, D(2025, 1, 11)]
    counts = profile.record_type_counts(auction_data).first()
    assert (counts.summary_records, counts.sale_records) == (3, 11)


def test_coverage(rows):
    cards, seen = rows([("1",)], "item_id string"), rows([("1", "10"), ("1", "10")], "item_id string, grade string")
    assert tuples(auctions.coverage_gaps(cards, seen, ["10", "9"])) == [("1", "9")]
    assert auctions.coverage_gaps(cards, seen).count() == 18


# --- mentions ----------------------------------------------------------------------------------

def test_mentions(rows):
    subs = rows([
        ("1", "x", T(2024, 1, 1), "POKÉMON CARDS on eBay", None, "r", 0, 1),
        ("2", "x", T(2024, 1, 2), "ebay find", "a trading card", "r", 0, 1),
        ("3", "[deleted]", T(2024, 1, 9), "nothing", "[deleted]", "r", 0, 1),
        ("4", "x", T(2009, 1, 1), "ebay", None, "r", 0, 1),
    ], "id string, author string, created_utc timestamp_ntz, title string, selftext string, "
       "subreddit_name_prefixed string, num_comments bigint, score bigint")
    comments = rows([("5", "y", T(2024, 1, 1), "pokemon card", 1, "p", "l", "r"), ("6", "y", T(2024, 1, 9), None, 1, "p", "l", "r")],
                    "id string, author string, created_utc timestamp_ntz, body string, score bigint, "
                    "parent_id string, link_id string, subreddit_name_prefixed string")
    got = tuples(mentions.mention_counts(mentions.posts(subs, comments)))
    assert got == [(D(2024, 1, 1), 2, 1, 3, 2, 1, 1, 2, 3), (D(2024, 1, 8), 0, 0, 0, 0, 0, 0, 0, 2)]
    union = {r.id: r.content for r in mentions.content_union(subs, comments).collect()}
    assert union == {"1": "POKÉMON CARDS on eBay | ", "2": "ebay find | a trading card", "4": "ebay | ", "5": "pokemon card"}
    assert [r.id for r in mentions.cross_field_match(subs, "ebay", "card").orderBy("id").collect()] == ["1", "2"]
    wanted = mentions.content_union(*mentions.market_and_cards(subs, comments))
    assert sorted(r.id for r in wanted.collect()) == ["1", "2"]
    named = mentions.content_union(*mentions.mentioning(subs, comments, "ebay"))
    sample = [r.id for r in mentions.sample(named, 2, seed=3).collect()]
    assert len(sample) == 2 and sample == [r.id for r in mentions.sample(named, 2, seed=3).collect()]
    assert mentions.sample(named, 100, seed=None).count() == 3


# --- series ------------------------------------------------------------------------------------

@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(-3, 3)), min_size=1, max_size=30))
def test_exact_median(spark, data):
    from statistics import median

    df = spark.createDataFrame([(k, float(v)) for k, v in data], "k string, v double")
    got = {r.k: r["median"] for r in series.exact_median(df, "k", "v", pieces=4, bound=2).collect()}
    assert got == {k: median(float(v) for kk, v in data if kk == k) for k in {k for k, _ in data}}


def test_median_of_a_large_skewed_group(spark):
    df = spark.range(100_001).select(F.lit("k").alias("k"), (F.col("id") * F.col("id")).cast("double").alias("v"))
    assert series.exact_median(df, "k", "v", pieces=16).first()["median"] == float(50_000 ** 2)
    # No range over the bound is left to be ordered, beside a key that is small from the start.
    both = df.unionByName(spark.createDataFrame([("s", float(v)) for v in (1, 5, 5, 9)], "k string, v double"))
    counted = series.count_values(both, "k", "v")
    ranges = {r.k: r for r in series.middle_range(counted, "k", "v", pieces=16, rounds=3, bound=100).collect()}
    assert ranges["k"].held <= 100 and ranges["s"].held == 3 and ranges["k"].total == 100_001
    medians = series.exact_median(both, "k", "v", pieces=16, rounds=3, bound=100).collect()
    assert {r.k: r["median"] for r in medians} == {"k": float(50_000 ** 2), "s": 5.0}


def test_histogram(rows):
    data = [("new", float(v)) for v in range(21)] + [("used", 5.0), ("used", 5.0)]
    got = series.price_histogram(rows(data, "price_type string, price double"), ["new", "used"])
    new = {r.bin: r.n for r in got.filter("price_type = 'new'").collect()}
    assert len(new) == 20 and new[1] == 1 and new[20] == 2 and sum(new.values()) == 21
    used = {r.bin: r.n for r in got.filter("price_type = 'used'").collect() if r.n}
    assert used == {11: 2}


def test_alignment_and_summary(rows):
    at, later = T(2025, 1, 1), T(2025, 1, 2)
    points = rows([("p", "new", 0, at, 1.0), ("p", "new", 2, at, 9.0), ("p", "used", 0, at, 2.0), ("p", "new", 4, later, 3.0)],
                  "asin string, price_type string, pos int, ts timestamp_ntz, price double")
    wide = series.align_series(points, ["asin"], ["new", "used"], ["pos"]).orderBy("ts")
    assert tuples(wide) == [("p", at, 1.0, 2.0), ("p", later, 3.0, None)]
    one = series.series_summary(points.filter("price_type = 'new'"), ["asin"], ["pos"]).first()
    assert (one.points, one.first_price, one.last_price, one.last_ts) == (3, 1.0, 3.0, later)
    assert filters.last_days_of_data(points, "ts", 0).count() == 1


# --- audit -------------------------------------------------------------------------------------

FAILURES = "date date, failure_type string, error_message string"


def test_failures_of_four_kinds(rows):
    df = rows([(D(2023, 5, 9), "download", "Read timeout after 30 s"), (D(2023, 5, 11), "extract", "could not extract member 7"),
               (D(2023, 5, 12), "download", "prices.zip: Not Found"), (D(2023, 6, 2), "upload", "GCP refused the job")], FAILURES)
    keys = [r[0] for r in df.select(audit.error_key(F.col("error_message"))).collect()]
    assert keys == ["connection_error", "extraction_error", "file_not_found", "bigquery_error"]
    got = audit.failures_by_type(df).collect()
    assert [(r.pattern_type, r.frequency, r.severity, r.common_error) for r in got] == [
        ("download_failures", 2, "low", "Read timeout after 30 s")]
    assert audit.failure_clusters(df).count() == 0 and audit.error_patterns(df).count() == 0
    report = audit.recovery_report(df).first()
    assert (report.total_failures, report.failed_dates) == (4, 4) and report.recommendation.endswith("Increase timeout values.")
    assert [r.date for r in audit.failed_dates(df).collect()][0] == D(2023, 5, 9)


def test_clusters_and_other_messages(rows):
    days = [D(2024, 12, d) for d in (1, 2)]
    df = rows([(d, "process", "Odd   thing happened here") for d in days for _ in range(3)], FAILURES)
    assert tuples(audit.failure_clusters(df)) == [("temporal_clustering", 2, 2, "medium")]
    assert tuples(audit.error_patterns(df)) == [("odd_thing_happened", 6, 2, "medium")]
    assert [r.severity for r in audit.recovery_report(df).collect()] == ["medium"] * 3


def test_runs(rows):
    df = rows([(D(2024, 12, 1), "failed", 0, 1.0, T(2024, 12, 1, 1)), (D(2024, 12, 1), "completed", 10, 2.0, T(2024, 12, 1, 2)),
               (D(2024, 12, 2), "completed", 30, 2.0, T(2024, 12, 2, 1)), (D(2024, 12, 2), "failed", 0, 0.0, T(2024, 12, 2, 2))],
              "date date, status string, record_count bigint, processing_time double, event_time timestamp_ntz")
    status = audit.run_status(df)
    assert {r.date: r.status for r in status.collect()} == {D(2024, 12, 1): "completed", D(2024, 12, 2): "failed"}
    report = audit.run_report(status).first()
    assert (report.success_rate, report.total_records, report.records_per_second, report.dates_per_hour) == (50.0, 40, 10.0, 1800.0)


def test_date_spine(rows):
    bounds = rows([(D(2024, 12, 1), D(2024, 12, 3))], "a date, b date")
    assert audit.date_spine(bounds, F.col("a"), F.col("b")).count() == 3
    days = audit.date_spine(bounds, F.col("a"), F.col("b"), skip_weekends=True)
    assert sorted(r.date for r in days.collect()) == [D(2024, 12, 2), D(2024, 12, 3)]
    done = rows([(D(2024, 12, 2), "completed"), (D(2024, 12, 3), "failed")], "date date, status string")
    assert [r.date for r in audit.missing_dates(days, done).collect()] == [D(2024, 12, 3)]


def test_validation(rows):
    df = rows([(DAY, 1, None, 5.0, 1, 1), (DAY, 1, "x", 0.001, 1, 1)],
              "price_date date, product_id bigint, sub_type_name string, market_price double, category_id bigint, group_id bigint")
    got = audit.validate_batch(df).first()
    assert got.issues == ["Low record count: 2", "Missing sub_type_name: 1", "Price out of range: 1"] and not got.validation_passed
    assert audit.validate_batch(df.filter("market_price = 5").fillna("x"), least=1).first().validation_passed


def test_groups_and_retries(rows):
    events = rows([("1", "a", "failed", 0, 1), ("1", "a", "completed", 5, 2), ("1", "b", "failed", 0, 1), ("2", "c", "completed", 3, 1)],
                  "category_id string, group_id string, status string, record_count bigint, event_time int")
    got = {r.category_id: (r.completed_groups, r.failed_groups, r.products, r.status)
           for r in audit.category_status(audit.group_status(events)).collect()}
    assert got == {"1": (1, 1, 5, "partial"), "2": (1, 0, 3, "completed")}
    failed = rows([("1:b",), ("8:x",), ("odd",)], "group_key string")
    names = rows([("1", "One")], "category_id string, name string")
    groups = rows([("1", "b", "Bee"), ("1", "a", "Ay")], "category_id string, group_id string, group_name string")
    assert [r.group_name for r in audit.retry_list(failed, names, groups).collect()] == ["Bee"]


def test_endpoint_health(rows):
    log = [("a", "success", 1.0, 1), ("a", "failed", 9.0, 2), ("a", "rate_limited", 9.0, 3), ("a", "failed", 9.0, 4),
           ("b", "failed", 9.0, 1), ("b", "success", 3.0, 2), ("c", "failed", 1.0, 1)]
    got = {r.endpoint: r for r in audit.endpoint_health(
        rows(log, "endpoint string, status string, response_time double, event_time int")).collect()}
    assert (got["a"].consecutive_failures, got["a"].is_healthy, got["a"].success_rate, got["a"].avg_response_time) == (3, False, 25.0, 1.0)
    assert (got["b"].consecutive_failures, got["b"].is_healthy) == (0, True)
    assert (got["c"].consecutive_failures, got["c"].avg_response_time) == (1, 0.0)


def test_endpoint_health_over_many_hours(spark):
    import random

    rng = random.Random(8)
    log = [(rng.choice("abc"), rng.choice(["success", "failed", "rate_limited", "failed"]), 1.0, rng.randrange(90_000), i)
           for i in range(400)] + [("d", "failed", 1.0, t, t) for t in range(0, 40_000, 900)]
    log += [("e", "success", 1.0, 3600, 1), ("e", "failed", 1.0, 3599, 9), ("e", "failed", 1.0, 3600, 2), ("e", "failed", 1.0, 9999, 3)]
    df = spark.createDataFrame(log, "endpoint string, status string, response_time double, event_time int, event_id int")
    health = audit.endpoint_health(df, order=("event_time", "event_id"))
    expected = {}
    for name in "abcde":
        mine = sorted((t, i, s) for e, s, _, t, i in log if e == name)
        expected[name] = next((k for k, m in enumerate(reversed(mine)) if m[2] == "success"), len(mine))
    assert {r.endpoint: r.consecutive_failures for r in health.collect()} == expected
    assert health._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


# --- filters -----------------------------------------------------------------------------------

def test_snapshot_prunes_folders(rows, spark, tmp_path):
    df = rows([(T(2025, 1, 10, 0), DAY), (T(2025, 1, 10, 23), DAY), (T(2025, 1, 11), D(2025, 1, 11))],
              "scraped_at timestamp_ntz, scrape_date date")
    tables.replace(df, str(tmp_path / "t"), "scrape_date")
    day = filters.snapshot_day(spark.read.parquet(str(tmp_path / "t")), DAY, partition="scrape_date")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert day.count() == 2 and "PartitionFilters: [isnotnull(scrape_date" in plan


def test_lists_and_nulls(rows):
    df = rows([(1, "a"), (2, None), (None, "b")], "n int, s string")
    assert filters.only(df, "n", [1, 5]).count() == 1
    assert filters.exclude(df, "n", [1]).count() == 1
    hit = filters.in_both([F.col("s"), F.lit("z")], lambda c: c == "a", lambda c: c == "z")
    assert df.filter(hit).count() == 1
