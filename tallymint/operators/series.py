"""Price series: alignment, summaries, distributions, and search-trend grids."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.money import MONEY
from ..schemas import PRICE_SERIES


def align_series(points: DataFrame, keys: list[str], kinds: list[str], order: list[str]) -> DataFrame:
    """One row per time with one column per series, NULL where a series has no point.

    When a series has the same time twice, the first by ``order`` counts.
    """
    return points.groupBy(*keys, "ts").pivot("price_type", kinds).agg(F.min_by("price", F.struct(*order)))


def series_summary(points: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Points, first and last point per series."""
    at = F.struct("ts", *order)
    return points.groupBy(*keys, "price_type").agg(
        F.count("*").alias("points"),
        F.min("ts").alias("first_ts"), F.min_by("price", at).alias("first_price"),
        F.max("ts").alias("last_ts"), F.max_by("price", at).alias("last_price"),
    )


def count_values(df: DataFrame, key: str, value: str) -> DataFrame:
    """Rows per key and distinct non-null value, as ``n``: the one pass that the statistics below share."""
    return df.filter(F.col(value).isNotNull()).groupBy(key, F.col(value).alias(value)).agg(F.count("*").alias("n"))


#: Values of a key that one task may put in order for a median.
ORDERED_VALUES = 100_000


def middle_range(counted: DataFrame, key: str, value: str, pieces: int = 64, rounds: int = 2,
                 bound: int = ORDERED_VALUES) -> DataFrame:
    """For each key the range of values that holds its middle rows: ``low`` (outside it) and ``high``, null where open.

    Beside it stand all rows (``total``), the rows below the range (``before``) and its distinct values (``held``). A round
    cuts the range at quantiles of its values into about equal pieces and keeps those with the middle ranks; ranges of
    at most ``bound`` values are left as they are. So what is kept has at most ``bound`` values, or the key's values
    divided by ``pieces`` for each round.
    """
    ranges = counted.groupBy(key).agg(
        F.sum("n").alias("total"), F.lit(0).cast("bigint").alias("before"), F.count("*").alias("held"),
        *[F.lit(None).cast(counted.schema[value].dataType).alias(c) for c in ("low", "high")])
    cuts = [i / pieces for i in range(1, pieces)]
    lower, upper = F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2)
    for _ in range(rounds):
        inside = within(counted, ranges, key, value)
        state = [F.first(c).alias(c) for c in ("total", "before", "low", "high")]
        # No edges where the range is small enough: all of it is one piece.
        edges = inside.groupBy(key).agg(
            *state, F.percentile_approx(F.when(F.col("held") > bound, F.col(value)), cuts).alias("edges"))
        placed = inside.select(key, value, "n").join(edges, key).withColumn(
            "piece", F.coalesce(F.size(F.filter("edges", lambda e: e < F.col(value))), F.lit(0)))
        sums = placed.groupBy(key, "piece").agg(
            *state, F.first("edges").alias("edges"), F.sum("n").alias("m"), F.count("*").alias("values"))
        # At most `pieces` rows of a key.
        upto = F.col("before") + F.sum("m").over(Window.partitionBy(key).orderBy("piece"))
        middle = sums.withColumn("upto", upto).filter((F.col("upto") > lower) & (F.col("upto") - F.col("m") <= upper))
        first, last = F.min("piece"), F.max("piece")
        ranges = middle.groupBy(key).agg(
            F.first("total").alias("total"), F.min(F.col("upto") - F.col("m")).alias("before"), F.sum("values").alias("held"),
            F.coalesce(F.get(F.first("edges"), first - 1), F.first("low")).alias("low"),
            F.coalesce(F.get(F.first("edges"), last), F.first("high")).alias("high"))
    return ranges


def within(counted: DataFrame, ranges: DataFrame, key: str, value: str) -> DataFrame:
    """Counted values of each key inside its range."""
    v = F.col(value)
    return counted.join(ranges, key).filter(
        (F.col("low").isNull() | (v > F.col("low"))) & (F.col("high").isNull() | (v <= F.col("high"))))


def median_of_counts(counted: DataFrame, key: str, value: str, pieces: int = 64, rounds: int = 2,
                     bound: int = ORDERED_VALUES) -> DataFrame:
    """Exact median per key from counted values, for groups of any size.

    The range that holds the middle ranks is narrowed first, and only its values are put in order.
    """
    lower, upper = F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2)
    held = within(counted, middle_range(counted, key, value, pieces, rounds, bound), key, value)
    ranked = held.withColumn("upto", F.col("before") + F.sum("n").over(Window.partitionBy(key).orderBy(value)))

    def at(rank):
        holds = (F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank)
        return F.max(F.when(holds, F.col(value)))

    return ranked.groupBy(key).agg(((at(lower) + at(upper)) / 2).alias("median"))


def exact_median(df: DataFrame, key: str, value: str, pieces: int = 64, rounds: int = 2,
                 bound: int = ORDERED_VALUES) -> DataFrame:
    """Exact median per key over non-null values."""
    return median_of_counts(count_values(df, key, value), key, value, pieces, rounds, bound)


def series_stats(points: DataFrame, key: str = "price_type", value: str = "price") -> DataFrame:
    """Points, minimum, maximum, mean and exact median per series, over non-null values."""
    counted = count_values(points, key, value)
    basics = counted.groupBy(key).agg(
        F.sum("n").alias("points"), F.min(value).alias("min_price"), F.max(value).alias("max_price"),
        (F.sum(F.col(value).cast(MONEY) * F.col("n")).cast("double") / F.sum("n")).alias("mean_price"),
    )
    median = median_of_counts(counted, key, value).withColumnRenamed("median", "median_price")
    return basics.join(median, key)


def price_histogram(points: DataFrame, kinds: list[str] | None = None, bins: int = 20, value: str = "price") -> DataFrame:
    """Points per series in equal bins from its smallest to its largest value, the last bin closed.

    A series with one distinct value gets bins from half below to half above it.
    """
    kinds = kinds or list(PRICE_SERIES)
    counted = count_values(points.filter(F.col("price_type").isin(kinds)), "price_type", value)
    low, high = F.min(value), F.max(value)
    # One row per series of a fixed list, so it is small enough to broadcast. Asking for the points as
    # well keeps this the same aggregation as `counted`, whose shuffle is then used twice.
    edges = counted.groupBy("price_type").agg(
        F.when(low == high, low - 0.5).otherwise(low).alias("lo"),
        F.when(low == high, high + 0.5).otherwise(high).alias("hi"),
        F.sum("n").alias("points"),
    ).filter("points > 0").drop("points")
    at = F.floor(F.lit(float(bins)) * (F.col(value) - F.col("lo")) / (F.col("hi") - F.col("lo"))) + 1
    filled = counted.join(F.broadcast(edges), "price_type").groupBy(
        "price_type", F.least(at, F.lit(bins)).cast("int").alias("bin")
    ).agg(F.sum("n").alias("n"))
    grid = edges.select("price_type", "lo", "hi", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / bins
    return grid.join(filled, ["price_type", "bin"], "left").select(
        "price_type", "bin",
        (F.col("lo") + width * (F.col("bin") - 1)).alias("bin_start"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def trend_values(points: DataFrame) -> DataFrame:
    """Price and quantity per keyword and date; of several points on a date the last one counts."""
    at = F.struct("line_no", "pos")

    def last(series: str):
        mine = F.col("series") == series
        return F.max_by("value", F.when(mine, at))

    return points.groupBy("keyword", "date").agg(
        last("averageSold").alias("price"), last("quantity").alias("quantity")
    )


def trend_grid(points: DataFrame, keywords: DataFrame | None = None) -> DataFrame:
    """Every keyword on every date seen anywhere, NULL where it has no value.

    ``keywords`` adds keywords that have no point at all. The dates are one scalar array, bounded by
    the calendar, which each keyword unfolds.
    """
    values = trend_values(points)
    names = (points if keywords is None else keywords).select("keyword").distinct()
    # Every value row has one of the two; testing it keeps both uses of `values` alike, so that the
    # documents are parsed once.
    seen = values.filter("price IS NOT NULL OR quantity IS NOT NULL")
    days = seen.agg(F.array_sort(F.collect_set("date"))).scalar()
    return names.withColumn("date", F.explode(days)).join(values, ["keyword", "date"], "left")


def trend_pivot(points: DataFrame, value: str, dates: list[dt.date]) -> DataFrame:
    """Keyword by date as columns named ``yyyy-mm-dd``."""
    return trend_values(points).withColumn("_day", F.date_format("date", "yyyy-MM-dd")) \
        .groupBy("keyword").pivot("_day", [d.isoformat() for d in dates]).agg(F.first(value))
