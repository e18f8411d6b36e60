from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallymint.functions import cleaning, dates, money, text

D = dt.date


def values(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_date_from_name(spark):
    names = {
        "cards_2025-01-15.zip": D(2025, 1, 15), "data_20250115.zip": D(2025, 1, 15),
        "details_2025-01.zip": D(2025, 1, 1), "d_2025_01_15.zip": D(2025, 1, 15),
        "d_2025-01-45.zip": D(2025, 1, 1), "d_20251345.zip": D(2024, 5, 6), "nodate.zip": D(2024, 5, 6),
    }
    expr = dates.date_from_name("n", F.lit(dt.datetime(2024, 5, 6, 7)))
    assert values(spark, expr, [(n,) for n in names], "n string") == list(names.values())
    assert values(spark, dates.date_from_name("n"), [("nodate.zip",)], "n string") == [None]


def test_us_dates(spark):
    data = [("1/5/2025",), ("01/06/2025",), ("13/1/2025",), ("x",), ("",), (None,)]
    assert values(spark, dates.parse_us_date("d"), data, "d string") == [
        D(2025, 1, 5), D(2025, 1, 6), None, None, None, None]


def test_weeks_start_on_monday(spark):
    data = [(D(2024, 12, 1),), (D(2024, 12, 2),), (D(2024, 12, 8),)]
    assert values(spark, dates.week_start("d"), data, "d date") == [D(2024, 11, 25), D(2024, 12, 2), D(2024, 12, 2)]
    assert dates.calendar_weeks(D(2024, 12, 1), D(2024, 12, 9)) == [D(2024, 11, 25), D(2024, 12, 2), D(2024, 12, 9)]


def test_epochs(spark):
    assert values(spark, dates.from_packed_minutes("m"), [(7000000,)], "m bigint") == [dt.datetime(2024, 4, 23, 2, 40)]
    late = [(1756965437056.0,)]
    assert values(spark, dates.from_epoch_millis("m"), late, "m double")[0].replace(microsecond=0) == \
        dt.datetime(2025, 9, 4, 5, 57, 17)
    assert values(spark, dates.from_epoch_millis("m", "America/New_York").cast("date"), [(1756950000000.0,)],
                  "m double") == [D(2025, 9, 3)]


def test_ids(spark):
    files = [("a/123.json",), ("481225.0.json",), ("x/_summary.json",), ("12_summary.json",), ("abc.json",), ("1.5.json",)]
    assert values(spark, text.product_id_from_file("p"), files, "p string") == ["123", "481225", None, None, None, None]
    urls = [("https://shop.example/product/42/name",), ("https://shop.example/",), (None,)]
    assert values(spark, text.product_id_from_url("u"), urls, "u string") == ["42", None, None]


def test_names(spark):
    assert values(spark, text.safe_name("s"), [("Pokémon card #1!",), ("x" * 60,)], "s string") == ["Pokémon_card__1_", "x" * 50]
    assert values(spark, text.keyword_of("s"), [("0007_blue_card",)], "s string") == ["blue_card"]
    data = [("a" * 40, 7), ("a" * 41, 7), (None, 7)]
    assert values(spark, text.display_name("n", "i"), data, "n string, i int") == [
        "a" * 40 + " (7)", "a" * 40 + "... (7)", None]
    assert values(spark, text.composite_key("a", "b"), [("x", "y"), ("x", None)], "a string, b string") == ["x_y", None]


@pytest.mark.parametrize("raw, double, whole, fraction", [
    ("4", 4.0, 4, False), (" 4.0 ", 4.0, 4, False), ("1.5", 1.5, None, True), ("n/a", None, None, False),
    ("1f", None, None, False), ("NaN", None, None, False), ("1e3", 1000.0, 1000, False), ("", None, None, False),
    (None, None, None, False), ("9007199254740993", 9007199254740992.0, 9007199254740993, False),
])
def test_numbers(spark, raw, double, whole, fraction):
    df = spark.createDataFrame([(raw,)], "v string")
    got = df.select(cleaning.to_double("v"), cleaning.to_whole("v"), cleaning.is_fractional("v")).first()
    assert tuple(got) == (double, whole, fraction)


def test_days(spark):
    data = [("2025-01-06",), ("not a date",), ("2025-02-30",), (None,)]
    assert values(spark, cleaning.to_day("d"), data, "d string") == [D(2025, 1, 6), None, None, None]


def test_normalise_values(rows):
    df = rows([([1, 2], True, 1.5, "x", D(2025, 1, 1), {"a": 1})],
              "l array<int>, b boolean, n double, s string, d date, m map<string,int>")
    assert tuple(cleaning.normalise_values(df).first()) == ("[1,2]", "true", 1.5, "x", "2025-01-01", '{"a":1}')


def test_money_does_not_depend_on_order(rows):
    prices = [0.1, 0.2, 0.3, 1e9, -1e9]
    totals = {rows([(p,) for p in order], "p double").agg(money.money_total("p")).first()[0]
              for order in (prices, prices[::-1], sorted(prices))}
    assert totals == {0.6}


def test_cents_and_percentages(rows):
    df = rows([(1.005, 1, 0), (2.675, 1, 4)], "p double, a int, b int")
    got = df.select(money.cents("p"), money.percentage(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(1.01, None), (2.68, 25.0)]


def test_json_get(rows):
    df = rows([('{"a": {"b": 1, "c": null, "d e": [2]}}',), ("broken",), (None,)], "j string")
    from tallymint.functions.text import json_get

    got = df.select(json_get("j", "a", "b"), json_get("j", "a", "c", default="x"), json_get("j", "a", "d e", default="x"),
                    json_get("j", "z", "y", default=F.lit("w"))).collect()
    assert [tuple(r) for r in got] == [("1", "x", "[2]", "w"), (None, "x", "x", "w"), (None, "x", "x", "w")]
