"""Dates and times: week buckets, tolerant parsing, epoch encodings, dates in file names."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

# Fixed value: minutes between 1970-01-01 and the zero point of packed price histories.
PACKED_EPOCH_MINUTES = 21564000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def week_start(c: Column | str) -> Column:
    """Monday of the week that holds a date or timestamp, as a DATE."""
    return F.date_trunc("week", _col(c)).cast("date")


def parse_us_date(c: Column | str) -> Column:
    """``m/d/yyyy`` text, padded or not, to DATE; NULL when it is no such date."""
    return F.try_to_date(_col(c), "M/d/yyyy")


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Minutes from ``start`` to ``end`` as DOUBLE."""
    return (F.timestamp_diff("SECOND", _col(start), _col(end)).cast("double")) / F.lit(60.0)


def in_zone(ts: Column, zone: str = "UTC") -> Column:
    """A UTC wall-clock timestamp moved to ``zone``."""
    return ts if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)


def from_packed_minutes(minutes: Column | str, zone: str = "UTC") -> Column:
    """Packed minute count to a wall-clock timestamp in ``zone``."""
    epoch = F.lit(dt.datetime(1970, 1, 1)).cast("timestamp_ntz")
    m = (_col(minutes) + F.lit(PACKED_EPOCH_MINUTES)).try_cast("int")
    return in_zone(epoch + F.make_dt_interval(mins=m), zone)


def from_epoch_millis(ms: Column | str, zone: str = "UTC") -> Column:
    """Epoch milliseconds to a wall-clock timestamp in ``zone``."""
    epoch = F.lit(dt.datetime(1970, 1, 1)).cast("timestamp_ntz")
    seconds = (_col(ms).try_cast("bigint") / F.lit(1000)).try_cast("decimal(18,6)")
    return in_zone(epoch + F.make_dt_interval(secs=seconds), zone)


def date_from_name(name: Column | str, modified: Column | None = None) -> Column:
    """Date written in an archive name, else the date of ``modified``.

    The forms are tried in order and each must be a real date; a form that matches but is not a
    date falls through to the next, so ``2025-01-45`` ends as the first of its month.
    """
    name = _col(name)

    def found(pattern: str, iso) -> Column:
        # What makes no date, as the empty text of a form that isn't there, ends as null.
        return iso(F.regexp_extract(name, pattern, 0)).try_cast("date")

    def compact(hit: Column) -> Column:
        return F.concat_ws("-", F.substring(hit, 1, 4), F.substring(hit, 5, 2), F.substring(hit, 7, 2))

    # Accepted date forms, in order.
    options = [
        found(r"\d{4}-\d{2}-\d{2}", lambda hit: hit),
        found(r"\d{8}", compact),
        found(r"\d{4}-\d{2}", lambda hit: F.concat(hit, F.lit("-01"))),
        found(r"\d{4}_\d{2}_\d{2}", lambda hit: F.replace(hit, F.lit("_"), F.lit("-"))),
    ]
    if modified is not None:
        options.append(modified.cast("date"))
    return F.coalesce(*options)


def calendar_weeks(first: dt.date, last: dt.date) -> list[dt.date]:
    """Every Monday from the week of ``first`` to the week of ``last``: the column list of a pivot."""
    day = first - dt.timedelta(days=first.weekday())
    weeks = []
    while day <= last:
        weeks.append(day)
        day += dt.timedelta(days=7)
    return weeks
