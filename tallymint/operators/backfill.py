"""Loading past days, resumably: stage all missing days, check them, publish those that pass, and keep a log.

The log alone decides what is left to do, so a run that stops is simply started again, as often as needed.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from . import audit, versions

#: Messages of days without rows.
NO_ROWS = "No rows"


def run_log(spark: SparkSession, log: str) -> DataFrame:
    """Events of all runs so far."""
    return versions.read_or_empty(spark, f"{log}/events", schemas.RUN_EVENT)


def failure_log(spark: SparkSession, log: str) -> DataFrame:
    """Failures of all runs so far, in the layout that the recovery report reads."""
    return versions.read_or_empty(spark, f"{log}/failures", schemas.FAILURE)


def days_between(spark: SparkSession, first: dt.date, last: dt.date, skip_weekends: bool = False) -> DataFrame:
    """The days of a period, as the ``spine`` of a backfill."""
    bounds = spark.createDataFrame([(first, last)], "first DATE, last DATE")
    return audit.date_spine(bounds, F.col("first"), F.col("last"), skip_weekends)


def days_to_do(spark: SparkSession, log: str, spine: DataFrame, limit: int | None = None) -> list[dt.date]:
    """Days of the spine that no run has completed; if they are limited, those first that fewest runs have tried."""
    status = audit.run_status(run_log(spark, log), order=("event_time", "run_id"))
    missing = audit.missing_dates(spine, status)
    if limit is not None:
        tried = failure_log(spark, log).groupBy("date").agg(F.count("*").alias("tries"))
        missing = missing.join(tried, "date", "left").orderBy(F.coalesce("tries", F.lit(0)), "date").limit(limit)
    return sorted(r["date"] for r in missing.collect())  # at most the calendar's


def backfill(spark: SparkSession, source: DataFrame | Callable[[list[dt.date]], DataFrame], spine: DataFrame,
             table: str, log: str, run_id: str, day: str = "price_date", cluster: tuple[str, ...] = (),
             limit: int | None = None, required: tuple[str, ...] = audit.REQUIRED, **checks) -> dict[dt.date, str]:
    """Load the days of the spine that are still missing, at most ``limit`` of them; returns their outcomes.

    ``source`` is a table, or gives the rows of a list of days. All days of the run are staged in one job and checked in
    another (``required`` and ``checks`` are those of ``audit.validate_batch``). Days that pass become visible in one
    moment and replace what the table held of them; the others stay as they were and are tried again by the next run.
    Then the outcomes are logged. A run that broke off is started again: what it staged but didn't publish is written
    anew, and what it published but didn't log is replaced by the same days.
    """
    began = time.monotonic()
    days = days_to_do(spark, log, spine, limit)
    if not days:
        return {}
    rows = source(days) if callable(source) else source
    rows = rows.filter(F.col(day).isin(days)).withColumn("verdict", F.lit(versions.ACCEPTED))
    now = versions.newest(spark, table)
    batch = f"backfill-{run_id}-{now.number}"  # never one that readers see
    versions.write_batch(rows, table, batch, day, cluster)
    layout = versions.layout(rows.schema, day)
    staged = versions.read(spark, table, version=versions.Version(
        partition=day, layout=layout, parts=frozenset(versions.days_of(spark, table, batch, day))))
    checked = audit.validate_batch(staged, day, required=[c for c in required if c in staged.columns], **checks)
    found = {r[day]: r for r in checked.collect()}  # a row a day
    outcome = {d: "completed" if d in found and found[d]["validation_passed"] else "failed" for d in days}
    passed = {d for d, status in outcome.items() if status == "completed"}
    kept = {(b, d) for b, d in now.parts if d not in passed}
    versions.commit(spark, table, dataclasses.replace(
        now, partition=day, layout=layout, parts=frozenset(kept | {(batch, d) for d in passed})))
    _write_log(spark, log, run_id, batch, outcome, found, (time.monotonic() - began) / len(days))
    return outcome


def _write_log(spark: SparkSession, log: str, run_id: str, batch: str, outcome: dict, found: dict, seconds: float) -> None:
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    counts = {d: found[d]["record_count"] if d in found else 0 for d in outcome}
    events = [(run_id, d, "process", status, counts[d] if status == "completed" else 0, seconds, now)
              for d, status in outcome.items()]
    tries = {r["date"]: r["n"] for r in failure_log(spark, log).filter(F.col("context")["run_id"] != run_id)
             .groupBy("date").agg(F.count("*").alias("n")).collect()}
    failures = [(d, now.isoformat(), "process" if d in found else "download",
                 "; ".join(found[d]["issues"]) if d in found else NO_ROWS, None, tries.get(d, 0), "retry",
                 {"run_id": run_id, "record_count": str(counts[d])})
                for d, status in outcome.items() if status == "failed"]
    # Failures first: a day is only taken as done or tried by its event.
    for name, rows, schema in (("failures", failures, schemas.FAILURE), ("events", events, schemas.RUN_EVENT)):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{log}/{name}/batch={batch}")
