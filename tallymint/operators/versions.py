"""Which parts of a table its readers see.

A job writes rows to a folder of its own batch, below it one folder per verdict and day. A version lists the (batch, day)
pairs that make up the table, and readers take the newest one. So rows become visible all at once, a batch that runs again
leaves the same table, and a replaced or compacted day goes in the moment in which the new one comes.

``{table}/rows/batch=.../verdict=.../{day}=.../`` holds the rows, ``{table}/versions/version=.../`` the versions. One job
at a time may commit: of two that take the same number, one fails. A version has one small row per batch and day, so
compaction also keeps the list short.
"""

from __future__ import annotations

import datetime as dt
import json
import re
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

#: Verdicts on rows: those that readers of the table get, those set aside, documents without rows, and one row per file.
ACCEPTED, REJECTED, EMPTY, FILE = "accepted", "rejected", "empty", "file"
#: A version's first row has no batch; it holds the run and the layout of the rows.
VERSION = "batch STRING, day DATE, run BIGINT, partition STRING, layout STRING"

Part = tuple[str, dt.date | None]


@dataclass(frozen=True)
class Version:
    """The table as one version shows it; number -1 is a table that doesn't exist yet."""

    number: int = -1
    run: int = 0
    partition: str = "scrape_date"
    layout: str = ""
    parts: frozenset[Part] = frozenset()

    @property
    def schema(self) -> StructType:
        """Layout of the rows, with the batch, verdict and day of their folders."""
        return StructType.fromJson(json.loads(self.layout)) if self.layout else StructType()


def files_below(spark: SparkSession, path: str, base: str | None = None) -> list[str]:
    """Parquet files below a folder, none if it doesn't exist. Lists names only.

    A path that fits several folders needs the one above them as ``base``.
    """
    try:
        return spark.read.schema("x INT").options(**({"basePath": base} if base else {})).parquet(path).inputFiles()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def read_or_empty(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The rows below a folder, none if it doesn't exist."""
    reader = spark.read.schema(schema)
    return reader.parquet(path) if files_below(spark, path) else spark.createDataFrame([], schema)


def newest(spark: SparkSession, table: str) -> Version:
    """The newest version of a table."""
    numbers = [int(n) for f in files_below(spark, f"{table}/versions") for n in re.findall(r"/version=(\d+)/", f)]
    if not numbers:
        return Version()
    rows = spark.read.schema(VERSION).parquet(f"{table}/versions/version={max(numbers)}").collect()
    head = next(r for r in rows if r["batch"] is None)
    parts = frozenset((r["batch"], r["day"]) for r in rows if r["batch"] is not None)
    return Version(max(numbers), head["run"], head["partition"], head["layout"], parts)


def commit(spark: SparkSession, table: str, version: Version) -> Version:
    """Make the given content the table's newest version."""
    after = replace(version, number=version.number + 1)
    rows = [(None, None, after.run, after.partition, after.layout)]
    rows += [(batch, day, None, None, None) for batch, day in sorted(after.parts, key=str)]
    spark.createDataFrame(rows, VERSION).coalesce(1).write.mode("errorifexists") \
        .parquet(f"{table}/versions/version={after.number}")
    return after


def layout(rows: StructType, partition: str) -> str:
    """The layout of a table for rows of some layout: their columns, then those of the folders."""
    own = [StructField(f.name, f.dataType) for f in rows.fields if f.name not in ("verdict", partition, "batch")]
    folders = [StructField("batch", StringType()), StructField("verdict", StringType()), StructField(partition, DateType())]
    return StructType(own + folders).json()


def write_batch(df: DataFrame, table: str, batch: str, partition: str, cluster: tuple[str, ...] = (),
                mode: str = "overwrite") -> None:
    """Write the rows of a batch, which nobody sees before a commit.

    The rows need a ``verdict``. A batch that runs again replaces what it wrote before.
    """
    spread = df.hint("rebalance", "verdict", partition).sortWithinPartitions("verdict", partition, *cluster)
    spread.write.partitionBy("verdict", partition).mode(mode) \
        .option("partitionOverwriteMode", "static").parquet(f"{table}/rows/batch={batch}")


def days_of(spark: SparkSession, table: str, batches: str, partition: str) -> set[Part]:
    """The batches that fit a pattern, with their days: what a commit lists. Reads folder names only."""
    found = set()
    for file in files_below(spark, f"{table}/rows/batch={batches}", f"{table}/rows"):
        batch, day = re.search(rf"/batch=([^/]+)/verdict=[^/]+/{re.escape(partition)}=([^/]+)/", file).groups()
        found.add((batch, None if day.startswith("__") else dt.date.fromisoformat(day)))
    return found


def read(spark: SparkSession, table: str, verdict: str | None = ACCEPTED, version: Version | None = None,
         days: list[dt.date] | None = None) -> DataFrame:
    """The rows of a version, the newest unless one is given; only those of ``days``, if given.

    Batches and days are chosen by their folders, before any file is opened.
    """
    version = newest(spark, table) if version is None else version
    parts = [(b, d) for b, d in version.parts if days is None or d in days]
    if not parts:
        return spark.createDataFrame([], version.schema)
    folders = sorted({f"{table}/rows/batch={b}" for b, _ in parts})
    rows = spark.read.schema(version.schema).option("basePath", f"{table}/rows").parquet(*folders)
    name = F.concat("batch", F.lit("/"), F.coalesce(F.col(version.partition).cast("string"), F.lit("")))
    rows = rows.filter(name.isin(sorted(f"{b}/{d or ''}" for b, d in parts)))
    return rows if verdict is None else rows.filter(F.col("verdict") == verdict)


def compact(spark: SparkSession, table: str, before: dt.date, cluster: tuple[str, ...] = ()) -> Version:
    """Rewrite the closed days, those before a date, that lie in several batches as one batch of clustered files.

    Nothing is done where every closed day has one batch, so a second run changes nothing. A run that failed before its
    commit is repeated under the same name.
    """
    version = newest(spark, table)
    batches: dict[dt.date, set[str]] = {}
    for batch, day in version.parts:
        if day is not None and day < before:
            batches.setdefault(day, set()).add(batch)
    scattered = [day for day, found in batches.items() if len(found) > 1]
    if not scattered:
        return version
    name = f"compact-{version.number}"
    rows = read(spark, table, verdict=None, version=version, days=scattered).drop("batch")
    write_batch(rows, table, name, version.partition, cluster)
    kept = {(b, d) for b, d in version.parts if d not in scattered}
    return commit(spark, table, replace(version, parts=frozenset(kept | {(name, d) for d in scattered})))
