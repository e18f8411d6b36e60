"""Writing tables: append, replace, one day replaced, retention, and facts about what is stored.

Tables are folders of Parquet with one sub-folder per day. Before a write, rows are rebalanced on the
day: adaptive execution then joins small pieces and splits a day that is too large for one task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, functions as F
from pyspark.sql.types import StructType


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of the schema in order and type; absent ones are NULL."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ])


def _writer(df: DataFrame, partition: str, cluster: list[str]) -> DataFrameWriter:
    spread = df.hint("rebalance", partition)
    return spread.sortWithinPartitions(partition, *cluster).write.partitionBy(partition)


def append(df: DataFrame, path: str, partition: str, cluster: list[str] | None = None) -> None:
    """Add rows to a table, made if missing."""
    _writer(df, partition, cluster or []).mode("append").parquet(path)


def replace(df: DataFrame, path: str, partition: str, cluster: list[str] | None = None) -> None:
    """Replace a whole table in one write."""
    _writer(df, partition, cluster or []).mode("overwrite") \
        .option("partitionOverwriteMode", "static").parquet(path)


def replace_days(df: DataFrame, path: str, partition: str, cluster: list[str] | None = None) -> None:
    """Replace the days that occur in ``df`` and leave all others.

    Running it twice gives the same table, so a failed job is simply run again.
    """
    _writer(df, partition, cluster or []).mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").parquet(path)


#: Property of a catalog table that names its cluster columns.
CLUSTER_PROPERTY = "cluster.columns"


def create_table(spark: SparkSession, name: str, schema: StructType, partition: str, path: str | None = None,
                 cluster: tuple[str, ...] = ()) -> None:
    """A catalog table over Parquet, partitioned by day, unless it exists; it keeps its cluster columns as a property."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    where = f"LOCATION '{path}'" if path else ""
    kept = f"TBLPROPERTIES ('{CLUSTER_PROPERTY}' = '{','.join(cluster)}')" if cluster else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY (`{partition}`) {where} {kept}")


def layout(spark: SparkSession, name: str) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """Partition and cluster columns of a table, as the catalog has them."""
    partition = tuple(c.name for c in spark.catalog.listColumns(name) if c.isPartition)
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return partition, tuple(c for c in properties.get(CLUSTER_PROPERTY, "").split(",") if c)


def insert(df: DataFrame, name: str, replace_days: bool = False) -> None:
    """Write rows to a catalog table in its own layout: dealt by its partition, sorted by its cluster columns.

    ``replace_days`` replaces the days that occur in the rows and leaves all others.
    """
    spark = df.sparkSession
    partition, cluster = layout(spark, name)
    rows = conform(df, spark.table(name).schema).hint("rebalance", *partition).sortWithinPartitions(*partition, *cluster)
    before = spark.conf.get(OVERWRITE)
    try:
        spark.conf.set(OVERWRITE, "dynamic")
        rows.write.insertInto(name, overwrite=replace_days)
    finally:
        spark.conf.set(OVERWRITE, before)


OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


def drop_days(spark: SparkSession, name: str, partition: str, days: list[dt.date]) -> None:
    """Remove days of a catalog table and their files, also where the table has a location of its own.

    Dropping a partition of such a table would leave its files, so each day is first overwritten with nothing.
    """
    if not days:
        return
    fields = [f for f in spark.table(name).schema.fields if f.name != partition]
    nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in fields)
    for day in days:
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (`{partition}` = DATE'{day.isoformat()}') SELECT {nothing} WHERE 1 = 0")
    parts = ", ".join(f"PARTITION (`{partition}` = DATE'{d.isoformat()}')" for d in days)
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {parts}")


def retire(spark: SparkSession, name: str, partition: str, days: int, as_of: dt.date) -> list[dt.date]:
    """Remove the days of a catalog table that are older than ``days`` days, and their files; returns them."""
    found = [r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]  # one row per day
    kept = as_of - dt.timedelta(days=days)
    old = sorted(d for d in map(dt.date.fromisoformat, (f for f in found if f[:1].isdigit())) if d < kept)
    drop_days(spark, name, partition, old)
    return old


def retain(df: DataFrame, day: str, days: int, as_of: dt.date) -> DataFrame:
    """Rows no older than ``days`` days: what a retention run keeps."""
    return df.filter(F.col(day) >= F.lit(as_of - dt.timedelta(days=days)))


def without_day(df: DataFrame, day: str, gone: dt.date) -> DataFrame:
    """Rows of all days but one."""
    return df.filter(F.col(day) != F.lit(gone))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header."""
    df.write.mode("overwrite").option("header", "true").csv(path)


def write_report(sections: dict[str, DataFrame], path: str) -> None:
    """A report of several tables: one CSV folder per section."""
    for name, rows in sections.items():
        write_csv(rows, f"{path}/{name}")


def partition_stats(table: DataFrame, partition: str) -> DataFrame:
    """Rows, files and bytes per partition, newest first.

    ``table`` must read files directly, because sizes come from the file metadata.
    """
    per_file = table.groupBy(
        F.col(partition), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")
    ).agg(F.count("*").alias("n"))
    return per_file.groupBy(partition).agg(
        F.sum("n").alias("total_rows"), F.count("*").alias("files"), F.sum("size").alias("total_bytes")
    ).orderBy(F.desc(partition))


def table_facts(spark: SparkSession, name: str) -> DataFrame:
    """Rows, files, bytes, columns and layout of a catalog table (one row); the layout is that of the catalog."""
    table = spark.table(name)
    partition, cluster = layout(spark, name)
    per_file = table.groupBy(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")
    ).agg(F.count("*").alias("n"))
    return per_file.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("num_rows"),
        F.count("*").alias("files"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("num_bytes"),
    ).withColumns({
        "num_columns": F.lit(len(table.columns)),
        "partitioned_by": F.lit(", ".join(partition)),
        "clustered_by": F.lit(", ".join(cluster)),
    })
