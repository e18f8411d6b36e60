"""Scans of managed tables by name or path, and limited scans for trial runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def limit_per_group(df: DataFrame, category: str, group: str, categories: int, groups: int) -> DataFrame:
    """Rows of the first ``categories`` categories and, in each, the first ``groups`` groups, by id.

    The ranking runs on the distinct (category, group) pairs only, so a hot group costs one row.
    """
    pairs = df.select(category, group).distinct()
    first = pairs.select(category).distinct().orderBy(category).limit(categories)
    in_category = Window.partitionBy(category).orderBy(group)
    wanted = (
        pairs.join(first, category, "left_semi")
        .withColumn("_n", F.row_number().over(in_category))
        .filter(F.col("_n") <= groups)
        .select(category, group)
    )
    return df.join(wanted, [category, group], "left_semi")
