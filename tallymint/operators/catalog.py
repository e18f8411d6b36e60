"""The product catalog: three levels joined into one row, newest rows, and listings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.cleaning import flat_value
from .dedup import keep_one
from .filters import last_days


def _prefixed(df: DataFrame, prefix: str, skip=()) -> DataFrame:
    return df.select(*[flat_value(f).alias(f"{prefix}_{f.name}") for f in df.schema.fields if f.name not in skip])


def denormalise(categories: DataFrame, groups: DataFrame, products: DataFrame, load_date: Column) -> DataFrame:
    """Category, group and product as one wide row per product, values made flat, names prefixed.

    ``groups`` carries ``categoryId`` and ``products`` carries ``groupId``. Joins are left to the
    optimiser: the two small levels are broadcast only while they are below Spark's size limit.
    """
    c = _prefixed(categories, "category")
    g = _prefixed(groups, "group")
    p = _prefixed(products, "product")
    return (
        p.join(g, F.col("product_groupId") == F.col("group_groupId"))
        .join(c, F.col("group_categoryId") == F.col("category_categoryId"))
        .withColumn("update_date", load_date)
    )


def latest_catalog(catalog: DataFrame, columns: list[str]) -> DataFrame:
    """The newest catalog row per product, with the given columns."""
    return keep_one(catalog.select("product_id", "update_date", *columns), ["product_id"], "update_date")


def category_summary(catalog: DataFrame) -> DataFrame:
    """Groups, rows and load dates per category."""
    per_group = catalog.groupBy("category_id", "category_name", "group_id").agg(
        F.count("*").alias("n"), F.min("update_date").alias("lo"), F.max("update_date").alias("hi")
    )
    return per_group.groupBy("category_id", "category_name").agg(
        F.count("group_id").alias("groups_count"),
        F.sum("n").alias("products_count"),
        F.min("lo").alias("first_update"),
        F.max("hi").alias("last_update"),
    ).orderBy(F.desc("products_count"), "category_id")


def recent_activity(catalog: DataFrame, days: int = 7, as_of: dt.date | None = None) -> DataFrame:
    """Rows, categories and groups per recent load date, beside the total of all those dates."""
    recent = last_days(catalog, "update_date", days, as_of)
    per_group = recent.groupBy("update_date", "category_id", "group_id").agg(F.count("*").alias("n"))
    daily = per_group.groupBy("update_date").agg(
        F.sum("n").alias("products_added"),
        F.countDistinct("category_id").alias("categories_updated"),
        F.countDistinct("group_id").alias("groups_updated"),
    )
    total = recent.agg(F.count("*")).scalar()
    return daily.withColumn("total_products", total).orderBy(F.desc("update_date"))


def top_categories(catalog: DataFrame, limit: int = 5) -> DataFrame:
    """Categories with most rows."""
    return catalog.groupBy("category_name").agg(F.count("*").alias("product_count")) \
        .orderBy(F.desc("product_count"), "category_name").limit(limit)


def recent_groups(catalog: DataFrame, limit: int = 5) -> DataFrame:
    """Groups by newest load date, then size."""
    return catalog.groupBy("category_name", "group_name").agg(
        F.count("*").alias("products"), F.max("update_date").alias("last_update")
    ).orderBy(F.desc("last_update"), F.desc("products"), "category_name", "group_name").limit(limit)


def largest_groups(catalog: DataFrame, limit: int = 5) -> DataFrame:
    """Groups with most rows."""
    return catalog.groupBy("category_name", "group_name").agg(F.count("*").alias("product_count")) \
        .orderBy(F.desc("product_count"), "category_name", "group_name").limit(limit)


def sample_with_total(df: DataFrame, order: list[str], limit: int = 10) -> DataFrame:
    """The first rows by ``order``, each beside the row count of the whole table.

    The count is a scalar subquery and the rows a top-k, so neither passes through one task.
    """
    total = df.agg(F.count("*")).scalar()
    return df.orderBy(*order).limit(limit).withColumn("total_rows", total)
