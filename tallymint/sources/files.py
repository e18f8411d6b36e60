"""File scans. Paths carry ids and dates; every scan reads its files in parallel with Spark readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from .. import schemas
from ..functions import text as txt
from . import documents

# Fixed value: the tail of a daily price path, {date}/{category}/{group}/prices. Folders written by
# Spark carry a "name=" in front of each part.
DAILY_PATH = r"^(?:[a-z_]+=)?(\d{4}-\d{2}-\d{2})/(?:[a-z_]+=)?(\d+)/(?:[a-z_]+=)?(\d+)/[^/]+$"


def read_documents(spark: SparkSession, path: str, glob: str = "*.json", whole: bool = True) -> DataFrame:
    """Text files below ``path`` as ``value`` and ``path``: one row per file, or one per line."""
    # Keyword arguments, because text() resets these options when they are set before.
    found = spark.read.text(path, wholetext=whole, pathGlobFilter=glob, recursiveFileLookup=True)
    return found.select("value", F.col("_metadata.file_path").alias("path"))


def relative_path(path: Column | str, base: str) -> Column:
    """``path`` below the folder ``base``; a path outside it stays whole.

    Spark gives paths of files in URI encoding, so they are decoded first; a plus sign stands for itself there.
    """
    p = F.col(path) if isinstance(path, str) else path
    decoded = F.coalesce(F.try_url_decode(F.replace(p, F.lit("+"), F.lit("%2B"))), p)
    marker = base.rstrip("/").split(":", 1)[-1].replace("//", "/") + "/"
    # Without a percent sign there is nothing to decode; without the marker the path comes back whole.
    return F.substring_index(F.when(F.contains(p, F.lit("%")), decoded).otherwise(p), marker, -1)


def scan_price_documents(spark: SparkSession, path: str, scrape_date: Column, whole: bool = True,
                         glob: str = "*.json", product_id: Column | None = None) -> DataFrame:
    """Price documents below ``path`` with their product id, scrape date and relative file name.

    Files whose names carry no product id are skipped.
    """
    docs = read_documents(spark, path, glob, whole)
    product_id = txt.product_id_from_file("path") if product_id is None else product_id
    return docs.select(
        product_id.alias("product_id"),
        scrape_date.alias("scrape_date"),
        relative_path("path", path).alias("source_file"),
        "value",
    ).filter("product_id IS NOT NULL")


def scan_price_json(spark: SparkSession, path: str, scrape_date: Column, flag: str | None = None, **how) -> DataFrame:
    """Price-bucket rows of all product files below ``path``."""
    return documents.price_rows(scan_price_documents(spark, path, scrape_date, **how), flag=flag)


def scan_daily_prices(spark: SparkSession, path: str, loaded_at: Column, glob: str = "prices",
                      whole: bool = True) -> DataFrame:
    """Price rows of a ``{date}/{category}/{group}/prices`` tree; other folders are ignored."""
    docs = read_documents(spark, path, glob, whole)
    # Unfolding an array of one keeps the optimiser from matching the path once for every use of it.
    tail = F.split(F.regexp_extract(F.substring_index("path", "/", -4), DAILY_PATH, 0), "/")
    found = docs.select("value", F.explode(F.array(tail)).alias("tail"))

    def part(at: int) -> Column:
        return F.substring_index(F.get("tail", F.lit(at)), "=", -1)

    parts = found.select(
        part(0).try_cast("date").alias("price_date"), part(1).alias("category_id"), part(2).alias("group_id"), "value",
    ).filter("price_date IS NOT NULL")
    return documents.daily_price_rows(parts, loaded_at)


def graded_documents(docs: DataFrame, cards: DataFrame) -> DataFrame:
    """Documents of ``{item}_{grade}.json`` files with item, grade and card name; other names are skipped.

    ``docs`` holds ``value`` and ``path``; ``cards`` holds ``item_id`` and ``card_name``.
    """
    name = txt.file_name("path")
    keyed = docs.select(
        txt.extract(name, txt.GRADED_FILE, 1).alias("item_id"),
        txt.extract(name, txt.GRADED_FILE, 2).alias("grade"),
        "value",
    ).filter("item_id IS NOT NULL")
    # A short list is broadcast by its known size; beside a long one the documents are dealt by item, hot ones split.
    return keyed.join(cards.select("item_id", "card_name"), "item_id", "left")


def scan_auction_json(spark: SparkSession, path: str, cards: DataFrame, scraped_at: Column) -> DataFrame:
    """Auction rows of all ``{item}_{grade}.json`` files below ``path``."""
    return documents.auction_rows(graded_documents(read_documents(spark, path), cards), scraped_at)


def scan_trend_lines(spark: SparkSession, path: str, glob: str = "*.json", stem: Column | None = None) -> DataFrame:
    """Lines of trend files with their keyword, one row per line; large files are read in several pieces.

    ``line_no`` orders the lines of a keyword: by the running number that begins the file name and is dropped from the
    keyword, then by the piece's place in the file, then as they are read within it. ``stem`` takes number and keyword
    from another part of the ``path`` than the file name.
    """
    found = spark.read.text(path, pathGlobFilter=glob, recursiveFileLookup=True)
    lines = found.select("value", F.col("_metadata.file_path").alias("path"),
                         F.col("_metadata.file_block_start").alias("piece"), F.monotonically_increasing_id().alias("at"))
    stem = F.regexp_replace(txt.file_name("path"), r"\.[a-z]+$", "") if stem is None else stem
    named = lines.select(F.explode(F.array(stem)).alias("stem"), "piece", "at", "value")
    return named.select(txt.keyword_of(F.col("stem")).alias("keyword"), F.struct("stem", "piece", "at").alias("line_no"), "value")


def latest_folder(paths: DataFrame, path: str = "path") -> DataFrame:
    """The newest date stamp among folders named ``yymmdd_raw_jsons``."""
    stamp = txt.extract(path, txt.FOLDER_STAMP)
    return paths.agg(F.max(stamp).alias("stamp"))


def read_keywords(spark: SparkSession, path: str) -> DataFrame:
    """Keyword list, one per line, trimmed, without blank lines."""
    return spark.read.text(path).select(F.trim("value").alias("keyword")).filter("keyword != ''")


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header and a declared schema."""
    return spark.read.schema(schema).option("header", "true").csv(path)


def newest_file(spark: SparkSession, path: str, glob: str) -> str | None:
    """The last changed file below a folder whose name fits (equal times: largest name). No file is opened."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    last = found.select("path", "modificationTime").orderBy(F.desc("modificationTime"), F.desc("path")).first()
    return None if last is None else last["path"]


def card_list(spark: SparkSession, path: str) -> DataFrame:
    """The list of cards to follow; ids are text."""
    return read_csv(spark, path, schemas.CARD_LIST)


def grade_list(spark: SparkSession, path: str) -> DataFrame:
    """The list of grades; values are text."""
    return read_csv(spark, path, schemas.GRADE_LIST)
