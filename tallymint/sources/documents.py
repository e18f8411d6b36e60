"""From document text to typed rows.

Each function takes a DataFrame that already holds the text (read in batch, read as a stream or
derived from a table) and returns flat rows, so batch and stream share one definition. No function
groups or shuffles: a document becomes rows inside the task that read it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas
from ..functions import cleaning, dates
from ..functions.text import product_id_from_url


def parsed(docs: DataFrame, keep: tuple[str, ...], value: Column) -> DataFrame:
    """The parsed document as column ``d`` beside the columns to keep.

    Unfolding a one-element array is a boundary for the optimiser: later filters and field reads stay
    above it instead of being folded into the parser, which would run it several times per document.
    """
    return docs.select(*keep, F.explode_outer(F.array(value)).alias("d"))


# --- price history documents -------------------------------------------------------------------

# JSON names of a price document and the column each one fills.
RESULT_FIELDS = {
    "skuId": "sku_id",
    "variant": "variant",
    "language": "language",
    "condition": "condition",
    "averageDailyQuantitySold": "average_daily_quantity_sold",
    "averageDailyTransactionCount": "average_daily_transaction_count",
    "totalQuantitySold": "total_quantity_sold",
    "totalTransactionCount": "total_transaction_count",
}
BUCKET_FIELDS = {
    "bucketStartDate": "bucket_start_date",
    "marketPrice": "market_price",
    "quantitySold": "quantity_sold",
    "lowSalePrice": "low_sale_price",
    "lowSalePriceWithShipping": "low_sale_price_with_shipping",
    "highSalePrice": "high_sale_price",
    "highSalePriceWithShipping": "high_sale_price_with_shipping",
    "transactionCount": "transaction_count",
}


def _buckets(rows: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """Text fields of a result ``r`` and its bucket ``b`` as columns of the price table."""
    return rows.select(
        "product_id",
        *[F.col(f"r.{name}").alias(column) for name, column in RESULT_FIELDS.items()],
        *[F.col(f"b.{name}").alias(column) for name, column in BUCKET_FIELDS.items()],
        *[c for c in keep if c != "product_id"],
    )


DOUBLES = ("market_price", "low_sale_price", "low_sale_price_with_shipping",
           "high_sale_price", "high_sale_price_with_shipping")
WHOLES = ("quantity_sold", "transaction_count")
DAYS = ("bucket_start_date",)


def price_rows(docs: DataFrame, text: str = "value", flag: str | None = None) -> DataFrame:
    """Price documents to price-bucket rows.

    ``docs`` holds ``product_id``, ``scrape_date``, ``source_file`` and the document text. A result
    without buckets keeps one row with NULL bucket fields; invalid text gives no row. ``flag`` names
    an optional column marking rows whose whole-number fields held a fraction.
    """
    keep = ("product_id", "scrape_date", "source_file")
    per_result = parsed(docs, keep, F.from_json(text, schemas.PRICE_DOCUMENT)).select(
        *keep, F.explode("d.result").alias("r")
    )
    per_bucket = per_result.select(
        *keep, "r", F.explode_outer("r.buckets").alias("b")
    )
    return cleaning.coerce(_buckets(per_bucket, keep), doubles=DOUBLES, wholes=WHOLES, days=DAYS, flag=flag)


def price_verdicts(docs: DataFrame, text: str = "value") -> DataFrame:
    """Price documents to rows with a ``verdict`` and its ``reason``, all from one parse of each document.

    Rows are ``accepted``, or ``rejected`` where a whole-number field holds a fraction; the reason gives the text. A
    document without results leaves one row, ``empty``, whose reason tells whether it had a list of them.
    """
    keep = ("product_id", "scrape_date", "source_file")
    per_result = parsed(docs, keep, F.from_json(text, schemas.PRICE_DOCUMENT)).select(
        *keep, F.array_size("d.result").alias("results"), F.explode_outer("d.result").alias("r"))
    per_bucket = per_result.select(*keep, "results", "r", F.explode_outer("r.buckets").alias("b"))
    flat = _buckets(per_bucket, (*keep, "results"))
    odd = F.concat_ws("; ", *[F.when(cleaning.is_fractional(c), F.concat(F.lit(f"{c} = "), c)) for c in WHOLES])
    reason = F.when(F.col("results").isNull(), F.lit("no list of results")).otherwise(F.nullif(odd, F.lit("")))
    # Unfolded, so that it is made once and not again for the verdict.
    judged = flat.select("*", F.explode_outer(F.array(reason)).alias("reason"))
    typed = cleaning.coerce(judged, doubles=DOUBLES, wholes=WHOLES, days=DAYS)
    verdict = F.when(F.coalesce("results", F.lit(0)) == 0, F.lit("empty")) \
        .when(F.col("reason").isNotNull(), F.lit("rejected")).otherwise(F.lit("accepted"))
    return typed.withColumn("verdict", verdict).drop("results")


# --- daily price lists -------------------------------------------------------------------------

def daily_price_rows(docs: DataFrame, loaded_at: Column, text: str = "value") -> DataFrame:
    """Daily price payloads to price rows.

    ``docs`` holds ``price_date``, ``category_id``, ``group_id`` and the payload, which is
    ``{"results": [...]}`` or a bare array; any other shape gives no rows.
    """
    entry = schemas.DAILY_PRICE_ENTRY
    first = F.substring(F.ltrim(F.col(text), F.lit(" \t\r\n")), 1, 1)
    # The first character tells the shape, so each payload is parsed once.
    entries = F.when(first == "{", F.from_json(text, f"STRUCT<results: ARRAY<{entry}>>")["results"]) \
        .when(first == "[", F.from_json(text, f"ARRAY<{entry}>"))
    keep = ("price_date", "category_id", "group_id")
    return parsed(docs, keep, entries).select(*keep, F.explode("d").alias("e")).select(
        "price_date",
        F.col("e.productId").alias("product_id"),
        F.col("e.subTypeName").alias("sub_type_name"),
        F.col("e.lowPrice").alias("low_price"),
        F.col("e.midPrice").alias("mid_price"),
        F.col("e.highPrice").alias("high_price"),
        F.col("e.marketPrice").alias("market_price"),
        F.col("e.directLowPrice").alias("direct_low_price"),
        F.col("category_id").cast("bigint").alias("category_id"),
        F.col("group_id").cast("bigint").alias("group_id"),
        loaded_at.alias("update_timestamp"),
    )


# --- graded-card auction documents -------------------------------------------------------------

def auction_rows(docs: DataFrame, scraped_at: Column, text: str = "value") -> DataFrame:
    """Auction documents to one summary row and one row per sale, in one layout.

    ``docs`` holds ``item_id``, ``grade``, ``card_name`` and the document text. An empty document
    gives no rows. Both kinds come out of one pass: each document becomes a small array of records.
    """
    def number(values: Column | None, name: str, kind: str) -> Column:
        return F.lit(None).cast(kind) if values is None else values[name].try_cast("double").try_cast(kind)

    def record(kind: str, summary: Column | None, sale: Column | None) -> Column:
        return F.struct(
            F.lit(kind).alias("record_type"),
            number(summary, "numberOfSales", "bigint").alias("total_sales_count"),
            number(summary, "averagePrice", "double").alias("average_price"),
            number(summary, "medianPrice", "double").alias("median_price"),
            number(summary, "minPrice", "double").alias("min_price"),
            number(summary, "maxPrice", "double").alias("max_price"),
            (F.lit(None).cast("string") if sale is None else sale["dateOfSale"]).alias("sale_date"),
            (F.lit(None).cast("double") if sale is None else sale["price"]).alias("sale_price"),
        )

    keep = ("item_id", "grade", "card_name")
    summary, sales = F.col("d.historicalItemAuctionSummary"), F.col("d.historicalAuctionInfo.highestDailySales")
    records = F.concat(
        # An empty summary counts as absent.
        F.when(F.size(summary) > 0, F.array(record("summary", summary, None))).otherwise(F.array()),
        F.coalesce(F.transform(sales, lambda s: record("sale", None, s)), F.array()),
    )
    rows = parsed(docs, keep, F.from_json(text, schemas.AUCTION_DOCUMENT)).select(
        *keep, F.explode_outer(records).alias("r")
    ).filter("r IS NOT NULL")
    made = {
        "item_id": F.col("item_id"),
        "grade": F.col("grade"),
        "grade_label": F.concat(F.lit("PSA "), F.col("grade")),
        "card_name": F.col("card_name"),
        "scraped_at": scraped_at,
        "data_source": F.lit("psa_api"),
        "lifecycle_sales_count": F.col("r.total_sales_count"),
    }
    from_record = {"record_type", "total_sales_count", "average_price", "median_price", "min_price",
                   "max_price", "sale_date", "sale_price"}
    return rows.select(*[
        (F.col(f"r.{f.name}") if f.name in from_record else made.get(f.name, F.lit(None)))
        .cast(f.dataType).alias(f.name)
        for f in schemas.AUCTION.fields
    ])


# --- search-trend lines ------------------------------------------------------------------------

# The line kind that holds series, and the series that are read.
TREND_KIND = "MetricsTrendsModule"
TREND_SERIES = ("averageSold", "quantity")


def trend_points(lines: DataFrame, text: str = "value", zone: str = "UTC") -> DataFrame:
    """Trend lines to points: ``keyword, line_no, series, pos, date, value``.

    ``lines`` holds ``keyword``, ``line_no`` (any value that orders the lines of a keyword) and the
    line text. Blank, broken and other lines are dropped, and so are NULL points.
    """
    keep = ("keyword", "line_no")
    series = parsed(lines, keep, F.from_json(text, schemas.TREND_LINE)).filter(
        F.col("d._type") == TREND_KIND
    ).select(*keep, F.explode("d.series").alias("s"))
    points = series.filter(F.col("s.id").isin(*TREND_SERIES)).select(
        "keyword", "line_no", F.col("s.id").alias("series"), F.posexplode("s.data").alias("pos", "p")
    )
    value = F.get("p", F.lit(1))
    return points.filter(value.isNotNull()).select(
        "keyword", "line_no", "series", "pos",
        dates.from_epoch_millis(F.get("p", F.lit(0)), zone).cast("date").alias("date"),
        value.alias("value"),
    )


# --- packed price histories --------------------------------------------------------------------

def packed_points(products: DataFrame, series: dict[str, int] | None = None, stride: int = 2,
                  zone: str = "UTC", keys: tuple[str, ...] = ("asin",), packed: str = "csv") -> DataFrame:
    """Packed ``[time, value, ...]`` arrays to points: ``keys, price_type, pos, ts, price``.

    ``packed`` is an array of arrays, one per series position. A trailing incomplete group and the
    "no offer" value -1 are skipped. ``stride`` is 3 for series that carry shipping as well.
    """
    series = series or schemas.PRICE_SERIES
    kinds = F.array(*[
        F.struct(F.lit(name).alias("price_type"), F.get(packed, F.lit(at)).alias("values"))
        for name, at in series.items()
    ])
    per_kind = products.select(*keys, F.inline(kinds))
    whole = F.floor(F.size("values") / F.lit(stride)).cast("int")
    starts = F.transform(F.sequence(F.lit(0), whole - 1), lambda i: i * stride)
    points = F.transform(
        starts,
        lambda i: F.struct(i.alias("pos"), F.get("values", i).alias("minutes"), F.get("values", i + 1).alias("cents")),
    )
    return (
        per_kind.filter(F.size("values") >= stride)
        .select(*keys, "price_type", F.inline(points))
        .filter(F.col("cents") != -1)
        .select(*keys, "price_type", "pos",
                dates.from_packed_minutes("minutes", zone).alias("ts"),
                (F.col("cents") / F.lit(100.0)).alias("price"))
    )


def packed_products(docs: DataFrame, text: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Product documents to ``asin`` and the packed arrays; ``keep`` names columns passed through."""
    return parsed(docs, keep, F.from_json(text, schemas.PACKED_PRODUCT)).select(*keep, "d.asin", "d.csv")


# --- catalog pages -----------------------------------------------------------------------------

def page_results(pages: DataFrame, entry: str, text: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """The entries of ``{"results": [...]}`` pages as rows; ``entry`` is the STRUCT type of one entry."""
    page = F.from_json(text, f"STRUCT<results: ARRAY<{entry}>>")
    return parsed(pages, keep, page).select(*keep, F.inline("d.results"))


def url_ids(files: DataFrame, text: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Product ids of address lists in file order: ``keep, pos, product_id``.

    ``files`` holds the whole text of a list, one address per line. Lines without an id are dropped.
    """
    lines = files.select(*keep, F.posexplode(F.split(text, r"\r?\n")).alias("pos", "line"))
    return lines.withColumn("product_id", product_id_from_url("line")).filter("product_id IS NOT NULL").drop("line")

