"""Table and document layouts. Field names are fixed values: they are the data formats."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType, DoubleType, IntegerType, LongType, MapType, StringType, StructField, StructType, TimestampNTZType,
)

_TYPES = {
    "STRING": StringType(), "BIGINT": LongType(), "INT": IntegerType(), "DOUBLE": DoubleType(), "DATE": DateType(),
    "TIMESTAMP_NTZ": TimestampNTZType(), "TEXT_MAP": MapType(StringType(), StringType()),
}


def _flat(text: str) -> StructType:
    """A flat layout from ``name TYPE [NOT NULL]`` entries."""
    fields = []
    for entry in text.split(","):
        name, kind, *rest = entry.split()
        fields.append(StructField(name, _TYPES[kind], nullable=not rest))
    return StructType(fields)


def _nested(text: str) -> str:
    """A document layout as DDL text, the form that JSON parsing takes."""
    return " ".join(text.split())


# One graded-card auction record; record_type is 'summary' or 'sale'.
AUCTION = _flat("""
    item_id STRING, grade STRING, grade_label STRING, record_type STRING,
    total_sales_count BIGINT, average_price DOUBLE, median_price DOUBLE, min_price DOUBLE, max_price DOUBLE,
    std_deviation DOUBLE, date_range_start STRING, date_range_end STRING,
    sale_date STRING, sale_price DOUBLE, scraped_at TIMESTAMP_NTZ, data_source STRING,
    card_name STRING, card_set STRING, card_year BIGINT, card_variant STRING, psa_url STRING,
    lifecycle_sales_count BIGINT
""")

# The summary is read as a map, which tells an empty one from one with unknown fields.
AUCTION_DOCUMENT = _nested("""
    historicalItemAuctionSummary MAP<STRING, STRING>,
    historicalAuctionInfo STRUCT<highestDailySales: ARRAY<STRUCT<dateOfSale: STRING, price: DOUBLE>>>
""")

# One price bucket of one product variant.
PRICE_BUCKET = _flat("""
    product_id STRING NOT NULL, sku_id STRING, variant STRING, language STRING, condition STRING,
    average_daily_quantity_sold STRING, average_daily_transaction_count STRING,
    total_quantity_sold STRING, total_transaction_count STRING,
    bucket_start_date DATE, market_price DOUBLE, quantity_sold BIGINT,
    low_sale_price DOUBLE, low_sale_price_with_shipping DOUBLE,
    high_sale_price DOUBLE, high_sale_price_with_shipping DOUBLE,
    transaction_count BIGINT, scrape_date DATE NOT NULL, source_file STRING
""")

# Values may be JSON numbers or text, so every leaf is read as text and typed afterwards.
PRICE_DOCUMENT = _nested("""
    result ARRAY<STRUCT<skuId: STRING, variant: STRING, language: STRING, condition: STRING,
        averageDailyQuantitySold: STRING, averageDailyTransactionCount: STRING,
        totalQuantitySold: STRING, totalTransactionCount: STRING,
        buckets: ARRAY<STRUCT<bucketStartDate: STRING, marketPrice: STRING, quantitySold: STRING,
            lowSalePrice: STRING, lowSalePriceWithShipping: STRING,
            highSalePrice: STRING, highSalePriceWithShipping: STRING, transactionCount: STRING>>>>
""")

# One product in the daily price list.
DAILY_PRICE = _flat("""
    price_date DATE, product_id BIGINT, sub_type_name STRING, low_price DOUBLE, mid_price DOUBLE,
    high_price DOUBLE, market_price DOUBLE, direct_low_price DOUBLE,
    category_id BIGINT, group_id BIGINT, update_timestamp TIMESTAMP_NTZ
""")

DAILY_PRICE_ENTRY = (
    "STRUCT<productId: BIGINT, subTypeName: STRING, lowPrice: DOUBLE, midPrice: DOUBLE, highPrice: DOUBLE, "
    "marketPrice: DOUBLE, directLowPrice: DOUBLE>"
)

COMMENT = _flat("""
    id STRING, author STRING, created_utc TIMESTAMP_NTZ, body STRING, score BIGINT,
    parent_id STRING, link_id STRING, subreddit_name_prefixed STRING
""")

SUBMISSION = _flat("""
    id STRING, author STRING, created_utc TIMESTAMP_NTZ, title STRING, selftext STRING,
    subreddit_name_prefixed STRING, num_comments BIGINT, score BIGINT
""")

CARD_LIST = _flat("card_number INT, card_name STRING, card_id STRING, url STRING, lifecycle_sales_count BIGINT")
GRADE_LIST = _flat("grade_value STRING, grade_label STRING")

TREND_LINE = _nested("_type STRING, series ARRAY<STRUCT<id: STRING, data: ARRAY<ARRAY<DOUBLE>>>>")

PACKED_PRODUCT = _nested("asin STRING, csv ARRAY<ARRAY<BIGINT>>")

MANIFEST = _flat("""
    filepath STRING, scrape_date DATE, upload_timestamp TIMESTAMP_NTZ, record_count BIGINT,
    rejected_count BIGINT, reason STRING
""")

FAILURE = _flat("""
    date DATE, timestamp STRING, failure_type STRING, error_message STRING, error_code STRING,
    retry_count INT, recovery_action STRING, context TEXT_MAP
""")

RUN_EVENT = _flat("""
    run_id STRING, date DATE, step STRING, status STRING, record_count BIGINT, processing_time DOUBLE,
    event_time TIMESTAMP_NTZ
""")

# Grades of the card list, best first; '0' means authentic only.
GRADES = ["10", "9", "8.5", "8", "7.5", "7", "6.5", "6", "5.5", "5",
          "4.5", "4", "3.5", "3", "2.5", "2", "1.5", "1", "0"]

# Price series by their position in a packed history; position 3 is a rank, not a price.
PRICE_SERIES = {
    "amazon": 0, "new": 1, "used": 2, "list_price": 4, "collectible": 5, "refurbished": 6,
    "lightning_deal": 8, "warehouse": 9, "new_fba": 10,
}
