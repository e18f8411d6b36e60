"""Domain views built from the test tables, and the same views as SQL.

Every view is derived row by row (or by one aggregation) from a whole table; nothing is filtered out.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import schemas
from ..operators.tables import conform
from ..sources.tables import table

DAY = dt.date(2001, 12, 2)
DAY_BEFORE = dt.date(2001, 12, 1)
SINCE = dt.date(1995, 1, 1)
POSTS_SINCE = dt.date(2010, 1, 1)

# Categories of the catalog view by part type.
TYPES = {"ECONOMY": 1, "LARGE": 2, "MEDIUM": 3, "PROMO": 4, "SMALL": 5, "STANDARD": 6}
CATEGORIES = [TYPES["PROMO"], TYPES["SMALL"], TYPES["STANDARD"]]
# Grades of the auction view by line number.
LINE_GRADES = {1: "10", 2: "9", 3: "8.5", 4: "8", 5: "7", 6: "1.5", 7: "0"}
# Series position and name of the packed view by event type; "purchase" is the rank series.
EVENT_SERIES = {"click": 0, "view": 1, "signup": 2, "purchase": 3, "error": 4}
SERIES_NAMES = {"click": "amazon", "view": "new", "signup": "used", "error": "list_price"}
FAILURE_TYPES = {"click": "download", "view": "extract", "signup": "process", "purchase": "upload", "error": "upload"}
# Message of the failure view by upper bound of the value.
MESSAGES = [(1, "Connection timeout"), (2, "HTTP 404 Not Found"), (4, "Permission denied by host"),
            (8, "Memory limit reached"), (16, "7z error: corrupt archive"), (32, "BigQuery quota exceeded")]
LAST_MESSAGE = "Unexpected end of input stream"


def case(c: Column, values: dict) -> Column:
    """Lookup in a small literal table."""
    out = None
    for key, value in values.items():
        out = F.when(c == key, F.lit(value)) if out is None else out.when(c == key, F.lit(value))
    return out


def dealt(df: DataFrame) -> DataFrame:
    """Rows in pieces of even size: the test tables come in one piece, and texts made from them are costly to read."""
    return df.hint("rebalance")


def sql_case(column: str, values: dict) -> str:
    """The same lookup as SQL."""
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else str(v)

    return f"CASE {column} " + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in values.items()) + " END"


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


class Views:
    """Views over one folder of test tables, built when first used."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.folder, name)

    @cached_property
    def prices(self) -> DataFrame:
        """Price buckets from lineitem; open lines are scraped a day after finished ones."""
        price = F.col("l_extendedprice")
        return self.table("lineitem").select(
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("l_suppkey").cast("string").alias("sku_id"),
            F.col("l_linestatus").alias("variant"),
            F.lit("English").alias("language"),
            F.col("l_returnflag").alias("condition"),
            F.col("l_shipdate").cast("date").alias("bucket_start_date"),
            price.alias("market_price"),
            F.col("l_quantity").cast("bigint").alias("quantity_sold"),
            (price * (1 - F.col("l_discount"))).alias("low_sale_price"),
            (price * (1 + F.col("l_tax"))).alias("high_sale_price"),
            F.col("l_linenumber").cast("bigint").alias("transaction_count"),
            F.when(F.col("l_linestatus") == "F", F.lit(DAY_BEFORE)).otherwise(F.lit(DAY)).alias("scrape_date"),
        )

    @cached_property
    def daily(self) -> DataFrame:
        """Daily prices from lineitem: category by line number, group by return flag."""
        price = F.col("l_extendedprice")
        return self.table("lineitem").select(
            F.col("l_shipdate").cast("date").alias("price_date"),
            F.col("l_partkey").alias("product_id"),
            F.concat("l_returnflag", "l_linestatus").alias("sub_type_name"),
            (price * (1 - F.col("l_discount"))).alias("low_price"),
            (price * (1 + F.col("l_tax"))).alias("high_price"),
            F.when(F.col("l_discount") > 0, price).alias("market_price"),
            F.col("l_linenumber").cast("bigint").alias("category_id"),
            case(F.col("l_returnflag"), {"A": 1, "N": 2, "R": 3}).cast("bigint").alias("group_id"),
        )

    @cached_property
    def catalog(self) -> DataFrame:
        """The part table as a catalog that was loaded twice, a week apart, under other names."""
        def load(day: dt.date, suffix: str) -> DataFrame:
            return self.table("part").select(
                F.col("p_partkey").cast("string").alias("product_id"),
                F.concat("p_name", F.lit(suffix)).alias("product_name"),
                F.concat("p_brand", F.lit(" "), "p_name", F.lit(suffix)).alias("product_clean_name"),
                case(F.col("p_type"), TYPES).cast("bigint").alias("category_id"),
                F.col("p_type").alias("category_name"),
                F.replace("p_brand", F.lit("Brand#"), F.lit("")).cast("bigint").alias("group_id"),
                F.col("p_brand").alias("group_name"),
                F.lit(day).alias("update_date"),
            )

        return load(dt.date(2001, 11, 24), " (old)").unionByName(load(DAY_BEFORE, ""))

    @cached_property
    def categories(self) -> DataFrame:
        return self.table("region").select(F.col("r_regionkey").alias("categoryId"), F.col("r_name").alias("name"))

    @cached_property
    def groups(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").alias("groupId"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("categoryId")
        )

    @cached_property
    def products(self) -> DataFrame:
        """Suppliers as products, with a nested field and a boolean."""
        return self.table("supplier").select(
            F.col("s_suppkey").alias("productId"), F.col("s_name").alias("name"),
            F.col("s_nationkey").alias("groupId"), F.col("s_acctbal").alias("balance"),
            F.array(F.struct(F.lit("Key").alias("name"), F.col("s_suppkey").alias("value"))).alias("extendedData"),
            (F.col("s_acctbal") < 0).alias("isPresale"),
        )

    @cached_property
    def auction_sales(self) -> DataFrame:
        """Sales from lineitem, some of them scraped again half an hour later or the day before too."""
        at = {h: F.lit(t).cast("timestamp_ntz") for h, t in
              {"d0": dt.datetime(2001, 12, 1, 8), "d1": dt.datetime(2001, 12, 2, 8),
               "again": dt.datetime(2001, 12, 2, 8, 30)}.items()}
        scrapes = (
            F.when(F.col("l_returnflag") == "R", F.array(at["d1"], at["again"]))
            .when(F.col("l_returnflag") == "A", F.array(at["d0"], at["d1"]))
            .otherwise(F.array(at["d1"]))
        )
        # Texts are made inside the unfolded records, so that filters on them do not make them again.
        record = F.transform(scrapes, lambda at: F.struct(
            at.alias("scraped_at"),
            F.date_format("l_shipdate", "MM/dd/yyyy").alias("sale_date"),
            F.concat(F.lit("Card "), F.col("l_partkey").cast("string")).alias("card_name"),
        ))
        rows = self.table("lineitem").select(
            F.col("l_partkey").cast("string").alias("item_id"),
            case(F.col("l_linenumber"), LINE_GRADES).alias("grade"),
            F.lit("sale").alias("record_type"),
            F.col("l_extendedprice").alias("sale_price"),
            F.when(F.col("l_linestatus") == "F",
                   F.concat(F.lit("https://cards.example/"), F.col("l_partkey").cast("string"))).alias("psa_url"),
            F.inline(record),
        )
        return conform(rows, schemas.AUCTION)

    @cached_property
    def auction_summaries(self) -> DataFrame:
        """One summary per card and grade, scraped twice in a day; the later one counts one sale more."""
        per_grade = self.table("lineitem").groupBy("l_partkey", "l_linenumber").agg(
            F.count("*").alias("n"), F.min("l_extendedprice").alias("lo"), F.max("l_extendedprice").alias("hi")
        )
        scrapes = F.array(
            F.struct(F.lit(dt.datetime(2001, 12, 2, 7)).cast("timestamp_ntz").alias("at"), F.lit(0).alias("more")),
            F.struct(F.lit(dt.datetime(2001, 12, 2, 9)).cast("timestamp_ntz").alias("at"), F.lit(1).alias("more")),
        )
        rows = per_grade.select("*", F.inline(scrapes)).select(
            F.col("l_partkey").cast("string").alias("item_id"),
            case(F.col("l_linenumber"), LINE_GRADES).alias("grade"),
            F.lit("summary").alias("record_type"),
            (F.col("n") + F.col("more")).alias("total_sales_count"),
            F.col("lo").alias("min_price"), F.col("hi").alias("max_price"),
            F.concat(F.lit("Card "), F.col("l_partkey").cast("string")).alias("card_name"),
            F.col("at").alias("scraped_at"),
        )
        return conform(rows, schemas.AUCTION)

    @cached_property
    def auctions(self) -> DataFrame:
        return self.auction_sales.unionByName(self.auction_summaries)

    @cached_property
    def submissions(self) -> DataFrame:
        """Documents as submissions: the first line is the title, the rest the text."""
        first_break = F.instr("text", "\n")
        body = F.when(first_break > 0, F.expr(r"substr(text, instr(text, '\n') + 1)"))
        rows = dealt(self.table("documents")).select(
            F.col("doc_id").cast("string").alias("id"),
            F.when(F.col("source") == "src0", "[deleted]").otherwise(F.col("source")).alias("author"),
            F.date_add(F.lit(dt.date(2009, 6, 1)), (F.col("n_chars") % 5000).cast("int"))
            .cast("timestamp_ntz").alias("created_utc"),
            F.substring_index("text", "\n", 1).alias("title"),
            F.when(F.col("source") == "src1", "[deleted]").otherwise(body).alias("selftext"),
            F.concat(F.lit("r/"), "lang").alias("subreddit_name_prefixed"),
            F.col("n_chars").alias("score"),
        )
        return conform(rows, schemas.SUBMISSION)

    @cached_property
    def comments(self) -> DataFrame:
        """Conversation turns as comments."""
        conv = F.col("conv_id").cast("string")
        rows = dealt(self.table("conversations")).select(
            F.concat(conv, F.lit("-"), F.col("turn").cast("string")).alias("id"),
            F.when(F.col("role") == "system", "[deleted]").otherwise(F.col("role")).alias("author"),
            F.date_add(F.lit(dt.date(2009, 6, 1)), (F.col("conv_id") % 4000).cast("int"))
            .cast("timestamp_ntz").alias("created_utc"),
            F.col("text").alias("body"),
            F.col("turn").alias("score"),
            conv.alias("parent_id"),
            conv.alias("link_id"),
            F.lit("r/talk").alias("subreddit_name_prefixed"),
        )
        return conform(rows, schemas.COMMENT)

    @cached_property
    def ticks(self) -> DataFrame:
        """Events with the number inside their JSON properties."""
        return self.table("events").withColumn("k", _k())

    @cached_property
    def trend_lines(self) -> DataFrame:
        """One line of a trend file per event; some lines are of another kind or broken."""
        ms = F.unix_millis(F.col("ts").cast("timestamp")).cast("double")
        line = F.to_json(F.struct(
            F.lit("MetricsTrendsModule").alias("_type"),
            F.array(
                F.struct(F.lit("averageSold").alias("id"),
                         F.array(F.array(ms, F.col("value")),
                                 F.array(ms + 86400000.0, F.lit(None).cast("double"))).alias("data")),
                F.struct(F.lit("quantity").alias("id"),
                         F.array(F.array(ms, F.col("k").cast("double"))).alias("data")),
            ).alias("series"),
        ))
        return dealt(self.table("events")).withColumn("k", _k()).select(
            F.concat(F.lit("kw_"), F.col("user_id").cast("string")).alias("keyword"),
            F.col("event_id").alias("line_no"),
            F.when(F.col("event_type") == "error", '{"_type": "Other"}')
            .when(F.col("event_type") == "signup", "not json").otherwise(line).alias("value"),
        )

    @cached_property
    def packed_documents(self) -> DataFrame:
        """One product document per event: a packed series with a gap, two prices and an odd tail."""
        minutes = (F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 60) - 21564000).cast("bigint")
        cents = F.round(F.col("value") * 100).cast("bigint")
        packed = F.array(minutes, cents, minutes + 60, F.lit(-1).cast("bigint"),
                         minutes + 120, cents * 2, minutes + 180)
        at = case(F.col("event_type"), EVENT_SERIES)
        csv = F.transform(F.sequence(F.lit(0), F.lit(10)), lambda i: F.when(i == at, packed))
        doc = F.to_json(F.struct(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("asin"), csv.alias("csv")))
        return dealt(self.table("events")).select("event_id", doc.alias("value"))

    @cached_property
    def run_log(self) -> DataFrame:
        return self.ticks.select(
            F.col("user_id").cast("string").alias("run_id"),
            F.col("ts").cast("date").alias("date"),
            F.col("event_type").alias("step"),
            F.when(F.col("event_type") == "error", "failed").otherwise("completed").alias("status"),
            F.col("k").alias("record_count"),
            F.col("value").alias("processing_time"),
            F.col("ts").alias("event_time"),
            "event_id",
        )

    @cached_property
    def failures(self) -> DataFrame:
        message = None
        for bound, text in MESSAGES:
            test = F.col("value") < bound
            message = F.when(test, text) if message is None else message.when(test, text)
        return self.ticks.select(
            F.col("ts").cast("date").alias("date"),
            case(F.col("event_type"), FAILURE_TYPES).alias("failure_type"),
            message.otherwise(LAST_MESSAGE).alias("error_message"),
        )

    @cached_property
    def requests(self) -> DataFrame:
        """Events as a request log per endpoint."""
        return self.ticks.select(
            F.col("user_id").cast("string").alias("endpoint"),
            F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "signup", "rate_limited")
            .otherwise("success").alias("status"),
            F.col("value").alias("response_time"),
            F.col("ts").alias("event_time"),
            "event_id",
        )

    @cached_property
    def archive_names(self) -> DataFrame:
        """Archive names in every accepted form, and two without a date."""
        day, priority = F.col("o_orderdate"), F.substring("o_orderpriority", 1, 1)
        name = (
            F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("cards_"), F.date_format(day, "yyyy-MM-dd")))
            .when(F.col("o_orderstatus") == "F", F.concat(F.lit("data_"), F.date_format(day, "yyyyMMdd")))
            .when(priority == "5", F.concat(F.lit("details_"), F.date_format(day, "yyyy-MM")))
            .when(priority == "4", F.concat(F.lit("d_"), F.date_format(day, "yyyy_MM_dd")))
            .when(priority == "3", F.concat(F.lit("d_"), F.date_format(day, "yyyy-MM"), F.lit("-45")))
            .when(priority == "2", F.lit("nodate"))
            .otherwise(F.lit("d_20251345"))
        )
        return self.table("orders").select(
            "o_orderkey", name.alias("name"), (day + F.make_dt_interval(days=F.lit(1))).alias("modified")
        )


_SALE_SCRAPES = (
    "CASE l_returnflag WHEN 'R' THEN [TIMESTAMP '2001-12-02 08:00:00', TIMESTAMP '2001-12-02 08:30:00'] "
    "WHEN 'A' THEN [TIMESTAMP '2001-12-01 08:00:00', TIMESTAMP '2001-12-02 08:00:00'] "
    "ELSE [TIMESTAMP '2001-12-02 08:00:00'] END"
)

_CATALOG_LOAD = """
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name || '{suffix}' AS product_name,
           p_brand || ' ' || p_name || '{suffix}' AS product_clean_name,
           CAST(""" + sql_case("p_type", TYPES) + """ AS BIGINT) AS category_id, p_type AS category_name,
           CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS group_id, p_brand AS group_name,
           DATE '{day}' AS update_date
    FROM part"""

SQL_VIEWS = {
    "prices": """
        SELECT CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS sku_id,
               l_linestatus AS variant, 'English' AS language, l_returnflag AS condition,
               CAST(l_shipdate AS DATE) AS bucket_start_date, l_extendedprice AS market_price,
               CAST(l_quantity AS BIGINT) AS quantity_sold,
               l_extendedprice * (1 - l_discount) AS low_sale_price,
               l_extendedprice * (1 + l_tax) AS high_sale_price,
               CAST(l_linenumber AS BIGINT) AS transaction_count,
               CASE WHEN l_linestatus = 'F' THEN DATE '2001-12-01' ELSE DATE '2001-12-02' END AS scrape_date,
               CAST(date_trunc('week', l_shipdate) AS DATE) AS week_start
        FROM lineitem""",
    "daily": """
        SELECT CAST(l_shipdate AS DATE) AS price_date, l_partkey AS product_id,
               l_returnflag || l_linestatus AS sub_type_name,
               l_extendedprice * (1 - l_discount) AS low_price,
               l_extendedprice * (1 + l_tax) AS high_price,
               CASE WHEN l_discount > 0 THEN l_extendedprice END AS market_price,
               CAST(l_linenumber AS BIGINT) AS category_id,
               CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 WHEN 'R' THEN 3 END AS BIGINT) AS group_id
        FROM lineitem""",
    "catalog": _CATALOG_LOAD.format(suffix=" (old)", day="2001-11-24") + " UNION ALL "
        + _CATALOG_LOAD.format(suffix="", day="2001-12-01"),
    "newest": "SELECT * FROM catalog WHERE update_date = DATE '2001-12-01'",
    "auctions": f"""
        SELECT CAST(l_partkey AS VARCHAR) AS item_id, {sql_case("l_linenumber", LINE_GRADES)} AS grade,
               'sale' AS record_type, CAST(NULL AS BIGINT) AS total_sales_count,
               CAST(NULL AS DOUBLE) AS min_price, CAST(NULL AS DOUBLE) AS max_price,
               strftime(l_shipdate, '%m/%d/%Y') AS sale_date, l_extendedprice AS sale_price,
               'Card ' || l_partkey AS card_name,
               CASE WHEN l_linestatus = 'F' THEN 'https://cards.example/' || l_partkey END AS psa_url,
               unnest({_SALE_SCRAPES}) AS scraped_at
        FROM lineitem
        UNION ALL
        SELECT CAST(l_partkey AS VARCHAR), {sql_case("l_linenumber", LINE_GRADES)}, 'summary', n + m.more,
               lo, hi, NULL, NULL, 'Card ' || l_partkey, NULL, m.seen
        FROM (SELECT l_partkey, l_linenumber, COUNT(*) AS n, MIN(l_extendedprice) AS lo, MAX(l_extendedprice) AS hi
              FROM lineitem GROUP BY l_partkey, l_linenumber)
        CROSS JOIN (VALUES (TIMESTAMP '2001-12-02 07:00:00', 0), (TIMESTAMP '2001-12-02 09:00:00', 1)) AS m(seen, more)""",
    # Usable sales of the day and what remains of them after removing repeats.
    "sales": """
        SELECT card_name, grade AS psa_level, sale_price AS auction_price, psa_url,
               CAST(strptime(sale_date, '%m/%d/%Y') AS DATE) AS auction_date,
               CAST(date_trunc('week', strptime(sale_date, '%m/%d/%Y')) AS DATE) AS week_start, scraped_at
        FROM auctions
        WHERE record_type = 'sale' AND scraped_at >= TIMESTAMP '2001-12-02' AND scraped_at < TIMESTAMP '2001-12-03'
          AND sale_price > 0 AND card_name <> '' AND grade IS NOT NULL AND sale_date <> ''
          AND strptime(sale_date, '%m/%d/%Y') >= DATE '1995-01-01'""",
    "totals": """
        SELECT card_name, grade AS psa_level, arg_max(total_sales_count, scraped_at) AS total_sales_count
        FROM auctions
        WHERE record_type = 'summary' AND scraped_at >= TIMESTAMP '2001-12-02' AND scraped_at < TIMESTAMP '2001-12-03'
        GROUP BY ALL""",
    "session": """
        SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY card_name, psa_level, auction_date, auction_price
                                                    ORDER BY scraped_at, psa_url NULLS FIRST) AS rn FROM sales)
        WHERE rn = 1""",
    "weekly": """
        SELECT card_name, psa_level, week_start,
               CAST(ROUND(CAST(CAST(SUM(CAST(auction_price AS DECIMAL(24,6))) AS DOUBLE) / COUNT(*) AS DECIMAL(24,6)), 2)
                    AS DOUBLE) AS avg_price,
               COUNT(*) AS transaction_count,
               COALESCE(MAX(t.total_sales_count), 0) AS total_sales_count,
               arg_min(psa_url, (auction_date, auction_price)) FILTER (WHERE psa_url IS NOT NULL) AS psa_url
        FROM session LEFT JOIN totals t USING (card_name, psa_level)
        GROUP BY card_name, psa_level, week_start""",
    "best": """
        SELECT card_name, arg_min(total_sales_count, (psa_level, week_start)) AS lifecycle_sales
        FROM weekly GROUP BY card_name ORDER BY lifecycle_sales DESC, card_name LIMIT 10""",
    "top_weekly": """
        SELECT b.card_order, w.card_name, w.psa_level, CAST(w.psa_level AS DOUBLE) AS psa_numeric,
               COUNT(*) OVER (PARTITION BY w.card_name, w.psa_level) AS price_points, b.lifecycle_sales,
               COALESCE(first_value(w.psa_url) OVER (PARTITION BY w.card_name, w.psa_level
                   ORDER BY CASE WHEN w.psa_url IS NULL THEN 1 ELSE 0 END, w.week_start), '') AS psa_url,
               w.week_start, w.avg_price
        FROM weekly w JOIN (SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY lifecycle_sales DESC, card_name) - 1 AS INTEGER) AS card_order
                            FROM best) b USING (card_name)""",
    "submissions": """
        SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN source = 'src0' THEN '[deleted]' ELSE source END AS author,
               CAST(DATE '2009-06-01' + CAST(n_chars % 5000 AS INTEGER) AS TIMESTAMP) AS created_utc,
               split_part(text, chr(10), 1) AS title,
               CASE WHEN source = 'src1' THEN '[deleted]'
                    WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1) END AS selftext,
               'r/' || lang AS subreddit_name_prefixed, n_chars AS score
        FROM documents""",
    "comments": """
        SELECT conv_id || '-' || turn AS id, CASE WHEN role = 'system' THEN '[deleted]' ELSE role END AS author,
               CAST(DATE '2009-06-01' + CAST(conv_id % 4000 AS INTEGER) AS TIMESTAMP) AS created_utc,
               text AS body, turn AS score, CAST(conv_id AS VARCHAR) AS parent_id, CAST(conv_id AS VARCHAR) AS link_id,
               'r/talk' AS subreddit_name_prefixed
        FROM conversations""",
    "ticks": "SELECT *, CAST(props->>'$.k' AS BIGINT) AS k FROM events",
    "points": f"""
        SELECT 'u' || user_id AS asin, event_id, p.pos,
               {sql_case("event_type", SERIES_NAMES)} AS price_type,
               date_trunc('minute', ts) + to_minutes(p.later) AS ts,
               CAST(ROUND(value * 100) AS BIGINT) * p.times / 100.0 AS price
        FROM ticks CROSS JOIN (VALUES (0, 0, 1), (4, 120, 2)) AS p(pos, later, times)
        WHERE event_type <> 'purchase'""",
    "trend_values": """
        SELECT 'kw_' || user_id AS keyword, CAST(ts AS DATE) AS date, arg_max(value, event_id) AS price,
               CAST(arg_max(k, event_id) AS DOUBLE) AS quantity
        FROM ticks WHERE event_type NOT IN ('error', 'signup') GROUP BY ALL""",
    "run_log": """
        SELECT CAST(user_id AS VARCHAR) AS run_id, CAST(ts AS DATE) AS date, event_type AS step,
               CASE WHEN event_type = 'error' THEN 'failed' ELSE 'completed' END AS status, k AS record_count,
               value AS processing_time, ts AS event_time, event_id
        FROM ticks""",
    "run_status": """
        SELECT date, arg_max(status, (event_time, event_id)) AS status,
               CAST(COALESCE(SUM(record_count) FILTER (WHERE status = 'completed'), 0) AS BIGINT) AS record_count,
               COALESCE(CAST(SUM(CAST(processing_time AS DECIMAL(24,6))) FILTER (WHERE status = 'completed') AS DOUBLE), 0)
                   AS processing_time,
               COUNT(*) FILTER (WHERE status = 'completed') AS completed_runs
        FROM run_log GROUP BY date""",
    "failures": f"""
        SELECT CAST(ts AS DATE) AS date, {sql_case("event_type", FAILURE_TYPES)} AS failure_type,
               CASE {" ".join(f"WHEN value < {b} THEN '{m}'" for b, m in MESSAGES)} ELSE '{LAST_MESSAGE}' END AS error_message
        FROM ticks""",
    "by_type": """
        SELECT failure_type || '_failures' AS pattern_type, failure_type, frequency, dates_affected, common_error,
               CASE WHEN failure_type IN ('download', 'extract') AND frequency > 20 THEN 'critical'
                    WHEN failure_type = 'upload' AND frequency > 10 THEN 'high' WHEN dates_affected > 10 THEN 'high'
                    WHEN frequency > 5 THEN 'medium' ELSE 'low' END AS severity
        FROM (SELECT failure_type, COUNT(*) AS frequency, COUNT(DISTINCT date) AS dates_affected
              FROM failures GROUP BY failure_type)
        JOIN (SELECT failure_type, error_message AS common_error FROM (
                SELECT *, ROW_NUMBER() OVER (PARTITION BY failure_type ORDER BY n DESC, error_message) AS rn
                FROM (SELECT failure_type, error_message, COUNT(*) AS n FROM failures GROUP BY ALL)) WHERE rn = 1)
            USING (failure_type)
        WHERE frequency >= 2""",
    "error_groups": """
        SELECT error_key, COUNT(*) AS frequency, COUNT(DISTINCT date) AS dates_affected,
               CASE WHEN COUNT(*) > 10 THEN 'high' ELSE 'medium' END AS severity
        FROM (SELECT date, CASE
                WHEN contains(error_message, 'Connection') OR contains(lower(error_message), 'timeout') THEN 'connection_error'
                WHEN contains(error_message, '404') OR contains(error_message, 'Not Found') THEN 'file_not_found'
                WHEN contains(error_message, 'Permission') OR contains(error_message, 'Forbidden') THEN 'permission_error'
                WHEN contains(error_message, 'Memory') THEN 'memory_error'
                WHEN contains(error_message, '7z') OR contains(lower(error_message), 'extract') THEN 'extraction_error'
                WHEN contains(error_message, 'BigQuery') OR contains(error_message, 'GCP') THEN 'bigquery_error'
                ELSE lower(array_to_string(string_split(error_message, ' ')[1:3], '_')) END AS error_key
              FROM failures)
        GROUP BY error_key HAVING COUNT(*) >= 3""",
    "clusters": """
        SELECT 'temporal_clustering' AS pattern_type, COUNT(*) AS frequency, COUNT(*) AS dates_affected,
               CASE WHEN COUNT(*) < 5 THEN 'medium' ELSE 'high' END AS severity
        FROM (SELECT date FROM failures GROUP BY date HAVING COUNT(*) > 2) HAVING COUNT(*) >= 2""",
}


def with_views(*names: str) -> str:
    """A WITH clause over some views, in the order given."""
    return "WITH " + ", ".join(f"{n} AS ({SQL_VIEWS[n]})" for n in names) + " "
