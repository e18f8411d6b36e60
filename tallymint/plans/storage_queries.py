"""Queries that write tables or files derived from the test tables and read them back."""

from __future__ import annotations

import datetime as dt
import io
import itertools
import shutil
import struct
import zipfile
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import schemas
from ..functions.money import money_total
from ..operators import auctions, dedup, tables, versions
from ..session import removed, shuffles_removed, workspace
from ..sources import archives, documents, files
from ..streaming import ingest
from .registry import query
from .views import DAY, DAY_BEFORE, LINE_GRADES, SINCE, Views, case, dealt, sql_case, with_views

CLUSTER = ["product_id", "language", "condition"]

FACTS_SQL = """SELECT scrape_date, condition, COUNT(*) AS n, CAST(SUM(quantity_sold) AS BIGINT) AS quantity,
    CAST(SUM(CAST(market_price AS DECIMAL(24,6))) AS DOUBLE) AS value,
    MIN(bucket_start_date) AS first_day, MAX(bucket_start_date) AS last_day
    FROM {0} GROUP BY scrape_date, condition"""


def facts(df: DataFrame) -> DataFrame:
    return df.groupBy("scrape_date", "condition").agg(
        F.count("*").alias("n"), F.sum("quantity_sold").alias("quantity"), money_total("market_price").alias("value"),
        F.min("bucket_start_date").alias("first_day"), F.max("bucket_start_date").alias("last_day"))


def of_day(df: DataFrame, day: dt.date) -> DataFrame:
    return df.filter(F.col("scrape_date") == F.lit(day))


@query("sink_append", with_views("prices") + FACTS_SQL.format("prices"))
def sink_append(v: Views) -> DataFrame:
    path = workspace(v.spark, "append")
    tables.append(of_day(v.prices, DAY_BEFORE), path, "scrape_date", CLUSTER)
    tables.append(of_day(v.prices, DAY), path, "scrape_date", CLUSTER)
    return facts(v.spark.read.parquet(path))


@query("sink_replace", with_views("prices") + FACTS_SQL.format("(SELECT * FROM prices WHERE scrape_date = DATE '2001-12-02')"))
def sink_replace(v: Views) -> DataFrame:
    path = workspace(v.spark, "replace")
    tables.replace(of_day(v.prices, DAY_BEFORE), path, "scrape_date", CLUSTER)
    tables.replace(of_day(v.prices, DAY), path, "scrape_date", CLUSTER)
    return facts(v.spark.read.parquet(path))


@query("sink_clustered", with_views("prices") + """SELECT scrape_date, product_id, COUNT(*) AS n,
    CAST(SUM(quantity_sold) AS BIGINT) AS quantity FROM prices WHERE product_id = '42' GROUP BY ALL""")
def sink_clustered(v: Views) -> DataFrame:
    path = workspace(v.spark, "clustered")
    tables.replace(v.prices, path, "scrape_date", CLUSTER)
    return v.spark.read.parquet(path).filter("product_id = '42'").groupBy("scrape_date", "product_id").agg(
        F.count("*").alias("n"), F.sum("quantity_sold").alias("quantity"))


@query("replace_partition", with_views("prices") + FACTS_SQL.format(
    "(SELECT * REPLACE (CASE WHEN scrape_date = DATE '2001-12-02' THEN quantity_sold + 1 ELSE quantity_sold END "
    "AS quantity_sold) FROM prices)"))
def replace_partition(v: Views) -> DataFrame:
    path = workspace(v.spark, "days")
    tables.replace(v.prices, path, "scrape_date", CLUSTER)
    again = of_day(v.prices, DAY).withColumn("quantity_sold", F.col("quantity_sold") + 1)
    for _ in range(2):  # the second run changes nothing
        tables.replace_days(again, path, "scrape_date", CLUSTER)
    return facts(v.spark.read.parquet(path))


@query("retention_filter", with_views("prices") + """SELECT scrape_date, COUNT(*) AS n FROM prices
    WHERE bucket_start_date >= DATE '2001-12-02' - 1000 GROUP BY scrape_date""")
def retention_filter(v: Views) -> DataFrame:
    return tables.retain(v.prices, "bucket_start_date", 1000, DAY).groupBy("scrape_date").agg(F.count("*").alias("n"))


@query("delete_day", with_views("prices") + FACTS_SQL.format("(SELECT * FROM prices WHERE scrape_date <> DATE '2001-12-01')"))
def delete_day(v: Views) -> DataFrame:
    name, path = catalog_table(v)
    schema = v.spark.table(name).schema
    tables.drop_days(v.spark, name, "scrape_date", [DAY_BEFORE])
    return facts(v.spark.read.schema(schema).parquet(path))  # what storage holds, not the catalog


@query("partition_stats", with_views("prices") + "SELECT scrape_date, COUNT(*) AS total_rows FROM prices GROUP BY 1")
def partition_stats(v: Views) -> DataFrame:
    path = workspace(v.spark, "stats")
    tables.replace(v.prices, path, "scrape_date", CLUSTER)
    return tables.partition_stats(v.spark.read.parquet(path), "scrape_date").select("scrape_date", "total_rows")


def catalog_table(v: Views) -> tuple[str, str]:
    """A catalog table with all prices, in its own layout: its name and folder."""
    path = workspace(v.spark, "catalog")
    name = "prices_" + path.rsplit("-", 1)[-1]
    last = [c for c in v.prices.columns if c != "scrape_date"] + ["scrape_date"]
    tables.create_table(v.spark, name, v.prices.select(*last).schema, "scrape_date", path, tuple(CLUSTER))
    tables.insert(v.prices, name)
    return name, path


@query("table_facts", with_views("prices") + """SELECT COUNT(*) AS num_rows, 12 AS num_columns,
    COUNT(DISTINCT scrape_date) AS days, TRUE AS same_bytes, TRUE AS sorted_files, 'scrape_date' AS partitioned_by,
    'product_id, language, condition' AS clustered_by FROM prices""")
def table_facts(v: Views) -> DataFrame:
    """Facts of a catalog table: its layout is read back from the catalog, its files are sorted as it says."""
    name, path = catalog_table(v)
    stored = v.spark.read.parquet(path)
    listed = tables.partition_stats(stored, "scrape_date").agg(
        F.count("*").alias("days"), F.sum("total_bytes").alias("all_bytes"), F.sum("files").alias("all_files"))
    numbered = stored.select("product_id", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"))
    before = F.lag("product_id").over(Window.partitionBy("file").orderBy("at"))
    unsorted = numbered.withColumn("before", before).agg(F.count_if(F.col("before") > F.col("product_id")).alias("unsorted"))
    return tables.table_facts(v.spark, name).crossJoin(listed).crossJoin(unsorted).select(
        "num_rows", "num_columns", "days",
        ((F.col("num_bytes") == F.col("all_bytes")) & (F.col("files") == F.col("all_files"))).alias("same_bytes"),
        (F.col("unsorted") == 0).alias("sorted_files"), "partitioned_by", "clustered_by")


@query("catalog_replace_days", with_views("prices") + FACTS_SQL.format(
    "(SELECT * REPLACE (CASE WHEN scrape_date = DATE '2001-12-02' THEN quantity_sold + 1 ELSE quantity_sold END "
    "AS quantity_sold) FROM prices)"))
def catalog_replace_days(v: Views) -> DataFrame:
    """One day of a catalog table replaced, twice, in the table's own layout."""
    name, _ = catalog_table(v)
    again = of_day(v.prices, DAY).withColumn("quantity_sold", F.col("quantity_sold") + 1)
    for _ in range(2):
        tables.insert(again, name, replace_days=True)
    return facts(v.spark.table(name))


@query("dedup_copy", with_views("auctions") + f"""SELECT CAST(scraped_at AS DATE) AS scrape_date, grade, COUNT(*) AS n,
      'scrape_date' AS partitioned_by, 'item_id, grade' AS clustered_by
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {', '.join(dedup.HISTORY_KEYS)} ORDER BY scraped_at DESC) AS rn
          FROM auctions) WHERE rn = 1 GROUP BY ALL""")
def dedup_copy(v: Views) -> DataFrame:
    """The newest rows of each key as a partitioned, clustered table of their own."""
    path = workspace(v.spark, "copy")
    name = "auctions_" + path.rsplit("-", 1)[-1]
    rows = dedup.keep_one(v.auctions, dedup.HISTORY_KEYS, "scraped_at").withColumn("scrape_date", F.to_date("scraped_at"))
    tables.create_table(v.spark, name, rows.schema, "scrape_date", path, ("item_id", "grade"))
    tables.insert(rows, name)
    layout = tables.table_facts(v.spark, name).select("partitioned_by", "clustered_by")
    return v.spark.table(name).groupBy("scrape_date", "grade").agg(F.count("*").alias("n")).crossJoin(F.broadcast(layout))


@query("scan_csv_roundtrip", with_views("prices") + FACTS_SQL.format("prices"))
def scan_csv_roundtrip(v: Views) -> DataFrame:
    path = workspace(v.spark, "csv")
    tables.write_csv(v.prices, path)
    return facts(files.read_csv(v.spark, path, v.prices.schema))


# --- nested documents --------------------------------------------------------------------------

BUCKETS_SQL = """SELECT product_id, sku_id, variant, language, condition, scrape_date,
    CASE WHEN condition <> 'N' THEN bucket_start_date END AS bucket_start_date,
    CASE WHEN condition <> 'N' THEN market_price END AS market_price,
    CASE WHEN condition <> 'N' THEN quantity_sold END AS quantity_sold,
    CASE WHEN condition <> 'N' THEN low_sale_price END AS low_sale_price,
    CASE WHEN condition <> 'N' THEN transaction_count END AS transaction_count FROM prices"""
BUCKET_COLUMNS = ["product_id", "sku_id", "variant", "language", "condition", "scrape_date", "bucket_start_date",
                  "market_price", "quantity_sold", "low_sale_price", "transaction_count"]


def price_documents(v: Views, prices: DataFrame | None = None, *keep: str) -> DataFrame:
    """One price document per bucket; condition N comes without buckets. ``keep`` names columns passed through."""
    prices = dealt(v.prices) if prices is None else prices
    bucket = F.struct(
        F.date_format("bucket_start_date", "yyyy-MM-dd").alias("bucketStartDate"),
        F.col("market_price").cast("string").alias("marketPrice"),
        F.col("quantity_sold").cast("string").alias("quantitySold"),
        F.col("low_sale_price").alias("lowSalePrice"),
        F.col("transaction_count").alias("transactionCount"),
    )
    result = F.struct(
        F.col("sku_id").alias("skuId"), "variant", "language", "condition",
        F.when(F.col("condition") != "N", F.array(bucket)).otherwise(F.array()).alias("buckets"),
    )
    doc = F.to_json(F.struct(F.col("product_id").alias("productId"), F.array(result).alias("result")))
    return prices.select("product_id", "scrape_date",
                         F.concat("product_id", F.lit(".json")).alias("source_file"), doc.alias("value"), *keep)


@query("flatten_price_json", with_views("prices") + BUCKETS_SQL)
def flatten_price_json(v: Views) -> DataFrame:
    return documents.price_rows(price_documents(v)).select(*BUCKET_COLUMNS)


@query("scan_price_json", with_views("prices") + BUCKETS_SQL.replace("product_id, sku_id", "sku_id AS product_id, sku_id")
       .replace("scrape_date,", "DATE '2001-12-02' AS scrape_date,"))
def scan_price_json(v: Views) -> DataFrame:
    """Here a seller stands for a product: its documents share one folder, whose name carries the id."""
    path = workspace(v.spark, "price-json")
    # Rows move and are sorted before they become texts, and each task commits its own folders: they are as many as sellers.
    rows = v.prices.withColumn("seller", F.col("sku_id").cast("bigint")).hint("rebalance", "seller").sortWithinPartitions("seller")
    price_documents(v, rows, "seller").select("seller", "value").write.partitionBy("seller") \
        .option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(path)
    ident = F.regexp_extract("path", r"seller=(\d+)/[^/]+$", 1)
    return files.scan_price_json(v.spark, path, F.lit(DAY), whole=False, glob="*.txt", product_id=ident) \
        .select(*BUCKET_COLUMNS)


@query("scan_daily_prices", """SELECT CASE WHEN l_linestatus = 'F' THEN DATE '2001-12-01' ELSE DATE '2001-12-02' END
      AS price_date, l_partkey AS product_id, l_returnflag AS sub_type_name, l_extendedprice AS market_price,
      CAST(l_linenumber AS BIGINT) AS category_id,
      CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS BIGINT) AS group_id FROM lineitem""")
def scan_daily_prices(v: Views) -> DataFrame:
    path = workspace(v.spark, "daily")
    entry = F.array(F.struct(F.col("l_partkey").alias("productId"), F.col("l_returnflag").alias("subTypeName"),
                             F.col("l_extendedprice").alias("marketPrice")))
    payload = F.when(F.col("l_linestatus") == "F", F.to_json(F.struct(entry.alias("results")))) \
        .otherwise(F.to_json(entry))
    parts = ["price_date", "category_id", "group_id"]
    # Rows move and are sorted before they become texts.
    rows = v.table("lineitem").select(
        F.when(F.col("l_linestatus") == "F", F.lit(DAY_BEFORE)).otherwise(F.lit(DAY)).alias("price_date"),
        F.col("l_linenumber").alias("category_id"), case(F.col("l_returnflag"), {"A": 1, "N": 2, "R": 3}).alias("group_id"),
        "l_partkey", "l_returnflag", "l_linestatus", "l_extendedprice",
    ).hint("rebalance", *parts).sortWithinPartitions(*parts)
    rows.select(*parts, payload.alias("value")).write.partitionBy(*parts).text(path)
    loaded_at = F.lit(dt.datetime(2001, 12, 2)).cast("timestamp_ntz")
    return files.scan_daily_prices(v.spark, path, loaded_at, glob="*.txt", whole=False).select(
        "price_date", "product_id", "sub_type_name", "market_price", "category_id", "group_id")


@query("scan_auction_json", f"""SELECT CAST(l_partkey AS VARCHAR) AS item_id,
      {sql_case("l_linenumber", LINE_GRADES)} AS grade, p_name AS card_name, 'sale' AS record_type,
      strftime(l_shipdate, '%m/%d/%Y') AS sale_date, l_extendedprice AS sale_price
    FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag <> 'N'""")
def scan_auction_json(v: Views) -> DataFrame:
    sale = F.struct(F.date_format("l_shipdate", "MM/dd/yyyy").alias("dateOfSale"), F.col("l_extendedprice").alias("price"))
    doc = F.to_json(F.struct(F.struct(F.array(sale).alias("highestDailySales")).alias("historicalAuctionInfo")))
    item = F.col("l_partkey").cast("string")
    docs = dealt(v.table("lineitem")).select(
        F.concat(F.lit("cache/"), item, F.lit("_"), case(F.col("l_linenumber"), LINE_GRADES), F.lit(".json")).alias("path"),
        F.when(F.col("l_returnflag") == "N", "{}").otherwise(doc).alias("value"))
    cards = v.table("part").select(F.col("p_partkey").cast("string").alias("item_id"), F.col("p_name").alias("card_name"))
    at = F.lit(dt.datetime(2001, 12, 2)).cast("timestamp_ntz")
    return documents.auction_rows(files.graded_documents(docs, cards), at).select(
        "item_id", "grade", "card_name", "record_type", "sale_date", "sale_price")


# Members per archive in the queries below.
MEMBERS = 500
# Rows per archive inside that of a whole day.
PACKED = 20_000


# Rows that one task packs, about, and rows whose archives lie on disk at one time.
PACKING, ROUND = 50_000, 8_000_000


def zipped(entries: list[tuple[str, bytes | str]]) -> bytes:
    """An archive of the entries, in memory."""
    entries = [(name, data.encode() if isinstance(data, str) else data) for name, data in entries]
    if len(entries) >= zipfile.ZIP_FILECOUNT_LIMIT or sum(len(data) for _, data in entries) >= zipfile.ZIP64_LIMIT // 2:
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as out:
            for name, data in entries:
                out.writestr(name, data)
        return buffer.getvalue()
    # The common form, without 64-bit fields: zipfile takes three times as long for small members.
    members, directory, at = [], [], 0
    for name, data in entries:
        packer = zlib.compressobj(wbits=-zlib.MAX_WBITS)
        packed, raw = packer.compress(data) + packer.flush(), name.encode()
        facts = struct.pack("<5H3L2H", 20, 0 if name.isascii() else 0x800, zipfile.ZIP_DEFLATED, 0, 0x21, zlib.crc32(data),
                            len(packed), len(data), len(raw), 0)
        members += [zipfile.stringFileHeader, facts, raw, packed]
        directory += [zipfile.stringCentralDir, b"\x14\x03", facts, struct.pack("<3H2L", 0, 0, 0, 0o600 << 16, at), raw]
        at += archives.HEADER_SIZE + len(raw) + len(packed)
    listed = b"".join(directory)
    end = struct.pack(zipfile.structEndArchive, zipfile.stringEndArchive, 0, 0, len(entries), len(entries), len(listed), at, 0)
    return b"".join([*members, listed, end])


def put(folder: str, name: str):
    """A new file in a folder of any store, as a stream."""
    system, base = fs.FileSystem.from_uri(folder if ":" in folder.split("/")[0] else f"file://{folder}")
    system.create_dir(base, recursive=True)
    return system.open_output_stream(f"{base}/{name}")


def write_archives(docs: DataFrame, folder: str) -> DataFrame:
    """Documents into ZIP archives, one for each ``part``, and a broken one after each; returns their paths.

    The documents of a day and part lie together, in order. The second half of an archive's members sits in an archive of its
    own inside.
    """
    def written(day, part, docs: list[tuple]) -> list[str]:
        entries = [(f"{i}/{p}.json", value) for i, (p, value) in enumerate(docs)]
        half = len(entries) // 2
        whole = zipped([*entries[:half], ("more/rest.zip", zipped(entries[half:])), ("readme.txt", "x")])
        names = []
        for name, content in ((f"cards_{day}_{part}.zip", whole), (f"broken_{day}_{part}.zip", whole[:len(whole) // 2])):
            with put(folder, name) as out:
                out.write(content)
            names.append(f"{folder}/{name}")
        return names

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("scrape_date", "part", "product_id", "value"))))
        for key, group in itertools.groupby(rows, lambda r: r[:2]):
            yield pa.RecordBatch.from_pydict({"path": written(*key, [r[2:] for r in group])})

    return docs.mapInArrow(write, "path string")


def write_archive(docs: DataFrame, folder: str, name: str) -> None:
    """Documents of any number into one ZIP archive, which holds an archive for each ``part``.

    Parts are packed by all tasks. One task then copies them, a piece at a time, as an archive is one file.
    """
    parts = f"{folder}-parts"

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        part = group["part"].iloc[0]
        with put(parts, f"rest_{part}.zip") as out:
            out.write(zipped([(f"{i}/{p}.json", value) for i, (p, value) in enumerate(zip(group["product_id"], group["value"]))]))
        return pd.DataFrame({"path": [f"{parts}/rest_{part}.zip"]})

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with put(folder, name) as out, zipfile.ZipFile(out, "w") as archive:
            archive.writestr("readme.txt", "x")
            for batch in batches:
                for path in batch["path"]:
                    with archives.open_file(path) as part, archive.open(f"more/{path.rsplit('/', 1)[1]}", "w", force_zip64=True) as to:
                        shutil.copyfileobj(part, to, 1 << 20)
        yield pd.DataFrame({"path": [f"{folder}/{name}"]})

    packed = docs.groupBy("part").applyInPandas(pack, "path string")
    packed.repartition(1).mapInPandas(join, "path string").write.format("noop").mode("overwrite").save()


def archived(v: Views, prices: DataFrame, rows: int) -> str:
    """A folder of archives with the documents of ``rows`` prices, by day and product."""
    folder = workspace(v.spark, "archives")
    # About MEMBERS rows each, however many there are. Rows move and are sorted before they become texts.
    part = F.pmod(F.xxhash64("product_id"), F.lit(-(-rows // MEMBERS)))
    moved = prices.withColumn("part", part).repartition(-(-rows // PACKING) or 1, "scrape_date", "part") \
        .sortWithinPartitions("scrape_date", "part")
    docs = price_documents(v, moved, "part").select("scrape_date", "part", "product_id", "value")
    write_archives(docs, folder).write.format("noop").mode("overwrite").save()
    return folder


def in_rounds(v: Views, read: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``read`` finds in the archives of all price documents.

    They are written, read and removed ROUND rows at a time, so that the disk holds no more of them than that; what is found
    stays. Rows are dealt to rounds in turn, in one pass.
    """
    total = v.table("lineitem").count()
    rounds = max(1, -(-total // ROUND))
    dealt_to, found = workspace(v.spark, "rounds"), workspace(v.spark, "found")
    turn = F.pmod(F.monotonically_increasing_id(), F.lit(rounds)).cast("int")
    with shuffles_removed(v.spark):
        if rounds > 1:
            v.prices.withColumn("round", turn).write.partitionBy("round").parquet(dealt_to)
        for k in range(rounds):
            prices = v.prices if rounds == 1 else v.spark.read.schema(v.prices.schema).parquet(f"{dealt_to}/round={k}")
            folder = archived(v, prices, -(-total // rounds))
            rows = read(archives.read_archives(v.spark, folder))
            rows.write.mode("append").parquet(found)
            removed(v.spark, folder)
            removed(v.spark, f"{dealt_to}/round={k}")
    return v.spark.read.schema(rows.schema).parquet(found)


@query("scan_zip_members", with_views("prices") + BUCKETS_SQL)
def scan_zip_members(v: Views) -> DataFrame:
    """Archives written by tasks and read again member by member; the dates are those of the archives' names."""
    return in_rounds(v, lambda found: documents.price_rows(archives.archive_prices(archives.json_members(found))).select(*BUCKET_COLUMNS))


@query("broken_archives", with_views("prices") + """SELECT scrape_date, TRUE AS one_row_each, TRUE AS with_error FROM prices
    GROUP BY scrape_date""")
def broken_archives(v: Views) -> DataFrame:
    """Each archive that can't be read is a row with its error."""
    def read(found: DataFrame) -> DataFrame:
        broken = archives.json_members(found).filter("value IS NULL").groupBy("archive").agg(
            F.count("*").alias("n"), F.max("error").alias("error"))
        listed = found.filter(F.col("path").contains("/broken_")).select(F.col("path").alias("archive"))
        return listed.join(broken, "archive", "full_outer")

    return in_rounds(v, read).groupBy(
        F.regexp_extract("archive", r"_(\d{4}-\d{2}-\d{2})_", 1).cast("date").alias("scrape_date"),
    ).agg(F.bool_and(F.coalesce(F.col("n") == 1, F.lit(False))).alias("one_row_each"),
          F.bool_and(F.coalesce(F.col("error").contains("BadZipFile"), F.lit(False))).alias("with_error"))


@query("latest_archive", with_views("prices") + """SELECT scrape_date, condition, COUNT(*) AS n FROM prices
    WHERE scrape_date = DATE '2001-12-02' GROUP BY ALL""")
def latest_archive(v: Views) -> DataFrame:
    """Two archives, the newer one with the newer day: newest archive, members, rows."""
    folder = workspace(v.spark, "archives")
    parts = -(-v.table("lineitem").count() // PACKED)
    for day in (DAY_BEFORE, DAY):
        docs = price_documents(v, of_day(v.prices, day)).groupBy("product_id", "scrape_date").agg(
            F.concat(F.lit('{"result": ['), F.array_join(F.collect_list(
                F.regexp_extract("value", r'"result":\[(.*)\]\}$', 1)), ","), F.lit("]}")).alias("value"))
        part = F.pmod(F.xxhash64("product_id"), F.lit(parts)).alias("part")
        write_archive(docs.select(part, "product_id", "value"), f"{folder}/{day}", f"cards_{day}_0.zip")
    rows, _ = archives.load_latest(v.spark, folder, "cards_*.zip")
    return rows.groupBy("scrape_date", "condition").agg(F.count("*").alias("n"))


@query("write_report", with_views("prices") + """SELECT condition, COUNT(*) AS n FROM prices GROUP BY condition
    UNION ALL SELECT variant, COUNT(*) FROM prices GROUP BY variant""")
def write_report(v: Views) -> DataFrame:
    path = workspace(v.spark, "report")
    tables.write_report({name: v.prices.groupBy(F.col(name).alias("condition")).agg(F.count("*").alias("n"))
                         for name in ("condition", "variant")}, path)
    read = v.spark.read.schema("condition STRING, n BIGINT").option("header", "true")
    return read.csv(f"{path}/condition").unionByName(read.csv(f"{path}/variant"))


# --- streaming ---------------------------------------------------------------------------------

# Documents of a compressed file that is read whole by one task, about.
PIECE = 250_000


def landed(v: Views, name: str, prices: DataFrame | None = None, compression: str = "none") -> tuple[str, Column]:
    """A landing folder with one sub-folder of documents per scrape date."""
    landing = workspace(v.spark, name)
    prices = v.prices.hint("rebalance", "scrape_date") if prices is None else prices
    price_documents(v, prices).select("scrape_date", "value").write.partitionBy("scrape_date").text(landing, compression=compression)
    return landing, F.get_json_object("value", "$.productId")


def load_landed(v: Views, landing: str, ident: Column, out: str, **how) -> None:
    ingest.ingest_prices(v.spark, landing, f"{out}/table", f"{out}/checkpoint", product_id=ident, glob=how.pop("glob", "*.txt"),
                         whole=False, files_per_batch=how.pop("files_per_batch", 100_000), **how)


@query("stream_file_ingest", with_views("prices") + BUCKETS_SQL)
def stream_file_ingest(v: Views) -> DataFrame:
    landing, ident = landed(v, "landing")
    out = workspace(v.spark, "ingest")
    for _ in range(2):  # the second run finds nothing new
        load_landed(v, landing, ident, out)
    return ingest.read_prices(v.spark, f"{out}/table").select(*BUCKET_COLUMNS)


@query("stream_manifest", with_views("prices") + """SELECT 'scrape_date=' || scrape_date AS folder, scrape_date,
    COUNT(*) AS record_count, 0::BIGINT AS rejected_count FROM prices GROUP BY ALL""")
def stream_manifest(v: Views) -> DataFrame:
    landing, ident = landed(v, "landing")
    out = workspace(v.spark, "ingest")
    load_landed(v, landing, ident, out)
    return ingest.manifest(v.spark, f"{out}/table").groupBy(
        F.substring_index("filepath", "/", 1).alias("folder"), "scrape_date",
    ).agg(F.sum("record_count").alias("record_count"), F.sum("rejected_count").alias("rejected_count"))


def with_fractions(v: Views) -> DataFrame:
    """Prices as text documents, in which open lines of condition R have a fraction as quantity."""
    bucket = F.struct(F.col("market_price").cast("string").alias("marketPrice"), F.concat(
        F.col("quantity_sold").cast("string"),
        F.when((F.col("condition") == "R") & (F.col("transaction_count") == 1), F.lit(".5")).otherwise(F.lit(".0")),
    ).alias("quantitySold"))
    doc = F.to_json(F.struct(F.col("product_id").alias("productId"), F.array(F.struct(
        "condition", F.array(bucket).alias("buckets"))).alias("result")))
    broken = F.col("transaction_count") == 7
    return v.prices.select("scrape_date", F.when(broken, F.concat(F.lit("["), doc)).otherwise(doc).alias("value"))


@query("ingest_rejects", with_views("prices") + """SELECT scrape_date, verdict, reason, COUNT(*) AS n,
      CAST(SUM(quantity) AS BIGINT) AS quantity, CAST(SUM(CAST(market_price AS DECIMAL(24,6))) AS DOUBLE) AS value
    FROM (SELECT scrape_date, market_price,
        CASE WHEN condition = 'R' AND transaction_count = 1 THEN 'rejected' ELSE 'accepted' END AS verdict,
        CASE WHEN condition = 'R' AND transaction_count = 1 THEN 'quantity_sold = ' || quantity_sold || '.5' END AS reason,
        CASE WHEN NOT (condition = 'R' AND transaction_count = 1) THEN quantity_sold END AS quantity
      FROM prices WHERE transaction_count <> 7) GROUP BY scrape_date, verdict, reason
    UNION ALL SELECT scrape_date, 'empty', 'no list of results', COUNT(*), NULL, NULL FROM prices
    WHERE transaction_count = 7 GROUP BY scrape_date""")
def ingest_rejects(v: Views) -> DataFrame:
    """Accepted and rejected rows and unreadable documents, from one pass over the documents."""
    landing, out = workspace(v.spark, "landing"), workspace(v.spark, "ingest")
    with_fractions(v).hint("rebalance", "scrape_date").write.partitionBy("scrape_date").text(landing)
    load_landed(v, landing, F.coalesce(F.get_json_object("value", "$.productId"), F.lit("0")), out)
    rows = versions.read(v.spark, f"{out}/table", verdict=None).filter("verdict <> 'file'")
    return rows.groupBy("scrape_date", "verdict", "reason").agg(
        F.count("*").alias("n"), F.sum("quantity_sold").alias("quantity"), money_total("market_price").alias("value"))


@query("ingest_replace", with_views("prices") + FACTS_SQL.format(
    "(SELECT * REPLACE (quantity_sold + 1 AS quantity_sold) FROM prices WHERE scrape_date = DATE '2001-12-02' "
    "AND condition <> 'N')") + """
    UNION ALL SELECT scrape_date, 'manifest', COUNT(*), NULL, NULL, NULL, NULL FROM prices
    WHERE scrape_date = DATE '2001-12-02' GROUP BY scrape_date""")
def ingest_replace(v: Views) -> DataFrame:
    """All days are appended; then other documents of one day replace them, rows and manifest.

    Documents land compressed, and go once they are loaded: as plain text they take many times the room of the table.
    """
    out, glob = workspace(v.spark, "ingest"), "*.txt.gz"
    with shuffles_removed(v.spark):
        pieces = -(-v.table("lineitem").count() // PIECE) or 1
        landing, ident = landed(v, "landing", v.prices.repartition(pieces), "gzip")
        load_landed(v, landing, ident, out, glob=glob)
        removed(v.spark, landing)
        again = of_day(v.prices, DAY).withColumn("quantity_sold", F.col("quantity_sold") + 1)
        other, ident = landed(v, "landing", again.hint("rebalance", "scrape_date"), "gzip")
        load_landed(v, other, ident, out, mode="replace", files_per_batch=2, glob=glob, spread=True)
        load_landed(v, other, ident, out, glob=glob)  # finds nothing new
        removed(v.spark, other)
    rows = facts(ingest.read_prices(v.spark, f"{out}/table").filter("bucket_start_date IS NOT NULL"))
    listed = ingest.manifest(v.spark, f"{out}/table").groupBy("scrape_date").agg(F.sum("record_count").alias("n")) \
        .withColumn("condition", F.lit("manifest"))
    return rows.unionByName(listed, allowMissingColumns=True)


def file_count(v: Views, table: str) -> int:
    """Files that hold the rows of a table's newest version."""
    return versions.read(v.spark, table).select("_metadata.file_path").distinct().count()


LANDED = """(SELECT * REPLACE (CASE WHEN condition <> 'N' THEN bucket_start_date END AS bucket_start_date,
    CASE WHEN condition <> 'N' THEN market_price END AS market_price,
    CASE WHEN condition <> 'N' THEN quantity_sold END AS quantity_sold) FROM prices)"""


@query("compact_days", with_views("prices") + "SELECT *, TRUE AS fewer_files, TRUE AS same_again FROM ("
       + FACTS_SQL.format(LANDED) + ")")
def compact_days(v: Views) -> DataFrame:
    """Days loaded in many small batches and then compacted: the same rows in fewer files, also after a second run."""
    landing, out = workspace(v.spark, "landing"), workspace(v.spark, "ingest")
    # Rows move before they become texts.
    rows = v.prices.withColumn("part", F.pmod(F.xxhash64(*v.prices.columns), F.lit(4))).hint("rebalance", "scrape_date", "part")
    price_documents(v, rows, "part").select("scrape_date", "part", "value").write.partitionBy("scrape_date", "part").text(landing)
    load_landed(v, landing, F.get_json_object("value", "$.productId"), out, files_per_batch=3)
    table = f"{out}/table"
    scattered = file_count(v, table)
    closed = DAY + dt.timedelta(days=1)
    first = versions.compact(v.spark, table, closed, tuple(CLUSTER))
    second = versions.compact(v.spark, table, closed, tuple(CLUSTER))
    return facts(ingest.read_prices(v.spark, table)).withColumn("fewer_files", F.lit(file_count(v, table) < scattered)) \
        .withColumn("same_again", F.lit(first == second))


@query("stream_quarantine", with_views("daily") + """SELECT
    CASE WHEN market_price > 0 THEN 'accepted' ELSE 'rejected' END AS verdict,
    CASE WHEN market_price > 0 THEN NULL WHEN market_price IS NULL THEN 'no price' ELSE 'no positive price' END AS reason,
    COUNT(*) AS n FROM daily GROUP BY ALL""")
def stream_quarantine(v: Views) -> DataFrame:
    landing, out = workspace(v.spark, "landing"), workspace(v.spark, "quarantine")
    v.daily.write.parquet(landing)
    stream = v.spark.readStream.schema(v.daily.schema).parquet(landing)
    why = F.when(F.col("market_price").isNull(), F.lit("no price")).otherwise(F.lit("no positive price"))
    ingest.load_with_quarantine(stream, F.col("market_price") > 0, f"{out}/table", f"{out}/checkpoint", why)
    return v.spark.read.parquet(f"{out}/table").groupBy("verdict", "reason").agg(F.count("*").alias("n"))


@query("stream_dedup", with_views("auctions", "sales") + """SELECT psa_level, COUNT(*) AS n
    FROM (SELECT DISTINCT card_name, psa_level, auction_date, auction_price FROM sales) GROUP BY psa_level""")
def stream_dedup(v: Views) -> DataFrame:
    """Sales that land in three batches, most of them out of order."""
    landing, out = workspace(v.spark, "landing"), workspace(v.spark, "repeats")
    sales = auctions.sales(v.auctions, DAY, SINCE).withColumn("scraped_at", F.col("scraped_at").cast("timestamp"))
    part = F.pmod(F.xxhash64("card_name", "psa_level", "scraped_at"), F.lit(3))
    waiting = workspace(v.spark, "waiting")
    sales.withColumn("part", part).write.partitionBy("part").parquet(waiting)  # made once, not for each arrival
    for arrived in (2, 0, 1):
        v.spark.read.schema(sales.schema).parquet(f"{waiting}/part={arrived}").write.mode("append").parquet(landing)
        stream = v.spark.readStream.schema(sales.schema).parquet(landing)
        ingest.load_unique(stream, list(dedup.SESSION_KEYS), "scraped_at", f"{out}/table", f"{out}/checkpoint", "auction_date")
    return v.spark.read.parquet(f"{out}/table").groupBy("psa_level").agg(F.count("*").alias("n"))


def declared(v: Views) -> DataFrame:
    """Prices in the declared layout of the price table."""
    return tables.conform(v.prices, schemas.PRICE_BUCKET)


@query("conform_schema", with_views("prices") + """SELECT product_id, scrape_date, CAST(NULL AS VARCHAR) AS source_file,
    COUNT(*) AS n FROM prices GROUP BY product_id, scrape_date""")
def conform_schema(v: Views) -> DataFrame:
    return declared(v).groupBy("product_id", "scrape_date", "source_file").agg(F.count("*").alias("n"))
