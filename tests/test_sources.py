from __future__ import annotations

import datetime as dt
import json
import os
import zipfile

from pyspark.sql import functions as F

from tallymint.operators.series import trend_grid, trend_values
from tallymint.sources import archives, documents, files
from tallymint.sources.tables import limit_per_group

D = dt.date


def loaded_at():
    return F.lit(dt.datetime(2025, 1, 10)).cast("timestamp_ntz")


PRODUCT = {"result": [
    {"skuId": "1", "variant": "Normal", "language": "English", "condition": "Near Mint",
     "averageDailyQuantitySold": "2", "totalQuantitySold": "14",
     "buckets": [{"bucketStartDate": "2025-01-06", "marketPrice": "3.50", "quantitySold": "4", "lowSalePrice": "3.00",
                  "transactionCount": "3"},
                 {"bucketStartDate": "not a date", "marketPrice": "n/a", "quantitySold": "1.5"}]},
    {"skuId": "2", "condition": "Damaged", "buckets": []}, {"skuId": "3", "condition": "Damaged"}]}


def write(folder, name, content):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content if isinstance(content, str) else json.dumps(content))
    return path


def test_price_files(spark, tmp_path):
    write(tmp_path, "a/481225.0.json", PRODUCT)
    write(tmp_path, "b/77.json", "{broken")
    write(tmp_path, "_x/12_summary.json", PRODUCT)
    write(tmp_path, "abc.json", PRODUCT)
    write(tmp_path, "88.json", json.dumps(PRODUCT, indent=2))
    got = files.scan_price_json(spark, str(tmp_path), F.lit(D(2025, 1, 10)), flag="rejected")
    rows = got.filter("product_id = '481225'").orderBy("sku_id", F.col("market_price").desc()).collect()
    assert [(r.sku_id, r.market_price, r.quantity_sold, r.bucket_start_date, r.rejected) for r in rows] == [
        ("1", 3.5, 4, D(2025, 1, 6), False), ("1", None, None, None, True), ("2", None, None, None, False),
        ("3", None, None, None, False)]
    assert {r.source_file for r in rows} == {"a/481225.0.json"} and rows[0].scrape_date == D(2025, 1, 10)
    assert {r.product_id for r in got.select("product_id").collect()} == {"481225", "88"}


def test_file_names_in_odd_folders(spark, tmp_path):
    base = tmp_path / "my cards + é"
    write(base, "set 1/5.json", PRODUCT)
    write(base, "50%25/6+.json", PRODUCT)
    got = files.scan_price_documents(spark, str(base), F.lit(D(2025, 1, 10)), product_id=F.lit("1"))
    assert {r.source_file for r in got.collect()} == {"set 1/5.json", "50%25/6+.json"}


def test_daily_tree(spark, tmp_path):
    entry = {"productId": 1, "subTypeName": "Normal", "lowPrice": 1.0, "midPrice": 2.0, "highPrice": 3.0,
             "marketPrice": 2.5, "directLowPrice": None}
    write(tmp_path, "2024-12-01/3/17/prices", {"results": [entry, {**entry, "productId": 2}]})
    write(tmp_path, "2024-12-01/3/18/prices", "\n\t " + json.dumps([entry], indent=1))
    write(tmp_path, "2024-12-01/3/19/prices", {"error": "none"})
    write(tmp_path, "2024-12-01/x/17/prices", [entry])
    write(tmp_path, "2024-12-01/4/20/other", [entry])
    write(tmp_path, "2024-13-99/4/20/prices", [entry])
    got = files.scan_daily_prices(spark, str(tmp_path), loaded_at()).orderBy("group_id", "product_id").collect()
    assert [(r.price_date, r.category_id, r.group_id, r.product_id, r.market_price, r.direct_low_price) for r in got] == [
        (D(2024, 12, 1), 3, 17, 1, 2.5, None), (D(2024, 12, 1), 3, 17, 2, 2.5, None), (D(2024, 12, 1), 3, 18, 1, 2.5, None)]


def test_auction_files(spark, rows, tmp_path):
    doc = {"historicalItemAuctionSummary": {"numberOfSales": 3, "averagePrice": 110.0, "medianPrice": 100.0,
                                            "minPrice": 90.0, "maxPrice": 140.0},
           "historicalAuctionInfo": {"highestDailySales": [{"dateOfSale": "1/5/2025", "price": 100.0},
                                                           {"dateOfSale": "01/06/2025", "price": 140.0}]}}
    write(tmp_path, "544027_10.json", doc)
    write(tmp_path, "544027_8.5.json", {**doc, "historicalAuctionInfo": None})
    write(tmp_path, "544027_9.json", {})
    write(tmp_path, "9_1.json", {"historicalItemAuctionSummary": {}, "historicalAuctionInfo": {"highestDailySales": None}})
    cards = rows([("544027", "Dragon")], "item_id string, card_name string")
    got = files.scan_auction_json(spark, str(tmp_path), cards, loaded_at()).orderBy("grade", "record_type", "sale_date").collect()
    assert [(r.grade, r.record_type, r.sale_date, r.sale_price, r.total_sales_count, r.card_name) for r in got] == [
        ("10", "sale", "01/06/2025", 140.0, None, "Dragon"), ("10", "sale", "1/5/2025", 100.0, None, "Dragon"),
        ("10", "summary", None, None, 3, "Dragon"), ("8.5", "summary", None, None, 3, "Dragon")]
    assert got[0].grade_label == "PSA 10" and got[0].data_source == "psa_api"
    assert got[2].lifecycle_sales_count == 3 and got[2].median_price == 100.0


def test_trend_files(spark, tmp_path):
    module = {"_type": "MetricsTrendsModule", "series": [
        {"id": "averageSold", "data": [[1756965437056, 12.5], [1757051837056, None]]},
        {"id": "quantity", "data": [[1756965437056, 3]]}, {"id": "other", "data": [[1756965437056, 9]]}]}
    later = {"_type": "MetricsTrendsModule", "series": [{"id": "averageSold", "data": [[1756965437000, 13.0]]}]}
    write(tmp_path, "0000_blue_card.json", "\n".join(['{"_type": "Other"}', "not json", "", json.dumps(module), json.dumps(later)]))
    points = documents.trend_points(files.scan_trend_lines(spark, str(tmp_path)))
    assert points.count() == 3
    assert [tuple(r) for r in trend_values(points).collect()] == [("blue_card", D(2025, 9, 4), 13.0, 3.0)]
    names = spark.createDataFrame([("blue_card",), ("unseen",)], "keyword string")
    assert sorted(tuple(r) for r in trend_grid(points, names).collect()) == [
        ("blue_card", D(2025, 9, 4), 13.0, 3.0), ("unseen", D(2025, 9, 4), None, None)]


def test_trend_lines_keep_their_order_in_split_files(spark, tmp_path):
    lines = [json.dumps({"_type": "MetricsTrendsModule", "series": [
        {"id": "averageSold", "data": [[1756965437056, float(i)]]}]}) for i in range(3000)]
    write(tmp_path, "0001_red_card.json", "\n".join(lines))
    write(tmp_path, "0000_red_card.json", "\n".join(lines[:3]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
        found = files.scan_trend_lines(spark, str(tmp_path))
        assert found.select(F.spark_partition_id()).distinct().count() > 4
        points = documents.trend_points(found)
        values = [r.value for r in points.orderBy("line_no").collect()]
        last = trend_values(points).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert values == [float(i) for i in (*range(3), *range(3000))]
    assert [(r.keyword, r.price) for r in last] == [("red_card", 2999.0)]


def test_packed_histories(rows):
    doc = json.dumps({"asin": "B1", "csv": [[7000000, 1999, 7000060, -1, 7000120, 2099, 7000180], None,
                                            [7000000, 1500], [7000000, 42], []]})
    products = documents.packed_products(rows([(doc,), ('{"asin": "B2"}',), ("broken",)], "value string"))
    got = documents.packed_points(products).orderBy("price_type", "pos").collect()
    assert [(r.price_type, r.pos, r.ts, r.price) for r in got] == [
        ("amazon", 0, dt.datetime(2024, 4, 23, 2, 40), 19.99), ("amazon", 4, dt.datetime(2024, 4, 23, 4, 40), 20.99),
        ("used", 0, dt.datetime(2024, 4, 23, 2, 40), 15.0)]
    triples = documents.packed_products(rows([('{"asin": "B", "csv": [[1, 100, 5, 2, 200, 5]]}',)], "value string"))
    assert [r.price for r in documents.packed_points(triples, stride=3).orderBy("pos").collect()] == [1.0, 2.0]


def test_url_list(rows):
    text = "https://s.example/product/5/a\nnone\r\n\nhttps://s.example/product/3/b\n"
    got = documents.url_ids(rows([(text,)], "value string")).orderBy("pos").collect()
    assert [r.product_id for r in got] == ["5", "3"]


def test_archives(spark, tmp_path):
    inner = tmp_path / "in" / "inner.zip"
    inner.parent.mkdir()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("7.json", "{}")
        z.writestr("deep.zip", b"not opened")
    folder = tmp_path / "drop+é 1"
    folder.mkdir()
    old, new = folder / "cards_2025-01-01.zip", folder / "cards.zip"
    for path, how in ((old, zipfile.ZIP_STORED), (new, zipfile.ZIP_DEFLATED)):
        with zipfile.ZipFile(path, "w", how) as z:
            z.writestr("a/5.json", '{"result": [{"skuId": "1"}]}')
            z.writestr("a/notes.txt", "x")
            z.write(inner, "b/inner.zip")
            z.writestr("c/bad.zip", b"no archive")
    (folder / "bad.zip").write_bytes(b"no archive" * 9)
    damaged = bytearray(old.read_bytes())
    damaged[damaged.index(b'{"result"') + 3] ^= 1  # the checksum of this member doesn't fit any more
    (folder / "damaged.zip").write_bytes(bytes(damaged))
    for at, path in enumerate(("bad.zip", "damaged.zip", "cards_2025-01-01.zip", "cards.zip")):
        os.utime(folder / path, (1735900000 + at, 1735900000 + at))
    found = archives.read_archives(spark, str(folder))
    assert archives.latest_archive(found).first().path.endswith("cards.zip")
    got = [(r.archive.rsplit("/", 1)[1], r.member, r.value, (r.error or "").split(":")[0]) for r in
           archives.json_members(found, task_bytes=200).collect()]
    whole = [("a/5.json", '{"result": [{"skuId": "1"}]}', ""), ("b/7.json", "{}", ""), ("c/bad.zip", None, "BadZipFile")]
    expected = [(name, *row) for name in ("cards.zip", "cards_2025-01-01.zip") for row in whole]
    expected += [("damaged.zip", "a/5.json", None, "BadZipFile"), ("damaged.zip", *whole[1]), ("damaged.zip", *whole[2])]
    assert sorted(got, key=repr) == sorted(expected + [("bad.zip", None, None, "BadZipFile")], key=repr)
    rows, broken = archives.load_latest(spark, str(folder))
    assert [(r.product_id, r.sku_id, r.scrape_date, r.source_file) for r in rows.collect()] == [
        ("5", "1", D(2025, 1, 3), "a/5.json")]
    assert [(r.member, r.error.split(":")[0]) for r in broken.collect()] == [("c/bad.zip", "BadZipFile")]
    rows, _ = archives.load_latest(spark, str(folder), "cards_*.zip")
    assert rows.first().scrape_date == D(2025, 1, 1)


def test_lists(spark, tmp_path):
    write(tmp_path, "cards.csv", "card_number,card_name,card_id,url,lifecycle_sales_count\n1,Dragon,0042,u,7\n")
    assert files.card_list(spark, str(tmp_path / "cards.csv")).first().card_id == "0042"
    write(tmp_path, "grades.csv", "grade_value,grade_label\n8.5,NM-MT+\n0,Auth\n")
    assert [r.grade_value for r in files.grade_list(spark, str(tmp_path / "grades.csv")).collect()] == ["8.5", "0"]
    write(tmp_path, "words.txt", " blue card \n\nred\n")
    assert [r.keyword for r in files.read_keywords(spark, str(tmp_path / "words.txt")).collect()] == ["blue card", "red"]


def test_newest_file(spark, tmp_path):
    for at, name in enumerate(("wide_b.csv", "wide_a.csv", "other.csv")):
        write(tmp_path, name, f"n\n{at}\n")
        os.utime(tmp_path / name, (1735900000 + at // 2 * 60, 1735900000 + at // 2 * 60))
    newest = files.newest_file(spark, str(tmp_path), "wide_*.csv")
    assert newest.endswith("wide_b.csv") and files.newest_file(spark, str(tmp_path), "none*") is None


def test_latest_folder(rows):
    paths = rows([("x/250101_raw_jsons/a.json",), ("x/250301_raw_jsons/a.json",), ("x/old/a.json",)], "path string")
    assert files.latest_folder(paths).first().stamp == "250301"


def test_limits(rows):
    df = rows([(c, g) for c in (1, 2, 3) for g in (1, 2, 3) for _ in range(4)], "c int, g int")
    got = limit_per_group(df, "c", "g", 2, 1)
    assert {tuple(r) for r in got.collect()} == {(1, 1), (2, 1)} and got.count() == 8
