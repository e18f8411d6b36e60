"""What keeps jobs in proportion to their input: how archives are dealt and read, and what plans hold."""

from __future__ import annotations

import datetime as dt
import gzip
import io
import zipfile
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tallymint.functions import cleaning
from tallymint.plans import storage_queries
from tallymint.plans.views import Views
from tallymint.session import SHUFFLES_REMOVED, configure
from tallymint.sources import archives, files
from tallymint.streaming import ingest


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_directories_are_dealt_in_slices(spark, tmp_path, monkeypatch):
    for k in range(3):
        with zipfile.ZipFile(tmp_path / f"cards_{k}.zip", "w", zipfile.ZIP_DEFLATED) as z:
            z.comment = b"a comment"
            for i in range(25):
                z.writestr(f"{i}.json", "{}", zipfile.ZIP_BZIP2 if i == 7 else None)
            z.writestr("é.json", "ü")
    paths = pd.DataFrame({"path": [str(p) for p in sorted(tmp_path.glob("*.zip"))]})
    assert len(pd.concat(archives._directory(iter([paths])))) == 3  # one row for a small archive, whatever it holds
    monkeypatch.setattr(archives, "SLICE_MEMBERS", 10)
    monkeypatch.setattr(archives, "PIECE", 1 << 10)
    slices = pd.concat(archives._directory(iter([paths])))
    assert len(slices) == 9

    def whole(*args, **how):
        raise AssertionError("the whole directory was read")
    monkeypatch.setattr(zipfile.ZipFile, "infolist", whole)
    read = pd.concat(archives._read(iter([slices])))
    assert read["error"].isna().all() and len(read) == 78
    assert set(read["member"]) == {*(f"{i}.json" for i in range(25)), "é.json"}
    assert set(read["value"]) == {"{}", "ü"}


def test_a_large_archive_is_packed_in_parts(spark, rows, tmp_path):
    docs = rows([(i % 3, str(i), '{"result": []}') for i in range(30)], "part int, product_id string, value string")
    storage_queries.write_archive(docs, str(tmp_path / "day"), "cards.zip")
    with zipfile.ZipFile(tmp_path / "day" / "cards.zip") as z:
        assert z.testzip() is None
        assert sorted(z.namelist()) == ["more/rest_0.zip", "more/rest_1.zip", "more/rest_2.zip", "readme.txt"]
    found = archives.json_members(archives.read_archives(spark, str(tmp_path / "day"))).collect()
    assert sorted(int(r.member.split("/")[2].split(".")[0]) for r in found) == list(range(30))
    assert not [r.error for r in found if r.error]


def write_lines(rows, folder):
    """A table of 100 lines, half of them of each day; ``l_suppkey`` numbers them."""
    lines = [(i % 9, i, "FO"[i % 2], "AR"[i % 3 % 2], dt.date(2001, 1, 1), i + 0.5, 5.0, 0.0, 0.0, 1) for i in range(100)]
    rows(lines, "l_partkey long, l_suppkey long, l_linestatus string, l_returnflag string, l_shipdate date, l_extendedprice double, "
         "l_quantity double, l_discount double, l_tax double, l_linenumber int").coalesce(1).write.parquet(str(folder / "lineitem.parquet"))


def test_archives_lie_on_disk_a_round_at_a_time(spark, rows, tmp_path, monkeypatch):
    """Every row comes back, no more archives than those of a round are there at once, and none, nor a shuffle, is left."""
    monkeypatch.setattr(storage_queries, "ROUND", 40)
    monkeypatch.setattr(storage_queries, "MEMBERS", 10)
    write_lines(rows, tmp_path)
    seen, there, read = [], [], archives.read_archives

    def noted(session, path, *glob):
        seen.append(path)
        there.append([sum(n.endswith(".json") for n in zipfile.ZipFile(f).namelist()) * 2
                      for folder in seen for f in Path(folder).glob("cards_*.zip")])
        return read(session, path, *glob)

    monkeypatch.setattr(archives, "read_archives", noted)
    for name in ("scan_zip_members", "broken_archives"):
        seen.clear(), there.clear()
        found = getattr(storage_queries, name)(Views(configure(spark), str(tmp_path))).collect()
        if name == "scan_zip_members":
            assert sorted(int(r.sku_id) for r in found) == list(range(100))
        else:
            assert sorted((r.one_row_each, r.with_error) for r in found) == [(True, True)] * 2
        assert len(seen) == 3 and all(sum(sizes) <= 44 for sizes in there)  # members outside inner archives are half of all
        assert not any(Path(folder).exists() for folder in seen)
    assert spark.conf.get(SHUFFLES_REMOVED) == "false"


def test_landed_documents_are_compressed_and_go_once_they_are_loaded(spark, rows, tmp_path, monkeypatch):
    write_lines(rows, tmp_path)
    monkeypatch.setattr(storage_queries, "PIECE", 30)
    there, load = [], storage_queries.load_landed

    def noted(v, landing, *args, **how):
        there.append((landing, sorted({f.suffix for f in Path(landing).glob("*/part-*")}), [Path(x).exists() for x, *_ in there]))
        load(v, landing, *args, **how)

    monkeypatch.setattr(storage_queries, "load_landed", noted)
    found = storage_queries.ingest_replace(Views(configure(spark), str(tmp_path))).collect()
    first, other, again = there
    assert first[1:] == ([".gz"], []) and other[1:] == ([".gz"], [False]) and again[:2] == other[:2]
    assert not Path(first[0]).exists() and not Path(other[0]).exists()
    assert sum(r.n for r in found if r.condition != "manifest") == 50 == sum(r.n for r in found if r.condition == "manifest")
    assert {r.quantity / r.n for r in found if r.condition != "manifest"} == {6.0}


def test_documents_of_a_file_are_dealt_to_all_cores(spark, tmp_path, monkeypatch):
    (tmp_path / "in" / "2025-01-02").mkdir(parents=True)
    docs = [f'{{"productId": "{k}", "result": [{{"skuId": "{k}", "buckets": []}}]}}' for k in range(40)]
    with gzip.open(tmp_path / "in" / "2025-01-02" / "a.txt.gz", "wt") as f:
        f.write("\n".join(docs))
    parts, parse = [], ingest.price_documents

    def noted(lines, *args):
        if not lines.isStreaming:
            parts.append(lines.rdd.getNumPartitions())
        return parse(lines, *args)

    monkeypatch.setattr(ingest, "price_documents", noted)
    ingest.ingest_prices(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "cp"), glob="*.gz", whole=False,
                         product_id=F.get_json_object("value", "$.productId"), spread=True)
    assert parts == [spark.sparkContext.defaultParallelism]
    found = ingest.read_prices(spark, str(tmp_path / "t")).collect()
    assert sorted(int(r.product_id) for r in found) == list(range(40)) and {r.scrape_date for r in found} == {dt.date(2025, 1, 2)}


def test_small_archives_are_as_zipfile_reads_them():
    entries = [("a/é.json", "ü" * 99), ("b.json", b""), ("more/c.zip", storage_queries.zipped([("d", "e")])), ("f.txt", bytes(5000))]
    for some in (entries, [], [(f"{i}", "") for i in range(70_000)]):
        with zipfile.ZipFile(io.BytesIO(storage_queries.zipped(some))) as z:
            assert z.testzip() is None
            assert [(n, z.read(n)) for n in z.namelist()[:9]] == [(n, d.encode() if isinstance(d, str) else d) for n, d in some[:9]]
            assert len(z.namelist()) == len(some)


def test_wide_stages_are_compiled(spark):
    assert int(configure(spark).conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_a_landed_line_is_looked_at_once(rows):
    lines = rows([("{}", "file:/in/2025-01-01/a.txt", dt.datetime(2025, 1, 2))], "value string, path string, modified timestamp")
    docs = ingest.price_documents(lines, "/in", F.get_json_object("value", "$.productId"))
    assert plan(docs).count("get_json_object") == 1


def test_a_daily_path_is_matched_once(spark, tmp_path):
    folder = tmp_path / "2025-01-01" / "3" / "5"
    folder.mkdir(parents=True)
    (folder / "prices").write_text('[{"productId": 1}]')
    found = files.scan_daily_prices(spark, str(tmp_path), F.lit(dt.datetime(2025, 1, 1)).cast("timestamp_ntz"))
    assert [(r.price_date, r.category_id, r.group_id) for r in found.collect()] == [(dt.date(2025, 1, 1), 3, 5)]
    assert plan(found).count("regexp_extract") == 1


def test_rows_move_before_they_are_texts(spark, rows, tmp_path):
    data = [("1", "9", "F", "English", "R", dt.date(2025, 1, 1), 1.0, 2, 1.0, 1.0, 1, dt.date(2001, 12, 1))]
    layout = ("product_id string, sku_id string, variant string, language string, condition string, bucket_start_date date, "
              "market_price double, quantity_sold long, low_sale_price double, high_sale_price double, transaction_count long, "
              "scrape_date date")
    prices = rows(data, layout).withColumn("seller", F.col("sku_id").cast("bigint"))
    docs = storage_queries.price_documents(None, prices.hint("rebalance", "seller"), "seller")
    assert docs.columns == ["product_id", "scrape_date", "source_file", "value", "seller"]
    assert plan(docs).lower().index("tojson") < plan(docs).lower().index("rebalance")


def test_numbers_with_a_point_are_not_cast_in_vain(rows):
    texts = ["12", "12.0", "12.5", " 7 ", "1e3", "x", "9007199254740993", "nan", "1f", "inf", ".", "", None]
    df = rows([(t,) for t in texts], "t string")
    got = df.select(cleaning.to_whole("t"), cleaning.is_fractional("t"), cleaning.to_double("t")).collect()
    assert [tuple(r) for r in got] == [
        (12, False, 12.0), (12, False, 12.0), (None, True, 12.5), (7, False, 7.0), (1000, False, 1000.0), (None, False, None),
        (9007199254740993, False, 9007199254740992.0), (None, False, None), (None, False, None), (None, False, None),
        (None, False, None), (None, False, None), (None, False, None)]
    assert "contains" in plan(df.select(cleaning.to_whole("t"))).lower()


def test_unique_rows_need_no_join(spark, tmp_path, monkeypatch):
    schema = "k string, day date, at long, note string"
    source, out = str(tmp_path / "in"), str(tmp_path / "out")

    def joined(*args, **how):
        raise AssertionError("a join moves and sorts the new rows again")

    for batch in ([("a", dt.date(2025, 1, 1), 3, "x"), (None, None, 1, "y")],
                  [("a", dt.date(2025, 1, 1), 1, "early"), (None, None, 0, "z"), ("a", dt.date(2025, 1, 2), 5, "n"),
                   ("a", dt.date(2025, 1, 2), None, "first"), ("a", None, 1, "m")]):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(source)
        with monkeypatch.context() as m:
            m.setattr(type(spark.range(1)), "join", joined)
            ingest.load_unique(spark.readStream.schema(schema).parquet(source), ["k", "day"], "at", f"{out}/t", f"{out}/c", "day")
    got = {(r.k, r.day, r.note) for r in spark.read.parquet(f"{out}/t").collect()}
    assert got == {("a", dt.date(2025, 1, 1), "x"), (None, None, "y"), ("a", dt.date(2025, 1, 2), "first"), ("a", None, "m")}
