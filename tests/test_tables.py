from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tallymint.operators import tables, versions
from tallymint.session import workspace
from tallymint.sources import documents
from tallymint.streaming import ingest

D = dt.date
SCHEMA = "day date, product string, n int"


def content(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("day", "product", "n").collect())


def test_replace_days_twice_is_replace_once(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    tables.append(rows([(D(2025, 1, 1), "a", 1)], SCHEMA), path, "day", ["product"])
    tables.append(rows([(D(2025, 1, 2), "a", 1), (D(2025, 1, 2), "b", 2)], SCHEMA), path, "day")
    new = rows([(D(2025, 1, 2), "c", 3)], SCHEMA)
    tables.replace_days(new, path, "day")
    once = content(spark, path)
    tables.replace_days(new, path, "day")
    assert once == content(spark, path) == [(D(2025, 1, 1), "a", 1), (D(2025, 1, 2), "c", 3)]
    tables.replace(new, path, "day")
    assert content(spark, path) == [(D(2025, 1, 2), "c", 3)]


def test_facts(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    tables.append(rows([(D(2025, 1, 1), "a", 1), (D(2025, 1, 2), "b", 1), (D(2025, 1, 2), "c", 1)], SCHEMA), path, "day")
    table = spark.read.parquet(path)
    stats = tables.partition_stats(table, "day").collect()
    assert [(r.day, r.total_rows) for r in stats] == [(D(2025, 1, 2), 2), (D(2025, 1, 1), 1)]
    assert all(r.total_bytes > 0 for r in stats)


def test_catalog_keeps_the_layout(spark, rows, tmp_path):
    path, name = str(tmp_path / "t"), f"layout_{tmp_path.name.replace('-', '_')}"
    data = rows([(D(2025, 1, 1 + i % 2), f"p{i}", i) for i in reversed(range(9))], SCHEMA)
    tables.create_table(spark, name, data.select("product", "n", "day").schema, "day", path, ("product", "n"))
    tables.insert(data, name)
    assert tables.layout(spark, name) == (("day",), ("product", "n"))
    facts = tables.table_facts(spark, name).first()
    assert (facts.num_rows, facts.num_columns, facts.partitioned_by, facts.clustered_by) == (9, 3, "day", "product, n")
    stored = spark.read.parquet(path)
    assert facts.num_bytes == sum(r.total_bytes for r in tables.partition_stats(stored, "day").collect())
    for file in stored.inputFiles():
        found = [r.product for r in spark.read.parquet(file).collect()]
        assert found == sorted(found)
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    tables.insert(rows([(D(2025, 1, 2), "new", 1)], SCHEMA), name, replace_days=True)
    assert spark.table(name).count() == 6 and spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    spark.sql(f"DROP TABLE {name}")


def test_retention(rows):
    df = rows([(D(2025, 1, d), "a", d) for d in (1, 5, 9)], SCHEMA)
    assert {r.n for r in tables.retain(df, "day", 5, D(2025, 1, 10)).collect()} == {5, 9}
    assert {r.n for r in tables.without_day(df, "day", D(2025, 1, 5)).collect()} == {1, 9}


def test_report(spark, rows, tmp_path):
    tables.write_report({"a": rows([(1,)], "n int"), "b": rows([(2,)], "n int")}, str(tmp_path / "r"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "r" / "b")).first().n == "2"


def test_workspace_is_below_the_shared_folder(spark):
    first, second = workspace(spark, "x"), workspace(spark, "x")
    assert first != second and "/tallymint/x-" in first


def price_file(folder, day, product, price):
    path = folder / day
    path.mkdir(parents=True, exist_ok=True)
    buckets = [{"bucketStartDate": "2025-01-06", "marketPrice": price}] if price else []
    (path / f"{product}.json").write_text(json.dumps(
        {"result": [{"skuId": "1", "buckets": buckets}] if price != "none" else []}, indent=1))


def loaded(spark, table):
    rows = sorted(((r.product_id, r.scrape_date, r.market_price) for r in ingest.read_prices(spark, table).collect()), key=repr)
    files = sorted((r.filepath, r.record_count, r.rejected_count, r.reason) for r in ingest.manifest(spark, table).collect())
    return rows, files


def test_ingest_reads_each_file_once(spark, tmp_path):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    where = (str(landing), f"{out}/table", f"{out}/checkpoint")
    price_file(landing, "2025-01-10", 1, "3.5")
    price_file(landing, "2025-01-10", 2, "none")
    ingest.ingest_prices(spark, *where)
    ingest.ingest_prices(spark, *where)
    price_file(landing, "2025-01-11", 1, "4.5")
    ingest.ingest_prices(spark, *where, files_per_batch=1)
    assert loaded(spark, where[1]) == (
        [("1", D(2025, 1, 10), 3.5), ("1", D(2025, 1, 11), 4.5)],
        [("2025-01-10/1.json", 1, 0, None), ("2025-01-10/2.json", 0, 0, None), ("2025-01-11/1.json", 1, 0, None)])
    manifest = ingest.manifest(spark, where[1])
    files = manifest.select("filepath", "scrape_date").unionByName(
        spark.createDataFrame([("new.json", D(2025, 1, 10))], "filepath string, scrape_date date"))
    assert [r.filepath for r in ingest.not_loaded(files, manifest).collect()] == ["new.json"]


def test_nothing_loaded_yet(spark, tmp_path):
    table = str(tmp_path / "t")
    assert loaded(spark, table) == ([], []) and ingest.rejected_prices(spark, table).count() == 0


def test_fractions_and_broken_files_are_set_aside(spark, tmp_path):
    folder = tmp_path / "in" / "2025-01-10"
    folder.mkdir(parents=True)
    buckets = [{"bucketStartDate": "2025-01-06", "marketPrice": "1", "quantitySold": q, "transactionCount": t}
               for q, t in (("2.0", "1"), ("2.5", "0.25"), ("x", "1"))]
    (folder / "1.json").write_text(json.dumps({"result": [{"skuId": "7", "buckets": buckets}, {"skuId": "8"}]}))
    (folder / "2.json").write_text("[1, 2")
    (folder / "3.json").write_text('{"result": []}')
    table = str(tmp_path / "t")
    ingest.ingest_prices(spark, str(tmp_path / "in"), table, str(tmp_path / "cp"))
    assert sorted((r.sku_id, r.quantity_sold) for r in ingest.read_prices(spark, table).fillna(-1).collect()) == [
        ("7", -1), ("7", 2), ("8", -1)]
    bad = ingest.rejected_prices(spark, table).collect()
    assert [(r.reason, r.quantity_sold, r.market_price) for r in bad] == [
        ("quantity_sold = 2.5; transaction_count = 0.25", None, 1.0)]
    assert loaded(spark, table)[1] == [("2025-01-10/1.json", 3, 1, None),
                                      ("2025-01-10/2.json", 0, 0, "no list of results"), ("2025-01-10/3.json", 0, 0, None)]


def test_documents_are_parsed_once(spark):
    docs = spark.createDataFrame([("1", D(2025, 1, 1), "f", "{}")], "product_id string, scrape_date date, source_file string, value string")
    plan = documents.price_verdicts(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_replacement_shows_only_its_own_rows(spark, tmp_path, monkeypatch):
    first, second, out = tmp_path / "a", tmp_path / "b", str(tmp_path / "out")
    table, checkpoint = f"{out}/table", f"{out}/checkpoint"
    price_file(first, "2025-01-10", 1, "1.0")
    price_file(first, "2025-01-11", 1, "2.0")
    ingest.ingest_prices(spark, str(first), table, checkpoint)
    before = loaded(spark, table)
    price_file(second, "2025-01-11", 1, "5.0")
    price_file(second, "2025-01-11", 2, "6.0")
    # The first try breaks off in its second batch: readers still see the old rows.
    write, calls = versions.write_batch, []

    def failing(*args, **kwargs):
        write(*args, **kwargs)
        calls.append(args)
        if len(calls) == 3:
            raise RuntimeError("lost")

    monkeypatch.setattr(versions, "write_batch", failing)
    with pytest.raises(Exception):
        ingest.ingest_prices(spark, str(second), table, checkpoint, mode="replace", files_per_batch=1)
    assert loaded(spark, table) == before
    monkeypatch.setattr(versions, "write_batch", write)
    ingest.ingest_prices(spark, str(second), table, checkpoint, mode="replace", files_per_batch=1)
    expected = ([("1", D(2025, 1, 11), 5.0), ("2", D(2025, 1, 11), 6.0)],
                [("2025-01-11/1.json", 1, 0, None), ("2025-01-11/2.json", 1, 0, None)])
    assert loaded(spark, table) == expected
    # Later appends go on from the replacement; another replacement reads all files again.
    ingest.ingest_prices(spark, str(second), table, checkpoint)
    assert loaded(spark, table) == expected
    ingest.ingest_prices(spark, str(second), table, checkpoint, mode="replace")
    assert loaded(spark, table) == expected


def test_batch_that_fails_after_its_write_is_listed_once(spark, tmp_path, monkeypatch):
    landing, table, checkpoint = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "cp")
    price_file(landing, "2025-01-10", 1, "1.0")
    commit, calls = versions.commit, []

    def failing(*args, **kwargs):
        calls.append(args)
        if len(calls) == 1:
            raise RuntimeError("lost before the commit")
        after = commit(*args, **kwargs)
        if len(calls) == 2:
            raise RuntimeError("lost after the commit")
        return after

    monkeypatch.setattr(versions, "commit", failing)
    for _ in range(2):
        with pytest.raises(Exception):
            ingest.ingest_prices(spark, str(landing), table, checkpoint)
    ingest.ingest_prices(spark, str(landing), table, checkpoint)
    assert loaded(spark, table) == ([("1", D(2025, 1, 10), 1.0)], [("2025-01-10/1.json", 1, 0, None)])


def test_compaction_keeps_rows_and_is_done_once(spark, tmp_path):
    landing, table, checkpoint = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "cp")
    for day in ("2025-01-10", "2025-01-11"):
        for product in range(4):
            price_file(landing, day, product, f"{product}.5")
    ingest.ingest_prices(spark, str(landing), table, checkpoint, files_per_batch=3)
    opened = lambda: versions.read(spark, table).select("_metadata.file_path").distinct().count()
    before, files = loaded(spark, table), opened()
    version = versions.compact(spark, table, D(2025, 1, 11), ("product_id",))
    assert loaded(spark, table) == before and opened() < files
    assert versions.compact(spark, table, D(2025, 1, 11), ("product_id",)) == version
    days = {d: {b for b, e in version.parts if e == d} for _, d in version.parts}
    assert len(days[D(2025, 1, 10)]) == 1 and len(days[D(2025, 1, 11)]) > 1
    price_file(landing, "2025-01-10", 9, "9.5")
    ingest.ingest_prices(spark, str(landing), table, checkpoint)
    assert len(loaded(spark, table)[0]) == 9


def test_quarantine(spark, rows, tmp_path):
    rows([(1, 5.0), (2, None), (3, -1.0)], "id int, price double").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id int, price double").parquet(str(tmp_path / "in"))
    ingest.load_with_quarantine(stream, F.col("price") > 0, str(tmp_path / "t"), str(tmp_path / "cp"), F.lit("no price"))
    found = spark.read.parquet(str(tmp_path / "t")).collect()
    assert sorted((r.verdict, r.id, r.reason) for r in found) == [
        ("accepted", 1, None), ("rejected", 2, "no price"), ("rejected", 3, "no price")]


def test_late_first_arrivals_are_kept_and_repeats_dropped(spark, rows, tmp_path):
    source, out, cp = (str(tmp_path / d) for d in ("in", "out", "cp"))
    schema = "k string, day date, at timestamp"

    def arrive(*found):
        data = [(k, None if m is None else D(2025, m, 3), dt.datetime(2025, 1, 10, h)) for k, m, h in found]
        rows(data, schema).coalesce(1).write.mode("append").parquet(source)
        ingest.load_unique(spark.readStream.schema(schema).parquet(source), ["k", "day"], "at", out, cp, "day")

    arrive(("a", 1, 10), ("a", 1, 9), ("b", 2, 20), (None, None, 10))
    arrive(("c", 1, 5), ("b", 2, 1), ("b", 1, 3))
    arrive(("d", 3, 6), (None, None, 7), ("c", 1, 23), (None, 1, 8))
    found = spark.read.parquet(out).collect()
    assert sorted((r.k or "", r.at.hour) for r in found) == [
        ("", 8), ("", 10), ("a", 9), ("b", 3), ("b", 20), ("c", 5), ("d", 6)]
    # Only the folders of the batch's periods are opened.
    batch = rows([("z", D(2025, 2, 9), dt.datetime(2025, 1, 1))], schema)
    looked = ingest.loaded_before(spark, out, batch, F.trunc("day", "month"), 99)
    assert looked.count() == 1 and looked.select("k").collect()[0].k == "b"
    plan = looked._jdf.queryExecution().executedPlan().toString()
    assert "(period" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]


def test_dropped_days_leave_storage(spark, rows, tmp_path):
    path, name = str(tmp_path / "t"), f"drop_{tmp_path.name.replace('-', '_')}"
    data = rows([(1, dt.date(2025, 1, 1)), (2, dt.date(2025, 1, 2)), (3, dt.date(2025, 3, 1))], "id int, day date")
    tables.create_table(spark, name, data.schema, "day", path)
    data.write.insertInto(name)
    tables.drop_days(spark, name, "day", [dt.date(2025, 1, 2)])
    read = lambda: sorted(r.id for r in spark.read.schema(data.schema).parquet(path).collect())
    assert read() == [1, 3]
    spark.sql(f"MSCK REPAIR TABLE {name}")
    assert sorted(r.id for r in spark.table(name).collect()) == [1, 3]
    assert tables.retire(spark, name, "day", 30, dt.date(2025, 3, 2)) == [dt.date(2025, 1, 1)]
    assert read() == [3]
    spark.sql(f"DROP TABLE {name}")


def test_scrape_date_and_name_of_odd_folders(spark, tmp_path):
    landing = tmp_path / "my cards+é"
    for name in ("drop1/20231105.json", "2024-02-03/77.json"):
        (landing / name).parent.mkdir(parents=True, exist_ok=True)
        (landing / name).write_text('{"result": []}')
    os.utime(landing / "drop1/20231105.json", (1735732800, 1735732800))
    table = str(tmp_path / "t")
    ingest.ingest_prices(spark, str(landing), table, str(tmp_path / "c"))
    found = {r.filepath: r.scrape_date for r in ingest.manifest(spark, table).collect()}
    assert found == {"drop1/20231105.json": dt.date(2025, 1, 1), "2024-02-03/77.json": dt.date(2024, 2, 3)}
