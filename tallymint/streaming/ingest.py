"""Incremental ingest of files: each file once, resumable, safe to repeat.

The checkpoint remembers which files were read. Each micro-batch writes its own folder with overwrite, so a batch that
is run again after a failure leaves the same table.
"""

from __future__ import annotations

import dataclasses
import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import MapType, StructType

from .. import schemas
from ..functions.dates import date_from_name
from ..functions.text import product_id_from_file
from ..operators import dedup, versions
from ..session import SHUFFLES_REMOVED
from ..sources import documents
from ..sources.files import relative_path

#: Columns by which price rows are sorted within a day.
PRICE_CLUSTER = ("product_id", "language", "condition")


def landing_stream(spark: SparkSession, landing: str, glob: str = "*.json", whole: bool = True,
                   files_per_batch: int = 1000) -> DataFrame:
    """New text files below a folder as a stream of ``value``, ``path`` and ``modified``."""
    return (
        spark.readStream.schema("value STRING").format("text")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .option("wholetext", str(whole).lower())
        .option("maxFilesPerTrigger", files_per_batch)
        .load(landing)
        .select("value", F.col("_metadata.file_path").alias("path"),
                F.col("_metadata.file_modification_time").alias("modified"))
    )


def _finish(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    def adaptive(batch: DataFrame, batch_id: int) -> None:
        # A stream's session plans without adaptive execution, which state needs. There is none here, and without it a
        # rebalance leaves a hot day to one task.
        batch.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
        batch.sparkSession.conf.set(SHUFFLES_REMOVED, "true")  # those of many batches would add up
        each(batch, batch_id)

    query = (
        stream.writeStream.foreachBatch(adaptive)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def price_documents(stream: DataFrame, landing: str, product_id: Column | None = None) -> DataFrame:
    """Landed price documents with product id, relative file name and scrape date.

    The date is that in the name of the file's folder, else the day on which the file was last changed. File names
    don't count, as a product id can look like a date.
    """
    # Unfolding an array of one keeps the optimiser from decoding the path, or reading the id, once for every use of it.
    ident = product_id_from_file("path") if product_id is None else product_id
    named = stream.select("value", "modified", F.inline(F.array(F.struct(
        ident.alias("product_id"), relative_path("path", landing).alias("source_file")))))
    folder = F.regexp_extract("source_file", "^(.*)/", 1)
    return named.filter("product_id IS NOT NULL").select(
        "product_id", date_from_name(folder, F.col("modified")).alias("scrape_date"), "source_file", "value")


#: What the manifest tells of a file, in the rows that stand for files.
FILE_FIELDS = "record_count BIGINT, rejected_count BIGINT, loaded_at TIMESTAMP_NTZ"


def _write_prices(docs: DataFrame, table: str, name: str, layout: StructType) -> None:
    """Write a batch: rows of every verdict in one pass over the documents, then a row for each file.

    The files are counted from three columns of what was written; no document is read again.
    """
    versions.write_batch(documents.price_verdicts(docs), table, name, "scrape_date", PRICE_CLUSTER)
    written = docs.sparkSession.read.schema(layout).parquet(f"{table}/rows/batch={name}")
    files = written.groupBy("source_file", "scrape_date").agg(
        F.count_if(F.col("verdict") == versions.ACCEPTED).alias("record_count"),
        F.count_if(F.col("verdict") == versions.REJECTED).alias("rejected_count"),
        F.max(F.when(F.col("verdict") == versions.EMPTY, F.col("reason"))).alias("reason"),
    ).withColumn("loaded_at", F.current_timestamp().cast("timestamp_ntz"))
    versions.write_batch(files.withColumn("verdict", F.lit(versions.FILE)), table, name, "scrape_date", mode="append")


def ingest_prices(spark: SparkSession, landing: str, table: str, checkpoint: str, mode: str = "append",
                  product_id: Column | None = None, spread: bool = False, **scan) -> versions.Version:
    """Load price files into a table with versions; returns the version that readers see afterwards.

    ``append`` loads the files that are new since the last run, each batch visible once it is written. ``replace`` loads
    all files, whatever was loaded before, and shows them in one moment after the last batch, instead of the old rows and
    the old manifest; a replacement that broke off goes on where it stopped. Rows and rejected rows come from one write and
    one parse. ``read_prices``, ``rejected_prices`` and ``manifest`` read them. ``spread`` deals a batch's documents out to all
    cores before they are looked at, which serves batches of few large files that can't be split, as compressed ones.
    """
    if mode not in ("append", "replace"):
        raise ValueError(f"unknown mode {mode}")
    before = versions.newest(spark, table)
    run = before.run + (mode == "replace")
    stream = landing_stream(spark, landing, **scan)
    fields = StructType(documents.price_verdicts(price_documents(stream, landing, product_id)).schema.fields + StructType.fromDDL(FILE_FIELDS).fields)
    layout = versions.layout(fields, "scrape_date")

    def load(batch: DataFrame, batch_id: int) -> None:
        name = f"{run}-{batch_id}"
        lines = batch.repartition(spark.sparkContext.defaultParallelism) if spread else batch
        _write_prices(price_documents(lines, landing, product_id), table, name, StructType.fromJson(json.loads(layout)))
        if mode == "append":
            now = versions.newest(spark, table)
            parts = versions.days_of(spark, table, name, "scrape_date")
            if not parts <= now.parts:  # a batch that is run again may be listed already
                versions.commit(spark, table, dataclasses.replace(now, run=run, layout=layout, parts=now.parts | parts))

    _finish(stream, load, f"{checkpoint}/run={run}")
    if mode == "replace":
        parts = versions.days_of(spark, table, f"{run}-*", "scrape_date")
        versions.commit(spark, table, dataclasses.replace(before, run=run, layout=layout, parts=frozenset(parts)))
    return versions.newest(spark, table)


def read_prices(spark: SparkSession, table: str) -> DataFrame:
    """The loaded price rows."""
    rows = versions.read(spark, table)
    return rows.select(*[f.name for f in schemas.PRICE_BUCKET.fields]) if rows.columns else \
        spark.createDataFrame([], schemas.PRICE_BUCKET)


def rejected_prices(spark: SparkSession, table: str) -> DataFrame:
    """The rows that were set aside, with the reason and the fraction as it was written."""
    rows = versions.read(spark, table, versions.REJECTED)
    return rows.select(*[f.name for f in schemas.PRICE_BUCKET.fields], "reason") if rows.columns else \
        spark.createDataFrame([], schemas.PRICE_BUCKET.add("reason", "string"))


def manifest(spark: SparkSession, table: str) -> DataFrame:
    """The files that were read: name, scrape date, time of loading, loaded rows, rejected rows.

    Files without rows are listed too, with the reason if a document holds no results.
    """
    rows = versions.read(spark, table, versions.FILE)
    if not rows.columns:
        return spark.createDataFrame([], schemas.MANIFEST)
    return rows.select(F.col("source_file").alias("filepath"), "scrape_date", F.col("loaded_at").alias("upload_timestamp"),
                       "record_count", "rejected_count", "reason")


def not_loaded(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files that the manifest does not list for their scrape date."""
    return files.join(manifest.select("filepath", "scrape_date"), ["filepath", "scrape_date"], "left_anti")


def load_with_quarantine(stream: DataFrame, good: Column, table: str, checkpoint: str,
                         reason: Column | None = None) -> StreamingQuery:
    """Write all rows in one pass, apart by ``verdict``: ``accepted`` where ``good`` holds, else ``rejected``.

    ``reason`` is kept with rejected rows. Each verdict has its own folder below a batch's, so readers of one open no
    file of the other.
    """
    verdict = F.when(good, F.lit(versions.ACCEPTED)).otherwise(F.lit(versions.REJECTED))

    def load(batch: DataFrame, batch_id: int) -> None:
        judged = batch.withColumn("verdict", verdict)
        if reason is not None:
            judged = judged.withColumn("reason", F.when(F.col("verdict") == versions.REJECTED, reason))
        judged.write.partitionBy("verdict").mode("overwrite").parquet(f"{table}/batch={batch_id}")

    return _finish(stream, load, checkpoint)


def load_unique(stream: DataFrame, keys: list[str], order: str, table: str, checkpoint: str, day: str,
                period: str = "month") -> StreamingQuery:
    """Add the rows whose keys the table doesn't hold yet; of new rows with equal keys that of the smallest ``order``.

    However late a row arrives, it is compared with all that was loaded, so no first arrival is lost and no repeat
    passes. ``day`` is the key that names a row's day: the table has a folder for each ``period`` of it, and a batch is
    compared with the rows of its own periods only, which are chosen before any file is opened. A null in a key equals a
    null. A batch that is run again overwrites its own folder and doesn't see it.
    """
    if day not in keys:
        raise ValueError(f"{day} has to be one of the keys")
    slot = F.trunc(F.col(day), period)

    def load(batch: DataFrame, batch_id: int) -> None:
        loaded = loaded_before(batch.sparkSession, table, batch, slot, batch_id)
        # Loaded keys stand before the batch's rows, so one window tells which of these come first of all.
        both = batch.withColumn("_order", F.struct(F.lit(True).alias("new"), F.col(order).alias("at"))).unionByName(
            loaded.select(*keys, F.struct(F.lit(False).alias("new"), F.lit(None).cast(batch.schema[order].dataType).alias("at"))
                          .alias("_order")), allowMissingColumns=True)
        ties = [f.name for f in batch.schema.fields if f.name not in {*keys, order} and not isinstance(f.dataType, MapType)]
        first = dedup.keep_one(both, keys, "_order", keep="earliest", tie_break=ties)
        added = first.filter("_order.new").drop("_order").withColumn("period", slot)
        added.hint("rebalance", "period").write.partitionBy("period").mode("overwrite").parquet(f"{table}/batch={batch_id}")

    return _finish(stream, load, checkpoint)


def loaded_before(spark: SparkSession, table: str, batch: DataFrame, slot: Column, batch_id: int) -> DataFrame:
    """The loaded rows of the periods that occur in a batch, without those of that batch itself."""
    found = [r[0] for r in batch.select(slot).distinct().collect()]  # at most the calendar's
    rows = versions.read_or_empty(spark, table, f"{_layout(batch)}, batch BIGINT, period DATE")
    touched = F.col("period").isin([p for p in found if p is not None])
    return rows.filter(F.col("batch") != batch_id).filter(touched | F.col("period").isNull() if None in found else touched)


def _layout(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def write_stream(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append all rows available now to a Parquet folder."""
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", table).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query
