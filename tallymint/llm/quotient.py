"""Exact de-duplication with counting quotient filters.

A fingerprint of 64 bits falls into a quotient (its upper bits) and a remainder. Each task builds a filter of its own
rows: for each quotient the sorted distinct remainders with their counts. Filters merge without loss, quotient by
quotient, as sorted runs whose counts add up; a large group of copies is one remainder with a large count, wherever its
rows lie. Fingerprints counted once are done. Rows of the others go to byte verification, which compares whole texts
(rows are summed by text within each task before any text moves), so equal fingerprints of different texts separate.

Defined cases: a null text counts as empty, and empty texts are copies of one another. Null ids are smaller than all
others; of a group with only null ids the id that stays is null. Rows that repeat with the same id and text count one by
one in ``group_size`` and are all marked kept by ``exact_copies``; ``drop_copies`` leaves one of them. An empty table gives
an empty result. Columns named ``keep_id``, ``group_size``, ``kept`` or ``text_sha256`` are replaced in the result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import counted, documents, stored, text_of
from .registry import query

#: Rows for each quotient, about: the number of quotients follows the number of rows.
RUN_ROWS = 4096
#: Rows after which a task gives out its filter and begins another.
FILTER_ROWS = 1_000_000
FILTER = "quotient long, remainders binary, counts binary"


def quotient_bits(rows: int) -> int:
    return max(0, min(40, math.ceil(math.log2(max(1, rows) / RUN_ROWS))))


def runs(fingerprints: np.ndarray, counts: np.ndarray, bits: int):
    """The runs of a filter: each quotient with its sorted remainders and their counts."""
    shift = np.uint64(64 - bits) if bits else None
    order = np.argsort(fingerprints, kind="stable")
    values, first = np.unique(fingerprints[order], return_index=True)
    if not len(values):
        return
    total = np.add.reduceat(counts[order], first)
    quotient = (values >> shift).astype(np.int64) if bits else np.zeros(len(values), np.int64)
    remainder = values & ((np.uint64(1) << shift) - np.uint64(1)) if bits else values
    start = np.flatnonzero(np.append(True, quotient[1:] != quotient[:-1]))
    for a, b in zip(start.tolist(), [*start[1:].tolist(), len(values)]):
        yield int(quotient[a]), remainder[a:b], total[a:b]


def build_filters(fingerprints: DataFrame, bits: int) -> DataFrame:
    """Counting quotient filters of each task's rows of ``fingerprint``, one row per run."""
    def build(batches):
        held, size = [], 0

        def out():
            rows = [(q, r.astype("<u8").tobytes(), c.astype("<u8").tobytes())
                    for q, r, c in runs(np.concatenate(held), np.ones(size, np.int64), bits)]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(zip(*rows), (pa.int64(), pa.binary(), pa.binary()))],
                ["quotient", "remainders", "counts"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch.column("fingerprint").to_numpy().astype(np.uint64))
                size += batch.num_rows
            if size >= FILTER_ROWS:
                yield out()
                held, size = [], 0
        if size:
            yield out()

    return fingerprints.select("fingerprint").mapInArrow(build, FILTER)


def repeated_fingerprints(filters: DataFrame, bits: int) -> DataFrame:
    """Merge the filters and give the fingerprints counted more than once.

    A group has the runs of one quotient, about RUN_ROWS distinct remainders, whatever the data.
    """
    def merge(group: pd.DataFrame) -> pd.DataFrame:
        remainders = np.concatenate([np.frombuffer(r, "<u8") for r in group["remainders"]])
        counts = np.concatenate([np.frombuffer(c, "<u8") for c in group["counts"]]).astype(np.int64)
        _, values, total = next(runs(remainders, counts, 0))
        if bits:
            values = values | (np.uint64(group["quotient"].iloc[0]) << np.uint64(64 - bits))
        many = total > 1
        return pd.DataFrame({"fingerprint": values[many].astype(np.int64), "n": total[many]})

    return filters.groupBy("quotient").applyInPandas(merge, "fingerprint long, n long")


def copy_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Groups of two or more equal texts: fingerprint, digest, the id that stays, rows, and rows that have that id."""
    prints = docs.select(key, text_of(text).alias("text"), F.xxhash64(text_of(text)).alias("fingerprint"))
    bits = quotient_bits(docs.count())
    # Written, so that the planner knows the size: few fingerprints are broadcast, many are joined by shuffle.
    repeated = stored(repeated_fingerprints(build_filters(prints, bits), bits), "repeated")
    suspects = prints.join(repeated.select("fingerprint"), "fingerprint", "left_semi")
    # Byte verification; the partial sums hold one row for each text and task.
    classes = suspects.groupBy("fingerprint", "text").agg(F.max(key).alias("keep_id"), F.count("*").alias("group_size"))
    classes = classes.where("group_size > 1")
    return stored(classes.select("fingerprint", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size"), "classes")


def exact_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``. The largest id stays."""
    classes = copy_classes(docs, key, text)
    rows = docs.select(key, F.xxhash64(text_of(text)).alias("fingerprint"), F.sha2(text_of(text), 256).alias("text_sha256"))
    found = rows.join(classes, ["fingerprint", "text_sha256"], "left")
    stays = F.when(F.col("group_size").isNull(), F.col(key)).otherwise(F.col("keep_id"))
    return found.select(key, stays.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                        F.col(key).eqNullSafe(stays).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without those of which a copy stays; all columns as they were."""
    columns = docs.columns
    classes = copy_classes(docs, key, text)
    marked = docs.withColumn("_fingerprint", F.xxhash64(text_of(text)))
    # All other texts stay, and stay where they are while the fingerprints of copies are few.
    copied = counted(classes.select(F.col("fingerprint").alias("_copied")).distinct(), "copied")
    alone = marked.join(copied, F.col("_fingerprint") == F.col("_copied"), "left_anti")
    marked = marked.join(copied, F.col("_fingerprint") == F.col("_copied"), "left_semi").withColumn("_digest", F.sha2(text_of(text), 256))
    named = classes.select(F.col("fingerprint").alias("_fingerprint"), F.col("text_sha256").alias("_digest"),
                           F.col("keep_id").alias("_keep"))
    # Rows that a copy replaces, and ids that stay but occur in several rows; few columns move, no text.
    fates = (marked.select(F.col(key).alias("_id"), "_fingerprint", "_digest").join(named, ["_fingerprint", "_digest"])
             .groupBy("_id", "_fingerprint", "_digest").agg(F.first("_keep").alias("_keep"), F.count("*").alias("_rows")))
    fates = stored(fates, "fates")
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"f.{c}")) for c in ("_fingerprint", "_digest")]
    same.append(F.col(f"d.`{key}`").eqNullSafe(F.col("f._id")))
    stays = F.col("_id").eqNullSafe(F.col("_keep"))
    gone = fates.where(~stays | (F.col("_rows") > 1))
    kept = marked.alias("d").join(gone.alias("f"), same, "left_anti")
    several = fates.where(stays & (F.col("_rows") > 1))
    one = (marked.alias("d").join(several.alias("f"), same, "left_semi")
           .dropDuplicates([key, "_fingerprint", "_digest"]))
    return alone.select(*columns).unionByName(kept.select(*columns)).unionByName(one.select(*columns))


@query("op4_exact_dedup", """
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""")
def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the one of its equals that stays."""
    return exact_copies(documents(spark, folder).select("doc_id", "text"))
