from __future__ import annotations

import random

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallymint.llm import common, packing, passages

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def limit(spark):
    before = spark.conf.get(LIMIT)
    yield lambda value: spark.conf.set(LIMIT, value)
    spark.conf.set(LIMIT, before)


def batch_sizes(df):
    def work(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])

    return [r["size"] for r in df.mapInArrow(work, "size long").collect()]


def test_packing_gets_long_texts_in_small_batches(spark, table, limit):
    limit("64m")
    docs = table(["word " * 300_000] * 20).coalesce(1)
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end=1)
    assert max(batch_sizes(docs.select("doc_id", "text"))) < common.BATCH_BYTES + 2_000_000
    assert pieces.groupBy("doc_id").sum("length").where("`sum(length)` = 300002").count() == 20  # the last white space too


def test_smaller_batches_of_the_session_stay(spark, limit):
    limit("1m")
    common.small_batches(spark)
    assert spark.conf.get(LIMIT) == "1m"
    limit("32m")
    common.small_batches(spark)
    assert spark.conf.get(LIMIT) == str(common.BATCH_BYTES)


def test_common_seeds_equal_a_plain_version(spark, monkeypatch):
    """Frequent seeds, repeats within an id and rows that share an id, in chunks far smaller than a seed's rows."""
    rng = random.Random(4)
    rows = []
    for doc in [*range(60), 7, 7]:  # the id 7 has three texts
        for seed in range(-3, 12):
            places = sorted(rng.sample(range(1000), rng.choice((0, 1, 1, 2, 5)) if seed > 0 else 3 if seed else int(doc == 7) * 4))
            rows += [(doc, at, seed, nth) for nth, at in enumerate(places)]
    rows += [(99, 5, 50, 0), (99, 8, 50, 1), (99, 5, 50, 0)]
    want, groups = [], {}
    for doc, at, seed, nth in rows:
        groups.setdefault((seed, nth), []).append((doc, at))
    for doc, at, seed, nth in rows:
        if len({d for d, _ in groups[seed, 0]}) > 1:
            hub, here = min(groups[seed, 0]), min(groups[seed, nth])
            want.append((doc, at, seed, nth, *hub, *(here if nth and here[0] != doc else (None, None))))
    found = spark.createDataFrame(rows, "id long, at long, seed long, nth long").repartition(3)
    name = lambda: sorted(map(tuple, passages.common_seeds(found).collect()), key=str)
    assert name() == sorted(want, key=str)
    monkeypatch.setitem(passages.common_seeds.__globals__, "PLACES", 1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert name() == sorted(want, key=str)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_seeds_move_once(spark, table):
    """Of all seeds one shuffle is made, before: one for the hubs and one for the seeds that have them."""
    docs = table(["a b c"]).select(F.col("doc_id").alias("id"), "text")
    plan = passages.common_seeds(passages.find_seeds(docs))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(seed") == 1 and "Join" not in plan
