"""Mixing sources to target weights by a splitting tree.

The documents of a source, in a random order, form one line of words that is cut into blocks of equal length. A source's
quota is the number of blocks that its target takes; beyond the whole line it begins again, in another random order. The
quotas of all sources are the colours of an urn: a node of the tree divides its shards in two and draws the left half's
blocks from the node's quotas by a multivariate hypergeometric distribution, the rest goes right, until each shard has
its exact quota of each source. So every shard is a random sample of the mix, and the quotas add up without rounding. A
shard's quota is a range of the source's permuted blocks: ranges are disjoint, so nothing is drawn twice. Rows of a
shard are then shuffled within it.

Every random choice is a function of the seed, so reruns and repeated tasks agree. Nothing passes the driver but a few
totals. Equal rows (same id, source and text) are counted before they move, and lines are laid out by buckets of a hash, so
that neither a hot source nor a group of copies lies in one task. A task of the tree holds two numbers for each source.

Targets: sources, ordered by code points with null last, weigh ``weights`` in turn and share all words; a target stops at
``most`` times its source's size, and the excess is shared by weight among the others.

Defined cases: a null text has no words, and documents without words take nothing. A null source is a source of its own, a
null id an id like any other. Rows that repeat each get their own part. A very long text lies in many blocks. Sources
without words have a target of 0. An empty table gives no rows. Other columns of the input aren't carried, so their names
can't clash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from .common import documents, stored, text_of
from .registry import query

#: Shares of the sources, in turn.
WEIGHTS = (5, 2, 1)
#: A target is at most so many times its source's size.
MOST = 3
#: Words of a block. A larger table has longer ones, so that the blocks can be counted by the sampler.
BLOCK_WORDS = 256
MOST_BLOCKS = 2**29
#: Words of a shard, about.
SHARD_WORDS = 8_000_000
#: Shards that one node's task opens; more are opened by further rounds.
FAN = 64
#: Buckets of a source's line: as many rows each at first, then longer.
BUCKET_ROWS, MOST_BUCKETS = 4096, 2**20
#: Blocks of a source that are looked up together.
SLICE = 256
WORD = r"[^\x20\x09-\x0D]+"


def _hash(key: str, text: str) -> Column:
    return F.xxhash64(F.lit(17), F.col(key), text_of(text))


def classes(docs: DataFrame, key: str, source: str, text: str) -> DataFrame:
    """Equal rows once: ``id``, ``source``, ``size`` in words, ``hash`` and ``copies``."""
    rows = docs.select(
        F.col(key).alias("id"), F.col(source).cast("string").alias("source"),
        F.regexp_count(text_of(text), F.lit(WORD)).cast("long").alias("size"),
        _hash(key, text).alias("hash"))
    return stored(rows.groupBy("id", "source", "size", "hash").agg(F.count("*").alias("copies")), "classes")


def ranked(sources: DataFrame) -> DataFrame:
    """Sources with their ``rank`` from 0, by code points, null last; ranges are ranked side by side."""
    order = [F.col("source").isNull(), F.col("source")]
    ranges = stored(sources.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    starts = ranges.groupBy("range").agg(F.count("*").alias("n")) \
        .select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("range").orderBy(*order))
    return ranges.join(starts, "range").select("source", "size", (F.col("start") + place - 1).alias("rank"))


def weight_of(rank: str, weights: tuple[int, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col(rank) % len(weights) + 1).cast("int"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source``, ``rank``, ``size`` and ``target`` of each source; a round of resharing is one aggregation."""
    named = stored(ranked(sizes).withColumn("weight", weight_of("rank", weights)), "sources")
    limit = (F.col("size") * most).cast("double")
    share, full = 0.0, -1
    while True:
        stopped = limit <= F.col("weight") * share
        row = named.agg(
            F.sum("size").alias("all"), F.sum(F.when(stopped, limit)).alias("given"),
            F.sum(F.when(~stopped, F.col("weight"))).alias("weight"), F.count(F.when(stopped, True)).alias("n")).first()
        if row["weight"] is None or row["n"] == full:
            break
        full = row["n"]
        share = ((row["all"] or 0) - (row["given"] or 0)) / row["weight"]
    target = F.when(limit <= F.col("weight") * share, limit).otherwise(F.col("weight") * share)
    return named.select("source", "rank", "size", F.least(target, limit).alias("target"))


def quotas(sources: DataFrame, block: int) -> DataFrame:
    """Adds the ``words`` to take of each source, the ``blocks`` of its line, and the ``quota`` of blocks that hold them."""
    lines = sources.withColumn("words", F.round("target").cast("long")) \
        .withColumn("blocks", F.ceil(F.col("size") / F.lit(block)).cast("long"))
    whole = F.expr("IF(size > 0, words DIV size, 0)")
    rest = F.col("words") - whole * F.col("size")
    return lines.withColumn("quota", whole * F.col("blocks") + F.ceil(rest / F.lit(block)).cast("long"))


# --- the splitting tree ------------------------------------------------------------------------

def divide(first: int, last: int, quota: np.ndarray, capacity, seed: int) -> np.ndarray:
    """The blocks of each source that the left half of a node's shards draws."""
    middle = (first + last) // 2
    wanted = capacity(middle) - capacity(first)
    return np.random.default_rng([seed, first, last]).multivariate_hypergeometric(quota, wanted, method="marginals")


def shard_quotas(quotas: DataFrame, shards: int, seed: int, fan: int = FAN) -> DataFrame:
    """Ranges of the permuted blocks for each shard: ``shard``, ``rank``, ``begin`` and ``end``; empty ones are left out.

    A row is a node: its shards, and for each of its sources the first block and the quota. Each round opens all nodes to
    ``fan`` smaller ones at most, in tasks of their own.
    """
    kind = "first long, last long, ranks array<long>, begins array<long>, counts array<long>"
    total = quotas.agg(F.sum("quota")).first()[0] or 0

    def capacity(shard: int) -> int:
        return total * shard // shards

    def opened(rows):
        """Nodes below the given ones: the shards of each are halved until there are ``fan`` parts."""
        names = ["first", "last", "ranks", "begins", "counts"]
        types = [pa.int64(), pa.int64()] + [pa.list_(pa.int64())] * 3
        for batch in rows:
            for row in batch.to_pylist():
                step = max(1, math.ceil((row["last"] - row["first"]) / fan))
                nodes = [(row["first"], row["last"], *(np.array(row[c], np.int64) for c in names[2:]))]
                while nodes:
                    first, last, ranks, begins, counts = nodes.pop()
                    if last - first > step:
                        left = divide(first, last, counts, capacity, seed)
                        middle = (first + last) // 2
                        for a, b, at, n in ((middle, last, begins + left, counts - left), (first, middle, begins, left)):
                            some = n > 0
                            nodes.append((a, b, ranks[some], at[some], n[some]))
                    else:
                        values = (first, last, ranks, begins, counts)
                        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)

    colours = F.sort_array(F.collect_list(F.struct("rank", "quota")))
    nodes = quotas.where("quota > 0").agg(colours.alias("colours")).select(
        F.lit(0).cast("long").alias("first"), F.lit(shards).cast("long").alias("last"),
        F.col("colours.rank").alias("ranks"),
        F.transform("colours", lambda c: F.lit(0).cast("long")).alias("begins"), F.col("colours.quota").alias("counts"))
    width = shards
    while width > 1:
        nodes = stored(nodes.repartition("first").mapInArrow(opened, kind), "nodes")
        width = math.ceil(width / fan)
    parts = nodes.select(F.col("first").alias("shard"), F.inline(F.arrays_zip("ranks", "begins", "counts")))
    return parts.select("shard", F.col("ranks").alias("rank"), F.col("begins").alias("begin"),
                        (F.col("begins") + F.col("counts")).alias("end"))


# --- blocks of the lines -----------------------------------------------------------------------

def laid_out(rows: DataFrame, count: int, seed: int) -> DataFrame:
    """Rows with the ``start`` of their words on their source's line, in the order of a seeded hash.

    Buckets of the hash are summed first, then the rows within each are: at most MOST_BUCKETS rows of a source, or the
    rows of one bucket, are in one task.
    """
    buckets = min(MOST_BUCKETS, 1 << max(0, math.ceil(math.log2(max(1, count) / BUCKET_ROWS))))
    placed = rows.withColumn("order", F.xxhash64(F.lit(seed), F.col("hash"))) \
        .withColumn("bucket", F.pmod(F.shiftrightunsigned("order", 20), F.lit(buckets)))
    words = F.sum(F.col("size") * F.col("copies"))
    earlier = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("rank", "bucket").agg(words.alias("words")) \
        .select("rank", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("rank", "bucket").orderBy("order", "size", F.asc_nulls_first("id")) \
        .rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("inner", F.coalesce(words.over(inside), F.lit(0)))
    return local.join(sums, ["rank", "bucket"]).withColumn("start", F.col("base") + F.col("inner")) \
        .drop("order", "bucket", "base", "inner")


def cut(rows: DataFrame, block: int) -> DataFrame:
    """Each copy of the rows cut at the bounds of blocks: ``copy``, ``start``, ``block``, and ``lower`` to ``upper`` in it."""
    copies = rows.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))) \
        .withColumn("start", F.col("start") + F.col("copy") * F.col("size"))
    last = F.expr(f"(start + size - 1) DIV {block}")
    parts = copies.where("size > 0").withColumn("block", F.explode(F.sequence(F.expr(f"start DIV {block}"), last)))
    base = F.col("block") * block
    return parts.withColumn("lower", F.greatest("start", base) - base) \
        .withColumn("upper", F.least(F.col("start") + F.col("size"), base + block) - base)


def permuted(block: np.ndarray, blocks: np.ndarray, rank: np.ndarray, epoch: np.ndarray, seed: int) -> np.ndarray:
    """The place of each block in its source's random order of an epoch; the last block, which may be short, stays last.

    A Feistel network over the next even power of two, walked on until the place lies below the number of blocks.
    """
    n = np.maximum(blocks - 1, 1).astype(np.uint64)
    half = np.ones(len(block), np.uint64)
    while (short := (np.uint64(1) << (half * np.uint64(2))) < n).any():
        half = half + short.astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    key = mixed(rank.astype(np.uint64) * np.uint64(8) + epoch.astype(np.uint64), np.uint64(seed))
    out = block.astype(np.uint64)
    walk = np.flatnonzero(block < blocks - 1)
    while len(walk):
        x, h, m, k = out[walk], half[walk], mask[walk], key[walk]
        left, right = x >> h, x & m
        for turn in range(6):
            left, right = right, left ^ (mixed(right, k + np.uint64(turn)) & m)
        out[walk] = (left << h) | right
        walk = walk[out[walk] >= n[walk]]
    return out.astype(np.int64)


def mixed(x: np.ndarray, key) -> np.ndarray:
    """A hash of 64-bit numbers under a key."""
    with np.errstate(over="ignore"):
        x = (x ^ key) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(16)


def drawn(parts: DataFrame, block: int, most: int, seed: int) -> DataFrame:
    """Each part once for every place in its source's permuted blocks at which it is taken.

    Adds ``place`` (a permuted block), ``epoch``, and the words ``from_word`` and ``words`` of the document.
    """
    kept = ["id", "rank", "hash", "copy"]
    schema = T.StructType([parts.schema[n] for n in kept] + T._parse_datatype_string(
        "place long, epoch int, from_word long, words long").fields)

    def work(batches):
        for batch in batches:
            rank, start, length, words, blocks, at, lower, upper = (
                batch.column(n).to_numpy() for n in ("rank", "start", "length", "words", "blocks", "block", "lower", "upper"))
            found = []
            for epoch in range(most):
                place = permuted(at, blocks, rank, np.full(len(at), epoch), seed)
                # The last block taken is the only one of which less than all is taken.
                end = np.minimum(upper, words - epoch * length - place * block)
                some = np.flatnonzero(end > lower)
                found.append((some, (place + epoch * blocks)[some], np.full(len(some), epoch, np.int32),
                              (at * block + lower - start)[some], (end - lower)[some]))
            some, *columns = (np.concatenate(v) for v in zip(*found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(n).take(pa.array(some)) for n in kept] + [pa.array(c) for c in columns], schema.names)

    return parts.mapInArrow(work, schema)


def dealt(parts: DataFrame, ranges: DataFrame) -> DataFrame:
    """The drawn parts with the ``shard`` whose range holds their place; each look-up takes the ranges of one slice."""
    cell = F.explode(F.sequence(F.expr(f"begin DIV {SLICE}"), F.expr(f"(end - 1) DIV {SLICE}")))
    cells = ranges.select("rank", "shard", "begin", cell.alias("slice")).groupBy("rank", "slice") \
        .agg(F.array_sort(F.collect_list(F.struct("begin", "shard"))).alias("starts"))
    found = parts.withColumn("slice", F.expr(f"place DIV {SLICE}")).join(cells, ["rank", "slice"])
    own = F.element_at(F.filter("starts", lambda s: s["begin"] <= F.col("place")), -1)
    return found.withColumn("shard", own["shard"]).drop("slice", "starts")


# --- the operator ------------------------------------------------------------------------------

@dataclass
class Mix:
    """``sources``: source, rank, size, target; ``rows``: equal rows once; ``parts``: what the shards hold."""

    sources: DataFrame
    rows: DataFrame
    parts: DataFrame


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = 1, block_words: int = BLOCK_WORDS,
        shard_words: int = SHARD_WORDS, key: str = "doc_id", source: str = "source", text: str = "text") -> Mix:
    """The mix of all documents.

    A row of ``parts`` is a stretch of a document: ``shard``, ``id``, ``hash`` and ``copy`` (which of equal rows),
    ``rank`` of the source, ``epoch``, ``place`` (its block in the source's random order), ``from_word`` and ``words``.
    """
    counted = classes(docs, key, source, text)
    sizes = counted.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("size"))
    sources = targets(sizes, weights, most)
    total = sources.agg(F.sum("size")).first()[0] or 0
    block = max(block_words, -(-total // MOST_BLOCKS))
    lines = stored(quotas(sources, block), "lines")
    ranges = shard_quotas(lines, max(1, -(-total // shard_words)), seed)
    named = lines.select(F.col("source").alias("name"), "rank", F.col("size").alias("length"), "words", "blocks")
    rows = counted.join(named, F.col("source").eqNullSafe(F.col("name"))).drop("source", "name")
    parts = dealt(drawn(cut(laid_out(rows, counted.count(), seed), block), block, most, seed), ranges)
    return Mix(lines.select("source", "rank", "size", "target"), counted, parts)


def shuffled(parts: DataFrame, seed: int = 1) -> DataFrame:
    """The parts with their ``position`` in their shard: its blocks in random order, the parts of a block in theirs."""
    block = F.xxhash64(F.lit(seed), "shard", "rank", "place")
    order = Window.partitionBy("shard").orderBy(block, "rank", "place", "hash", "copy", "from_word")
    return parts.withColumn("position", F.row_number().over(order) - 1)


def texts(docs: DataFrame, parts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """What the shards hold, ``shard``, ``position``, ``id``, ``text``: the words of each part with the white space before."""
    placed = shuffled(parts)
    own = docs.select(F.col(key).alias("id"), text_of(text).alias("text"), _hash(key, text).alias("hash")) \
        .dropDuplicates(["id", "hash"])
    words = F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    same = placed["hash"].eqNullSafe(own["hash"]) & placed["id"].eqNullSafe(own["id"])
    return placed.join(own, same).select("shard", "position", placed["id"], F.array_join(
        F.slice(words, (F.col("from_word") + 1).cast("int"), F.col("words").cast("int")), "").alias("text"))


def taken(mixed: Mix, key: str = "doc_id") -> DataFrame:
    """One row per document: ``key``, ``size``, ``source_size``, ``target`` and the words ``taken``."""
    by = ["id", "hash", "copy", "rank"]
    names = mixed.sources.select(F.col("source").alias("name"), "rank", F.col("size").alias("source_size"), "target")
    whole = mixed.rows.join(names.select("name", "rank"), F.col("source").eqNullSafe(F.col("name")))
    nothing = whole.select("id", "hash", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"), "rank",
                           "size", F.lit(0).cast("long").alias("words"))
    some = mixed.parts.select("id", "hash", "copy", "rank", F.lit(0).cast("long").alias("size"), "words")
    sums = nothing.unionByName(some).groupBy(*by).agg(F.sum("size").alias("size"), F.sum("words").alias("taken"))
    return sums.join(names.drop("name"), "rank").select(F.col("id").alias(key), "size", "source_size", "target", "taken")


@query("op11_source_mix")
def op11_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the words that the mix of all sources takes of it."""
    return taken(mix(documents(spark, folder).select("doc_id", "text", "source")))
