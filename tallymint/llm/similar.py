"""Jaccard join of word n-grams: size-aware, heavy and light.

A document's set has its distinct n-grams of words. Small (light) sets list, for each size of a possible partner, all
subsets of the overlap that the threshold asks for; equal subsets link without further work. Large (heavy) sets scan
inverted lists: those of the first n-grams of each set in one global order, rarest first, which no similar pair can
miss. Every n-gram of the corpus is counted for that order, in an array of fixed size: n-grams that share a counter look
more frequent than they are, which decides cost only. The boundary between both is the size at which the subsets of the
corpus's sets cost more than their lists.

Sets that are equal become one representative. In a list, everything is first compared with one hub, then whole
clusters with one another by their best members, and only pairs of different clusters are listed one by one: a large
group of near copies costs about one comparison per member and list. A sketch of each set, n-grams counted by CELLS
ranges of their hashes, bounds the overlap of a pair from above; every candidate that may reach the threshold is verified
on whole sets, which only the documents of such pairs are cut into again. Links are exact, but for collisions of 64-bit
hashes of words and n-grams.

Defined cases: null or empty texts and texts without words have an empty set, and are linked with nothing; null ids have
no component and are linked with nothing; rows that share an id are one document with several sets; an empty table
gives no rows; ``n_shingles`` and ``component_id`` replace columns of those names.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import common
from .common import counted, documents, memory_returned, removed, slices, stored, stored_at
from .components import components
from .registry import query

#: Counters of n-grams for the global order (a power of two), a byte each. The order decides cost only.
COUNTERS = 1 << 25
#: Counters that are added up together.
BLOCK = 1 << 16
#: Tasks that add them up.
ADDERS = 32
#: Times that lists are compared with hubs before the remaining pairs are listed. It decides cost only.
ROUNDS = 2
#: No boundary lies beyond this size; subsets of larger sets cost too much anyway.
LARGEST_LIGHT = 32
#: Marks of listed n-grams, 2 to this power at most (32 MB), else about 16 for each list. It decides cost only.
MARK_BITS = 28
#: Cells of a sketch (a power of two), a byte each. It decides cost only.
CELLS = 128
#: Cells of its short form, by which pairs of a list are compared before they are written.
FOLDS = 32
SETS = "id long, n long, one long, two long, tokens array<long>, sketch binary, fold array<short>"


def ngrams(text: str, width: int) -> np.ndarray:
    """Distinct hashes of the word n-grams of a text, sorted; a shorter text is one n-gram."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(width, len(codes))
    found = np.full(len(codes) - size + 1, size, np.uint64)
    for k in range(size):
        found = (found ^ codes[k:k + len(found)]) * np.uint64(0x9E3779B97F4A7C15)
        found ^= found >> np.uint64(29)
    return np.unique(found)


def sketch(found: np.ndarray) -> bytes:
    """N-grams in each range of hashes, 255 at most."""
    cell = (found >> np.uint64(65 - CELLS.bit_length())).astype(np.int64)
    return np.minimum(np.bincount(cell, minlength=CELLS), 255).astype(np.uint8).tobytes()


def needed(a: int, b: int, part: int, whole: int) -> int:
    """The least overlap o of sets of these sizes with whole * o >= part * (a + b - o)."""
    return -(-part * (a + b) // (whole + part))


def partners(n: int, part: int, whole: int) -> range:
    """Sizes of sets that can be similar to one of size n."""
    return range(max(1, -(-part * n // whole)), whole * n // part + 1)


def light_cost(n: int, part: int, whole: int, most: int) -> int:
    """Subsets that a set of size n lists, for partners up to the size ``most``."""
    return sum(comb(n, needed(n, m, part, whole)) for m in partners(n, part, whole) if m <= most)


def counter(found: np.ndarray) -> np.ndarray:
    """The counters of n-grams."""
    return (found >> np.uint64(65 - COUNTERS.bit_length())).astype(np.int64)


def levels(docs: DataFrame, width: int) -> np.ndarray:
    """How frequent the n-grams of each counter are, over all documents: COUNTERS numbers of one byte.

    A task counts up to 255 in a counter. Counts below 16 are their own level; above, eight levels double them.
    """
    def count(batches):
        seen = np.zeros(COUNTERS, np.uint8)
        for batch in batches:
            for _, texts in slices(batch, "text"):
                at, times = np.unique(np.concatenate([counter(ngrams(t, width)) for t in texts]), return_counts=True)
                seen[at] = np.minimum(seen[at] + times, 255)
        for start in range(0, COUNTERS, BLOCK):
            block = seen[start:start + BLOCK]
            if block.any():
                yield pa.RecordBatch.from_arrays([pa.array([start // BLOCK]), pa.array([pa.compress(block.tobytes(), "zstd", asbytes=True)])],
                                                 ["block", "counts"])
        del seen
        memory_returned()

    def add(batches):
        total = {}
        for batch in batches:
            for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
                counts = np.frombuffer(pa.decompress(counts, BLOCK, "zstd", asbytes=True), np.uint8)
                total[block] = total[block] + counts if block in total else counts.astype(np.int64)
        for block, counts in total.items():
            level = np.where(counts < 16, counts, np.minimum(16 + 8 * np.log2(np.maximum(counts, 16) / 16), 255))
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([level.astype(np.uint8).tobytes()])], ["block", "level"])

    counts = docs.select("text").mapInArrow(count, "block long, counts binary")
    out = np.zeros(COUNTERS, np.uint8)
    for row in counts.repartition(ADDERS, "block").mapInArrow(add, "block long, level binary").collect():
        out[row["block"] * BLOCK:(row["block"] + 1) * BLOCK] = np.frombuffer(row["level"], np.uint8)
    return out


def sets(docs: DataFrame, width: int, part: int, whole: int, order: np.ndarray | None) -> DataFrame:
    """Each document's set: size, fingerprint in two numbers, n-grams, sketch and its short form.

    With an ``order`` (the counters' levels), sets that aren't small have their first n-grams only.
    """
    def work(batches):
        for batch in batches:
            for rows, texts in slices(batch, "text"):
                out = [[], [], [], [], [], []]
                for text in texts:
                    found = ngrams(text, width)
                    n, cells = len(found), sketch(found)
                    mark = xxhash.xxh3_128(found.tobytes()).digest()
                    keep = n
                    if order is not None:
                        found = found[np.argsort(order[counter(found)], kind="stable")]
                        if n > LARGEST_LIGHT:
                            keep = n - -(-part * n // whole) + 1
                    one, two = np.frombuffer(mark, "<i8").tolist()
                    fold = np.frombuffer(cells, np.uint8).reshape(FOLDS, -1).sum(axis=1, dtype=np.int16)
                    for column, value in zip(out, (n, one, two, found[:keep].astype(np.int64), cells, fold)):
                        column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id").cast(pa.int64()), *map(pa.array, out[:3]), pa.array(out[3], pa.list_(pa.int64())),
                     pa.array(out[4], pa.binary()), pa.array(out[5], pa.list_(pa.int16()))],
                    ["id", "n", "one", "two", "tokens", "sketch", "fold"])
        memory_returned()

    return docs.select("id", "text").mapInArrow(work, SETS)


def boundary(reps: DataFrame, lists: DataFrame, part: int, whole: int) -> int:
    """The largest light size: subsets up to it cost less than scanning the lists of those sets.

    ``lists`` has the lists with two members or more; all others have one.
    """
    first = F.col("n") - F.ceil(1.0 * part * F.col("n") / whole) + 1
    entries = reps.agg(F.sum(first).cast("double")).first()[0] or 0.0
    shared = lists.agg(F.sum("len").cast("double").alias("one"), F.sum(F.col("len").cast("double") * F.col("len")).alias("two")).first()
    scanned = (entries - (shared["one"] or 0.0) + (shared["two"] or 0.0)) / entries if entries else 1.0
    sizes = {r["n"]: r["count"] for r in reps.where(F.col("n") <= LARGEST_LIGHT).groupBy("n").count().collect()}
    best, least = 0, None
    for x in range(LARGEST_LIGHT + 1):
        cost = sum(c * light_cost(n, part, whole, x) for n, c in sizes.items() if n <= x)
        cost += sum(c * (n - -(-part * n // whole) + 1) * (1 + scanned) for n, c in sizes.items() if n > x)
        if least is None or cost < least:
            best, least = x, cost
    return best


def with_partners(postings: DataFrame, lists: DataFrame, size: int) -> DataFrame:
    """The postings whose n-gram is marked in a bitmap of the ``lists``, and a few others that share a mark.

    Most n-grams are in no list; what is left out here doesn't move to the join with the lists, which stays exact.
    """
    bits = min(MARK_BITS, max(16, (16 * size).bit_length()))
    place = F.shiftrightunsigned("token", 64 - bits) + 1
    rows = lists.select(F.bitmap_bucket_number(place).alias("block"), F.bitmap_bit_position(place).alias("bit"))
    found = rows.repartition("block").groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    marks = np.zeros((1 << bits) >> 3, np.uint8)
    for row in found:
        block = np.frombuffer(row["bits"], np.uint8)
        marks[(row["block"] - 1) * len(block):row["block"] * len(block)] = block

    def work(batches):
        for batch in batches:
            at = (batch.column("token").to_numpy().astype(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
            yield batch.filter(pa.array((marks[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)))

    return postings.mapInArrow(work, postings.schema)


def light_links(reps: DataFrame, most: int, part: int, whole: int) -> DataFrame:
    """Links of sets of at most ``most`` n-grams, by equal subsets.

    A subset of the overlap for sizes (lo, hi) is one key. A member of size lo links with all that share it.
    """
    def work(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                out = [[], [], [], []]
                for rep, n, tokens in zip(*(rows.column(c).to_pylist() for c in ("rep", "n", "tokens"))):
                    values = np.sort(np.array(tokens, np.int64)).astype(np.uint64)
                    for m in partners(n, part, whole):
                        if m > most:
                            continue
                        lo, hi = min(n, m), max(n, m)
                        for subset in combinations(values.tolist(), needed(n, m, part, whole)):
                            out[0].append(lo * 4096 + hi)
                            out[1].append(xxhash.xxh3_64_intdigest(np.array(subset, np.uint64).tobytes()) - (1 << 63))
                            out[2].append(rep)
                            out[3].append(n == lo)
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.bool_()))],
                                                 ["sizes", "subset", "rep", "least"])

    keys = reps.where(F.col("n").between(1, most)).mapInArrow(work, "sizes long, subset long, rep long, least boolean")
    hubs = keys.groupBy("sizes", "subset").agg(F.min(F.when(F.col("least"), F.col("rep"))).alias("hub"), F.count("*").alias("rows"))
    hubs = hubs.where("rows > 1 AND hub IS NOT NULL").drop("rows")
    return keys.join(hubs, ["sizes", "subset"]).where("rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct()


def possible(pairs: DataFrame, reps: DataFrame, part: int, whole: int) -> DataFrame:
    """The pairs (a, b) whose sketches don't rule out that their sets are similar.

    What the counts of a cell differ by is in one of the sets only, so all differences are at most the sizes' sum less
    twice the overlap.
    """
    def work(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, CELLS).astype(np.int32) for c in ("x", "y"))
            size = batch.column("nx").to_numpy() + batch.column("ny").to_numpy()
            apart = np.abs(x - y).sum(axis=1)
            near = pa.array((whole + part) * (size - apart) >= 2 * part * size)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(near), batch.column("b").filter(near)], ["a", "b"])

    left = reps.select(F.col("rep").alias("a"), F.col("n").alias("nx"), F.col("sketch").alias("x"))
    right = reps.select(F.col("rep").alias("b"), F.col("n").alias("ny"), F.col("sketch").alias("y"))
    return pairs.join(left, "a").join(right, "b").mapInArrow(work, "a long, b long").distinct()


def verified(pairs: DataFrame, reps: DataFrame, docs: DataFrame, width: int, part: int, whole: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar, by their whole sets."""
    pairs = counted(possible(pairs, reps, part, whole), "pairs")
    members = counted(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "members")
    whole_sets, path = stored_at(sets(docs.join(members, "id", "left_semi"), width, part, whole, None)
                                 .select("id", "tokens"), "sets")
    left = whole_sets.select(F.col("id").alias("a"), F.col("tokens").alias("x"))
    right = whole_sets.select(F.col("id").alias("b"), F.col("tokens").alias("y"))
    # Only sets that stand on a pair's side move.
    right = right.join(pairs.select("b").distinct(), "b", "left_semi")
    found = left.join(pairs, "a").join(right, "b")
    both = F.size(F.array_intersect("x", "y"))
    found = found.select("a", "b", F.size("x").alias("nx"), F.size("y").alias("ny"), both.alias("both"))
    found = stored(found.where(whole * F.col("both") >= part * (F.col("nx") + F.col("ny") - F.col("both"))).select("a", "b").distinct(), "verified")
    removed(docs.sparkSession, path)
    return found


def heavy_links(docs: DataFrame, reps: DataFrame, postings: DataFrame, lists: DataFrame, light: int, width: int, part: int,
                whole: int) -> DataFrame:
    """Links with at least one set larger than ``light``, by scanning inverted lists."""
    alike = lambda a, b: whole * F.least(a, b) >= part * F.greatest(a, b)
    # Lists without a large set are left to subsets.
    shared, path = stored_at(postings.join(lists.where(F.col("most") > light).select("token", "len"), "token"), "postings")
    # How much of a set's lists is shared tells how central it is in its group of near copies.
    score = shared.groupBy("rep").agg(F.sum("len").alias("score"))
    shared = stored(shared.drop("len").join(score, "rep"), "postings")
    removed(docs.sparkSession, path)
    clusters = shared.select("rep", F.col("rep").alias("cluster")).distinct()
    links = None
    for _ in range(ROUNDS):
        rows = shared.join(clusters, "rep")
        best = rows.groupBy("token", "cluster").agg(F.max(F.struct("score", "rep", "n")).alias("m"))
        hubs = best.groupBy("token").agg(F.max("m").alias("hub"), F.count("*").alias("clusters")).where("clusters > 1").drop("clusters")
        pairs = best.join(hubs, "token").where((F.col("m.rep") != F.col("hub.rep")) & alike(F.col("m.n"), F.col("hub.n")))
        pairs = pairs.select(F.col("m.rep").alias("a"), F.col("hub.rep").alias("b")).distinct()
        found = verified(pairs, reps, docs, width, part, whole)
        links = stored(found if links is None else found.union(links), "heavy-links")
        joined = components(links)
        clusters = stored(shared.select("rep").distinct().join(joined, F.col("rep") == F.col("node"), "left")
                          .select("rep", F.coalesce("component", "rep").alias("cluster")), "clusters")
    # What is left: pairs of different clusters, each listed. The smaller set of a similar pair has a common n-gram
    # even among its first n - need(n, n) + 1.
    rows = shared.join(clusters.join(reps.select("rep", "fold"), "rep"), "rep").select("token", "rep", "n", "pos", "cluster", "fold")
    small = rows.where(F.col("pos") <= F.col("n") - F.ceil(2.0 * part * F.col("n") / (whole + part)))
    a, b = small.alias("a"), rows.alias("b")
    order = (F.col("a.n") < F.col("b.n")) | ((F.col("a.n") == F.col("b.n")) & (F.col("a.rep") < F.col("b.rep")))
    apart = F.aggregate(F.zip_with("a.fold", "b.fold", lambda x, y: F.abs(x - y).cast("long")), F.lit(0).cast("long"), lambda total, x: total + x)
    pairs = a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.cluster") != F.col("b.cluster")) & order
                   & (whole * F.col("a.n") >= part * F.col("b.n"))
                   # No more can be common than what stands from the first common n-gram on.
                   & (F.least(F.col("a.n") - F.col("a.pos"), F.col("b.n") - F.col("b.pos")) * (whole + part)
                      >= part * (F.col("a.n") + F.col("b.n")))
                   # As for ``possible``, by the short form.
                   & ((whole + part) * (F.col("a.n") + F.col("b.n") - apart) >= 2 * part * (F.col("a.n") + F.col("b.n"))))
    pairs = pairs.select(F.col("a.rep").alias("a"), F.col("b.rep").alias("b")).distinct()
    return stored(verified(pairs, reps, docs, width, part, whole).union(links), "heavy-links")


def similar(docs: DataFrame, width: int = 5, part: int = 80, whole: int = 100, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key``, ``n_shingles`` and ``component_id``; similar means part / whole or more."""
    rows = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    found, path = stored_at(sets(rows, width, part, whole, levels(rows, width)), "sets")
    real = found.where("n > 0 AND id IS NOT NULL")
    reps = stored(real.groupBy("one", "two", "n").agg(F.min("id").alias("rep"), F.first("tokens").alias("tokens"),
                                                          F.first("sketch").alias("sketch"), F.first("fold").alias("fold")), "representatives")
    # From here on documents need their sizes and fingerprints only.
    found = stored(found.select("id", "n", "one", "two"), "sizes")
    real = found.where("n > 0 AND id IS NOT NULL")
    removed(docs.sparkSession, path)
    first = F.col("n") - F.ceil(1.0 * part * F.col("n") / whole) + 1
    postings = reps.select("rep", "n", F.posexplode(F.slice("tokens", F.lit(1), first.cast("int"))).alias("pos", "token"))
    lists = postings.groupBy("token").agg(F.count("*").alias("len"), F.max("n").alias("most")).where("len > 1")
    lists = stored(lists, "lists")
    size = lists.count()
    light = boundary(reps, lists, part, whole)
    # Small sets are in the lists too as far as a large set can be similar to them.
    postings = postings.where(F.col("n") >= -(-part * (light + 1) // whole))
    if size <= common.BROADCAST_ROWS:
        lists = F.broadcast(lists)
    else:
        postings = with_partners(postings, lists, size)
    links = light_links(reps, light, part, whole).union(heavy_links(rows, reps, postings, lists, light, width, part, whole))
    joined = components(links)
    member = real.select("id", "one", "two").distinct().join(reps.select("one", "two", "rep"), ["one", "two"])
    # Equal sets, and sets of one id, are links as well.
    if not member.groupBy("id").count().where("count > 1").isEmpty():
        joined = components(links.union(member.select(F.col("id").alias("a"), F.col("rep").alias("b"))))
    member = member.join(joined, F.col("rep") == F.col("node"), "left").groupBy("id").agg(F.min(F.coalesce("component", "rep")).alias("component"))
    out = found.select("id", F.col("n").alias("n_shingles")).join(member, "id", "left")
    return out.select(F.col("id").alias(key), "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("component", "id")).otherwise(F.col("id")).alias("component_id"))


def drop_similar(docs: DataFrame, width: int = 5, part: int = 80, whole: int = 100, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without those of which a similar one with a smaller id stays; all columns as they were."""
    gone = similar(docs, width, part, whole, key, text).where(F.col("component_id") < F.col(key)).select(F.col(key).alias("gone")).distinct()
    gone = counted(gone, "similar")
    return docs.join(gone, docs[f"`{key}`"] == gone["gone"], "left_anti")


@query("op6_ngram_jaccard")
def op6_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's component under a Jaccard similarity of 0.85 of four-word sets."""
    return similar(documents(spark, folder).select("doc_id", "text"), width=4, part=85)
