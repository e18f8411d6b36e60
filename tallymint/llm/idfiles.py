"""Token ids in binary shards, with a minimal perfect hash index from document keys to places in them.

A shard is a header of 16 bytes (magic, bytes per id) and the little-endian ids of its documents in a row, in ascending
key order; shards follow one another in that order. The index is split by key hash into parts of bounded size. Each
part is a minimal perfect hash function (hash and displace: keys fall into small buckets, the largest buckets choose
first a displacement that sends all their keys to free slots) with a fingerprint, shard, place and count per slot, so a
lookup touches one displacement and one slot. Files go to a shared folder under names of their own per attempt; only
files that a finished task reports are used, so a lost executor leaves at most an unused file.

Defined cases: a null or empty text has only the end id; null keys come first; documents of one key follow one another
in one shard and are told apart by their number among them (``nth``, in order of a hash of their texts); an empty table
gives no shard. Other columns of the input are not carried.
"""

from __future__ import annotations

import struct
import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..session import workspace
from .common import documents, file_system, slices, stored, text_of
from .registry import query
from .tokens import text_encoder

MAGIC, INDEX_MAGIC = b"TMIDS\0\0\1", b"TMMPH\0\0\1"
HEADER = 16
#: Expected keys in a part of the index, and in a bucket of its hash function.
PART_KEYS, BUCKET_KEYS = 50_000, 4
#: Reads of a shard join ranges that lie no further apart, up to a size.
GAP_IDS, RANGE_IDS = 1 << 14, 1 << 21
#: Ids that one task reads, about.
TASK_IDS = 1 << 23


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """A minimal perfect hash function over distinct pairs of 64-bit hashes."""

    def __init__(self, size: int, displacement: np.ndarray):
        self.size, self.displacement = size, displacement

    @classmethod
    def build(cls, first: np.ndarray, second: np.ndarray) -> PerfectHash:
        size = len(first)
        buckets = max(1, -(-size // BUCKET_KEYS))
        bucket = (mix(first) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        count = np.bincount(bucket, minlength=buckets)
        start = np.cumsum(count) - count
        used = np.zeros(size, bool)
        displacement = np.zeros(buckets, np.int32)
        single = []
        for b in np.argsort(-count, kind="stable").tolist():
            if count[b] == 0:
                break
            keys = order[start[b]:start[b] + count[b]]
            if count[b] == 1:
                single.append((b, int(keys[0])))
                continue
            at = 0
            while True:
                tries = np.arange(at, at + 64, dtype=np.uint64)
                slots = (mix(first[keys, None] + tries * (second[keys, None] | np.uint64(1))) % np.uint64(size)).astype(np.int64)
                free = ~used[slots].any(axis=0)
                ordered = np.sort(slots, axis=0)
                free &= (ordered[1:] != ordered[:-1]).all(axis=0)
                if free.any():
                    pick = int(np.argmax(free))
                    used[slots[:, pick]] = True
                    displacement[b] = at + pick
                    break
                at += 64
                if at > 1 << 28:
                    raise ValueError("two keys have the same hash")
        # A lone key takes any free slot; its bucket names it.
        for (b, _), slot in zip(single, np.flatnonzero(~used).tolist()):
            displacement[b] = -1 - slot
        return cls(size, displacement)

    def slots(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        bucket = (mix(first) % np.uint64(len(self.displacement))).astype(np.int64)
        shift = self.displacement[bucket].astype(np.int64)
        there = mix(first + np.maximum(shift, 0).astype(np.uint64) * (second | np.uint64(1))) % np.uint64(self.size)
        return np.where(shift < 0, -1 - shift, there.astype(np.int64))


def key_hashes(key: str, nth: str) -> tuple[Column, Column]:
    text = F.coalesce(F.col(key).cast("string"), F.lit("\0"))
    return F.xxhash64(text, F.col(nth)), F.xxhash64(F.lit("tallymint"), F.col(nth), text)


@dataclass
class Store:
    """Written shards and their index: ``shards`` (shard, file, base, ids), ``parts`` (part, index_file, keys)."""

    folder: str
    shards: DataFrame
    parts: DataFrame
    n_parts: int


def write(docs: DataFrame, tokenizer: str, end: int, folder: str, key: str = "doc_id", text: str = "text",
          id_bytes: int = 4) -> Store:
    """Encode the documents in ascending key order, write the shards and the index, and return what was written."""
    spark = docs.sparkSession
    system, path = file_system(folder)
    system.create_dir(path, recursive=True)
    ordered = (docs.select(key, text).repartitionByRange(F.col(key).asc_nulls_first())
               .sortWithinPartitions(F.col(key).asc_nulls_first(), F.xxhash64(text)))
    schema = T.StructType([docs.schema[key], *(T.StructField(n, T.LongType()) for n in ("nth", "shard", "at", "n_tokens")),
                           T.StructField("file", T.StringType())])
    kind = np.dtype(f"<u{id_bytes}")

    def shard(batches):
        encoder = text_encoder(tokenizer, end)
        number = TaskContext.get().partitionId()
        file = f"shard-{number:06d}-{uuid.uuid4().hex}.ids"
        out, at, last, nth = None, 0, None, 0
        system, path = file_system(folder)
        try:
            for batch in batches:
                for part, texts in slices(batch, text):
                    if out is None:
                        out = system.open_output_stream(f"{path}/{file}")
                        out.write(MAGIC + struct.pack("<II", id_bytes, 0))
                    flat, bounds = encoder.encode(texts)
                    if len(flat) and int(flat.max()) >= 256 ** id_bytes:
                        raise ValueError(f"id {int(flat.max())} doesn't fit {id_bytes} bytes")
                    out.write(flat.astype(kind).tobytes())
                    rows = []
                    for name, a, b in zip(part.column(key).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                        nth = nth + 1 if (name,) == last else 0
                        last = (name,)
                        rows.append((nth, number, at + a, b - a, file))
                    at += int(bounds[-1])
                    yield pa.RecordBatch.from_arrays([part.column(key), *map(pa.array, zip(*rows))], schema.names)
        finally:
            if out is not None:
                out.close()

    places = stored(ordered.mapInArrow(shard, schema), "places")
    totals = places.groupBy("shard", "file").agg(F.sum("n_tokens").alias("ids"), F.count("*").alias("documents"))
    # One row per shard.
    upto = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = stored(totals.withColumn("base", F.coalesce(F.sum("ids").over(upto), F.lit(0))), "shards")
    keys = shards.agg(F.sum("documents")).first()[0] or 0
    n_parts = max(1, -(-keys // PART_KEYS))
    return Store(folder, shards, _index(places, folder, n_parts, key), n_parts)


def _index(places: DataFrame, folder: str, n_parts: int, key: str) -> DataFrame:
    """Write the parts of the index. A part holds about PART_KEYS keys, whatever the data, as hashes decide."""
    first, second = key_hashes(key, "nth")
    rows = places.select(first.alias("first"), second.alias("second"), "shard", "at", "n_tokens")
    rows = rows.withColumn("part", F.pmod(F.shiftrightunsigned("first", 32), F.lit(n_parts)))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        a, b = (group[c].to_numpy().astype(np.uint64) for c in ("first", "second"))
        function = PerfectHash.build(a, b)
        slot = function.slots(a, b)
        arrays = []
        for values, kind in ((b >> np.uint64(32), "<u4"), (group["shard"], "<u4"), (group["at"], "<u8"), (group["n_tokens"], "<u4")):
            column = np.zeros(len(group), kind)
            column[slot] = np.asarray(values)
            arrays.append(column.tobytes())
        part = int(group["part"].iloc[0])
        file = f"index-{part:06d}-{uuid.uuid4().hex}.mph"
        system, path = file_system(folder)
        with system.open_output_stream(f"{path}/{file}") as out:
            out.write(INDEX_MAGIC + struct.pack("<II", len(group), len(function.displacement)))
            out.write(function.displacement.astype("<i4").tobytes() + b"".join(arrays))
        return pd.DataFrame({"part": [part], "index_file": [file], "keys": [len(group)]})

    return stored(rows.groupBy("part").applyInPandas(build, "part long, index_file string, keys long"), "parts")


def read_index(folder: str, file: str) -> tuple[PerfectHash, list[np.ndarray]]:
    """A part of the index: its hash function, and fingerprint, shard, place and count per slot."""
    system, path = file_system(folder)
    with system.open_input_file(f"{path}/{file}") as f:
        data = f.read()
    size, buckets = struct.unpack_from("<II", data, 8)
    at = HEADER
    arrays = []
    for kind, n in (("<i4", buckets), ("<u4", size), ("<u4", size), ("<u8", size), ("<u4", size)):
        arrays.append(np.frombuffer(data, kind, n, at))
        at += arrays[-1].nbytes
    return PerfectHash(size, arrays[0]), arrays[1:]


def lookup(keys: DataFrame, store: Store, key: str = "doc_id") -> DataFrame:
    """The place of each key (``key``, ``nth``) by the index; keys that it doesn't hold are left out."""
    first, second = key_hashes(key, "nth")
    rows = keys.select(key, "nth", first.alias("first"), second.alias("second"))
    rows = rows.withColumn("part", F.pmod(F.shiftrightunsigned("first", 32), F.lit(store.n_parts)))
    rows = rows.join(store.parts.select("part", "index_file"), "part")
    # Keys are dealt by part, so each part is opened by one task (or by the few that a large one is split into).
    rows = rows.repartition("part").sortWithinPartitions("part")
    schema = T.StructType([keys.schema[key], *(T.StructField(n, T.LongType()) for n in ("nth", "shard", "at", "n_tokens"))])
    folder = store.folder

    def find(batches):
        opened, loaded = None, None
        for batch in batches:
            files = np.asarray(batch.column("index_file").to_pylist(), object)
            a, b = (batch.column(c).to_numpy().astype(np.uint64) for c in ("first", "second"))
            bounds = [0, *(np.flatnonzero(files[1:] != files[:-1]) + 1).tolist(), len(files)]
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                if hi == lo:
                    continue
                if files[lo] != opened:
                    opened, loaded = files[lo], read_index(folder, files[lo])
                function, (mark, shard, at, count) = loaded
                slot = function.slots(a[lo:hi], b[lo:hi])
                hit = mark[slot] == (b[lo:hi] >> np.uint64(32)).astype(np.uint32)
                part, slot = batch.slice(lo, hi - lo).filter(pa.array(hit)), slot[hit]
                yield pa.RecordBatch.from_arrays(
                    [part.column(key), part.column("nth"), *(pa.array(x[slot].astype(np.int64)) for x in (shard, at, count))],
                    schema.names)

    return rows.mapInArrow(find, schema)


def id_type(header: bytes, name: str) -> np.dtype:
    """The type of a shard's ids, from its header."""
    if header[:len(MAGIC)] != MAGIC:
        raise ValueError(f"{name} is no shard of ids")
    return np.dtype(f"<u{struct.unpack_from('<I', header, len(MAGIC))[0]}")


def read(places: DataFrame, store: Store, key: str = "doc_id") -> DataFrame:
    """The ids at places from ``lookup``, with ``start`` (ids of all documents before); ranges are read in order, joined.

    ``ids`` holds little-endian unsigned 32-bit integers. The bytes of an id are those that a shard's header gives; the
    number of tasks comes from the size of the shards.
    """
    located = places.join(store.shards.select("shard", "file", "base"), "shard")
    tasks = max(1, -(-(store.shards.agg(F.sum("ids")).first()[0] or 0) // TASK_IDS))
    located = located.repartitionByRange(tasks, "shard", "at").sortWithinPartitions("shard", "at")
    schema = T.StructType([places.schema[key], T.StructField("nth", T.LongType()), T.StructField("start", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])
    folder = store.folder

    def ranges(files, at, size):
        """Stretches of rows whose ids are read at once."""
        lo = 0
        for i in range(1, len(files) + 1):
            if i == len(files) or files[i] != files[lo] or at[i] - (at[i - 1] + size[i - 1]) > GAP_IDS \
                    or at[i] + size[i] - at[lo] > RANGE_IDS:
                yield lo, i
                lo = i

    def fetch(batches):
        system, path = file_system(folder)
        name, source, kind = None, None, None
        try:
            for batch in batches:
                files = batch.column("file").to_pylist()
                at, size = (batch.column(c).to_pylist() for c in ("at", "n_tokens"))
                for lo, hi in ranges(files, at, size):
                    if files[lo] != name:
                        if source is not None:
                            source.close()
                        name, source = files[lo], system.open_input_file(f"{path}/{files[lo]}")
                        kind = id_type(source.read(HEADER), name)
                    source.seek(HEADER + at[lo] * kind.itemsize)
                    flat = np.frombuffer(source.read((at[hi - 1] + size[hi - 1] - at[lo]) * kind.itemsize), kind).astype("<u4")
                    ids = [flat[at[i] - at[lo]:at[i] - at[lo] + size[i]].tobytes() for i in range(lo, hi)]
                    part = batch.slice(lo, hi - lo)
                    start = part.column("base").to_numpy() + part.column("at").to_numpy()
                    yield pa.RecordBatch.from_arrays(
                        [part.column(key), part.column("nth"), pa.array(start), part.column("n_tokens"),
                         pa.array(ids, pa.binary())], schema.names)
        finally:
            if source is not None:
                source.close()

    return located.mapInArrow(fetch, schema)


def keys_of(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """The keys of all rows, numbered where one key has several."""
    counts = docs.groupBy(key).agg(F.count("*").alias("rows"))
    return counts.select(key, F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)).alias("nth"))


@query("op8_id_files")
def op8_id_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids, written, indexed, found by key and read back, as counts and checksums."""
    docs = documents(spark, folder).select("doc_id", text_of().alias("text"))
    store = write(docs, public_tokenizers.path("word_bpe_49k.json"), 2, workspace(spark, "id-files"), id_bytes=2)
    found = lookup(keys_of(documents(spark, folder)), store)
    back = read(stored(found, "found"), store)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
