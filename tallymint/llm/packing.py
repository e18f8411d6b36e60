"""Hierarchical multi-length packing.

Documents are cut into full windows of the longest context; the rest of each goes to the shortest tier that holds it.
Tiers are packed from the longest down: a window's gap takes the longest whole piece that fits, from this tier or
shorter ones, and a cut of the shortest piece closes what remains, so windows are full. Each task packs its own rows in
batches of bounded size and carries what is left from one batch to the next; at its end the rest is laid out in windows
whose lengths are powers of two. Full windows are dealt to step groups of equal tokens and about equal attention cost.

No row moves between tasks, so the size of a source or of a group of copies doesn't matter. Sequence and group numbers
hold the task's partition in their upper bits: they are unique, and a repeated task gives the same ones.

Defined cases: a null or empty text has only the end id; a null id stays null; rows that repeat are packed one by one;
an empty table gives no rows; other columns of the input are not carried, so their names can't clash.
"""

from __future__ import annotations

import bisect
import heapq

import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .common import documents, memory_returned, slices, small_batches, text_of
from .registry import query
from .tokens import CACHE_CHUNKS, text_encoder

#: Context sizes, longest first; all are powers of two.
TIERS = (2048, 1024, 512, 256)
#: Tokens that wait for packing in one batch of a task.
BATCH_TOKENS = 4_000_000
#: Pieces of a batch that a task gives back, 4 MB of ids at most.
BATCH_PIECES = 500
#: Tokens of a step group.
GROUP_TOKENS = 16 * 2048
#: Lower bits of a sequence or group number, counted within a partition.
LOCAL_BITS = 40

SCHEMA = ("start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, tier long, "
          "sequence_tokens long, step_group long")


class Packer:
    """Packs pieces ``(length, row, start)``; each finished sequence is a list of pieces and its tier."""

    def __init__(self, tiers: tuple[int, ...] = TIERS):
        self.tiers = sorted(tiers)
        self.free: list[tuple[int, int, int]] = []
        self.waiting = 0

    def add(self, row: int, tokens: int) -> list[tuple[list, int]]:
        """Take in a document; returns its full windows."""
        top = self.tiers[-1]
        full = tokens - tokens % top
        if tokens > full:
            self.free.append((tokens - full, row, full))
            self.waiting += tokens - full
        return [([(top, row, at)], top) for at in range(0, full, top)]

    def pack(self, last: bool) -> list[tuple[list, int]]:
        """Full sequences from the waiting pieces; the rest waits on, or is laid out too if this is the last call."""
        free, done, rest = sorted(self.free), [], []
        while free:
            piece = free.pop()
            tier = self.tiers[bisect.bisect_left(self.tiers, piece[0])]
            sequence, gap = [piece], tier - piece[0]
            while gap and free:
                at = bisect.bisect_left(free, (gap + 1,)) - 1
                if at >= 0:
                    piece = free.pop(at)
                else:
                    size, row, start = free.pop(0)
                    piece = (gap, row, start)
                    bisect.insort(free, (size - gap, row, start + gap))
                sequence.append(piece)
                gap -= piece[0]
            if gap:
                rest += sequence
            else:
                done.append((sequence, tier))
        self.free = rest
        if last:
            done += self._tail()
        self.waiting = sum(p[0] for p in self.free)
        return done

    def _tail(self) -> list[tuple[list, int]]:
        """What is left, less than one window, in windows whose sizes are the powers of two of its length."""
        done, pieces = [], sorted(self.free, reverse=True)
        self.free = []
        left = sum(p[0] for p in pieces)
        while left:
            size = min(self.tiers[-1], 1 << (left.bit_length() - 1))
            left -= size
            sequence, gap = [], size
            while gap:
                length, row, start = pieces.pop(0)
                take = min(length, gap)
                sequence.append((take, row, start))
                if take < length:
                    pieces.insert(0, (length - take, row, start + take))
                gap -= take
            done.append((sequence, size))
        return done


def step_groups(sequences: list[tuple[list, int]], budget: int = GROUP_TOKENS) -> list[int]:
    """A group for each sequence: groups have about equal tokens, and of these the least attention cost gets the next."""
    total = sum(tier for _, tier in sequences)
    heap = [(0, 0, g) for g in range(max(1, -(-total // budget)))]
    cost = [sum(p[0] ** 2 for p in pieces) for pieces, _ in sequences]
    group = [0] * len(sequences)
    for i in sorted(range(len(sequences)), key=lambda i: (-sequences[i][1], -cost[i], i)):
        tokens, spent, g = heapq.heappop(heap)
        group[i] = g
        heapq.heappush(heap, (tokens + sequences[i][1], spent + cost[i], g))
    return group


def pack(docs: DataFrame, tokenizer: str, end: int, tiers: tuple[int, ...] = TIERS, group_tokens: int = GROUP_TOKENS,
         key: str = "doc_id", text: str = "text", remembered: int = CACHE_CHUNKS) -> DataFrame:
    """One row per piece: its document, place and ids there, and its sequence, place in it, tier and step group.

    ``ids`` holds little-endian unsigned 32-bit integers. A worker remembers the ids of so many words, at about 150 bytes
    each; fewer make it slower, but give the same ids.
    """
    small_batches(docs.sparkSession)
    schema = T.StructType([docs.schema[key]] + T._parse_datatype_string(SCHEMA).fields)
    names = schema.names

    def work(batches):
        encoder, packer = text_encoder(tokenizer, end, remembered), Packer(tiers)
        base = TaskContext.get().partitionId() << LOCAL_BITS
        counter, groups = base, base
        held: dict[int, tuple] = {}  # by row: key, ids, length
        row = 0
        fields = None

        def rows(sequences):
            nonlocal counter, groups
            group = step_groups(sequences, group_tokens)
            out = [[] for _ in names]
            for (pieces, tier), g in zip(sequences, group):
                offset, tokens = 0, sum(p[0] for p in pieces)
                for length, at, start in pieces:
                    name, ids, total = held[at]
                    values = (name, start, length, ids[start:start + length].tobytes(), total, counter, offset, tier,
                              tokens, groups + g)
                    for column, value in zip(out, values):
                        column.append(value)
                    offset += length
                    if len(out[0]) >= BATCH_PIECES:
                        yield table(out)
                        out = [[] for _ in names]
                counter += 1
            groups += max(group, default=-1) + 1
            if out[0]:
                yield table(out)

        def table(out):
            types = [fields, pa.int64(), pa.int64(), pa.binary()] + [pa.int64()] * 6
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types)], names)

        full = []
        size = 0
        for batch in batches:
            fields = batch.schema.field(key).type
            for part, texts in slices(batch, text):
                flat, bounds = encoder.encode(texts)
                flat = flat.astype("<u4")
                for name, a, b in zip(part.column(key).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                    held[row] = (name, flat[a:b].copy(), b - a)
                    full += packer.add(row, b - a)
                    size += b - a
                    row += 1
                if size >= BATCH_TOKENS:
                    yield from rows(full + packer.pack(False))
                    full, size = [], 0
                    held = {at: held[at] for _, at, _ in packer.free}
        if row:
            yield from rows(full + packer.pack(True))
        held.clear()
        memory_returned()

    return docs.select(key, text).mapInArrow(work, schema)


@query("op9_packing")
def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document packed into sequences of at most 2048 tokens, one row per piece."""
    docs = documents(spark, folder).select("doc_id", text_of().alias("text"))
    pieces = pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset", "tier", "step_group")
