"""Helpers shared by the operators: slices of batches, tables in the shared folder, and files that tasks write."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import removed, workspace  # noqa: F401 (operators take ``removed`` from here)

#: Text handled at one time inside a task, in characters; longer batches are sliced.
SLICE_CHARS = 2_000_000
#: Rows of a few numbers that may be broadcast, after they have been counted; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000
#: Bytes of a batch that goes to a Python worker, unless the session has less; its JVM and the worker hold it several times.
BATCH_BYTES = 8 << 20


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def text_of(name: str = "text") -> Column:
    """The text, null counting as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def with_column(schema: T.StructType, *fields: T.StructField) -> T.StructType:
    """The schema with fields added at its end; columns of the same names give way."""
    names = {f.name for f in fields}
    return T.StructType([f for f in schema.fields if f.name not in names] + list(fields))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of a batch with at most ``limit`` characters of text each (one row at least), nulls as empty text."""
    texts = [t or "" for t in batch.column(column).to_pylist()]
    start = size = 0
    for at, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield batch.slice(start, at - start), texts[start:at]
            start, size = at, 0
        size += len(text)
    if start < len(texts):
        yield batch.slice(start), texts[start:]


def replaced(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """The batch with columns added at its end, in place of columns of the same names."""
    kept = [n for n in batch.schema.names if n not in columns]
    return pa.RecordBatch.from_arrays([batch.column(n) for n in kept] + list(columns.values()), kept + list(columns))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again: lineage ends there, and the planner knows their size."""
    return stored_at(df, name)[0]


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As ``stored``, with the folder, for ``removed``."""
    spark = df.sparkSession
    path = workspace(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def counted(df: DataFrame, name: str) -> DataFrame:
    """Rows of a few numbers, written; they are broadcast in joins if their count allows it."""
    rows = stored(df, name)
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def small_batches(spark: SparkSession) -> None:
    """From now on batches for Python workers hold at most BATCH_BYTES (or one row), however long their texts are.

    It is a setting of the session, since plans read it when they run.
    """
    if spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch() > BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a shared folder, and the path in it; a bare path is a local one."""
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def memory_returned() -> None:
    """Gives memory that a worker has freed back to the system; workers live on between tasks, beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def returned(work: Callable) -> Callable:
    """The function of batches ``work``, after which the worker gives back the memory that it has freed."""
    def run(batches):
        yield from work(batches)
        memory_returned()

    return run


class Codes(dict):
    """Numbers words in the order in which they are first asked for, and notes the new ones."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self)
        self.fresh.append(word)
        return at


def gather(values: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The stretches ``values[start:start + count]`` in a row."""
    total = int(count.sum())
    ends = np.cumsum(count)
    return values[np.arange(total) + np.repeat(start - (ends - count), count)]


class WordIds:
    """Ids of words, remembered up to a limit; ``learn`` gives the ids of new words and the number for each.

    Beyond the limit, words that were met only once since the last time are forgotten, or all, if that is too few.
    """

    def __init__(self, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int):
        self.learn, self.limit = learn, limit
        self.code = Codes()
        self.ids, self.count, self.used = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _forget(self) -> None:
        keep = np.flatnonzero(self.used > 1)
        if len(keep) > self.limit // 2:
            keep = keep[:0]
        ids = gather(self.ids, (np.cumsum(self.count) - self.count)[keep], self.count[keep])
        flags = np.zeros(len(self.used), bool)
        flags[keep] = True
        words = [w for w, k in zip(self.code, flags.tolist()) if k]
        self.code = Codes()
        self.code.update(zip(words, range(len(words))))
        self.ids, self.count, self.used = ids, self.count[keep], np.zeros(len(keep), np.int64)

    def flat(self, texts: list[list[str]], end: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, given as words, in a row with ``end`` after each, and the bounds of each text."""
        # Words of these texts are numbered in a small table first, which stays in the processor's cache.
        here = dict.fromkeys(chain.from_iterable(texts))
        words = list(here)
        here = dict(zip(here, range(len(here))))
        codes = [np.fromiter(map(here.__getitem__, text), np.int32, len(text)) for text in texts]
        return self.numbered(words, np.concatenate(codes) if codes else np.zeros(0, np.int32), [len(c) for c in codes], end)

    def numbered(self, here: list[str], words: np.ndarray, size: list[int], end: int | None) -> tuple[np.ndarray, np.ndarray]:
        """As ``flat``; the texts are given as places of their words among the words ``here``, and how many each has."""
        if len(self.code) > self.limit:
            self._forget()
        words = np.fromiter(map(self.code.__getitem__, here), np.int32, len(here))[words]
        if self.code.fresh:
            ids, count = self.learn(self.code.fresh)
            self.code.fresh = []
            self.ids, self.count = np.concatenate([self.ids, ids]), np.concatenate([self.count, count])
        new = np.bincount(words, minlength=len(self.count))
        new[:len(self.used)] += self.used
        self.used = new
        count = self.count[words]
        ids = gather(self.ids, (np.cumsum(self.count) - self.count)[words], count)
        ends = np.append(0, np.cumsum(count))
        bounds = ends[np.append(0, np.cumsum(size, dtype=np.int64)).astype(np.int64)]
        if end is not None:
            ids = np.insert(ids, bounds[1:], end)
            bounds = bounds + np.arange(len(bounds))
        return ids, bounds


def kept(name: str, make: Callable):
    """An object that lives as long as the Python worker, which Spark keeps for further tasks.

    Functions travel to workers with their module's code, so a module variable would start anew in each task.
    """
    holder = sys.modules.setdefault("_tallymint_worker", types.ModuleType("_tallymint_worker")).__dict__
    if name not in holder:
        holder[name] = make()
    return holder[name]
