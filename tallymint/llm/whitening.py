"""Whitening of embeddings by spectral divide and conquer.

The covariance of the distinct vectors is taken on Spark, each task adding the products of its centred vectors. It has
the size of the vectors, not of the table, so it is split on the driver: QDWH iterations give the polar factor of the
covariance less a shift, which is the matrix sign; half of it plus half the identity projects on the eigenvectors above
the shift. Bases of the projector's range and of its complement turn the covariance into two smaller ones, and so on
until a part has one dimension. Parts whose components aren't asked for aren't split. The components, a few numbers for
each dimension, are then broadcast and every row is projected where it is read.

Entries are scaled to whole numbers, so sums and squared deviations are exact.

Defined cases: rows whose vector is null, or has null or non-finite entries, are dropped. Vectors of another length than
the most frequent one (of equally frequent ones the longer) are dropped, empty vectors too. Scaled entries beyond 64 bits
are cut to that range; a squared deviation beyond 64 bits is null. Rows that repeat count once in the fit and are all
returned; a null id stays null. Components without variance (by the precision of doubles) are left out, so equal vectors, a
single one and an empty table give no rows. Of equal variances any orthogonal components are returned, the same for all
rows. Columns other than id and vector are not carried, so their names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import stored
from .registry import query

#: Factor of the entries before they are rounded down.
SCALE = 256
#: Vectors that are multiplied at one time within a task.
BLOCK = 4096
EPS = float(np.finfo(np.float64).eps)
#: Bounds of 64-bit numbers, the upper one as a double that fits.
LOWEST, HIGHEST = -2.0**63, float(np.nextafter(2.0**63, 0))
#: Widths of stored entries in bytes; a vector takes the smallest that holds all its entries.
WIDTHS = (1, 2, 4, 8)


# --- vectors as whole numbers ------------------------------------------------------------------

def scaled(batch: pa.RecordBatch, column: str, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows with a sound vector of that length, and these vectors as whole numbers."""
    vectors = batch.column(column)
    flat = vectors.flatten()
    length = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls turn into NaN
    ends = np.cumsum(np.maximum(length, 0))
    at = np.flatnonzero(length == dimensions)
    if not len(at) or not dimensions:
        return at[:0], np.zeros((0, dimensions), np.int64)
    rows = values[(ends[at] - dimensions)[:, None] + np.arange(dimensions)]
    sound = np.isfinite(rows).all(axis=1)
    with np.errstate(over="ignore"):
        whole = np.clip(np.floor(rows[sound] * SCALE), LOWEST, HIGHEST)
    return at[sound], whole.astype(np.int64)


def coded(vectors: np.ndarray) -> list[bytes]:
    """Each vector as bytes: equal bytes for equal vectors only."""
    most = np.maximum(vectors.max(axis=1, initial=0), -(vectors.min(axis=1, initial=0) + 1))
    width = np.searchsorted([2 ** (8 * w - 1) - 1 for w in WIDTHS], most)
    out: list[bytes] = [b""] * len(vectors)
    for i, w in enumerate(WIDTHS):
        at = np.flatnonzero(width == i)
        for k, row in zip(at.tolist(), vectors[at].astype(f"<i{w}")):
            out[k] = row.tobytes()
    return out


def decoded(codes: list[bytes], dimensions: int) -> np.ndarray:
    out = np.empty((len(codes), dimensions), np.int64)
    width = np.fromiter((len(c) // dimensions for c in codes), np.int64, len(codes))
    for w in WIDTHS:
        at = np.flatnonzero(width == w)
        if len(at):
            out[at] = np.frombuffer(b"".join(codes[k] for k in at.tolist()), f"<i{w}").reshape(-1, dimensions)
    return out


def common_length(rows: DataFrame, vector: str) -> int:
    """The most frequent length of sound vectors, 0 without any."""
    sound = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf")))
    found = (rows.where(sound & (F.size(vector) > 0)).groupBy(F.size(vector).alias("length")).count()
             .orderBy(F.desc("count"), F.desc("length")).first())
    return 0 if found is None else found["length"]


def distinct_vectors(rows: DataFrame, vector: str, dimensions: int) -> DataFrame:
    """The fit list: each vector once, as bytes. Copies within a task go before any row moves."""
    def work(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(coded(scaled(batch, vector, dimensions)[1]), pa.binary())], ["code"])

    return stored(rows.select(vector).mapInArrow(work, "code binary").distinct(), "vectors")


def blocks(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[np.ndarray]:
    """The vectors of coded rows in blocks of bounded size."""
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            yield decoded(batch.column("code").slice(start, BLOCK).to_pylist(), dimensions)


# --- statistics --------------------------------------------------------------------------------

def totals(vectors: DataFrame, dimensions: int) -> tuple[int, list[int]]:
    """Number and exact sums of the vectors."""
    def work(batches):
        n, total = 0, [0] * dimensions
        for block in blocks(batches, dimensions):
            # Sums of both halves of the numbers can't overflow within a block.
            high, low = (block >> 32).sum(axis=0), (block & 0xFFFFFFFF).sum(axis=0)
            total = [t + (int(h) << 32) + int(x) for t, h, x in zip(total, high, low)]
            n += len(block)
        if n:
            yield pd.DataFrame({"d": range(-1, dimensions), "v": [str(n), *map(str, total)]})

    def frames(batches):
        for frame in work(batches):
            yield pa.RecordBatch.from_pandas(frame, schema=pa.schema([("d", pa.int32()), ("v", pa.string())]))

    found = vectors.mapInArrow(frames, "d int, v string").groupBy("d").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    by = {r["d"]: int(r["v"]) for r in found.collect()}  # one number for each dimension
    return by.get(-1, 0), [by.get(d, 0) for d in range(dimensions)]


def summed_products(vectors: DataFrame, dimensions: int, centre: np.ndarray, turn: np.ndarray | None = None) -> np.ndarray:
    """The sum over all vectors of the products of their entries, centred and, if given, turned by a matrix before.

    Each task sums its own; rows of the matrices are then added in the order of the tasks.
    """
    width = dimensions if turn is None else turn.shape[1]
    fields = "i int, task int, products array<double>"
    arrow = pa.schema([("i", pa.int32()), ("task", pa.int32()), ("products", pa.list_(pa.float64()))])

    def work(batches):
        total = np.zeros((width, width))
        for block in blocks(batches, dimensions):
            x = block - centre
            x = x if turn is None else x @ turn
            total += x.T @ x
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array([task] * width, pa.int32()),
                                          pa.array(list(total), pa.list_(pa.float64()))], schema=arrow)

    def add(group: pd.DataFrame) -> pd.DataFrame:
        rows = np.stack(group.sort_values("task")["products"].to_list())
        return pd.DataFrame({"i": group["i"].iloc[:1], "task": 0, "products": [rows.sum(axis=0)]})

    found = vectors.mapInArrow(work, fields).groupBy("i").applyInPandas(add, fields).collect()
    out = np.zeros((width, width))
    for row in found:  # as many rows as dimensions
        out[row["i"]] = row["products"]
    return (out + out.T) / 2


# --- spectral divide and conquer ---------------------------------------------------------------

def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by dynamically weighted Halley steps through QR."""
    n = len(a)
    x = a / np.linalg.norm(a)
    least = EPS / n  # a lower bound of the smallest singular value; too low a one costs a step or two
    for _ in range(12):
        square = least * least
        d = np.cbrt(4 * (1 - square) / (square * square)) if least < 1 else 0.0
        a_ = np.sqrt(1 + d) + 0.5 * np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - square) / (square * np.sqrt(1 + d))))
        b_ = (a_ - 1) ** 2 / 4
        c_ = a_ + b_ - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(c_) * x, np.eye(n)]))
        after = (b_ / c_) * x + (a_ - b_ / c_) / np.sqrt(c_) * (q[:n] @ q[n:].T)
        after = (after + after.T) / 2
        moved = np.linalg.norm(after - x)
        x = after
        least = min(1.0, least * (a_ + b_ * square) / (1 + c_ * square))
        if moved < np.cbrt(EPS) and 1 - least < 10 * EPS:
            break
    return x


def split(a: np.ndarray) -> tuple[np.ndarray, int] | None:
    """An orthogonal basis whose first vectors span the part above some shift, and how many they are.

    None if the matrix is a multiple of the identity within rounding, so that any basis will do.
    """
    n, size = len(a), np.linalg.norm(a)
    diagonal = np.sort(np.diag(a))
    spread = np.linalg.norm(a - np.eye(n) * diagonal.mean())
    if spread <= 4 * n * EPS * size:
        return None
    # The eigenvalues lie around the mean; shifts between entries of the diagonal come next.
    gaps = [diagonal.mean(), np.median(diagonal), *((diagonal[1:] + diagonal[:-1]) / 2)[np.argsort(-np.diff(diagonal))][:8]]
    gaps += [diagonal.mean() + spread / np.sqrt(n) * s for s in (0.3, -0.3, 0.7, -0.7)]
    best = None
    for shift in gaps:
        shifted = a - shift * np.eye(n)
        if np.linalg.norm(shifted) <= 4 * n * EPS * size:
            continue
        projector = (polar_factor(shifted) + np.eye(n)) / 2
        above = int(round(np.trace(projector)))
        if not 0 < above < n:
            continue
        basis = ordered_range(projector, above)
        rest = np.linalg.norm(basis[:, above:].T @ a @ basis[:, :above])
        if best is None or rest < best[0]:
            best = rest, basis, above
        if rest <= 10 * n * EPS * size:
            break
    if best is None:
        return None
    return best[1], best[2]


def ordered_range(projector: np.ndarray, rank: int) -> np.ndarray:
    """An orthogonal basis: first of the projector's range, then of its complement. Two rounds of subspace iteration."""
    n = len(projector)
    start = projector[:, np.argsort(-np.diag(projector), kind="stable")[:rank]]
    probe = np.random.default_rng(n).standard_normal((n, rank))
    q, _ = np.linalg.qr(projector @ (start + projector @ probe))
    q, _ = np.linalg.qr(projector @ q)
    full, _ = np.linalg.qr(np.hstack([q, np.eye(n)]))
    full[:, :rank] = q
    other = full[:, rank:]
    other, _ = np.linalg.qr(other - q @ (q.T @ other))
    return np.hstack([q, other])


def leading(a: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix, falling, with their eigenvectors as columns."""
    n = len(a)
    count = min(n, count)
    if n == 0 or count == 0:
        return np.zeros(0), np.zeros((n, 0))
    parted = split(a) if n > 1 else None
    if parted is None:
        return np.diag(a)[:count].copy(), np.eye(n)[:, :count]
    basis, above = parted
    values, vectors = [], []
    for part in (basis[:, :above], basis[:, above:]):
        wanted = count - sum(map(len, values))
        inner = part.T @ a @ part
        found, turned = leading((inner + inner.T) / 2, wanted)
        values.append(found)
        vectors.append(part @ turned)
    values, vectors = np.concatenate(values), np.hstack(vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


# --- the operator ------------------------------------------------------------------------------

@dataclass
class Model:
    """A fitted whitening: a few numbers for each dimension."""

    dimensions: int
    n: int
    sums: list[int]
    values: np.ndarray  # variances of the components, falling
    vectors: np.ndarray  # components as columns
    explained: np.ndarray  # their parts of all variance
    identity_error: float

    @property
    def turn(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)

    @property
    def centre(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def fit(rows: DataFrame, count: int = 4, vector: str = "embedding") -> Model:
    """The whitening of the first components, from the covariance of the distinct vectors."""
    dimensions = common_length(rows, vector)
    empty = Model(dimensions, 0, [], np.zeros(0), np.zeros((dimensions, 0)), np.zeros(0), 0.0)
    if not dimensions:
        return empty
    vectors = distinct_vectors(rows, vector, dimensions)
    n, sums = totals(vectors, dimensions)
    model = Model(dimensions, n, sums, empty.values, empty.vectors, empty.explained, 0.0)
    covariance = summed_products(vectors, dimensions, model.centre) / n
    trace = float(np.trace(covariance))
    values, components = leading(covariance, count)
    real = values > dimensions * EPS * max(trace, 0.0)
    model.values, model.vectors = values[real], components[:, real]
    if model.vectors.shape[1]:
        model.explained = model.values / trace
        white = summed_products(vectors, dimensions, model.centre, model.turn) / n
        model.identity_error = float(np.abs(white - np.eye(len(white))).max())
    return model


def deviations(vectors: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact squared deviations, times the square of ``n``; null beyond 64 bits."""
    most = max(int(np.abs(vectors.astype(np.float64)).max(initial=0)) + 1, 1)
    reach = n * most + max(map(abs, sums))
    if reach * reach * len(sums) < 2**63:
        apart = vectors * n - np.array(sums, np.int64)
        return (apart * apart).sum(axis=1).tolist()
    exact = [sum((n * x - s) ** 2 for x, s in zip(row, sums)) for row in vectors.tolist()]
    return [e if e < 2**63 else None for e in exact]


def whiten(rows: DataFrame, model: Model, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row for each sound row and component: ``key``, ``component`` (from 1), ``n``, ``deviation``, ``whitened``,
    ``explained`` and ``identity_error``."""
    schema = T.StructType([T.StructField(key, rows.schema[key].dataType)] + T._parse_datatype_string(
        "component int, n long, deviation long, whitened double, explained double, identity_error double").fields)
    arrow = to_arrow_schema(schema)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        model = shared.value
        count = len(model.values)
        if not count:
            return
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                at, vectors = scaled(part, "vector", model.dimensions)
                if not len(at):
                    continue
                white = (vectors - model.centre) @ model.turn
                deviation = pa.array(deviations(vectors, model.n, model.sums), pa.int64())
                each = pa.array(np.repeat(np.arange(len(at)), count))
                columns = [
                    part.column("key").take(pa.array(at)).take(each),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(at))),
                    pa.array(np.full(len(each), model.n, np.int64)), deviation.take(each), pa.array(white.ravel()),
                    pa.array(np.tile(model.explained, len(at))), pa.array(np.full(len(each), model.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return rows.select(F.col(key).alias("key"), F.col(vector).alias("vector")).mapInArrow(work, schema)


@query("op12_embedding_whitening")
def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every sound embedding on the four components of largest variance."""
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding")
    return whiten(rows, fit(rows))
