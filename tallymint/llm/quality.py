"""Quality scores by histogram gradient-boosted trees over document statistics.

Statistics of whole texts are binned by quantiles; each tree grows level by level from histograms of gradients. The
trees are complete and flattened into arrays (feature, threshold, leaf), so a batch of documents passes all trees at
once by array indexing. The model is fitted on at most SAMPLE_ROWS labelled rows, those with the smallest hashes of
their ids; scoring reads every row and moves none.

Defined cases: a null text counts as empty and gets the score of its statistics, which are zero; labels that are null,
other than 0 and 1, or contradict one another for an id are not learnt from; with labels of one class or none the score
is the smoothed rate of label 1 (one half without labels); rows that repeat get equal scores; an empty table gives no
rows; columns ``score`` and ``predicted`` are replaced.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .common import documents, replaced, slices, text_of, with_column
from .registry import query

#: The bound of the fitting sample, in labelled rows.
SAMPLE_ROWS = 20_000
TREES, DEPTH, BINS = 80, 4, 64
RATE, L2, LEAST_WEIGHT = 0.15, 1.0, 2.0
#: Documents with this score or more are predicted good.
CUT = 0.7

STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "upper", "digits", "spaces", "stops", "marks", "pipes", "exclamations",
    "symbols", "other_ascii", "beyond_ascii", "distinct_words", "top_word", "top_five", "stutter", "short_words",
    "long_words", "capital_words", "line_words", "repeated_lines", "stops_per_word",
)
_CLASS = np.zeros(256, np.int64)
for _k, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\n\x0b\x0c\r", b".,", b"?;:'\"()-", b"|", b"!",
                             b"#*$%&<>@=+~^"), 1):
    _CLASS[list(_chars)] = _k
_CLASS[128:] = 9


def statistics(text: str) -> list[float]:
    """The numbers named in STATISTICS; all are zero for a text without words."""
    data = text.encode()
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    count = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    classes = np.bincount(_CLASS, weights=count, minlength=10)
    other = classes[0] - count[97:123].sum()
    size = len(data)
    seen = Counter(words)
    top = [c for _, c in seen.most_common(5)]
    lines = [x for x in data.split(b"\n") if x.strip()]
    lengths = np.fromiter(map(len, words), np.int64, n)
    return [
        np.log1p(size), np.log1p(n), lengths.mean(), classes[1] / size, classes[2] / size, classes[3] / size,
        classes[4] / size, classes[5] / size, classes[6] / size, classes[7] / size, classes[8] / size, other / size,
        classes[9] / size, len(seen) / n, top[0] / n, sum(top) / n, sum(map(eq, words, words[1:])) / n,
        (lengths <= 3).mean(), (lengths >= 12).mean(), sum(map(bytes.isupper, words)) / n, n / len(lines),
        1 - len(set(lines)) / len(lines), classes[4] / n,
    ]


@dataclass
class Trees:
    """Complete trees as arrays of (tree, node); a value above the threshold goes right. ``base`` is the score's logit."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def scores(self, values: np.ndarray) -> np.ndarray:
        trees, inner = self.feature.shape
        logit = np.full(len(values), self.base)
        if trees and len(values):
            row, tree = np.arange(len(values))[:, None], np.arange(trees)[None, :]
            node = np.zeros((len(values), trees), np.int64)
            for _ in range(int(np.log2(inner + 1))):
                node = 2 * node + 1 + (values[row, self.feature[tree, node]] > self.threshold[tree, node])
            logit = logit + self.leaf[tree, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-logit))


def fit(values: np.ndarray, labels: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boosted trees for labels 0 and 1 under logistic loss."""
    n, width = values.shape
    rate = (labels.sum() + 1) / (n + 2)
    inner = 2 ** depth - 1
    if n == 0 or labels.min() == labels.max():
        return Trees(float(np.log(rate / (1 - rate))), np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    edges = np.quantile(values, np.linspace(0, 1, BINS + 1)[1:-1], axis=0)
    bins = np.stack([np.searchsorted(edges[:, f], values[:, f], side="left") for f in range(width)], axis=1)
    base = float(np.log(rate / (1 - rate)))
    logit = np.full(n, base)
    feature, threshold = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, inner + 1))
    cell = bins + np.arange(width) * BINS
    for t in range(trees):
        p = 1 / (1 + np.exp(-logit))
        gradient, weight = labels - p, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, nodes = 2 ** level - 1, 2 ** level
            at = ((node - first)[:, None] * (width * BINS) + cell).ravel()
            shape = (nodes, width, BINS)
            g = np.bincount(at, np.repeat(gradient, width), nodes * width * BINS).reshape(shape).cumsum(axis=2)
            h = np.bincount(at, np.repeat(weight, width), nodes * width * BINS).reshape(shape).cumsum(axis=2)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g ** 2 / (h + L2) + (all_g - g) ** 2 / (all_h - h + L2) - all_g ** 2 / (all_h + L2)
            gain[(h < LEAST_WEIGHT) | (all_h - h < LEAST_WEIGHT)] = 0
            gain[:, :, -1] = 0
            best = gain.reshape(nodes, -1).argmax(axis=1)
            split = gain.reshape(nodes, -1)[np.arange(nodes), best] > 1e-9
            chosen, cut = best // BINS, best % BINS
            feature[t, first:first + nodes] = np.where(split, chosen, 0)
            threshold[t, first:first + nodes] = np.where(split, edges[np.minimum(cut, BINS - 2), chosen], np.inf)
            node = 2 * node + 1 + (values[np.arange(n), feature[t, node]] > threshold[t, node])
        out = node - inner
        g, h = np.bincount(out, gradient, inner + 1), np.bincount(out, weight, inner + 1)
        leaf[t] = RATE * g / (h + L2)
        logit = logit + leaf[t, out]
    return Trees(base, feature, threshold, leaf)


def held_out(key: str = "doc_id") -> Column:
    """Rows that are never learnt from: the checksum of the id's digits leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          sample_rows: int = SAMPLE_ROWS) -> Trees:
    """Fit on the texts of at most ``sample_rows`` labelled documents that aren't held out."""
    known = (labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull() & ~held_out(key)).groupBy(key)
             .agg(F.min(label).alias("_label"), F.max(label).alias("_other")).where("_label = _other"))
    sample = known.select(F.col(key).alias("_id"), F.col("_label").cast("int").alias("_label"))
    sample = sample.orderBy(F.xxhash64("_id"), "_id").limit(sample_rows)
    # At most sample_rows pairs of numbers.
    rows = docs.select(F.col(key).alias("_id"), text_of(text).alias("_text"), F.xxhash64(text_of(text)).alias("_hash")).join(F.broadcast(sample), "_id")

    def work(batches):
        for batch in batches:
            for part, texts in slices(batch, "_text"):
                numbers = [statistics(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id").cast(pa.string()), part.column("_label"), part.column("_hash"), pa.array(numbers, pa.list_(pa.float64()))],
                    ["_id", "_label", "_hash", "_values"])

    # Of rows that share an id the one with the smallest hash of its text, so that sample_rows bounds what is collected.
    found = rows.mapInArrow(work, "_id string, _label int, _hash long, _values array<double>")
    found = found.groupBy("_id", "_label").agg(F.min(F.struct("_hash", "_values")).alias("_first"))
    found = found.select("_id", "_label", F.col("_first._values").alias("_values")).collect()
    found.sort(key=lambda r: (r["_id"], r["_values"]))
    values = np.array([r["_values"] for r in found], float).reshape(len(found), len(STATISTICS))
    return fit(values, np.array([r["_label"] for r in found], float))


def score(docs: DataFrame, model: Trees, text: str = "text", cut: float = CUT) -> DataFrame:
    """The rows with ``score`` (0 to 1) and ``predicted`` (1 from the cut on)."""
    def work(batches):
        for batch in batches:
            for part, texts in slices(batch, text):
                values = np.array([statistics(t) for t in texts], float)
                scores = model.scores(values)
                yield replaced(part, score=pa.array(scores), predicted=pa.array((scores >= cut).astype(np.int32)))

    schema = with_column(docs.schema, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()))
    return docs.mapInArrow(work, schema)


@query("op2_quality_classifier")
def op2_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's quality score, learnt from the labels that aren't held out."""
    docs = documents(spark, folder).select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
