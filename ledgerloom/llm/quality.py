"""Quality classifier: naive Bayes support vectors.

Indicators of hashed n-grams (of characters, and of the marks that say whether a
word equals the one before it) are scaled by the log ratio of their smoothed
counts in the two classes; a linear hinge-loss model is fitted to the scaled
indicators by dual coordinate descent, and a logistic curve over its margins
turns them into probabilities.

The model is fitted on a bounded sample: at most ``TRAIN_ROWS`` labelled documents
of each class, drawn by hash of the id, whole texts, in one task. Its weights are
one vector of 2^BITS numbers. Scoring reads every text whole.

Defined results: null and empty texts are scored as texts without n-grams, by the
model's bias. Labels that contradict each other for one document are averaged and
rounded up; rows without a label are never learned from. Without rows of both
classes the score is the share of label 1 (0.5 without any label).
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .ngrams import grams

ORDERS = (1, 2, 3)
MARK_ORDERS = (1, 2, 3, 4, 5, 6, 7, 8)
BITS = 18
SMOOTHING = 1.0
COST = 1.0
ROUNDS = 12
TRAIN_ROWS = 3_000
_MARKS = sum(1 << n for n in MARK_ORDERS)
SIZE = (1 << BITS) + _MARKS


def _marks(text: str) -> list[int]:
    """The n-grams that occur of "this word repeats the one before it"."""
    words = text.split()
    same = np.fromiter(map(str.__eq__, words, words[1:]), np.int64, max(0, len(words) - 1))
    out, base = [], 1 << BITS
    for n in MARK_ORDERS:
        if len(same) >= n:
            code = sum(same[k:len(same) - n + 1 + k] << k for k in range(n))
            out += (np.unique(code) + base).tolist()
        base += 1 << n
    return out


def indicators(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) of every feature that a text has, once each, sorted."""
    keys = []
    for buckets, number, count in grams(texts, ORDERS, BITS):
        keys.append(np.unique(np.repeat(number << 20, count) + buckets))
    marks = [(i << 20) + m for i, t in enumerate(texts) for m in _marks(t)]
    keys = np.unique(np.concatenate([*keys, np.array(marks, np.int64)]).astype(np.int64))
    return keys >> 20, keys & (1 << 20) - 1


def fit(number: np.ndarray, feature: np.ndarray, labels: np.ndarray, weight: dict[int, float]) -> np.ndarray:
    """Weights of the features, then ratio-norm weights: a vector of 2 * SIZE + 2 (weights, ratios, slope, intercept)."""
    y = np.where(labels == 1, 1.0, -1.0)
    n = len(labels)
    counts = [np.bincount(feature[y[number] == s], minlength=SIZE) + SMOOTHING for s in (1.0, -1.0)]
    ratio = np.log((counts[0] / counts[0].sum()) / (counts[1] / counts[1].sum()))
    begin = np.searchsorted(number, np.arange(n + 1))
    rows = []
    for i in range(n):
        f = feature[begin[i]:begin[i + 1]]
        x = ratio[f]
        size = np.sqrt(x @ x) or 1.0
        rows.append((np.append(f, SIZE), np.append(x / size, 1.0)))  # the last is the bias
    w, alpha = np.zeros(SIZE + 1), np.zeros(n)
    diagonal = np.array([x @ x for _, x in rows])
    draw = np.random.default_rng(7)
    for _ in range(ROUNDS):
        for i in draw.permutation(n):
            f, x = rows[i]
            slope = y[i] * (w[f] @ x) - 1.0
            new = min(max(alpha[i] - slope / diagonal[i], 0.0), COST)
            if new != alpha[i]:
                w[f] += (new - alpha[i]) * y[i] * x
                alpha[i] = new
    margin = np.array([w[f] @ x for f, x in rows])
    share = np.array([weight[int(v)] for v in labels])
    # softened targets keep the curve finite where the classes part cleanly
    k = [max(1, int((labels == c).sum())) for c in (0, 1)]
    target = np.where(labels == 1, (k[1] + 1) / (k[1] + 2), 1 / (k[0] + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = share * (p - target)
        h = share * p * (1 - p) + 1e-9
        hess = np.array([[h @ margin**2 + 1e-6, h @ margin], [h @ margin, h.sum() + 1e-6]])
        step = np.linalg.solve(hess, np.array([g @ margin, g.sum()]))
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-8:
            break
    return np.concatenate([w[:-1] * ratio, ratio, [w[-1], a, b]])


class Model:
    def __init__(self, vector: np.ndarray | None, share: float):
        self.share = share
        self.weights = self.square = None
        if vector is not None:
            self.weights, self.square = vector[:SIZE].astype(np.float32), (vector[SIZE:2 * SIZE] ** 2).astype(np.float32)
            self.bias, self.slope, self.intercept = vector[2 * SIZE:].tolist()

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.share)
        number, feature = indicators([t or "" for t in texts])
        dot = np.bincount(number, self.weights[feature], len(texts))
        size = np.sqrt(np.bincount(number, self.square[feature], len(texts)))
        margin = dot / np.where(size > 0, size, 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.intercept, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          train_rows: int = TRAIN_ROWS) -> Model:
    """Learn from the documents that ``labels`` marks 0 or 1."""
    marked = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
              .agg((F.avg(label_col) >= 0.5).cast("int").alias("label")))
    marked = marked.join(docs.select(F.col(id_col).alias("id")).distinct(), "id", "left_semi")
    rows = {r.label: r["count"] for r in marked.groupBy("label").count().collect()}
    total = sum(rows.values())
    if len(rows) < 2:
        return Model(None, float(next(iter(rows))) if rows else 0.5)
    full = 1 << 30
    limit = F.when(F.col("label") == 1, min(full, train_rows * full // rows[1])).otherwise(min(full, train_rows * full // rows[0]))
    drawn = marked.filter(F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("quality")), F.lit(full)) < limit)
    texts = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
             .join(F.broadcast(drawn), "id").groupBy("id").agg(F.first("label").alias("label"), F.min("text").alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, feature, label = [], [], []
        for b in batches:
            i, f = indicators([t or "" for t in b.column(1).to_pylist()])
            number.append(i + len(label)), feature.append(f.astype(np.int32))
            label += b.column(0).to_pylist()
        label = np.array(label, np.int64)
        if len(set(label.tolist())) == 2:
            share = {c: rows[c] / total / (label == c).mean() for c in (0, 1)}
            vector = fit(np.concatenate(number), np.concatenate(feature), label, share)
            yield pa.RecordBatch.from_arrays([pa.array([vector.tobytes()])], ["vector"])

    # one task: the sample is bounded
    found = texts.select("label", "text", "id").repartition(1).sortWithinPartitions("id").select("label", "text").mapInArrow(
        run, "vector binary").collect()
    return Model(np.frombuffer(found[0].vector) if found else None, rows[1] / total)


def scorer(spark, model: Model):
    """A function from a text column to the probability of label 1."""
    shipped = spark.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(shipped.value.score(texts.tolist()))

    return lambda text: run(F.col(text) if isinstance(text, str) else text)
