"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of n-grams per language are gathered in parallel from at most
``TRAIN_ROWS`` labelled documents of each language (a Bernoulli sample by hash of
the id, whole texts). The log-probability matrix, buckets by languages, is
broadcast; its size is fixed by ``BITS`` and checked against ``MAX_LANGS``. Texts
are scored whole, in batches: the sparse matrix of a batch's n-grams times the
log-probability matrix.

Defined results: null texts and texts without a letter are ``und`` with score 0,
and so is everything if nothing could be learned. Ties go to the language that
sorts first. The score is the posterior of the predicted language if the text
gave no more evidence than ``EVIDENCE`` n-grams do, so it tells mixed texts from
plain ones. Rows without a language are scored and never learned from.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .ngrams import grams

UNKNOWN = "und"
ORDERS = (1, 2, 3)
BITS = 16
SMOOTHING = 0.5
EVIDENCE = 60
TRAIN_ROWS = 20_000
MAX_LANGS = 400
SLICE = 1 << 12


class Model:
    """Languages, and the log-probability of each bucket and the log-prior by language."""

    def __init__(self, langs: list[str], counts: np.ndarray, rows: list[int]):
        self.langs = langs
        if langs:
            smooth = counts + SMOOTHING
            self.log_p = np.log(smooth / smooth.sum(axis=1, keepdims=True)).T.astype(np.float32)
            self.prior = np.log(np.array(rows, float) / sum(rows))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        out, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
        which = [i for i, t in enumerate(texts) if t and regex.search(r"\p{L}", t)]
        if not self.langs or not which:
            return out.tolist(), score
        total, n = np.zeros((len(which), len(self.langs))), np.zeros(len(which))
        for buckets, number, count in grams([texts[i].lower() for i in which], ORDERS, BITS):
            np.add.at(total, number, np.add.reduceat(self.log_p[buckets], np.cumsum(count) - count, axis=0, dtype=np.float64))
            np.add.at(n, number, count)
        best = (total + self.prior).argmax(axis=1)
        odds = total * np.minimum(1, EVIDENCE / n)[:, None] + self.prior
        p = np.exp(odds - odds.max(axis=1, keepdims=True))
        out[which] = np.array(self.langs, object)[best]
        score[which] = p[np.arange(len(which)), best] / p.sum(axis=1)
        return out.tolist(), score


def _count(langs: list[str]):
    place = {k: i for i, k in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(langs), 1 << BITS), np.int64)
        for b in batches:
            lang = np.array([place[x] for x in b.column(0).to_pylist()], np.int64)
            texts = [t.lower() for t in b.column(1).to_pylist()]
            for buckets, number, count in grams(texts, ORDERS, BITS):
                at = np.repeat(lang[number] << BITS, count) + buckets
                counts += np.bincount(at, minlength=counts.size).reshape(counts.shape)
        for i in np.flatnonzero(counts.any(axis=1)).tolist():
            yield pa.RecordBatch.from_arrays(
                [pa.array([i] * (counts.shape[1] // SLICE)), pa.array(range(counts.shape[1] // SLICE)),
                 pa.array([x.tobytes() for x in counts[i].reshape(-1, SLICE)])], ["lang", "slice", "counts"])
    return run


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the rows of each (lang, slice); their number in a task is bounded by the model's size."""
    held: dict[tuple[int, int], np.ndarray] = {}
    for b in batches:
        for lang, slice_, counts in zip(*(c.to_pylist() for c in b.columns)):
            own = held.setdefault((lang, slice_), np.zeros(SLICE, np.int64))
            own += np.frombuffer(counts, np.int64)
    for (lang, slice_), own in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([slice_]), pa.array([own.tobytes()])],
                                         ["lang", "slice", "counts"])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          train_rows: int = TRAIN_ROWS) -> Model:
    """Learn from the rows of ``docs`` that have a text and a language."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = {r.lang: r["count"] for r in own.groupBy("lang").count().limit(MAX_LANGS + 1).collect()}
    if len(rows) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages: raise MAX_LANGS if the matrix may be that large")
    langs = sorted(rows)
    if not langs:
        return Model([], None, [])
    full = 1 << 30
    share = F.create_map(*[F.lit(x) for k in langs for x in (k, min(full, train_rows * full // rows[k]))])
    drawn = own.filter(F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("language")), F.lit(full)) < share[F.col("lang")])
    parts = (drawn.select("lang", "text").mapInArrow(_count(langs), "lang long, slice long, counts binary")
             .repartition("lang", "slice").mapInArrow(_sum, "lang long, slice long, counts binary"))
    counts = np.zeros((len(langs), 1 << BITS), np.int64)
    for r in parts.collect():  # languages times buckets in all
        counts[r.lang, r.slice * SLICE:(r.slice + 1) * SLICE] += np.frombuffer(r.counts, np.int64)
    return Model(langs, counts, [rows[k] for k in langs])


_PREDICTED = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def predictor(spark, model: Model):
    """A function from a text column to a struct (lang_pred, score)."""
    shipped = spark.sparkContext.broadcast(model)

    @F.pandas_udf(_PREDICTED)
    def run(texts: pd.Series) -> pd.DataFrame:
        lang, score = shipped.value.predict(texts.tolist())
        return pd.DataFrame({"lang_pred": lang, "score": score})

    return lambda text: run(F.col(text) if isinstance(text, str) else text)


def identify(docs: DataFrame, model: Model, text_col: str = "text", into: str = "_language") -> DataFrame:
    """``docs`` with the struct column ``into``: lang_pred, score."""
    return docs.withColumn(into, predictor(docs.sparkSession, model)(text_col))
