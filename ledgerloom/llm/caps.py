"""Embedding near-duplicates by spherical-cap filters.

Equal vectors of a label are one node first. A filter direction is a product code:
the dimensions of a randomly rotated vector are cut into ``BLOCKS`` blocks, each
with a random codebook, and every choice of one code per block is a direction, so
``CODES`` ^ ``BLOCKS`` directions cost only ``BLOCKS`` small codebooks. A node is
list-decoded to all directions whose inner product exceeds the threshold, best
blocks first, plus the nearest one of each rotation. Nodes join on filters within
a label, and every candidate's cosine is computed in double precision.

A bucket of over ``MAX_BUCKET`` nodes is cut into blocks that meet in pairs, each
pair a unit of its own, so no task holds more than two blocks. A bucket sends out
link counts and a spanning forest, never its pairs; a pair that shares several
filters counts in the first of them only.

Recall depends on the rotations and codes alone, not on the data's size; measured
0.98 at cosine 0.93 for random pairs in 64 dimensions and above 0.99 from 0.95 on.

Defined results: vectors that are null, empty, zero or hold a null or non-finite
component, and vectors with a null label, link with nothing and are components of
their own; so do vectors of different lengths with each other. Rows that repeat
are vectors of their own. A null id is never the least one.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import written
from .graph import components

SIMILARITY = 0.93
BLOCKS = 2
CODES = 256
ROTATIONS = 6
#: Filters of a rotation that a pair at the least similarity shares on average; sets the threshold.
SHARED = 3
MAX_BUCKET = 1_024
#: Rows of hot buckets that may be broadcast; beyond it they are joined by shuffle.
BROADCAST_ROWS = 100_000


class Filters:
    """The rotations and codebooks for vectors of one length."""

    def __init__(self, dim: int, similarity: float = SIMILARITY):
        draw = np.random.default_rng(dim)
        self.blocks = np.array_split(np.arange(dim), min(BLOCKS, dim))
        self.parts = []
        for _ in range(ROTATIONS):
            turn = np.linalg.qr(draw.normal(size=(dim, dim)))[0]
            books = [draw.normal(size=(CODES, len(b))) for b in self.blocks]
            self.parts.append((turn, [c / np.linalg.norm(c, axis=1, keepdims=True) for c in books]))
        pairs = 100
        x, y = draw.normal(size=(2, pairs, dim))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        y -= (x * y).sum(axis=1, keepdims=True) * x
        size = np.linalg.norm(y, axis=1, keepdims=True)
        y = similarity * x + np.sqrt(1 - similarity**2) * np.divide(y, size, out=np.zeros_like(y), where=size > 1e-9)
        scores = []
        for v in (x, y / np.linalg.norm(y, axis=1, keepdims=True)):
            score, turned = np.zeros((pairs, 1), np.float32), v @ self.parts[0][0]
            for b, c in zip(self.blocks, self.parts[0][1]):
                score = (score[:, :, None] + (turned[:, b] @ c.T)[:, None, :].astype(np.float32)).reshape(pairs, -1)
            scores.append(score)
        both = np.minimum(*scores).ravel()
        rank = both.size - min(both.size, SHARED * pairs)
        self.threshold = float(np.partition(both, rank)[rank]) / np.sqrt(len(self.blocks))

    def decode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) of each filter of each unit vector, by row, without repeats."""
        rows, found = [], []
        need = self.threshold * np.sqrt(len(self.blocks))
        base = 0
        for turn, books in self.parts:
            turned = unit @ turn
            scores = [turned[:, b] @ c.T for b, c in zip(self.blocks, books)]
            best = [s.max(axis=1) for s in scores]
            nearest = np.zeros(len(unit), np.int64)
            for s in scores:
                nearest = nearest * CODES + s.argmax(axis=1)
            row, value, code = np.arange(len(unit)), np.zeros(len(unit)), np.zeros(len(unit), np.int64)
            for k, s in enumerate(scores):
                # a partial code stays while the best codes of the other blocks could lift it over the threshold
                value = (value[:, None] + s[row]).ravel()
                row = np.repeat(row, CODES)
                code = (code[:, None] * CODES + np.arange(CODES)).ravel()
                rest = sum((b[row] for b in best[k + 1:]), np.zeros(len(row)))
                stay = value + rest >= need
                row, value, code = row[stay], value[stay], code[stay]
            rows += [row, np.arange(len(unit))]
            found += [code + base, nearest + base]
            base += CODES ** len(self.blocks)
        key = np.unique(np.concatenate(rows) * base + np.concatenate(found))
        return key // base, key % base


_FILTERS: dict[tuple[int, float], Filters] = {}


def filters(dim: int, similarity: float = SIMILARITY) -> Filters:
    if (dim, similarity) not in _FILTERS:
        _FILTERS[dim, similarity] = Filters(dim, similarity)
    return _FILTERS[dim, similarity]


def _decode(similarity: float):
    """(node, label, copies, vector) to (node, label, copies, dim, unit vector as bytes, filters)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vectors = b.column(3)
            lens = np.array(vectors.value_lengths())
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            begin = np.cumsum(lens) - lens
            for dim in np.unique(lens).tolist():
                own = np.flatnonzero(lens == dim)
                x = flat[begin[own][:, None] + np.arange(dim)]
                x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
                unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
                row, found = filters(dim, similarity).decode(unit)
                starts = np.searchsorted(row, np.arange(len(own) + 1)).astype(np.int32)
                take = pa.array(own)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(take), b.column(1).take(take), b.column(2).take(take), pa.array([dim] * len(own), pa.int64()),
                     pa.array([u.tobytes() for u in unit], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(starts), pa.array(found, pa.int64()))],
                    ["node", "label", "copies", "dim", "unit", "filters"])
    return run


def _earlier(filters_: list[np.ndarray], bucket: int) -> np.ndarray:
    """Which pairs share a filter before this one."""
    low = [f[f < bucket] for f in filters_]
    names = np.unique(np.concatenate(low)) if low else np.zeros(0, np.int64)
    held = np.zeros((len(low), max(1, len(names))), np.float32)
    for i, f in enumerate(low):
        held[i, np.searchsorted(names, f)] = 1
    return held @ held.T > 0


def _bucket(node, copies, unit, lists, block, cross, bucket, similarity):
    """Link counts and a spanning forest of one bucket's first-seen links."""
    near = unit @ unit.T >= similarity
    np.fill_diagonal(near, False)
    if cross:
        near &= block[:, None] != block[None, :]
    if near.any():
        near &= ~_earlier(lists, bucket)
    n = near @ copies
    some = np.flatnonzero(n)
    a, b, left = [], [], some
    while len(left):
        root, front, left = left[0], left[:1], left[1:]
        while len(front) and len(left):
            hit = near[front][:, left].any(axis=0)
            front, left = left[hit], left[~hit]
            a += [node[root]] * len(front)
            b += node[front].tolist()
    return node[some].tolist(), n[some].tolist(), a, b


def _link(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def done(rows: pa.Table) -> pa.RecordBatch | None:
            """``rows`` hold whole units, sorted."""
            keys = np.stack([rows.column(k).to_numpy() for k in range(5)])
            cut = np.flatnonzero(np.concatenate([[True], (np.diff(keys, axis=1) != 0).any(axis=0)]))
            size = np.diff(np.append(cut, rows.num_rows))
            node, copies, block = (rows.column(k).to_numpy() for k in ("node", "copies", "block"))
            a, n, b = [], [], []
            units, lists = rows.column("unit"), rows.column("filters")
            for at, k in zip(cut[size > 1].tolist(), size[size > 1].tolist()):
                dim = int(keys[1, at])
                unit = np.frombuffer(b"".join(units.slice(at, k).to_pylist()), np.float64).reshape(k, dim)
                if k == 2 and unit[0] @ unit[1] < similarity:
                    continue
                part = slice(at, at + k)
                own = [np.array(x, np.int64) for x in lists.slice(at, k).to_pylist()]
                c = _bucket(node[part], copies[part], unit, own, block[part], keys[3, at] != keys[4, at], int(keys[2, at]), similarity)
                a += c[0] + c[2]
                n += c[1] + [0] * len(c[2])
                b += [None] * len(c[0]) + c[3]
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, n)], ["a", "b", "n"]) if a else None

        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(5)])
            change = np.flatnonzero((np.diff(keys, axis=1) != 0).any(axis=0)) + 1
            if last is not None and (last != keys[:, 0]).any():
                change = np.append(0, change)
            last = keys[:, -1]
            if len(change):  # all before the last change is whole
                end = int(change[-1])
                if (out := done(pa.Table.from_batches([*held, batch.slice(0, end)]))) is not None:
                    yield out
                held, batch = [], batch.slice(end)
            held.append(batch)
        if held and (out := done(pa.Table.from_batches(held))) is not None:
            yield out
    return run


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    similarity: float = SIMILARITY, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept."""
    v = F.col("v")
    own = rows.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    sound = (F.col("label").isNotNull() & v.isNotNull() & (F.size("v") > 0)
             & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
             & F.exists(v, lambda x: x != 0))
    own = own.withColumn("sound", F.coalesce(sound, F.lit(False)))
    nodes = written(own.filter("sound").groupBy("label", "v").agg(F.min("id").alias("low"), F.count("*").alias("copies"))
                    .withColumn("node", F.monotonically_increasing_id()))
    # labels are numbered, so that a unit's key is numeric whatever their type
    index = written(nodes.select("node", F.xxhash64("label").alias("label"), "copies", "v").mapInArrow(
        _decode(similarity), "node long, label long, copies long, dim long, unit binary, filters array<long>"))
    keys = ["label", "dim", "filter"]
    hot = written(index.select("label", "dim", F.explode("filters").alias("filter")).groupBy(*keys).count()
                  .filter(F.col("count") > max_bucket).select(*keys, F.ceil(F.col("count") / max_bucket).cast("long").alias("ways")))
    spread = index.select("label", "dim", F.explode("filters").alias("filter"), "node", "copies", "unit", "filters")
    n_hot = hot.count()
    if n_hot:
        spread = spread.join(F.broadcast(hot) if n_hot <= BROADCAST_ROWS else hot, keys, "left")
        spread = spread.withColumn("block", F.pmod(F.xxhash64("node"), F.coalesce("ways", F.lit(1))))
        spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("ways", F.lit(1)) - 1)))
    else:
        spread = spread.withColumn("block", F.lit(0).cast("long")).withColumn("other", F.col("block"))
    units = spread.select(*keys, F.least("block", "other").alias("lower"), F.greatest("block", "other").alias("upper"),
                          "node", "copies", "block", "unit", "filters")
    order = [*keys, "lower", "upper"]
    found = written(units.repartition(*order).sortWithinPartitions(*order).mapInArrow(_link(similarity), "a long, b long, n long"))
    count = found.filter("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    linked = components(found.filter("b is not null").select("a", "b"))
    named = written(nodes.join(linked, "node", "left").join(count, "node", "left")
                    .select("label", "v", "low", F.coalesce("root", "node").alias("root"),
                            (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    least = named.groupBy("root").agg(F.min("low").alias("component_id"))
    named = named.join(least, "root").select(F.col("label").alias("l"), F.col("v").alias("w"), "n_links", "component_id")
    out = own.join(named, (own.label == named.l) & (own.v == named.w) & own.sound, "left")
    return out.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("sound"), F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    ).withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
