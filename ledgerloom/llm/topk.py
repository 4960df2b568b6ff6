"""Exact top-k search by columnar branch and bound.

Vectors are held dimension by dimension, the dimensions with most mass in the
queries first. For a block of queries and a chunk of candidates, inner products
are accumulated one block of dimensions at a time. After each, a pair's score is
at most what is accumulated plus the product of the lengths of what remains
(Cauchy-Schwarz); pairs below their query's threshold are out, candidates that no
query wants leave the columns, and once few pairs survive they are compacted to a
list and only those are carried on. The threshold is the k-th best score seen so
far, and starts as the k-th best among about ``SAMPLE`` ids drawn by hash, a row of each: any
subset's k-th best is a sound bound, so the sample changes speed only.

The queries are handled in blocks of about ``QUERY_BLOCK``, fewer where vectors are long
(``QUERY_VALUES`` components), each broadcast (its size does not depend on the input),
against all rows. The driver holds the sample and one block; thresholds are found in
tasks, ``GROUP`` queries at a time. A task sends k rows for a query at most.

Components are floor(64 x) in double precision. Scores are exact: sums that might
pass 2^53 are done in integers of any size; a score beyond 64 bits is an error.

Defined results: vectors that are null or hold null or non-finite components take no
part, nor do rows without an id; missing components of shorter vectors count as
zero. A query's own rows are all rows with its id; a query id that repeats is
answered for its least vector; a candidate that repeats counts as often.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .common import written

SCALE = 64
K = 20
EVERY = 20
QUERY_BLOCK = 50_000
#: Components of a block's queries at most, as the driver holds a block several times over in double precision.
QUERY_VALUES = QUERY_BLOCK * 64
SAMPLE = 4_096
CHUNK = 8_192
GROUP = 256
DIMENSIONS = 8
#: Share of pairs below which the survivors are compacted to a list.
SPARSE = 0.05
_EXACT = float(1 << 52)


def components(vectors: pa.Array, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(places of the sound vectors, their scaled components, shorter ones filled with zeros)."""
    n = len(vectors)
    lens = np.nan_to_num(np.asarray(vectors.value_lengths().to_numpy(zero_copy_only=False), float)).astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    row = np.repeat(np.arange(n), lens)
    good = np.asarray(vectors.is_valid().to_numpy(zero_copy_only=False), bool)
    good[row[~np.isfinite(flat)]] = False  # a null component reads as not a number
    width = int(lens.max(initial=0)) if width is None else width
    out = np.zeros((n, max(width, int(lens.max(initial=0)))))
    begin = np.cumsum(lens) - lens
    with np.errstate(invalid="ignore", over="ignore"):
        out[row, np.arange(len(flat)) - begin[row]] = np.floor(SCALE * flat)
    places = np.flatnonzero(good)
    return places, out[places]


class Search:
    """Queries of a block, their dimension order, and thresholds."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.k = ids, k
        self.order = np.argsort(-(vectors**2).sum(axis=0), kind="stable")
        self.q = np.ascontiguousarray(vectors[:, self.order])
        self.floor = np.full(len(ids), -np.inf)
        self.rest = self._rest(self.q.T)

    @staticmethod
    def _rest(columns: np.ndarray) -> np.ndarray:
        """Lengths of what remains from each block of dimensions on; row b is before block b."""
        starts = range(0, len(columns), DIMENSIONS)
        mass = np.stack([(columns[s:s + DIMENSIONS] ** 2).sum(axis=0) for s in starts] + [np.zeros(columns.shape[1])])
        return np.sqrt(mass[::-1].cumsum(axis=0)[::-1]) * (1 + 1e-9)

    def pairs(self, ids: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query place, candidate place, score) of every pair at or above its query's threshold."""
        d = self.q.shape[1]
        wide = np.zeros((len(vectors), d))
        wide[:, :min(d, vectors.shape[1])] = vectors[:, :d]  # what queries lack adds nothing
        columns = np.ascontiguousarray(wide[:, self.order].T)
        rest = self._rest(columns)
        if self.rest[0].max(initial=0) * rest[0].max(initial=0) >= _EXACT or max(
                np.abs(self.q).max(initial=0), np.abs(columns).max(initial=0)) >= _EXACT:
            return self._exact(ids, columns)
        out = [self._group(at, columns, rest) for at in range(0, len(self.q), GROUP)]
        q, c, s = (np.concatenate(x) for x in zip(*out))
        other = self.ids[q] != ids[c]
        return q[other], c[other], s[other].astype(np.int64)

    def _group(self, at: int, columns: np.ndarray, rest: np.ndarray):
        q, floor = self.q[at:at + GROUP], self.floor[at:at + GROUP] - 1e-6
        own = self.rest[:, at:at + GROUP]
        here, x = np.arange(columns.shape[1]), columns
        score = np.zeros((len(q), x.shape[1]))
        blocks = list(range(0, len(columns), DIMENSIONS))
        for b, s in enumerate(blocks):
            score += q[:, s:s + DIMENSIONS] @ x[s:s + DIMENSIONS]
            alive = score + own[b + 1][:, None] * rest[b + 1][here][None, :] >= floor[:, None]
            wanted = alive.any(axis=0)
            share = alive.sum() / max(1, alive.size)
            if share <= SPARSE or b == len(blocks) - 1:
                i, j = np.nonzero(alive)
                total, j = score[i, j], here[j]
                for n, t in enumerate(blocks[b + 1:], b + 1):
                    for dim in range(t, min(t + DIMENSIONS, len(columns))):
                        total = total + q[i, dim] * columns[dim, j]
                    stay = total + own[n + 1][i] * rest[n + 1][j] >= floor[i]
                    i, j, total = i[stay], j[stay], total[stay]
                return i + at, j, total
            if wanted.mean() < 0.7:
                here, x, score = here[wanted], x[:, wanted], score[:, wanted]
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def _exact(self, ids, columns):
        q, x = ([[int(v) for v in row] for row in m.tolist()] for m in (self.q, columns.T))
        found = [(i, j, s) for i, a in enumerate(q) for j, b in enumerate(x)
                 if self.ids[i] != ids[j] and (s := sum(u * v for u, v in zip(a, b))) >= self.floor[i]]
        if any(abs(s) >= 1 << 63 for _, _, s in found):
            raise OverflowError("a score does not fit into 64 bits")
        i, j, s = zip(*found) if found else ((), (), ())
        return np.array(i, np.int64), np.array(j, np.int64), np.array(s, np.int64)

    def best(self, q: np.ndarray, ids: np.ndarray, score: np.ndarray):
        """The k best of each query among pairs, ties to the smaller id; thresholds rise to the k-th."""
        order = np.lexsort((ids, -score, q))
        q, ids, score = q[order], ids[order], score[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        last = rank == self.k - 1
        self.floor[q[last]] = np.maximum(self.floor[q[last]], score[last].astype(float))
        top = rank < self.k
        return q[top], ids[top], score[top]


def _start(shipped):
    """Queries with the thresholds they start from: their k-th best among the sample."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, k = shipped.value
        for b in batches:
            for at in range(0, b.num_rows, GROUP):
                part = b.slice(at, GROUP)
                _, own = components(part.column(1))
                search = Search(part.column(0).to_numpy(), own, k)
                kept = (np.zeros(0, np.int64),) * 3
                for n in range(0, len(ids), 1024):
                    q, c, s = search.pairs(ids[n:n + 1024], vectors[n:n + 1024])
                    kept = search.best(*(np.concatenate(x) for x in zip(kept, (q, ids[n:n + 1024][c], s))))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(search.floor)], ["id", "v", "floor"])
    return run


def _scan(shipped):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search: Search = shipped.value
        search.floor = search.floor.copy()
        empty = np.zeros(0, np.int64)
        kept, held, rows = (empty, empty, empty), [], 0

        def work():
            nonlocal kept
            ids = np.concatenate([i for i, _ in held])
            width = max(v.shape[1] for _, v in held)
            vectors = np.concatenate([np.pad(v, ((0, 0), (0, width - v.shape[1]))) for _, v in held])
            q, c, s = search.pairs(ids, vectors)
            kept = search.best(*(np.concatenate(x) for x in zip(kept, (q, ids[c], s))))

        for b in batches:
            places, vectors = components(b.column(1))
            ids = b.column(0).to_numpy(zero_copy_only=False)
            if len(places):
                held.append((ids[places].astype(np.int64), vectors))
                rows += len(places)
            if rows >= CHUNK:
                work()
                held, rows = [], 0
        if held:
            work()
        q, ids, score = kept
        for at in range(0, len(q), 100_000):
            part = slice(at, at + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(search.ids[q[part]]), pa.array(ids[part]), pa.array(score[part])],
                                             ["query_id", "vec_id", "score"])
    return run


def _sound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        places, _ = components(b.column(1))
        yield b.take(pa.array(places))


def _drawn(own: DataFrame, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scaled vectors of about ``sample`` ids drawn by hash, one row of each."""
    share = min(1.0, sample / max(1, own.count()))
    drawn = own.filter(F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 30)) < int(share * (1 << 30)))
    drawn = drawn.dropDuplicates(["id"]).toArrow()  # an id that repeats comes once, however many rows it has
    if not drawn.num_rows:
        return np.zeros(0, np.int64), np.zeros((0, 0))
    places, seen = components(drawn.column("v").combine_chunks())
    return drawn.column("id").to_numpy()[places], seen


def _block(queries: DataFrame, k: int) -> Search | None:
    part = queries.toArrow()
    if not part.num_rows:
        return None
    _, vectors = components(part.column("v").combine_chunks())
    search = Search(part.column("id").to_numpy(), vectors, k)
    search.floor = part.column("floor").to_numpy().copy()
    return search


def top_k(rows: DataFrame, k: int = K, every: int = EVERY, id_col: str = "vec_id", vector_col: str = "embedding",
          query_block: int = QUERY_BLOCK, sample: int = SAMPLE) -> DataFrame:
    """The k best of all rows for each row whose id is divisible by ``every``: query_id, rank, vec_id, score."""
    spark = rows.sparkSession
    own = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).filter("id is not null and v is not null")
    sound = own.filter(F.col("id") % every == 0).mapInArrow(_sound, own.schema).groupBy("id").agg(F.min("v").alias("v"))
    shipped = spark.sparkContext.broadcast((*_drawn(own, sample), k))
    queries = written(sound.mapInArrow(_start(shipped), T.StructType([*sound.schema, T.StructField("floor", T.DoubleType())])))
    shipped.destroy()
    n, width = queries.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    blocks, out = max(1, -(-n // query_block), -(-n * (width or 0) // QUERY_VALUES)), None
    for block in range(blocks):
        search = _block(queries.filter(F.pmod(F.xxhash64("id", F.lit("block")), F.lit(blocks)) == block), k)
        if search is None:
            continue
        shipped, search = spark.sparkContext.broadcast(search), None
        found = own.mapInArrow(_scan(shipped), "query_id long, vec_id long, score long")
        if blocks > 1:
            found = written(found)
            shipped.destroy()  # in the driver too
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
