"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint of 64 bits is cut into two halves. Of two fingerprints that differ
in at most 3 bits, one half differs in at most one bit, so both fingerprints
share a variant of that half in which one bit is a wildcard. Each distinct
fingerprint is indexed under its 64 one-wildcard variants, fingerprints meet by
equality of a variant, and every link is verified on all 64 bits.

A variant shared by more than ``MAX_BUCKET`` fingerprints is never brought
together: its members agree on 31 bits, and the same rule is applied to the
other 33, then to the 18 that remain. What agrees after that has 10 free bits,
so it holds at most 1,024 fingerprints. Which variants are that common is known
from counts of the halves before any member moves. A bucket gives a spanning
forest of its links, never its pairs.

Defined results: null and empty texts have fingerprint zero and link like any
other; equal fingerprints link; repeated rows give a row each; documents without
an id link too and take the smallest id they reach, null if there is none.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .common import text_bytes, unused, written
from .graph import components

MAX_DISTANCE = 3
MAX_BUCKET = 4_096
#: Rows of hot keys that may be broadcast; beyond it they are joined by shuffle.
BROADCAST_ROWS = 100_000
WIDTH = 3
_CHUNK = 1 << 16


def fingerprint_of(text: bytes) -> int:
    """Signed 64-bit fingerprint: a bit is 1 if set in over half of the hashes of the word shingles, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    line, size = b" ".join(words), min(WIDTH, len(words))
    ends = list(accumulate(len(w) + 1 for w in words))
    digest = xxhash.xxh64_digest
    total, n = np.zeros(64, np.int64), len(words) - size + 1
    for at in range(0, n, _CHUNK):
        stop = min(n, at + _CHUNK)
        starts = [0 if i == 0 else ends[i - 1] for i in (at,)] + ends[at:stop - 1]
        hashes = b"".join([digest(line[a:b - 1], 42) for a, b in zip(starts, ends[at + size - 1:stop + size - 1])])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, 64)
        total += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big", signed=True)


@F.pandas_udf(T.LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint_of(t) for t in texts], dtype="int64")


def fingerprint(text: str | Column) -> Column:
    return _fingerprints(text_bytes(text))


def hex_of(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def finer(mask: int) -> list[int]:
    """Masks that also hold one of the two halves of the free bits, but for one bit of it."""
    free = [b for b in range(64) if not mask >> b & 1]
    out = []
    for half in (free[:len(free) // 2], free[len(free) // 2:]):
        whole = sum(1 << b for b in half)
        out += [mask | whole & ~(1 << b) for b in half]
    return out


def _divide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (mask, fp) under each finer variant: (mask, val, fp)."""
    known: dict[int, np.ndarray] = {}
    for b in batches:
        masks, fps = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
        for mask in np.unique(masks).tolist():
            if mask not in known:
                known[mask] = np.array([_signed(m) for m in finer(mask & (1 << 64) - 1)], np.int64)
            own, variants = fps[masks == mask], known[mask]
            m, f = np.tile(variants, len(own)), np.repeat(own, len(variants))
            yield pa.RecordBatch.from_arrays([pa.array(m), pa.array(m & f), pa.array(f)], ["mask", "val", "fp"])


def _differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))  # of a signed number it would count the bits of its size


def forest(fps: np.ndarray, distance: int = MAX_DISTANCE) -> list[tuple[int, int]]:
    """Edges from one fingerprint of each linked set to its others."""
    left, edges = fps, []
    while len(left) > 1:
        root, front, left = left[0], left[:1], left[1:]
        while len(front) and len(left):
            near = np.zeros(len(left), bool)
            for at in range(0, len(front), 256):
                near |= (_differing(front[at:at + 256, None], left[None, :]) <= distance).any(axis=0)
            front, left = left[near], left[~near]
            edges += [(int(root), int(x)) for x in front]
    return edges


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (mask, val, fp) sorted by bucket: a spanning forest of each bucket's links."""
    rest = np.zeros((3, 0), np.int64)

    def edges(rows):
        n = rows.shape[1]
        if n < 2:
            return None
        new = np.concatenate([[True], (np.diff(rows[0]) != 0) | (np.diff(rows[1]) != 0)])
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, n))
        fps = rows[2]
        two = starts[sizes == 2]
        near = two[_differing(fps[two], fps[two + 1]) <= MAX_DISTANCE]
        a, b = [fps[near]], [fps[near + 1]]
        for s, k in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            if found := forest(fps[s:s + k]):
                x = np.array(found, np.int64)
                a.append(x[:, 0]), b.append(x[:, 1])
        a, b = np.concatenate(a), np.concatenate(b)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"]) if len(a) else None

    for batch in batches:
        rows = np.concatenate([rest, np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])], axis=1)
        if not rows.shape[1]:
            continue
        same = (rows[0] == rows[0, -1]) & (rows[1] == rows[1, -1])
        cut = int(np.argmin(same[::-1])) if not same.all() else rows.shape[1]
        rest, rows = rows[:, rows.shape[1] - cut:], rows[:, :rows.shape[1] - cut]
        if (out := edges(rows)) is not None:
            yield out
    if (out := edges(rest)) is not None:
        yield out


def _split_by(rows: DataFrame, hot: DataFrame, n_hot: int) -> tuple[DataFrame, DataFrame | None]:
    if n_hot == 0:
        return rows, None
    side = F.broadcast(hot) if n_hot <= BROADCAST_ROWS else hot
    return rows.join(side, ["mask", "val"], "left_anti"), rows.join(side, ["mask", "val"], "left_semi")


def links(fps: DataFrame, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Edges (a, b) that connect exactly the distinct fingerprints (column fp) linked within 3 bits."""
    halves = [((1 << 32) - 1) << 32, (1 << 32) - 1]
    masks = F.array(*[F.lit(_signed(m)) for m in finer(0)])
    rows = (fps.select("fp", F.explode(masks).alias("mask"))
            .select("mask", F.col("mask").bitwiseAND(F.col("fp")).alias("val"), "fp"))
    # a bucket above the limit has a half value with more than half the limit
    half = F.explode(F.array(*[F.struct(F.lit(_signed(h)).alias("half"), F.col("fp").bitwiseAND(F.lit(_signed(h))).alias("v"))
                               for h in halves])).alias("x")
    common = (fps.select(half).groupBy("x").count().filter(F.col("count") > max_bucket // 2)
              .select("x.half", "x.v", F.explode(masks).alias("mask"))
              .filter(F.col("mask").bitwiseAND(F.col("half")) == F.col("mask")))
    hot = written(common.select("mask", F.col("v").bitwiseAND(F.col("mask")).alias("val")).distinct())
    out, level = None, 1
    while True:
        n_hot = hot.count() if level < 3 else 0
        cold, warm = _split_by(rows, hot, n_hot)
        found = (cold.repartition("mask", "val").sortWithinPartitions("mask", "val")
                 .mapInArrow(_link, "a long, b long").distinct())
        out = found if out is None else out.unionByName(found)
        if warm is None:
            return out.distinct()
        rows = written(warm.select("mask", "fp").mapInArrow(_divide, "mask long, val long, fp long").distinct())
        hot = written(rows.groupBy("mask", "val").count().filter(F.col("count") > max_bucket).select("mask", "val"))
        level += 1


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    max_bucket: int = MAX_BUCKET) -> DataFrame:
    """One row per document: id, fp (signed long), root (a fingerprint naming the component), component_id."""
    own = written(docs.select(F.col(id_col).alias("id"), fingerprint(text_col).alias("fp")))
    distinct = own.groupBy("fp").agg(F.min("id").alias("low"))
    linked = components(links(distinct.select("fp"), max_bucket))
    named = written(distinct.join(linked, distinct.fp == linked.node, "left")
                    .select("fp", "low", F.coalesce("root", "fp").alias("root")))
    least = named.groupBy("root").agg(F.min("low").alias("component_id"))
    return (own.join(named.select("fp", "root").join(least, "root"), "fp")
            .select(F.col("id").alias(id_col), "fp", "root", "component_id"))


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       max_bucket: int = MAX_BUCKET) -> DataFrame:
    """The rows of ``docs`` with the smallest id of each component, one row of each component."""
    members = written(near_duplicates(docs, id_col, text_col, max_bucket).select(F.col(id_col).alias("id"), "fp", "root"))
    id_, fp, own, row = (unused(docs, c) for c in ("_keep_id", "_keep_fp", "_own_fp", "_row"))
    first = (members.groupBy("root").agg(F.min(F.struct(F.isnull("id").alias("none"), "id", "fp")).alias("k"))
             .select(F.col("k.id").alias(id_), F.col("k.fp").alias(fp)))
    kept = docs.join(first.hint("shuffle_hash"), docs[id_col].eqNullSafe(first[id_]))
    if members.groupBy("id").count().filter("count > 1").limit(1).count():  # ids that repeat: tell their rows by fingerprint
        w = Window.partitionBy(id_, fp).orderBy(F.col(text_col))
        kept = (kept.withColumn(own, fingerprint(text_col)).filter(F.col(own) == F.col(fp))
                .withColumn(row, F.row_number().over(w)).filter(F.col(row) == 1).drop(own, row))
    return kept.drop(id_, fp)
