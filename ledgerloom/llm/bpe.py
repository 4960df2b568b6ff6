"""Byte-level BPE encoding and decoding over padded numpy matrices.

A text is split by the vocabulary's pattern and every match is encoded by
itself. Distinct matches are sorted into buckets by length, each a padded matrix
of token ids. In a round every row merges its leftmost pair of minimum rank; the
row is closed up by one cell, only the two pairs beside the merge are looked up
again, and finished rows leave the matrix. Pairs are found in an open-addressing
hash table held in numpy arrays.

Defined results: a null text is empty and has no ids. Texts of any length are
encoded whole; a match wider than the widest bucket is merged in a row of its
own, all places of its minimum pair in one round (see ``_merge_long``). Rows
that repeat give the same result each. Only the id and text columns are read, so
other columns cannot clash.
"""
from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .hashtable import HashTable

NONE = np.int32(2**31 - 1)
WIDEST = 256
CELLS = 1 << 21
#: Distinct runs of text a worker remembers; beyond it the memory starts anew.
REMEMBERED = 300_000


class PairTable:
    """Hash table from a pair of token ids to the id of their concatenation."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        self.table = HashTable(self._key(left, right), merged, NONE)

    def _key(self, left, right):
        return (left.astype(np.int64) << 32) | right.astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where the pair is no token; ids below 0 are padding."""
        return self.table.get(np.where((left < 0) | (right < 0), -1, self._key(left, right)))


class Codec:
    """Encoder and decoder of one vocabulary file of ranks."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.find = regex.compile(pattern).findall
        self.single = np.full(256, -1, np.int32)
        left, right, merged = [], [], []
        for word, rank in ranks.items():
            if len(word) == 1:
                self.single[word[0]] = rank
            for cut in range(1, len(word)):
                a, b = ranks.get(word[:cut]), ranks.get(word[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), merged.append(rank)
        self.pairs = PairTable(np.array(left, np.int32), np.array(right, np.int32), np.array(merged, np.int32))
        top = max(ranks.values(), default=-1) + 1
        self.lengths = np.zeros(top, np.int64)
        for word, rank in ranks.items():
            self.lengths[rank] = len(word)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]) if top else np.zeros(0, np.int64)
        letters = bytearray(int(self.lengths.sum()))
        for word, rank in ranks.items():
            letters[self.starts[rank]:self.starts[rank] + len(word)] = word
        self.letters = np.frombuffer(bytes(letters), np.uint8)
        self._forget()

    def _forget(self) -> None:
        """Start the memory of runs anew: ``known`` numbers them, their ids lie one after the other in ``flat``."""
        self.known: dict[str, int] = {}
        self.begin, self.flat = np.zeros(1, np.int64), np.zeros(0, np.int32)

    def merge(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece, merged in matrices of pieces of like length."""
        out: list[list[int]] = [[]] * len(pieces)
        lens = np.fromiter(map(len, pieces), np.int64, len(pieces))
        for i in np.flatnonzero(lens > WIDEST):
            out[i] = self._merge_long(self.single[np.frombuffer(pieces[i], np.uint8)])
        width, low = 4, 0
        while width <= WIDEST:
            rows = np.flatnonzero((lens > low) & (lens <= width))
            step = max(1, CELLS // width)
            for at in range(0, len(rows), step):
                part = rows[at:at + step]
                for i, ids in zip(part.tolist(), self._merge_matrix([pieces[k] for k in part], lens[part], width)):
                    out[i] = ids
            low, width = width, width * 2
        return out

    def _merge_matrix(self, pieces: list[bytes], lens: np.ndarray, width: int) -> list[list[int]]:
        flat = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        cells = np.full((len(pieces), width), -1, np.int32)
        cells[np.arange(width) < lens[:, None]] = flat
        ranks = np.full((len(pieces), width), NONE, np.int32)
        ranks[:, :-1] = self.pairs.ranks(cells[:, :-1].ravel(), cells[:, 1:].ravel()).reshape(len(pieces), -1)
        done = np.empty_like(cells)
        rows, count, cols = np.arange(len(pieces)), lens.copy(), np.arange(width)
        while len(rows):
            at = ranks.argmin(axis=1)
            here = np.arange(len(rows))
            best = ranks[here, at]
            over = best == NONE
            if over.any():
                done[rows[over]] = cells[over]
                go = ~over
                rows, cells, ranks, at, best = rows[go], cells[go], ranks[go], at[go], best[go]
                here = np.arange(len(rows))
                if not len(rows):
                    break
            source = np.minimum(cols + (cols > at[:, None]), width - 1)
            last = cells[:, -1].copy()
            cells, ranks = np.take_along_axis(cells, source, 1), np.take_along_axis(ranks, source, 1)
            cells[:, -1], ranks[:, -1] = np.where(at == width - 1, last, -1), NONE
            cells[here, at] = best
            count[rows] -= 1
            after = np.minimum(at + 1, width - 1)
            ranks[here, at] = np.where(at + 1 < width, self.pairs.ranks(best, cells[here, after]), NONE)
            inner = np.flatnonzero(at > 0)
            ranks[inner, at[inner] - 1] = self.pairs.ranks(cells[inner, at[inner] - 1], best[inner])
        return [row[:n] for row, n in zip(done.tolist(), count.tolist())]

    def _merge_long(self, ids: np.ndarray) -> list[int]:
        """One wide row. A round merges every place of the minimum pair, which equals merging
        them one by one from the left unless a merge makes a pair of lower rank; then it merges the first only."""
        ranks = self.pairs.ranks(ids[:-1], ids[1:])
        while len(ranks) and (best := ranks.min()) != NONE:
            places = np.flatnonzero(ranks == best)
            fresh = np.concatenate([[True], np.diff(places) > 1])
            begin = np.maximum.accumulate(np.where(fresh, np.arange(len(places)), 0))
            places = places[(places - places[begin]) % 2 == 0]
            between = self.pairs.ranks(np.full(len(places), best, np.int32), ids[places])
            new, new_ranks = self._close(ids, places, best)
            if len(places) > 1 and (min(between.min(), new_ranks.min(initial=NONE)) < best):
                new, new_ranks = self._close(ids, places[:1], best)
            ids, ranks = new, new_ranks
        return ids.tolist()

    def _close(self, ids, places, best):
        new = ids.copy()
        new[places] = best
        new = np.delete(new, places + 1)
        return new, self.pairs.ranks(new[:-1], new[1:])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's begin."""
        if len(self.known) > REMEMBERED:
            self._forget()
        split = [self._runs(t) for t in texts]
        runs = list(chain.from_iterable(split))
        at = np.fromiter(map(self.known.get, runs, repeat(-1)), np.int64, len(runs))
        new = np.flatnonzero(at < 0)
        if len(new):
            self._learn(list({runs[i] for i in new.tolist()}))
            at[new] = np.fromiter((self.known[runs[i]] for i in new.tolist()), np.int64, len(new))
        sizes = self.begin[at + 1] - self.begin[at]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        flat = self.flat[np.repeat(self.begin[at] - ends[:-1], sizes) + np.arange(ends[-1])]
        return flat, ends[np.concatenate([[0], np.cumsum([len(r) for r in split], dtype=np.int64)])]

    def _learn(self, runs: list[str]) -> None:
        found = [[p.encode("utf-8", "surrogatepass") for p in self.find(r)] for r in runs]
        pieces = list(set(chain.from_iterable(found)))
        ids = dict(zip(pieces, self.merge(pieces)))
        new = [[i for p in ps for i in ids[p]] for ps in found]
        self.known.update(zip(runs, range(len(self.known), len(self.known) + len(new))))
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum([len(x) for x in new])])
        self.flat = np.concatenate([self.flat, np.array(list(chain.from_iterable(new)), np.int32)])

    _odd = regex.compile(r" \s|\s |^\s|\s$").search

    def _runs(self, text: str) -> list[str]:
        """The text cut before single spaces between two visible characters, where a match always begins."""
        if not text:
            return []
        if Codec._odd(text):
            return self.find(text)  # a match found again by itself is one match
        first, *rest = text.split(" ")
        return [first, *[" " + r for r in rest]]

    def decode(self, ids: np.ndarray) -> bytes:
        lens = self.lengths[ids]
        ends = np.cumsum(lens)
        total = int(ends[-1]) if len(ends) else 0
        return self.letters[np.repeat(self.starts[ids] - ends + lens, lens) + np.arange(total)].tobytes()


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ids array<int>. ``path`` is where each worker finds the vocabulary."""
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for b in batches:
            flat, starts = own.encode([t or "" for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(flat))], ["id", "ids"])

    schema = T.StructType([T.StructField("id", kind), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema).select(F.col("id").alias(id_col), "ids")


def decode(ids: str | Column, path: str, pattern: str) -> Column:
    """The bytes that an array of ids stands for."""
    @F.pandas_udf(T.BinaryType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(path, pattern)
        for s in batches:
            yield pd.Series([own.decode(np.asarray(x, np.int64)) for x in s], dtype=object)

    return run(F.col(ids) if isinstance(ids, str) else ids)


def joined_ids(ids: str) -> Column:
    """Decimal ids joined by one space."""
    return F.array_join(F.col(ids).cast("array<string>"), " ")
