"""Periodic runs of words by string synchronising sets.

A run is a stretch of consecutive words with smallest period q and at least
``max(MIN_LENGTH, EXPONENT * q)`` words that no neighbouring word extends. The
words of many texts lie in one array, numbered per text, so that nothing matches
across texts, and all steps are vectorised.

1. Names. Contexts of 1, 2, 4, 8, ... words get a number each, equal if and only if the
   contexts are equal (pairs of names of half the length are named by sorting). A
   context that does not recur in its text gets no name and none of the contexts
   around it does, so that ordinary prose leaves the work after a few lengths.
2. Small periods. Periods below ``FIRST`` are read off directly: stretches where each
   word equals the one q places on.
3. Synchronising sets. At the scale t (a power of two) serve periods t to 2t - 1. A place
   is selected if the least hash of the t-word contexts that begin 0 to t places on is
   that of the first or the last of them. Contexts of period t/4 or less have no
   hash: these highly periodic regions are the longer runs of smaller scales, already
   found, which supply those periods. The choice depends on 2t words only, so a
   run of period q repeats its selected places every q words, and it holds at least one.
4. Proposals. Neighbouring selected places of one 2t-word context, t to 2t - 1 places
   apart, propose that distance as a period. It is the smallest one of their stretch,
   as any smaller one would repeat the context in between.
5. Extents. Each proposal is extended to both sides by comparing names of halving length.

A run of period q and 4q words or more holds a selected place and its repeat, both with
their whole contexts, and a region without selected places would have a period that
divides q; so every run is proposed, at the scale t <= q < 2t.

Cost: names sort the places whose context recurs, once per length; a text's arrays hold four
bytes a word and length. Every text is a row, worked on whole in one task, with others up
to ``CHUNK_WORDS`` words.

Defined results: a null or empty text, or one of white space only, has no words, no runs
and collapses to an empty text. Runs are ordered by start, then period. Rows that repeat
give the same result each; ids are not looked at. Bytes that are no UTF-8 are words
like others and are replaced in the collapsed text. Only the text column is read;
``find`` keeps all other columns and moves none, whatever their names are.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import text_bytes

MIN_LENGTH, EXPONENT = 6, 4
#: Periods below it are found directly, the others by synchronising sets.
FIRST = 4
#: Words of the texts that are worked on together; a longer text is worked on by itself.
CHUNK_WORDS = 1_000_000
FAR = np.uint64(2**64 - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A hash of each number."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the stretches of set flags."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return edge[::2], edge[1::2]


def names(words: np.ndarray) -> list[np.ndarray]:
    """For contexts of 1, 2, 4, ... words the name of each that recurs, -1 for the others; ``words`` are ids no two texts share."""
    levels, n = [words], len(words)
    while True:
        half, step = levels[-1], 1 << len(levels) - 1
        at = np.flatnonzero((half[:n - step] >= 0) & (half[step:] >= 0)) if n > step else np.zeros(0, np.int64)
        keys = (half[at].astype(np.int64) << 32) | half[at + step]
        order = np.argsort(keys, kind="stable")
        fresh = np.diff(keys[order], prepend=-1) != 0
        group = np.cumsum(fresh) - 1
        again = (np.bincount(group) > 1)[group] if len(group) else np.zeros(0, bool)
        if not again.any():
            return levels
        level = np.full(n, -1, np.int32)
        level[at[order[again]]] = group[again]
        levels.append(level)


def _same_right(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words from a on equal those from b on."""
    n, out = len(levels[0]), np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        level = levels[k]
        x, y = np.minimum(a + out, n - 1), np.minimum(b + out, n - 1)
        out[(b + out < n) & (level[x] >= 0) & (level[x] == level[y])] += 1 << k
    return out


def _same_left(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words before a equal those before b."""
    out = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        level = levels[k]
        x, y = a - out - (1 << k), b - out - (1 << k)
        out[(x >= 0) & (level[np.maximum(x, 0)] >= 0) & (level[np.maximum(x, 0)] == level[np.maximum(y, 0)])] += 1 << k
    return out


def _small(words: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of the periods below ``FIRST`` with ``EXPONENT`` periods or more."""
    out, one = [], words[1:] == words[:-1]
    for q in range(1, FIRST):
        a, z = _stretches(words[q:] == words[:-q])
        length = z - a + q
        keep = length >= EXPONENT * q
        a, length = a[keep], length[keep]
        if q > 1:  # a smaller period divides 2 or 3, so it is 1
            within = np.concatenate([[0], np.cumsum(one)])
            fresh = within[a + q - 1] - within[a] < q - 1
            a, length = a[fresh], length[fresh]
        out.append(np.stack([a, length, np.full(len(a), q)], 1))
    return np.concatenate(out)


def _selected(level: np.ndarray, level2: np.ndarray, t: int, periodic: np.ndarray) -> np.ndarray:
    """The synchronising set at scale t, as far as its 2t-word contexts recur: places in rising order."""
    n, places = len(level), np.flatnonzero(level2 >= 0)
    cover = np.zeros(n + t + 2, np.int32)
    np.add.at(cover, places, 1)
    np.add.at(cover, places + t + 1, -1)
    held = np.flatnonzero(np.cumsum(cover)[:n] > 0)  # contexts 0 to t places on, in whole stretches
    hashed = np.where(periodic[held], FAR, _mixed(level[held]))
    least, width = hashed, 1
    while width < t + 1:
        step = min(width, t + 1 - width)
        least = np.minimum(least, np.concatenate([least[step:], np.full(min(step, len(least)), FAR)])[:len(least)])
        width += step
    own = np.searchsorted(held, places)
    m = least[own]
    return places[(m != FAR) & ((m == hashed[own]) | (m == hashed[own + t]))]


def _regions(found: np.ndarray, t: int, n: int) -> np.ndarray:
    """Places whose t-word context has a period of t/4 or less: inside the runs of such periods."""
    deep = found[(found[:, 2] * 4 <= t) & (found[:, 1] >= t)]
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, deep[:, 0], 1)
    np.add.at(edge, deep[:, 0] + deep[:, 1] - t + 1, -1)
    return np.cumsum(edge)[:n] > 0


def runs(words: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and period."""
    words = np.asarray(words, np.int32)
    if len(words) < MIN_LENGTH:
        return np.zeros((0, 3), np.int64)
    found, levels = _small(words), names(words)
    for k in range(FIRST.bit_length() - 1, len(levels) - 1):
        t, n = 1 << k, len(words)
        at = _selected(levels[k], levels[k + 1], t, _regions(found, t, n))
        name = levels[k + 1][at]
        order = np.argsort(name, kind="stable")
        a, b = at[order[:-1]], at[order[1:]]
        near = (name[order[:-1]] == name[order[1:]]) & (b - a >= t) & (b - a < 2 * t)
        a, b = a[near], b[near]
        left, right = _same_left(levels, a, b), _same_right(levels, a, b)
        new = np.stack([a - left, left + right + (b - a), b - a], 1)
        found = np.concatenate([found, np.unique(new[new[:, 1] >= EXPONENT * new[:, 2]], axis=0)])
    found = found[found[:, 1] >= MIN_LENGTH]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _numbered(texts: list[list[bytes]]) -> np.ndarray:
    """Ids of the words of all texts, no two texts sharing one."""
    flat = list(chain.from_iterable(texts))
    known = dict(zip(dict.fromkeys(flat), range(len(flat))))
    ids = np.fromiter(map(known.__getitem__, flat), np.int64, len(flat))
    keys = np.repeat(np.arange(len(texts)), [len(t) for t in texts]) * max(1, len(known)) + ids
    order = np.argsort(keys, kind="stable")
    out = np.empty(len(keys), np.int32)
    out[order] = np.cumsum(np.diff(keys[order], prepend=-1) != 0) - 1
    return out


def _chunks(texts: list[list[bytes]]) -> Iterator[list[list[bytes]]]:
    part, size = [], 0
    for t in texts:
        if part and size + len(t) > CHUNK_WORDS:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


def _described(texts: list[list[bytes]]) -> Iterator[tuple]:
    """(n_words, runs, collapsed) of each text."""
    found = runs(_numbered(texts))
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    edge = np.zeros(begins[-1] + 1, np.int32)
    np.add.at(edge, found[:, 0] + found[:, 2], 1)
    np.add.at(edge, found[:, 0] + found[:, 1], -1)
    kept = np.cumsum(edge)[:-1] == 0
    cuts = np.searchsorted(found[:, 0], begins)
    for i, words in enumerate(texts):
        own = found[cuts[i]:cuts[i + 1]]
        if len(own):
            own = own - [begins[i], 0, 0]
            words = [w for w, k in zip(words, kept[begins[i]:begins[i + 1]].tolist()) if k]
        yield int(sizes[i]), own.tolist(), b" ".join(words)


RUN = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])
FOUND = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)),
                      T.StructField("collapsed", T.StringType())])


@F.pandas_udf(FOUND)
def _find(texts: pd.Series) -> pd.DataFrame:
    out = []
    for part in _chunks([t.split() for t in texts]):
        for n, own, rest in _described(part):
            out.append((n, [dict(zip(RUN.names, r)) for r in own], rest.decode("utf-8", "replace")))
    return pd.DataFrame(out, columns=FOUND.names)


def periodic_runs(text: str | Column) -> Column:
    """Struct of a text: n_words, runs (array of start, length, period in words), collapsed (the text
    without the words that a run repeats, joined by one space)."""
    return _find(text_bytes(text))


def find(docs: DataFrame, text_col: str = "text", into: str = "_runs") -> DataFrame:
    """``docs`` with the struct column ``into`` of ``periodic_runs``."""
    return docs.withColumn(into, periodic_runs(text_col))


def longest(runs_: Column) -> Column:
    """The run of greatest length, then least start, then least period; null if there is none."""
    def better(best, run):
        return F.when(best.isNull() | (run["length"] > best["length"]), run).otherwise(best)  # in order of start and period
    return F.aggregate(runs_, F.lit(None).cast(RUN), better)
