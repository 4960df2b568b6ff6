"""Hashed character n-grams of whole texts, in numpy."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Characters worked on at a time; longer texts go in overlapping pieces.
STEP = 1 << 19
_MIX = np.uint32(0x9E3779B1)


def _groups(texts: list[str], overlap: int, step: int) -> Iterator[list[tuple[int, str, bool]]]:
    """Pieces (text number, characters, whether the text ends here) of about ``step`` characters together."""
    group, size = [], 0
    for i, t in enumerate(texts):
        for at in range(0, len(t), step):
            last = at + step >= len(t)
            piece = t[at:] if last else t[at:at + step + overlap]
            group.append((i, piece, last))
            size += len(piece)
            if size >= step:
                yield group
                group, size = [], 0
    if group:
        yield group


def grams(texts: list[str], orders: tuple[int, ...], bits: int, step: int = STEP) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For pieces of ``texts`` and each order: (buckets, text number, number of grams), the grams of a piece
    together and in order. Every n-gram of every text comes once; pieces without any are left out."""
    for group in _groups(texts, max(orders) - 1, step):
        codes = np.frombuffer("".join(p for _, p, _ in group).encode("utf-32-le", "surrogatepass"), np.uint32)
        lens = np.array([len(p) for _, p, _ in group], np.int64)
        begin = np.cumsum(lens) - lens
        number, last = np.array([i for i, _, _ in group]), np.array([e for _, _, e in group])
        for n in orders:
            if len(codes) < n:
                continue
            h = np.full(len(codes) - n + 1, n, np.uint32)
            for k in range(n):
                h = (h ^ codes[k:len(codes) - n + 1 + k]) * _MIX
                h ^= h >> np.uint32(15)
            h = (h * _MIX) >> np.uint32(32 - bits)
            count = np.where(last, np.maximum(lens - n + 1, 0), step)
            some = count > 0
            at = np.repeat(begin[some] - (np.cumsum(count[some]) - count[some]), count[some]) + np.arange(count.sum())
            yield h[at], number[some], count[some]
