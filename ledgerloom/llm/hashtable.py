"""An open-addressing hash table in numpy arrays."""
from __future__ import annotations

import numpy as np


class HashTable:
    """Values of distinct keys (at least 0) of 64 bits, looked up in bulk."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing):
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 2))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, missing, values.dtype)
        self.missing = missing
        slots = self._slots(keys)
        todo = np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[slots[todo]] < 0]
            self.keys[slots[free]] = keys[free]  # the last writer of a slot keeps it
            won = self.keys[slots[todo]] == keys[todo]
            self.values[slots[todo[won]]] = values[todo[won]]
            todo = todo[~won]
            slots[todo] = (slots[todo] + 1) & (len(self.keys) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values of ``keys``; ``missing`` for keys that are not there and for keys below 0."""
        slots = self._slots(keys)
        found = self.keys[slots]
        hit = (found == keys) & (keys >= 0)
        out = np.where(hit, self.values[slots], self.missing)
        open_ = np.flatnonzero(~hit & (found >= 0) & (keys >= 0))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & (len(self.keys) - 1)
            found = self.keys[slots[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[slots[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out
