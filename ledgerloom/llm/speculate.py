"""BPE encoding by speculation: greedy longest match, pair checks, exact merging where they fail.

A text is split into words as the tokenizer file says. For the distinct new words of a batch

1. greedy longest match proposes tokens: a walk in the trie of all tokens, from every
   byte at once, finds the longest token there, and words hop from token to token;
2. every adjacent pair of proposed tokens is checked, each distinct pair once: two tokens
   are compatible if merging their bytes together gives the two tokens again. The check
   goes back in time: of the two pieces that touch at the border, the one merged later
   is taken apart, and no two pieces that touch may merge while both exist;
3. a word whose pairs are all compatible is done, as merges that stay within tokens never
   meet; a word with an incompatible pair is merged exactly, by rank.

The check needs every token to come from one merge, of tokens that were merged before it. A
file without that property is found when it is read, and all its words are merged exactly.

Control tokens of the file, such as ``<|endoftext|>``, are recognised in a text as the library does
by default: they stand for their id and words end there. Characters without a
category in this Python may have one in the library, so texts that hold any are
split into words by the library itself.

Defined results: a null or empty text has no ids. Texts of any length are encoded whole.
Rows that repeat give the same result each. Bytes that are no UTF-8 count as
replacement characters. Ids that the file lacks decode to nothing. Only the id and text
columns are read, so other columns cannot clash.
"""
from __future__ import annotations

import heapq
import json
import sys
import unicodedata
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F, types as T
from tokenizers import pre_tokenizers

from .common import text_bytes
from .hashtable import HashTable

#: Words of the byte-level scheme.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Distinct words and runs of words a worker remembers; beyond it the memory starts anew.
REMEMBERED = 600_000
#: Words longer than that are merged each by itself, with a heap.
HEAP_FROM = 64
NEVER = 2**31 - 1


def letters() -> dict[str, int]:
    """The byte each letter of a byte-level file stands for: visible Latin-1 letters for themselves, those from U+0100 on for the other bytes."""
    visible = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = sorted(set(range(256)).difference(visible))
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def unassigned() -> np.ndarray:
    """Whether each character lacks a category."""
    return np.array([unicodedata.category(chr(c)) == "Cn" for c in range(sys.maxunicode + 1)])


class Speculator:
    """Encoder and decoder of one tokenizer file of byte-level BPE."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        split, model, added = file["pre_tokenizer"] or {}, file["model"], file["added_tokens"]
        plain = model.get("continuing_subword_prefix") or model.get("end_of_word_suffix") or model.get("ignore_merges")
        if (file["normalizer"] or split.get("type") != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"]
                or model["type"] != "BPE" or plain or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added)):
            raise ValueError(f"{path} is no plain byte-level BPE file")
        self.split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self.find = regex.compile(PATTERN).findall
        self.unassigned = unassigned()
        self.control = {t["content"]: t["id"] for t in added}
        self.controls = regex.compile("(" + "|".join(map(regex.escape, sorted(self.control, key=len, reverse=True))) + ")").split
        byte = letters()
        spelled = {i: bytes(byte[c] for c in w) for w, i in model["vocab"].items()}
        self._merges([m if isinstance(m, list) else m.split(" ") for m in model["merges"]], model["vocab"], spelled)
        self._trie(spelled)
        spelled |= {i: w.encode() for w, i in self.control.items()}
        top = max(spelled, default=-1) + 1
        self.lengths = np.array([len(spelled.get(i, b"")) for i in range(top)], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.spelled = np.frombuffer(b"".join(spelled.get(i, b"") for i in range(top)), np.uint8)
        self._forget()

    def _merges(self, merges: list[list[str]], vocab: dict[str, int], spelled: dict[int, bytes]) -> None:
        """``birth`` of each token (the rank of its merge, -1 for bytes), its two parts, and the rank of each pair."""
        top = max(vocab.values(), default=-1) + 1
        self.birth, self.left, self.right = np.full(top, -1, np.int32), np.full(top, -1, np.int32), np.full(top, -1, np.int32)
        self.made = [0] * len(merges)
        pairs, self.settled = np.zeros((len(merges), 2), np.int64), True
        for rank, (a, b) in enumerate(merges):
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            self.settled &= self.birth[z] < 0 and len(spelled[z]) > 1
            pairs[rank], self.made[rank], self.birth[z], self.left[z], self.right[z] = (x, y), z, rank, x, y
        single = {s[0]: i for i, s in spelled.items() if len(s) == 1}
        if len(single) < 256:
            raise ValueError("the file lacks tokens for some bytes")
        self.single = [single[b] for b in range(256)]
        merged = np.array([i for i, s in spelled.items() if len(s) > 1], np.int64)
        self.settled &= bool((self.birth[merged] >= 0).all()) and bool(
            (np.maximum(self.birth[pairs[:, 0]], self.birth[pairs[:, 1]]) < np.arange(len(merges))).all())
        self.pairs = HashTable(pairs[:, 0] << 32 | pairs[:, 1], np.arange(len(merges), dtype=np.int32), np.int32(NEVER))
        self.rank_of = dict(zip(map(tuple, pairs.tolist()), range(len(merges))))

    def _trie(self, spelled: dict[int, bytes]) -> None:
        """Trie nodes are numbered; ``steps`` leads from node and byte to node, ``token`` is the node's token or -1."""
        nodes = {b"": 0}
        for w in spelled.values():
            for k in range(1, len(w) + 1):
                nodes.setdefault(w[:k], len(nodes))
        self.token = np.full(len(nodes), -1, np.int32)
        for i, w in spelled.items():
            self.token[nodes[w]] = i
        keys = np.array([nodes[w[:-1]] << 8 | w[-1] for w in nodes if w], np.int64)
        self.steps = HashTable(keys, np.array([n for w, n in nodes.items() if w], np.int64), -1)

    def _forget(self) -> None:
        """Start the memory anew: ``known`` numbers words and runs of words, their ids lie one after the other in ``flat``."""
        self.known: dict[str, int] = {}
        self.begin, self.flat = np.zeros(1, np.int64), np.zeros(0, np.int32)
        self._remember(list(self.control), np.array(list(self.control.values()), np.int32), [1] * len(self.control))

    def _remember(self, runs: list[str], ids: np.ndarray, sizes) -> None:
        self.known.update(zip(runs, range(len(self.known), len(self.known) + len(runs))))
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(sizes, dtype=np.int64)])
        self.flat = np.concatenate([self.flat, ids])

    def propose(self, words: list[bytes]) -> list[list[int]]:
        """Tokens of each word by greedy longest match."""
        text = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        stop = np.repeat(ends, np.diff(ends, prepend=0))
        best, longest = np.array(self.single, np.int32)[text], np.ones(len(text), np.int64)
        at, node, depth = np.arange(len(text)), np.zeros(len(text), np.int64), 0
        while len(at):
            node = self.steps.get(node << 8 | text[at + depth])
            depth += 1
            at, node = at[node >= 0], node[node >= 0]
            token = self.token[node]
            whole = token >= 0
            best[at[whole]], longest[at[whole]] = token[whole], depth
            more = at + depth < stop[at]
            at, node = at[more], node[more]
        best, after, out, i = best.tolist(), (np.arange(len(text)) + longest).tolist(), [], 0
        for end in ends.tolist():
            tokens = []
            while i < end:
                tokens.append(best[i])
                i = after[i]
            out.append(tokens)
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether tokens a and b stay apart when the bytes of both are merged together.

        x ends at the border and y begins there. x exists from its birth until the merge that
        takes it in (``x_dies``), in which it has the left neighbour and so goes first
        in a tie; y likewise, but there the pair across the border goes first.
        """
        good, left = np.ones(len(a), bool), np.arange(len(a))
        x, y = a.astype(np.int64), b.astype(np.int64)
        x_dies, y_dies = np.full(len(a), NEVER, np.int32), np.full(len(a), NEVER, np.int32)
        while len(left):
            rank = self.pairs.get(x << 32 | y)
            meet = (rank != NEVER) & (rank < x_dies) & (rank <= y_dies)
            good[left[meet]] = False
            born_x, born_y = self.birth[x], self.birth[y]
            on = ~meet & ((born_x >= 0) | (born_y >= 0))
            left, x, y, x_dies, y_dies, born_x, born_y = (v[on] for v in (left, x, y, x_dies, y_dies, born_x, born_y))
            undo_x = born_x > born_y
            x_dies, y_dies = np.where(undo_x, born_x, x_dies), np.where(undo_x, y_dies, born_y)
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
        return good

    def merge(self, words: list[bytes]) -> list[list[int]]:
        """Tokens of each word by merging its least-ranked pair, the leftmost of equals, until there is none.

        The tokens of all words lie in one array; a round merges one pair in every word that still has one.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        out: list[list[int]] = [[]] * len(words)
        for i in np.flatnonzero(sizes > HEAP_FROM).tolist():
            out[i] = self._merge_long([self.single[b] for b in words[i]])
        word = np.flatnonzero((sizes > 0) & (sizes <= HEAP_FROM))
        sizes, made = sizes[word], np.array(self.made, np.int64)
        ids = np.array(self.single, np.int64)[np.frombuffer(b"".join([words[i] for i in word]), np.uint8)]
        ranks = self.pairs.get(ids << 32 | np.append(ids[1:], 0))
        ranks[np.cumsum(sizes) - 1] = NEVER
        while len(word):
            begins = np.cumsum(sizes) - sizes
            best = np.minimum.reduceat(ranks, begins)
            done = best == NEVER
            if done.any():
                for i, a, n in zip(word[done].tolist(), begins[done].tolist(), sizes[done].tolist()):
                    out[i] = ids[a:a + n].tolist()
                cells = np.repeat(~done, sizes)
                ids, ranks, word, sizes, best = ids[cells], ranks[cells], word[~done], sizes[~done], best[~done]
                continue
            at = np.flatnonzero(ranks == np.repeat(best, sizes))
            row = np.searchsorted(begins, at, "right") - 1
            at = at[np.diff(row, prepend=-1) != 0]  # the first of each word
            ids[at] = made[best]
            ranks[at] = ranks[at + 1]  # stays NEVER at a word's end
            cells = np.ones(len(ids), bool)
            cells[at + 1] = False
            ids, ranks, sizes, at = ids[cells], ranks[cells], sizes - 1, at - np.arange(len(at))
            ends = np.cumsum(sizes)
            right, left = at[at + 1 < ends], at[at > ends - sizes]
            ranks[right] = self.pairs.get(ids[right] << 32 | ids[right + 1])
            ranks[left - 1] = self.pairs.get(ids[left - 1] << 32 | ids[left])
        return out

    def _merge_long(self, ids: list[int]) -> list[int]:
        """Tokens of one long word, with a heap of pairs and a linked list."""
        n, rank_of, made = len(ids), self.rank_of, self.made
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank_of.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # one of the two has been merged since
            ids[i], ids[j] = made[rank], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank_of.get((ids[i], ids[k]))) is not None:
                    heapq.heappush(heap, (r, i, ids[i], ids[k]))
            h = before[i]
            if h >= 0 and (r := rank_of.get((ids[h], ids[i]))) is not None:
                heapq.heappush(heap, (r, h, ids[h], ids[i]))
        return [x for x in ids if x >= 0]

    def tokens(self, words: list[bytes]) -> list[list[int]]:
        """Tokens of each word: proposed, checked, and merged exactly where the check fails."""
        if not self.settled:
            return self.merge(words)
        found = self.propose(words)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.int64, int(sizes.sum()))
        word = np.repeat(np.arange(len(found)), sizes)
        inner = np.flatnonzero(word[1:] == word[:-1])
        pairs, place = np.unique(flat[inner] << 32 | flat[inner + 1], return_inverse=True)
        bad = ~self.compatible(pairs >> 32, pairs & 0xFFFFFFFF)
        failing = np.unique(word[inner[bad[place]]]).tolist()
        for i, ids in zip(failing, self.merge([words[i] for i in failing])):
            found[i] = ids
        return found

    _loose = regex.compile(r" \s|\s |^\s|\s$").search

    def _doubtful(self, text: str) -> bool:
        return not text.isascii() and bool(self.unassigned[np.frombuffer(text.encode("utf-32-le"), np.uint32)].any())

    def _words(self, text: str) -> list[str]:
        if self._doubtful(text):
            return [text[a:z] for _, (a, z) in self.split.pre_tokenize_str(text)]
        return self.find(text)

    def _cut(self, text: str) -> list[str]:
        """A text without control tokens, cut where words begin in any case: before single spaces between visible characters."""
        if Speculator._loose(text) or self._doubtful(text):
            return self._words(text)  # a word found again by itself is one word
        first, *rest = text.split(" ")
        return [first, *[" " + r for r in rest]]

    def runs(self, text: str) -> list[str]:
        if any(c in text for c in self.control):
            return [r for part in self.controls(text) if part for r in ([part] if part in self.control else self._cut(part))]
        return self._cut(text) if text else []

    def _places(self, runs: list[str]) -> np.ndarray:
        return np.fromiter(map(self.known.get, runs, repeat(-1)), np.int64, len(runs))

    def _ids(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the remembered runs at these places, one after the other, and where each one's begin."""
        sizes = self.begin[at + 1] - self.begin[at]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return self.flat[np.repeat(self.begin[at] - ends[:-1], sizes) + np.arange(ends[-1])], ends

    def _learn(self, runs: list[str]) -> None:
        cut = self._words if self._doubtful("".join(runs)) else self.find
        split = [[r] if r.isascii() and r[r[0] == " ":].isalpha() else cut(r) for r in runs]
        words = list(chain.from_iterable(split))
        new = list(set(words).difference(self.known))
        if new:
            ids = self.tokens([w.encode("utf-8") for w in new])
            self._remember(new, np.fromiter(chain.from_iterable(ids), np.int32), [len(x) for x in ids])
        joined = [(r, len(ws)) for r, ws in zip(runs, split) if len(ws) != 1]
        if joined:
            flat, ends = self._ids(self._places([w for ws in split if len(ws) != 1 for w in ws]))
            cuts = ends[np.concatenate([[0], np.cumsum([n for _, n in joined])])]
            self._remember([r for r, _ in joined], flat, np.diff(cuts))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's begin."""
        if len(self.known) > REMEMBERED:
            self._forget()
        split = [self.runs(t) for t in texts]
        runs = list(chain.from_iterable(split))
        at = self._places(runs)
        new = np.flatnonzero(at < 0)
        if len(new):
            missing = [runs[i] for i in new.tolist()]
            self._learn(list(dict.fromkeys(missing)))
            at[new] = self._places(missing)
        flat, ends = self._ids(at)
        return flat, ends[np.concatenate([[0], np.cumsum([len(r) for r in split], dtype=np.int64)])]

    def decode(self, ids) -> str:
        ids = np.asarray(ids, np.int64)
        ids = ids[(ids >= 0) & (ids < len(self.lengths))]
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[ids] - ends + sizes, sizes) + np.arange(int(ends[-1]) if len(ends) else 0)
        return self.spelled[at].tobytes().decode("utf-8", "replace")


_HELD: dict[str, Speculator] = {}


def speculator(path: str) -> Speculator:
    if path not in _HELD:
        _HELD[path] = Speculator(path)
    return _HELD[path]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ids array<int>. ``path`` is where each worker finds the tokenizer file."""
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = speculator(path)
        for b in batches:
            flat, starts = own.encode([t.decode("utf-8", "replace") for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(flat))], ["id", "ids"])

    schema = T.StructType([T.StructField("id", kind), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return (docs.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text")).mapInArrow(run, schema)
            .select(F.col("id").alias(id_col), "ids"))


def decode(ids: str | Column, path: str) -> Column:
    """The text that an array of ids stands for, control tokens included."""
    @F.pandas_udf(T.StringType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = speculator(path)
        for s in batches:
            yield pd.Series([own.decode(x) for x in s], dtype=object)

    return run(F.col(ids) if isinstance(ids, str) else ids)
