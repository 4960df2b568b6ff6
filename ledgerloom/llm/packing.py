"""Packing of tokenised documents into windows of fixed length, best fit decreasing.

Documents are tokenised whole, closed by an end id, and cut into full windows and
one remainder. Pieces are dealt over shards by hash, those that are equal in turn
(equal pieces are counted first and move as one row a shard), and a shard packs its pieces
from long to short, each into the open window with the least room that still
holds it. A segment tree over the room left finds that window in a few steps. Only
the pieces' lengths move between tasks; a shard holds about ``SHARD_PIECES`` of
them at any input size, so the unfilled windows at its end are a negligible share.

Defined results: a null text is empty and consists of the end id; rows that
repeat are packed each; a document without an id is packed like any other.
Sequence ids are unique, and the same for the same pieces. A text that spells one of
the vocabulary's control tokens, such as ``<|endoftext|>``, has that token's id there,
as the library does by default; the spelling must be exact, in lower case.
"""
from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from tokenizers import Tokenizer

from .common import text_bytes, written

CAPACITY = 4_096
SHARD_PIECES = 100_000
#: Distinct words a worker remembers; beyond it the memory starts anew.
REMEMBERED = 1_500_000
#: Marks that a word's end can be split off by: the pre-tokenizer always cuts between them and a letter.
_MARKS = b".,!|$%&#*?;:()"
_ALNUM = frozenset(b"abcdefghijklmnopqrstuvwxyz0123456789")
#: First bytes of U+0300 to U+037F, which hold every mark that composes with a letter of ASCII.
_COMPOSING = b"\xcc", b"\xcd"
#: How the vocabulary's control tokens begin. They are looked for before case is ignored.
_CONTROL = b"<|"


def _folded(text: bytes) -> list[bytes]:
    """Words of a text, in lower case where that leaves the ids as they are."""
    if _CONTROL in text or _COMPOSING[0] in text or _COMPOSING[1] in text:
        return [w.lower() if w.isascii() and _CONTROL not in w else w for w in text.split()]
    return text.lower().split()


class Words:
    """Ids of texts by the library, word by word.

    The tokenizer in use cuts at white space before anything else and ignores
    case, so a text's ids are those of its words, and a word is encoded once.

    It composes marks before it ignores case, and some letters (h, j, t, w, y) have
    composed forms in lower case only. So words with marks keep their case here.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.begin, self.flat = np.zeros(1, np.int64), np.zeros(0, np.int32)

    def _add(self, words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(sizes)])
        self.flat = np.concatenate([self.flat, ids])

    def _places(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def _ids(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words at these places, one after the other, and how many each has."""
        sizes = self.begin[at + 1] - self.begin[at]
        ends = np.cumsum(sizes)
        return self.flat[np.repeat(self.begin[at] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)], sizes

    def _learn(self, words: list[bytes]) -> None:
        plain, whole, stems, marks = set(), [], [], []
        for w in words:
            stem = w.rstrip(_MARKS)
            if len(stem) == len(w) or not stem or stem[-1] not in _ALNUM:
                plain.add(w)
            else:
                whole.append(w)
                stems.append(stem)
                marks.append(w[len(stem):])
        plain = list(plain.union(stems, marks).difference(self.known))
        if plain:
            texts = [w.decode("utf-8", "replace") for w in plain]
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            self._add(plain, np.array(list(chain.from_iterable(found)), np.int32), np.fromiter(map(len, found), np.int64, len(found)))
        if whole:
            pairs = np.stack([self._places(stems), self._places(marks)], axis=1).ravel()
            ids, sizes = self._ids(pairs)
            self._add(whole, ids, sizes.reshape(-1, 2).sum(axis=1))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's begin."""
        if len(self.known) > REMEMBERED:
            self._forget()
        split = [_folded(t) for t in texts]
        words = list(chain.from_iterable(split))
        at = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(at < 0)
        if len(new):
            missing = [words[i] for i in new.tolist()]
            self._learn(list(set(missing)))
            at[new] = self._places(missing)
        flat, sizes = self._ids(at)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return flat, ends[np.concatenate([[0], np.cumsum([len(w) for w in split], dtype=np.int64)])]


_WORDS: dict[str, Words] = {}


def words(path: str) -> Words:
    if path not in _WORDS:
        _WORDS[path] = Words(path)
    return _WORDS[path]


def pieces(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Full windows and the remainder of each document: id, start, length, ids_crc32, doc_tokens and, if asked for, ids."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType)]
                          + [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens")]
                          + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = words(path)
        for b in batches:
            flat, starts = own.encode(b.column(1).to_pylist())
            row, out, ids = [], [], []
            for i, (a, z) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist())):
                doc = np.append(flat[a:z], end_id).astype("<u4")
                for at in range(0, len(doc), capacity):
                    part = doc[at:at + capacity]
                    row.append(i)
                    out.append((at, len(part), zlib.crc32(part.tobytes()), len(doc)))
                    if with_ids:
                        ids.append(part.astype(np.int32))
            if row:
                columns = [pa.array(x, pa.int64()) for x in zip(*out)]
                more = [pa.array(ids, pa.list_(pa.int32()))] if with_ids else []
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), *columns, *more], schema.names)

    return docs.select(F.col(id_col), text_bytes(text_col).alias("_text")).mapInArrow(run, schema)


class Rooms:
    """Open windows by the room left in them; a segment tree over the rooms finds the tightest that fits."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.size)
        self.windows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, window: int, room: int) -> None:
        self.windows[room].append(window)
        self._count(room, 1)

    def _count(self, room: int, by: int) -> None:
        i = room + self.size
        while i:
            self.open[i] += by
            i >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """The window with the least room of at least ``length``, and that room."""
        i, open_ = length + self.size, self.open
        while not open_[i]:
            while i & 1 or not open_[i + 1]:  # up to a left child whose sibling holds something
                i >>= 1
                if i <= 1:
                    return None
            i += 1
        while i < self.size:
            i = 2 * i if open_[2 * i] else 2 * i + 1
        room = i - self.size
        self._count(room, -1)
        return self.windows[room].pop(), room


def best_fit(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(window, offset) of each piece; ``lengths`` run from long to short."""
    rooms, out, windows = Rooms(capacity), [], 0
    for n in lengths:
        found = rooms.take(n)
        if found is None:
            found, windows = (windows, capacity), windows + 1
        window, room = found
        out.append((window, capacity - room))
        if room > n:
            rooms.put(window, room - n)
    return out


def pack(parts: DataFrame, id_col: str = "doc_id", capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``parts`` (id, start, length, ...) with sequence_id and offset."""
    shards = max(1, -(-parts.count() // shard_pieces))
    n, turn = F.col("_n"), F.col("_turn")  # shard after shard gets its share of n equal pieces
    dealt = (parts.groupBy(*parts.columns).agg(F.count(F.lit(1)).alias("_n"))
             .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.least(n, F.lit(shards)) - 1)).alias("_turn"))
             .select(*parts.columns, F.pmod(F.pmod(F.xxhash64(id_col, "start", "ids_crc32"), F.lit(shards)) + turn, F.lit(shards)).alias("_shard"),
                     (F.floor(n / shards) + (turn < n % shards).cast("long")).alias("_copies")))
    schema = T.StructType([*parts.schema.fields, T.StructField("_shard", T.LongType()),
                           T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            shard, copies = rows.column("_shard")[0].as_py(), rows.column("_copies").to_numpy()
            rows = rows.drop_columns("_copies")
            if (copies > 1).any():
                rows = rows.take(pa.array(np.repeat(np.arange(len(copies)), copies)))
            at = np.array(best_fit(rows.column("length").to_pylist(), capacity), np.int64).reshape(-1, 2)
            yield from (rows.append_column("sequence_id", pa.array(at[:, 0] + (shard << 32)))
                        .append_column("offset", pa.array(at[:, 1])).to_batches(10_000))

        for b in batches:
            while b.num_rows:
                first = b.column(b.schema.get_field_index("_shard")).to_numpy(zero_copy_only=False)
                if held and held[0].column("_shard")[0].as_py() != first[0]:
                    yield from done(pa.Table.from_batches(held))
                    held = []
                n = int(np.searchsorted(first, first[0], "right"))
                held.append(b.slice(0, n))
                b = b.slice(n)
        if held:
            yield from done(pa.Table.from_batches(held))

    return (dealt.repartition("_shard").sortWithinPartitions("_shard", F.desc("length"), id_col, "start", "ids_crc32")
            .mapInArrow(run, schema).drop("_shard"))


def packed(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    return pack(written(pieces(docs, path, end_id, id_col, text_col, capacity)), id_col, capacity, shard_pieces)
