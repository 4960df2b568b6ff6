"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions along a tree of 255 nodes, and each node has a
context tree over the bytes before it. With a zeros and b ones seen in a context,
the Krichevsky-Trofimov estimate of their probability is
``Pe = G(a + 1/2) G(b + 1/2) / (pi G(a + b + 1))``, and the weighted probability is
``Pw = Pe / 2 + (product of Pw over the contexts one byte longer) / 2``, at the
greatest depth ``Pw = Pe``. A text's probability is that of its bytes and an end
byte (zero), each given the ``DEPTH`` bytes before (zeros before the start), under
the mixture of all depths' estimates with the weights the training texts leave.

How it runs: documents are dealt to blocks of about ``BLOCK_BYTES`` by hash. Each
block sends its distinct (context, byte) grams and its distinct words, with their
counts in training texts; their totals are the model. Grams are dealt by the last two
context bytes, below which every context tree is complete in one task (2^32 grams
at most at the default depth, in parts of whole contexts); only what lies above, at most 257 x 255 nodes, passes the
driver. Each distinct gram is scored once, scores return to the blocks that asked, and
texts are streamed against their block's table. Texts move between tasks compressed, those
of one block and batch together. Nothing that grows with the corpus
is broadcast or capped, so the model grows with the corpus.

Defined results: a null text is empty; documents whose ``train`` is null are scored
and not learned from; rows that repeat count and are scored each; without training
texts every bit has probability 1/2 and the base score is 0.
"""
from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import text_bytes, written
from .hashtable import HashTable

DEPTH = 5
BLOCK_BYTES = 32 << 20
#: Partitions beyond one for each block, at most, so that few blocks meet in one.
SPARE = 2_000
#: Grams of whole two-byte contexts worked on together in a task.
SHARD_ROWS = 1 << 20
#: Bytes whose grams are worked on together, and grams a block gathers before it adds up equal ones.
STEP, FOLD_ROWS = 1 << 20, 2_000_000
END_WORD = b"\n"  # no word holds white space
_HALF = math.log(0.5)


def _codes(buffers: list[bytes], depth: int) -> np.ndarray:
    """Grams of every byte but the first ``depth`` of each buffer. A gram is the bytes before, the nearest first, then the byte."""
    x = np.frombuffer(b"".join(buffers), np.uint8).astype(np.int64)
    n = len(x) - depth
    codes = np.zeros(n, np.int64)
    for k in range(1, depth + 1):
        codes = codes << 8 | x[depth - k:depth - k + n]
    codes = codes << 8 | x[depth:]
    keep = np.ones(n, bool)
    begin = np.cumsum([len(b) for b in buffers])[:-1]
    for k in range(depth):
        keep[begin - depth + k] = False
    return codes[keep]


def gram_chunks(texts: list[bytes], depth: int, step: int = STEP) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Grams of every byte of every text and of its end, about ``step`` at a time: (grams, text numbers, how many
    grams each of them has here). A text longer than that goes on in the next part."""
    buffers, number, size = [], [], 0

    def part():
        counts = np.array([len(b) - depth for b in buffers], np.int64)
        return _codes(buffers, depth), np.array(number, np.int64), counts

    for i, t in enumerate(texts):
        for at in range(0, len(t) + 1, step):
            before = t[max(0, at - depth):at]
            buffers.append(bytes(depth - len(before)) + before + t[at:at + step] + (b"\0" if at + step > len(t) else b""))
            number.append(i)
            size += len(buffers[-1])
            if size >= step:
                yield part()
                buffers, number, size = [], [], 0
    if buffers:
        yield part()


def gram_codes(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """All grams, text after text, and how many each text has."""
    parts = list(gram_chunks(texts, depth))
    counts = np.zeros(len(texts), np.int64)
    for _, number, n in parts:
        np.add.at(counts, number, n)
    return np.concatenate([c for c, _, _ in parts]) if parts else np.zeros(0, np.int64), counts


def _lgamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for x >= 1/2: Stirling's series at x + 8."""
    y = x + 8
    low = x.copy()
    for k in range(1, 8):  # in place: a shard's nodes are millions
        low *= x + k
    series = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return series - np.log(low)


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _lgamma(a + 0.5) + _lgamma(b + 0.5) - _lgamma(a + b + 1.0) - math.log(math.pi)


def _summed(keys: np.ndarray, *columns: np.ndarray):
    """Distinct keys, sorted, with the sums of the columns."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], *(np.add.reduceat(c[order], first) if len(first) else c[:0] for c in columns)


def _bits(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(context and node, bit) of the eight decisions of each gram, decision by decision."""
    byte, context = codes & 255, codes >> 8 << 8
    nodes = np.concatenate([context | 1 << k | byte >> 8 - k for k in range(8)])
    return nodes, np.concatenate([byte >> 7 - k & 1 for k in range(8)])


class Level:
    """The nodes of one depth: key (context and node), counts, and log probabilities."""

    def __init__(self, keys, zeros, ones, below=None):
        self.keys, self.zeros, self.ones = keys, zeros, ones
        self.own = np.empty(len(keys))
        for at in range(0, len(keys), STEP // 4):  # its many temporary arrays only for a part at a time
            part = slice(at, at + STEP // 4)
            self.own[part] = log_kt(zeros[part], ones[part])
        self.weighted = self.own if below is None else np.logaddexp(_HALF + self.own, _HALF + below)
        # the share of the mixture that stops at this depth
        self.stop = np.ones(len(keys)) if below is None else np.exp(np.minimum(0.0, _HALF + self.own - self.weighted))
        self.one = (ones + 0.5) / (zeros + ones + 1.0)

    def shorter(self) -> tuple[np.ndarray, ...]:
        """(key, zeros, ones, sum of weighted) of the contexts one byte shorter."""
        return _summed(self.keys >> 16 << 8 | self.keys & 255, self.zeros, self.ones, self.weighted)

    def forget(self) -> None:
        """Leave only what ``mix`` needs; a shorter level was summed from the rest."""
        del self.zeros, self.ones, self.own, self.weighted

    def mix(self, done: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Adds this depth's share to what shorter contexts gave: probability of a one so far, and the share still open."""
        return done + left * self.stop * self.one, left * (1 - self.stop)


def levels(codes: np.ndarray, n: np.ndarray, depth: int, least: int = 2) -> list[Level]:
    """Levels ``least`` to ``depth`` of grams that hold every context they extend."""
    seen = n > 0
    nodes, bit = _bits(codes[seen])
    many = np.tile(n[seen].astype(float), 8)
    out = [Level(*_summed(nodes, many * (1 - bit), many * bit))]
    for _ in range(depth - least):
        keys, zeros, ones, below = out[0].shorter()
        out[0].forget()
        out.insert(0, Level(keys, zeros, ones, below))
    return out


def top(keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From the sums of depth 2 by (last byte, node): probability of a one from depths 0 and 1 and the open share, dense by that key."""
    order = np.argsort(keys)
    first = Level(keys[order], zeros[order], ones[order], below[order])
    k, z, o, w = _summed(first.keys & 255, first.zeros, first.ones, first.weighted)
    root = Level(k, z, o, w)
    done, left = np.full(256, 0.5), np.zeros(256)
    done[root.keys], left[root.keys] = root.mix(np.zeros(len(k)), np.ones(len(k)))
    node = np.arange(1 << 16) & 255
    done, left = done[node], left[node]
    new_done, left_1 = done + left / 2, np.zeros(1 << 16)  # a context never seen gives a half
    new_done[first.keys], left_1[first.keys] = first.mix(done[first.keys], left[first.keys])
    return new_done, left_1


def score_grams(codes: np.ndarray, n: np.ndarray, depth: int, done: np.ndarray, left: np.ndarray) -> np.ndarray:
    """log10 probability of each gram's byte in its context, given the depths above."""
    nodes, bit = _bits(codes)
    one = np.zeros(len(nodes))
    at = nodes >> 8 * depth - 8 & 0xFF00 | nodes & 255
    share_done, share_left = done[at], left[at]
    one[:] = share_done + share_left / 2
    alive = np.ones(len(nodes), bool)
    above = None
    for d, level in enumerate(levels(codes, n, depth), 2):
        if not len(level.keys):
            break
        up = level.keys >> 16 << 8 | level.keys & 255
        if above is None:
            own_done, own_left = level.mix(done[up], left[up])
        else:
            place = np.searchsorted(above[0], up)
            own_done, own_left = level.mix(above[1][place], above[2][place])
        above = (level.keys, own_done, own_left)
        want = nodes >> 8 * (depth - d) + 8 << 8 | nodes & 255
        place = np.minimum(np.searchsorted(level.keys, want), len(level.keys) - 1)
        alive &= level.keys[place] == want
        one[alive] = own_done[place[alive]] + own_left[place[alive]] / 2
    return np.log10(np.where(bit == 1, one, 1 - one)).reshape(8, -1).sum(axis=0)


def _shards(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted rows (gram, n) in parts that hold two-byte contexts whole."""
    held, rows = [], 0
    for b in batches:
        part = np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns])
        if not part.shape[1]:
            continue
        held.append(part)
        rows += part.shape[1]
        if rows >= SHARD_ROWS:
            all_ = np.concatenate(held, axis=1)
            context = all_[0] >> 8 * (depth - 1)
            cut = int(np.searchsorted(context, context[-1]))
            if cut:
                yield all_[0, :cut], all_[1, :cut]
            held, rows = [all_[:, cut:]], all_.shape[1] - cut
    if held:
        all_ = np.concatenate(held, axis=1)
        if all_.shape[1]:
            yield all_[0], all_[1]


def gram_scores(grams: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(gram, logp) of each distinct gram of ``grams`` (gram, n: its count in training texts, 0 if only asked for)."""
    dealt = grams.repartition(F.shiftright("gram", 8 * (depth - 1))).sortWithinPartitions("gram")

    def lower(batches):
        for codes, n in _shards(batches, depth):
            level = levels(codes, n, depth)[0]
            if len(level.keys):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in level.shorter()], ["key", "zeros", "ones", "below"])

    parts = (dealt.mapInArrow(lower, "key long, zeros double, ones double, below double")
             .groupBy("key").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "below")]))
    sums = parts.toPandas()  # at most 256 x 255 rows
    shipped = grams.sparkSession.sparkContext.broadcast(top(sums["key"].to_numpy(np.int64), *(
        sums[c].to_numpy(float) for c in ("zeros", "ones", "below"))))

    def score(batches):
        for codes, n in _shards(batches, depth):
            yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(score_grams(codes, n, depth, *shipped.value))], ["gram", "logp"])

    return dealt.mapInArrow(score, "gram long, logp double")


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, train, id, text) to one row for each block in a batch, which holds the block's rows compressed."""
    squeeze = zstandard.ZstdCompressor(level=3)
    for b in batches:
        blocks = b.column(0).to_numpy(zero_copy_only=False)
        order = np.argsort(blocks, kind="stable")
        rows = b.take(pa.array(order)).select(["train", "id", "text"])
        cuts = np.flatnonzero(np.diff(blocks[order], prepend=-1) != 0)
        frames = []
        for at, n in zip(cuts.tolist(), np.diff(np.append(cuts, len(order))).tolist()):
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, rows.schema) as w:
                w.write_batch(rows.slice(at, n))
            frames.append(squeeze.compress(out.getvalue()))
        yield pa.RecordBatch.from_arrays([pa.array(blocks[order][cuts], pa.int64()), pa.array(frames, pa.binary())], ["block", "frame"])


def _rows(frame: bytes) -> pa.Table:
    """The rows (train, id, text) of a frame."""
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(frame)).read_all()


def _items(depth: int):
    """Rows (block, frame) sorted by block: each block's distinct grams and words and their training counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, grams, words = None, [], Counter()
        held, size = {True: [], False: []}, 0

        def count():
            nonlocal size
            for chosen, own in held.items():
                for codes, _, _ in gram_chunks(own, depth):
                    codes, n = np.unique(codes, return_counts=True)
                    grams.append((codes, n if chosen else np.zeros(len(codes), np.int64)))
                    if sum(len(g) for g, _ in grams) > FOLD_ROWS:
                        fold()
                for t in own:
                    if chosen:
                        words.update(t.lower().split())
                    else:
                        words.update(dict.fromkeys(t.lower().split(), 0))
                words[END_WORD] += len(own) if chosen else 0
                own.clear()
            size = 0

        def fold():
            codes, n = _summed(np.concatenate([g for g, _ in grams]), np.concatenate([n for _, n in grams]))
            grams[:] = [(codes, n)]

        def done():
            count()
            fold()
            codes, n = grams[0]
            for at in range(0, len(codes), 50_000):
                c = codes[at:at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(c), pa.int64()), pa.array(c), pa.nulls(len(c), pa.binary()), pa.array(n[at:at + 50_000])],
                    ["block", "gram", "word", "n"])
            names, counts = list(words), list(words.values())
            for at in range(0, len(names), 50_000):
                w = names[at:at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(w), pa.int64()), pa.array([-1] * len(w), pa.int64()), pa.array(w, pa.binary()),
                     pa.array(counts[at:at + 50_000], pa.int64())], ["block", "gram", "word", "n"])

        for b in batches:
            blocks = b.column(0).to_numpy(zero_copy_only=False)
            for at in np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1]])).tolist() if len(blocks) else []:
                if blocks[at] != block:
                    if block is not None:
                        yield from done()
                    block, grams, words = int(blocks[at]), [], Counter()
                part = b.slice(at, int(np.searchsorted(blocks, blocks[at], "right")) - at)
                for frame in part.column(1).to_pylist():
                    for chosen, _, t in zip(*(c.to_pylist() for c in _rows(frame).columns)):
                        held[chosen].append(t)
                        size += len(t)
                    if size >= 4 * STEP:
                        count()
        if block is not None:
            yield from done()
    return run


def _score(depth: int, train_tokens: int, distinct: int):
    """Rows (block, kind, gram, word, value, frame) sorted by block and kind: a block's values, then its documents."""
    scale = math.log10(train_tokens + 0.5 * (distinct + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, grams, logp, counts, table = None, [], [], {}, None
        for b in batches:
            keys = np.stack([b.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)])
            cuts = np.flatnonzero(np.concatenate([[True], (np.diff(keys, axis=1) != 0).any(axis=0)])) if b.num_rows else []
            for at, end in zip(cuts, [*cuts[1:], b.num_rows]):
                part = b.slice(int(at), int(end) - int(at))
                if keys[0, at] != block:
                    block, grams, logp, counts, table = keys[0, at], [], [], {}, None
                if keys[1, at] == 0:
                    grams.append(part.column(2).to_numpy(zero_copy_only=False))
                    logp.append(part.column(4).to_numpy(zero_copy_only=False))
                    continue
                if keys[1, at] == 1:
                    counts.update(zip(part.column(3).to_pylist(), part.column(4).to_pylist()))
                    continue
                if table is None:
                    codes, values = np.concatenate(grams), np.concatenate(logp)
                    grams, logp = [], []  # held twice otherwise, and beside the table while documents are scored
                    table = HashTable(codes, values, np.nan)
                    del codes, values
                for frame in part.column(5).to_pylist():
                    own = _rows(frame)
                    texts = own.column("text").to_pylist()
                    total = np.zeros(len(texts))
                    for codes, number, n in gram_chunks(texts, depth):
                        np.add.at(total, number, np.add.reduceat(table.get(codes), np.cumsum(n) - n))
                    n = np.array([len(t) + 1 for t in texts])
                    split = [[*t.lower().split(), END_WORD] for t in texts]
                    sizes = np.array([len(w) for w in split])
                    c = np.fromiter((counts[w] for words in split for w in words), np.float64, int(sizes.sum()))
                    begin = np.cumsum(sizes) - sizes
                    base = np.add.reduceat(np.log10(c + 0.5) - scale, begin)
                    known = np.add.reduceat((c > 0).astype(np.int64), begin)
                    yield pa.RecordBatch.from_arrays(
                        [own.column("id").combine_chunks(), pa.array(sizes, pa.int64()), pa.array(known), pa.array([train_tokens] * len(texts), pa.int64()),
                         pa.array(base), pa.array(total), pa.array(-total / math.log10(2) / n)],
                        ["id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"])
    return run


def score(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: id, n_tokens, n_known, train_tokens, base_score (unigram words), score (log10 probability), bits_per_byte."""
    if not 2 <= depth <= 6:
        raise ValueError("depth is 2 to 6 bytes")
    own = docs.select(F.col(id_col).alias("id"), F.coalesce(train, F.lit(False)).alias("train"), text_bytes(text_col).alias("text"))
    total = own.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    own = own.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))
    ways = blocks + min(3 * blocks, SPARE)
    kind = own.schema["id"].dataType
    dealt = own.select("block", "train", "id", "text").mapInArrow(_dealt, "block long, frame binary")
    items = written(dealt.repartition(ways, "block").sortWithinPartitions("block")
                    .mapInArrow(_items(depth), "block long, gram long, word binary, n long"), "zstd")
    of_grams, of_words = items.filter("word is null"), items.filter("word is not null")
    logp = gram_scores(written(of_grams.groupBy("gram").agg(F.sum("n").alias("n"))), depth)
    words = written(of_words.groupBy("word").agg(F.sum("n").alias("n")))
    sums = words.agg(F.sum("n").alias("tokens"), F.sum((F.col("n") > 0).cast("long")).alias("distinct")).first()
    none = F.lit(None)
    rows = of_grams.select("block", "gram").join(logp, "gram").select(
        "block", F.lit(0).cast("long").alias("kind"), "gram", none.cast("binary").alias("word"), F.col("logp").alias("value"))
    rows = rows.unionByName(of_words.select("block", "word").join(words, "word").select(
        "block", F.lit(1).cast("long").alias("kind"), F.lit(-1).cast("long").alias("gram"), "word", F.col("n").cast("double").alias("value")))
    rows = rows.withColumn("frame", none.cast("binary")).unionByName(dealt.select(
        "block", F.lit(2).cast("long").alias("kind"), F.lit(-1).cast("long").alias("gram"), none.cast("binary").alias("word"),
        F.lit(0.0).alias("value"), "frame"))
    schema = T.StructType([T.StructField("id", kind)] + [T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known", "train_tokens")]
                          + [T.StructField(n, T.DoubleType()) for n in ("base_score", "score", "bits_per_byte")])
    return (rows.repartition(ways, "block").sortWithinPartitions("block", "kind")
            .mapInArrow(_score(depth, int(sums.tokens or 0), int(sums.distinct or 0)), schema).withColumnRenamed("id", id_col))
