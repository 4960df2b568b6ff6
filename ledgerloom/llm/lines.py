"""Line dedup by a pair of Bloom filters.

Pass one hashes every long line key and sets bits in two Bloom filters of one
size: keys seen once and keys seen twice. Filters of parts of the corpus merge by
``twice = twice1 | twice2 | once1 & once2`` and ``once = once1 | once2``, so each
task sends its set bits, and slices of the filters are merged in parallel. Pass two sends a key on only if the twice-seen
filter holds it. Those suspects are counted exactly, by key text and distinct
document, which also picks the document that keeps the line. The filter decides
what is shuffled, never the result.

Filters grow with the number of lines up to ``MAX_BITS`` (a broadcast of 32 MB),
beyond which more lines are suspected and shuffled, with the same result.

Defined results: a null or empty text is one empty line; a document is told by its
id, and rows that repeat an id count as one document; rows without an id count as
none, so they lose every line that is dropped; lines are cut at line feeds only.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import text_bytes, unused, written

MIN_CHARS = 40
MIN_DOCS = 5
MIN_BITS, MAX_BITS = 1 << 20, 1 << 28
HASHES = 3
#: Bytes of a filter that are merged together.
SLICE = 1 << 17
_SPACE = b" \t\n\x0b\x0c\r"
#: Documents with dropped lines that may be broadcast; beyond it they are joined by shuffle.
BROADCAST_BYTES = 8 << 20


def keys_of(text: bytes, min_chars: int) -> list[bytes]:
    """The distinct keys of a text's lines that are long enough."""
    keys = {line.strip(_SPACE).lower() for line in text.split(b"\n") if len(line) >= min_chars}
    return [k for k in keys if len(k) >= min_chars and len(k.decode("utf-8", "replace")) >= min_chars]


def places(keys: list[bytes], bits: int) -> np.ndarray:
    """Bit numbers of each key, one column per hash function."""
    h = np.frombuffer(b"".join([xxhash.xxh3_128_digest(k) for k in keys]), "<u8").reshape(-1, 2)
    return ((h[:, :1] + np.arange(HASHES, dtype=np.uint64) * (h[:, 1:] | np.uint64(1))) & np.uint64(bits - 1)).astype(np.int64)


def holds(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether every place of each key is set; ``bits`` holds eight to a byte."""
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).all(axis=1)


def add(once: np.ndarray, twice: np.ndarray, at: np.ndarray) -> None:
    """Enter distinct keys, each of one document, into a pair of filters."""
    seen = holds(once, at)
    for bits, own in ((twice, at[seen].ravel()), (once, at[~seen].ravel())):
        np.bitwise_or.at(bits, own >> 3, np.left_shift(np.uint8(1), (own & 7).astype(np.uint8)))


def pack(part: np.ndarray) -> bytes:
    """A slice of a filter: the numbers of its set bits, or the slice itself where that is shorter."""
    bits = np.flatnonzero(np.unpackbits(part, bitorder="little")).astype(np.uint32)
    return b"s" + bits.tobytes() if bits.nbytes < part.nbytes else b"d" + part.tobytes()


def unpack(held: bytes, size: int) -> np.ndarray:
    if held[:1] == b"d":
        return np.frombuffer(held, np.uint8, offset=1)
    bits = np.zeros(size * 8, np.uint8)
    bits[np.frombuffer(held, np.uint32, offset=1)] = 1
    return np.packbits(bits, bitorder="little")


def _filters(bits: int, min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for b in batches:
            keys = [k for t in b.column(0).to_pylist() for k in keys_of(t, min_chars)]
            first = list(set(keys))
            if not first:
                continue
            add(once, twice, places(first, bits))
            again = [k for k, n in Counter(keys).items() if n > 1]
            if again:
                add(once, twice, places(again, bits))
        for i in range(0, bits // 8, SLICE):
            if once[i:i + SLICE].any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i]), pa.array([pack(once[i:i + SLICE])]), pa.array([pack(twice[i:i + SLICE])])],
                    ["slice", "once", "twice"])
    return run


def _merge(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, o, t = None, None, None
        for b in batches:
            for i, once, twice in zip(*(c.to_pylist() for c in b.columns)):
                if i != now:
                    if now is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([t.tobytes()])], ["slice", "twice"])
                    now, o, t = i, np.zeros(size, np.uint8), np.zeros(size, np.uint8)
                once = unpack(once, size)
                t |= unpack(twice, size) | o & once
                o |= once
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([t.tobytes()])], ["slice", "twice"])
    return run


def twice_seen(texts: DataFrame, bits: int, min_chars: int = MIN_CHARS) -> np.ndarray:
    """The filter (as bytes of bits) of keys that at least two rows of ``texts`` (column text) hold."""
    size = min(SLICE, bits // 8)
    slices = (texts.mapInArrow(_filters(bits, min_chars), "slice long, once binary, twice binary")
              .repartition("slice").sortWithinPartitions("slice")
              .mapInArrow(_merge(size), "slice long, twice binary"))
    out = np.zeros(bits // 8, np.uint8)
    for r in slices.toLocalIterator(prefetchPartitions=True):  # bits / 8 bytes in all
        out[r.slice:r.slice + size] = np.frombuffer(r.twice, np.uint8)
    return out


def suspects(docs: DataFrame, filter_: np.ndarray, id_type, min_chars: int = MIN_CHARS) -> DataFrame:
    """Rows (id, key) of the long keys of ``docs`` (columns id, text) that the filter holds."""
    bits, shipped = len(filter_) * 8, docs.sparkSession.sparkContext.broadcast(filter_)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shipped.value
        for b in batches:
            lists = [keys_of(t, min_chars) for t in b.column(1).to_pylist()]
            flat = [k for ks in lists for k in ks]
            if not flat:
                continue
            row = np.repeat(np.arange(len(lists)), list(map(len, lists)))
            at = places(flat, bits)
            hit = np.flatnonzero(holds(held, at))
            if len(hit):
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(row[hit])), pa.array([flat[i] for i in hit.tolist()], pa.binary())], ["id", "key"])

    return docs.mapInArrow(run, T.StructType([T.StructField("id", id_type), T.StructField("key", T.BinaryType())]))


def dropped_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                 min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per document that loses lines: id, keys (the keys of those lines)."""
    own = docs.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"))
    # of long lines, a text holds at most its length over the least length
    n = own.agg(F.sum(F.floor(F.length("text") / (min_chars + 1)))).first()[0] or 0
    bits = min(MAX_BITS, max(MIN_BITS, 1 << int(np.ceil(np.log2(max(1, 2 * n))))))
    filter_ = twice_seen(own.select("text"), bits, min_chars)
    pairs = written(suspects(own, filter_, own.schema["id"].dataType, min_chars))
    # written, so that the join below reads it straight from a shuffle or a scan and common keys can be split
    common = written(pairs.groupBy("key").agg(F.countDistinct("id").alias("n"), F.max("id").alias("keeper"))
                     .filter(F.col("n") >= min_docs).select("key", "keeper"))
    lost = pairs.join(common, "key").filter(~F.col("id").eqNullSafe(F.col("keeper")))
    return lost.groupBy("id").agg(F.collect_set("key").alias("keys"))


_KEPT = T.StructType([T.StructField("kept", T.BinaryType()), T.StructField("n_lines", T.LongType()),
                      T.StructField("n_dropped", T.LongType())])


@F.pandas_udf(_KEPT)
def _without(texts: pd.Series, keys: pd.Series) -> pd.DataFrame:
    out = []
    for text, lost in zip(texts, keys):
        lines = text.split(b"\n")
        kept = lines
        if lost is not None and len(lost):
            lost = set(lost)
            kept = [x for x in lines if x.strip(_SPACE).lower() not in lost]
        out.append((b"\n".join(kept), len(lines), len(lines) - len(kept)))
    return pd.DataFrame(out, columns=["kept", "n_lines", "n_dropped"])


def without_lines(text: str | Column, keys: str) -> Column:
    """Struct (kept bytes, n_lines, n_dropped) of a text without the lines whose keys are given."""
    return _without(text_bytes(text), F.col(keys))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", into: str = "_lines",
                min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the struct column ``into``: kept (bytes), n_lines, n_dropped."""
    id_, keys = unused(docs, "_lost_id"), unused(docs, "_lost_keys")
    lost = written(dropped_keys(docs, id_col, text_col, min_chars, min_docs)
                   .select(F.col("id").alias(id_), F.col("keys").alias(keys)))
    n = lost.agg(F.sum(F.aggregate(keys, F.lit(0), lambda a, k: a + F.length(k) + 24) + 24)).first()[0] or 0
    side = F.broadcast(lost) if n <= BROADCAST_BYTES else lost.hint("shuffle_hash")
    return (docs.join(side, docs[id_col].eqNullSafe(lost[id_]), "left")
            .withColumn(into, without_lines(text_col, keys)).drop(id_, keys))
