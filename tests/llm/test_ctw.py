import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from ledgerloom.llm import ctw
from ledgerloom.llm.common import prepare, remainder
from ledgerloom.llm.hashtable import HashTable


def steps(text, depth):
    """(context from near to far, node, bit) of every decision of a text and its end."""
    x = bytes(depth) + text + b"\0"
    for i in range(depth, len(x)):
        near = x[i - depth:i][::-1]
        node = 1
        for k in range(7, -1, -1):
            bit = x[i] >> k & 1
            yield near, node, bit
            node = node << 1 | bit


def log_pe(a, b):
    return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)


def weighted(counts, node, depth):
    """log of the weighted probability of a node's tree, by recursion over whole contexts."""
    def of(context):
        a, b = counts.get((context, node), (0, 0))
        own = log_pe(a, b)
        if len(context) == depth:
            return own
        below = sum(of(c) for c, m in counts if m == node and len(c) == len(context) + 1 and c[:-1] == context)
        return np.logaddexp(math.log(.5) + own, math.log(.5) + below)
    return of(b"")


def add(counts, near, node, bit, depth):
    for d in range(depth + 1):
        a, b = counts.get((near[:d], node), (0, 0))
        counts[near[:d], node] = (a + (bit == 0), b + (bit == 1))


def plain_log10(train, text, depth):
    """Ratio of weighted probabilities with and without each further decision."""
    counts = {}
    for t in train:
        for near, node, bit in steps(t, depth):
            add(counts, near, node, bit, depth)
    total = 0
    for near, node, bit in steps(text, depth):
        more = dict(counts)
        add(more, near, node, bit, depth)
        total += weighted(more, node, depth) - weighted(counts, node, depth)
    return total / math.log(10)


def model_log10(train, texts, depth):
    codes, n = ctw.gram_codes(train, depth) if train else (np.zeros(0, np.int64), None)
    asked, sizes = ctw.gram_codes(texts, depth)
    grams, n = ctw._summed(np.concatenate([codes, asked]), np.concatenate([np.ones(len(codes), np.int64), np.zeros(len(asked), np.int64)]))
    shorter = ctw.levels(grams, n, depth)[0].shorter()
    score = ctw.score_grams(grams, n, depth, *ctw.top(*shorter))
    return [score[np.searchsorted(grams, part)].sum() for part in np.split(asked, np.cumsum(sizes)[:-1])]


@pytest.mark.parametrize("depth", [2, 3, 4])
def test_mixture(depth):
    train = [b"abracadabra", b"abc abc", b"", b"banana\xff"]
    texts = [b"abra", b"", b"zebra abc", b"\xffnan"]
    got = model_log10(train, texts, depth)
    assert got == pytest.approx([plain_log10(train, t, depth) for t in texts], abs=1e-8)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.binary(max_size=6), max_size=3), st.binary(max_size=4))
def test_any_mixture(train, text):
    assert model_log10(train, [text], 2) == pytest.approx([plain_log10(train, text, 2)], abs=1e-8)


def test_probabilities_sum_to_one():
    train = [b"the cat sat", b"the hat"]
    asked = np.array([(c << 8) | b for c in (ctw.gram_codes([b"the c"], 3)[0] >> 8).tolist() for b in range(256)], np.int64)
    codes = ctw.gram_codes(train, 3)[0]
    grams, n = ctw._summed(np.concatenate([codes, asked]), np.concatenate([np.ones(len(codes), np.int64), np.zeros(len(asked), np.int64)]))
    score = ctw.score_grams(grams, n, 3, *ctw.top(*ctw.levels(grams, n, 3)[0].shorter()))
    p = 10 ** score[np.searchsorted(grams, asked)].reshape(-1, 256)
    assert p.sum(axis=1) == pytest.approx(1)


def test_lgamma():
    x = np.array([0.5, 1, 1.5, 7, 100.5, 1e6, 1e12])
    assert ctw._lgamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-12, abs=1e-9)


def test_hash_table():
    r = np.random.default_rng(0)
    keys = np.unique(r.integers(0, 1 << 40, 5000))
    t = HashTable(keys, np.arange(len(keys)), -1)
    assert (t.get(keys) == np.arange(len(keys))).all()
    other = np.setdiff1d(r.integers(0, 1 << 40, 5000), keys)
    assert (t.get(other) == -1).all() and (t.get(np.array([-1, -5])) == -1).all()
    assert (HashTable(keys[:0], keys[:0], -1).get(keys) == -1).all()


def plain_base(rows, train):
    def tokens(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return [*(w for w in re.split(r"[\x20\x09-\x0D]+", low) if w), None]
    count = Counter(w for i, t in rows if train(i) for w in tokens(t))
    n, v = sum(count.values()), len(count)
    return sorted(((i, len(tokens(t)), sum(count[w] > 0 for w in tokens(t)), n,
                    sum(math.log10((count[w] + .5) / (n + .5 * (v + 1))) for w in tokens(t))) for i, t in rows), key=str)


@pytest.mark.parametrize("block_bytes", [40, 1 << 20])
def test_documents(spark, monkeypatch, block_bytes):
    prepare(spark)
    monkeypatch.setattr(ctw, "SHARD_ROWS", 50)
    rows = [(1, "The cat sat on the mat"), (2, "the dog\tSAT\n"), (2, "the dog\tSAT\n"), (3, None), (4, ""), (5, "é É zebra the"), (None, "no id here"),
            (6, "held out words the cat"), (7, "x" * 300)]
    from pyspark.sql import functions as F
    docs = spark.createDataFrame([(*r, 1, "w") for r in rows], "doc_id long, text string, n int, word string")
    got = ctw.score(docs, F.col("doc_id") != 6, depth=3, block_bytes=block_bytes).collect()
    want = plain_base(rows, lambda i: i is not None and i != 6)
    got = sorted(got, key=lambda r: str(tuple(r)))
    assert [tuple(r)[:4] for r in got] == [w[:4] for w in want]
    assert [r.base_score for r in got] == pytest.approx([w[4] for w in want])
    train = [(t or "").encode() for i, t in rows if i is not None and i != 6]
    by_id = dict(zip([i for i, _ in rows], model_log10(train, [(t or "").encode() for _, t in rows], 3)))
    assert [r.score for r in got] == pytest.approx([by_id[r.doc_id] for r in got])
    assert all(r.bits_per_byte == pytest.approx(-r.score / math.log10(2) / (len((dict(rows)[r.doc_id] or "").encode()) + 1)) for r in got)
    assert ctw.score(docs.limit(0), F.lit(True)).count() == 0
    none = ctw.score(docs, F.lit(False), depth=2).collect()
    assert all(r.train_tokens == 0 and r.base_score == 0 and r.n_known == 0 for r in none)
    assert all(r.bits_per_byte == pytest.approx(8) for r in none)


def test_query(spark):
    from ledgerloom.llm.queries import QUERIES
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(QUERIES["op10_ctw_scores"](spark, folder).collect(), key=lambda r: str(tuple(r)))
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    want = plain_base(rows, lambda i: not held(i))
    assert [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens) for r in got] == [w[:4] for w in want]
    assert [r.base_score for r in got] == pytest.approx([w[4] for w in want])
    assert all(r.held_out == held(r.doc_id) for r in got)
    assert np.mean([r.bits_per_byte for r in got if r.held_out]) < 3.2  # 8 without a model


def test_held_out_code_length(spark):
    """More training text and more depth shorten the code of texts that were not learned from."""
    prepare(spark)
    from pyspark.sql import functions as F
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = remainder("doc_id", 5) == 1

    def bits(train, depth):
        out = ctw.score(docs, train, depth=depth).filter(held)
        return out.agg(-F.sum("score") / math.log10(2) / F.sum(F.col("score") / F.col("bits_per_byte") / -math.log10(2))).first()[0]

    few, shallow, deep = bits(remainder("doc_id", 50) == 0, 5), bits(~held, 2), bits(~held, 5)
    assert deep < shallow < 3.2 and deep < few


@pytest.mark.parametrize("step", [1, 3, 7, 64])
def test_long_texts_in_parts(step):
    texts = [b"", b"a", b"abcdefg", b"xy" * 20, b"", b"\xff\x00z"]
    whole, counts = ctw.gram_codes(texts, 3)
    assert counts.tolist() == [len(t) + 1 for t in texts]
    own = [[] for _ in texts]
    for codes, number, n in ctw.gram_chunks(texts, 3, step):
        for i, part in zip(number.tolist(), np.split(codes, np.cumsum(n)[:-1])):
            own[i] += part.tolist()
    assert [c for x in own for c in x] == whole.tolist()
    assert whole[:2].tolist() == [0, 97]


def test_scoring_a_shard_holds_few_arrays():
    import tracemalloc
    r = np.random.default_rng(1)
    codes = np.unique(r.integers(0, 1 << 48, 20_000))
    tracemalloc.start()
    try:
        ctw.score_grams(codes, r.integers(0, 4, len(codes)), 5, np.full(1 << 16, 0.3), np.full(1 << 16, 0.4))
        held = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert held < 32 * 8 * 8 * len(codes)  # arrays of one number a decision; it was 42
