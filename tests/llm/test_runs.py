import hashlib
import re
import zlib

import numpy as np
from hypothesis import given, settings, strategies as st

from ledgerloom.llm import runs
from ledgerloom.llm.common import prepare

FOLDER = "/root/testdata/sf0.001"


def plain(words):
    """All runs, every period and every stretch by itself."""
    n, out = len(words), []
    for q in range(1, n // runs.EXPONENT + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            end = j + q
            if j > i and end - i >= max(runs.MIN_LENGTH, runs.EXPONENT * q):
                if not any(words[i:end - p] == words[i + p:end] for p in range(1, q)):
                    out.append((i, end - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def found(words):
    known = {}
    return [tuple(r) for r in runs.runs(np.array([known.setdefault(w, len(known)) for w in words], np.int32)).tolist()]


periodic = st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=14), st.integers(2, 9), st.integers(0, 13)).map(
    lambda x: (x[0] * x[1]) + x[0][:x[2]])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=12) | periodic, max_size=4))
def test_as_the_plain_version(parts):
    words = [w for p in parts for w in p]
    assert found(words) == plain(words)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 1), min_size=1, max_size=3).map(lambda x: x * 4), min_size=1, max_size=4), st.integers(4, 7))
def test_runs_within_periods(parts, times):
    words = [w for p in parts for w in p] * times
    assert found(words) == plain(words)


def test_long_period():
    rng = np.random.default_rng(1)
    block = rng.integers(0, 50, 1500).tolist()
    words = rng.integers(50, 99, 700).tolist() + block * 4 + block[:77] + [99] * 5
    assert found(words) == [(700, 6077, 1500)]
    assert found(block * 3 + block[:-1]) == []  # a word short of four periods


def test_table_cases(spark):
    prepare(spark)
    rows = [(1, "a a a a a a b", 1), (2, None, 2), (None, "", 3), (3, " \n\t ", 4), (1, "a a a a a a b", 5), (4, "x y " * 4 + "z", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    got = [(r.runs, r._runs.n_words, [tuple(x) for x in r._runs.runs], r._runs.collapsed) for r in runs.find(docs).orderBy("runs").collect()]
    assert got == [(1, 7, [(0, 6, 1)], "a b"), (2, 0, [], ""), (3, 0, [], ""), (4, 0, [], ""), (5, 7, [(0, 6, 1)], "a b"),
                   (6, 9, [(0, 8, 2)], "x y z")]
    assert runs.find(docs.limit(0)).count() == 0


def test_texts_do_not_touch_and_long_ones_stand_alone(monkeypatch):
    texts = [[b"a"] * 4, [b"a"] * 4, [], [b"a"] * 7]
    assert [(n, r) for n, r, _ in runs._described(texts)] == [(4, []), (4, []), (0, []), (7, [[0, 7, 1]])]
    monkeypatch.setattr(runs, "CHUNK_WORDS", 5)
    assert list(runs._chunks(texts)) == [[texts[0]], [texts[1], []], [texts[3]]]


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    own = found(words)
    kept = [True] * n
    for start, length, q in own:
        kept[start + q:start + length] = [False] * (length - q)
    top = max(own, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
    return (len(own), *top, top[1] * 1000 // top[2] if own else None,
            hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in own).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for w, k in zip(words, kept) if k).encode()).hexdigest(), n)


def test_query(spark):
    from ledgerloom.llm.queries import QUERIES
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_periodic_runs"](spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs) and sum(r[0] for r in got.values()) > 10
    for r in docs:
        assert got[r.doc_id] == expected(r.doc_id, r.text)


def test_runs_of_the_documents(spark):
    """The runs of short documents, with their planted periods, against every period and stretch."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    for r in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")[:300] * (1 + r.doc_id % 5)
        assert found(words) == plain(words)
