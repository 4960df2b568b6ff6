import random
import re

import numpy as np
import pytest
import xxhash

from ledgerloom.llm import simhash
from ledgerloom.llm.common import prepare


def plain_fingerprint(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
    if not words:
        return 0
    k = min(3, len(words))
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + k]).encode(), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_roots(fps):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("text", ["", " \n", "one", "Two Words", "a b c", "A\tB \x0b c d a b c", "é É ß x y z w", "x " * 500])
def test_fingerprint(text):
    got = simhash.fingerprint_of(text.encode())
    assert got & (1 << 64) - 1 == plain_fingerprint(text)


def test_chunks(monkeypatch):
    text = " ".join(random.Random(3).choices("abcdefgh", k=500))
    want = simhash.fingerprint_of(text.encode())
    monkeypatch.setattr(simhash, "_CHUNK", 7)
    assert simhash.fingerprint_of(text.encode()) == want


@pytest.mark.parametrize("max_bucket", [2, 4_096])
def test_links(spark, max_bucket):
    prepare(spark)
    r = random.Random(max_bucket)
    fps = set()
    for size in (60, 25, 3, 1, 1):
        x = r.getrandbits(64)
        for _ in range(size):
            y = x
            for _ in range(r.randint(0, 4)):
                y ^= 1 << r.randrange(64)
            fps.add(y)
            x = y if r.random() < 0.5 else x
    fps = sorted(simhash._signed(x) for x in fps)
    from ledgerloom.llm.graph import components
    edges = simhash.links(spark.createDataFrame([(x,) for x in fps], "fp long"), max_bucket)
    root = {r.node: r.root for r in components(edges).collect()}
    want = plain_roots([x & (1 << 64) - 1 for x in fps])
    assert [root.get(x, x) for x in fps] == [fps[i] for i in want]


def test_documents(spark):
    prepare(spark)
    base = [" ".join(random.Random(i).choices(["on", "in", "at", "to", "by", "we", "he"], k=120)) for i in range(6)]
    rows = [(i, t) for i, t in enumerate(base)] + [(10 + i, t + " extra") for i, t in enumerate(base)]
    rows += [(30, None), (31, ""), (32, " \t"), (40, base[0].upper()), (40, base[0].upper()), (None, base[1]), (None, "alone here now")]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, fp string, root int")
    got = simhash.near_duplicates(docs).select("doc_id", simhash.hex_of("fp").alias("f"), "component_id").collect()
    fps = [plain_fingerprint(t) for _, t in rows]
    roots = plain_roots(fps)
    want = []
    for (i, _), f, k in zip(rows, fps, roots):
        ids = [j for (j, _), x in zip(rows, roots) if x == k and j is not None]
        want.append((i, f"{f:016x}", min(ids, default=None)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_query(spark):
    from ledgerloom.llm.queries import QUERIES
    folder = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op3_simhash"](spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    roots = plain_roots(fps)
    assert got == {r.doc_id: (f"{f:016x}", rows[k].doc_id) for r, f, k in zip(rows, fps, roots)}
    assert len({k for k in roots}) < len(rows)
