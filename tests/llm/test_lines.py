import hashlib
import re

import numpy as np
import pytest

from ledgerloom.llm import lines
from ledgerloom.llm.common import prepare

SPACE = r"[\x20\x09-\x0D]+"


def key(line):
    line = re.sub(f"^{SPACE}|{SPACE}$", "", line)
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)


def plain(rows, min_chars=40, min_docs=5):
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, t in rows:
        all_ = (t or "").split("\n")
        kept = []
        for x in all_:
            ids = holders.get(key(x), set()) - {None}
            if len(key(x)) < min_chars or len(ids) < min_docs or i == max(ids):
                kept.append(x)
        out.append((i, "\n".join(kept), len(all_), len(all_) - len(kept)))
    return out


def test_filters_merge():
    bits = 1 << 12
    keys = [f"key {i}".encode() for i in range(60)]
    parts = [keys[:30], keys[20:50], keys[45:]]
    size = bits // 8
    import pyarrow as pa
    sent = []
    for p in parts:
        text = b"\n".join(p)
        sent += list(lines._filters(bits, 1)(iter([pa.RecordBatch.from_arrays([pa.array([text])], ["text"])])))
    (out,) = list(lines._merge(size)(iter(sent)))
    twice = np.frombuffer(out.column(1)[0].as_py(), np.uint8)
    held = lines.holds(twice, lines.places(keys, bits))
    both = [k in parts[0] and k in parts[1] or k in parts[1] and k in parts[2] for k in keys]
    assert all(h for h, b in zip(held, both) if b)
    assert sum(held) < 45


@pytest.mark.parametrize("broadcast", [0, 8 << 20])
def test_lines(spark, monkeypatch, broadcast):
    prepare(spark)
    monkeypatch.setattr(lines, "BROADCAST_BYTES", broadcast)
    a, b, c = "The shared line of text that is long enough to count", "é" * 40, "x" * 39
    rows = [(i, f"{a}\nown line {i} of this one document, also long enough\n \t{b}\r\n{c}") for i in range(5)]
    rows += [(7, f"  {a.upper()}\n{a}\n\n{a}"), (7, "x\n" + a), (8, None), (9, ""), (None, a + "\nno id"), (11, "\n\n"), (12, b)]
    rows += [(100 + i, "four only: this line is in no more than four documents") for i in range(4)]
    docs = spark.createDataFrame([(*r, [b"z"], 3) for r in rows], "doc_id long, text string, keys array<binary>, n_lines int")
    got = [(r.doc_id, bytes(r.l.kept).decode(), r.l.n_lines, r.l.n_dropped)
           for r in lines.dedup_lines(docs, into="l").select("doc_id", "l").collect()]
    assert sorted(got, key=str) == sorted(plain(rows), key=str)
    assert lines.dedup_lines(docs.limit(0)).count() == 0


def test_saturated_filter(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(lines, "MIN_BITS", 64)
    monkeypatch.setattr(lines, "MAX_BITS", 64)
    test_lines(spark, monkeypatch, 0)


def test_query(spark):
    from ledgerloom.llm.queries import QUERIES
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    want = [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, t, n, d in plain(rows)]
    assert sorted(map(tuple, QUERIES["op5_line_dedup"](spark, folder).collect())) == sorted(want)
    assert any(r[2] for r in want)
