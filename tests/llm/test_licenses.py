import random
import re

import pytest

from ledgerloom.llm import licenses
from ledgerloom.llm.common import prepare
from ledgerloom.llm.license_texts import NOTICES


def words(t):
    return [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]


def plain(rows, notices, least=0.8):
    out = []
    for name, text in notices.items():
        w = words(text)
        k = min(5, len(w))
        want = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()
        for i, t in rows:
            v = words(t)
            n = len(want & {tuple(v[j:j + k]) for j in range(len(v) - k + 1)})
            if want and n / len(want) >= least:
                out.append((i, name, len(want), n, n / len(want)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    filler = lambda n: " ".join(r.choices("lorem ipsum dolor sit amet elit sed do of the".split(), k=n))
    out = [(0, None), (0, None), (1, ""), (2, "All rights"), (3, "ALL  rights;\nRESERVED"), (4, "reserved all rights")]
    for i, (name, text) in enumerate(NOTICES.items()):
        for shift in (0, 3, 11):
            out.append((100 + 10 * i + shift % 7, f"{filler(shift)} {text.upper() if shift else text} {filler(20)}"))
        w = text.split()
        w[len(w) // 2:len(w) // 2 + 1] = ["changed"]  # one word within, up to five shingles
        out.append((500 + i, f"{filler(9)} {' '.join(w)} {filler(9)}"))
        out.append((600 + i, f"{filler(9)} {' '.join(text.split()[:-2])} {filler(9)}"))
    out += [(700, filler(5000) + " " + NOTICES["MIT"] + " " + filler(5000)), (None, NOTICES["ISC"]), (701, " ".join(NOTICES.values()))]
    out.append((701, out[-1][1]))
    return out


def test_scan(spark, rows):
    prepare(spark)
    docs = spark.createDataFrame([(*r, [1], "n") for r in rows], "doc_id long, text string, h array<int>, notice string")
    got = licenses.scan(docs, NOTICES)
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows, NOTICES)
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert licenses.scan(docs.limit(0), NOTICES).count() == 0
    assert licenses.scan(docs, {"none": " ;"}).count() == 0
    more = {**NOTICES, "odd": ";"}
    assert sorted(map(tuple, licenses.scan(docs, more).collect()), key=str) == plain(rows, NOTICES)


def test_bound(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(licenses, "MAX_SHINGLES", 3)
    with pytest.raises(ValueError):
        licenses.scan(spark.createDataFrame([(1, "a")], "doc_id long, text string"), NOTICES)


def test_query(spark):
    from ledgerloom.llm.queries import QUERIES
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, QUERIES["op4_license_scan"](spark, folder).collect()), key=str)
    assert got == plain(docs, NOTICES) and got
