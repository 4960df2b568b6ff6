import math

import numpy as np
import pytest
from pyspark.sql import types as T

from ledgerloom.llm import topk
from ledgerloom.llm.common import prepare

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                       T.StructField("score", T.IntegerType())])


def plain(rows, k=20, every=20):
    good = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in rows:
        if any(i == g for g, _ in good) and i % every == 0 and v is not None and all(x is not None and math.isfinite(x) for x in v):
            queries[i] = min(queries.get(i, v), v)
    out = []
    for i, v in queries.items():
        w = [math.floor(64 * x) for x in v]
        found = sorted((-sum(a * b for a, b in zip(w, x)), j) for j, x in good if j != i)[:k]
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(found)]
    return sorted(out)


def run(spark, rows, **args):
    table = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, topk.top_k(table, **args).collect()))


@pytest.mark.parametrize("args", [{}, {"query_block": 3, "sample": 0}, {"sample": 40, "k": 5}])
def test_search(spark, monkeypatch, args):
    prepare(spark)
    monkeypatch.setattr(topk, "CHUNK", 64)
    draw = np.random.default_rng(4)
    rows = [(i, draw.normal(size=20).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[40][1]) for i in range(30)]  # ties
    rows += [(40, rows[40][1]), (60, rows[3][1]), (7, rows[7][1]), (None, rows[1][1]), (2000, None), (2020, [None, 1.0]),
             (2040, [float("nan")] * 20), (2060, [float("inf")] * 20), (2080, [0.0] * 20), (2100, [1.0, -2.0]), (2120, [])]
    assert run(spark, rows, **args) == plain(rows, k=args.get("k", 20))


def test_sample_of_repeated_ids(spark, monkeypatch):
    prepare(spark)
    draw = np.random.default_rng(5)
    rows = [(i, draw.normal(size=4).tolist()) for i in range(50)] + [(7, draw.normal(size=4).tolist()) for _ in range(500)]
    brought, kind = [], type(spark.range(0))
    bring = kind.toArrow
    monkeypatch.setattr(kind, "toArrow", lambda self: brought.append(bring(self)) or brought[-1])
    assert run(spark, rows) == plain(rows)
    assert max(t.num_rows for t in brought) == 50


def test_driver_holds_no_pairs(spark, monkeypatch):
    """Starting thresholds are found in tasks, and a block of long vectors holds fewer queries."""
    prepare(spark)
    draw = np.random.default_rng(6)
    rows = [(i, draw.normal(size=30).tolist()) for i in range(400)]
    brought, kind = [], type(spark.range(0))
    bring = kind.toArrow
    monkeypatch.setattr(kind, "toArrow", lambda self: brought.append(bring(self)) or brought[-1])
    monkeypatch.setattr(topk, "QUERY_VALUES", 5 * 30)
    monkeypatch.setattr(topk.Search, "pairs", None)  # here only: tasks import the module anew
    assert run(spark, rows, sample=100) == plain(rows)
    assert len(brought) > 3 and max(t.num_rows for t in brought[1:]) < 20


def test_pruned_as_full():
    draw = np.random.default_rng(8)
    x = np.floor(64 * draw.normal(size=(3000, 64)) * np.linspace(3, 0.05, 64))
    s = topk.Search(np.arange(100), x[:100], 20)
    kept = tuple(np.zeros(0, np.int64) for _ in range(3))
    for at in range(0, 3000, 500):
        q, c, v = s.pairs(np.arange(at, at + 500), x[at:at + 500])
        kept = s.best(*(np.concatenate(p) for p in zip(kept, (q, c + at, v))))
    full = x[:100] @ x.T
    full[np.arange(100), np.arange(100)] = -np.inf
    for i in range(100):
        order = np.lexsort((np.arange(3000), -full[i]))[:20]
        assert kept[1][kept[0] == i].tolist() == order.tolist() and kept[2][kept[0] == i].tolist() == full[i][order].astype(int).tolist()


def test_large_numbers(spark):
    prepare(spark)
    rows = [(20, [1e7, 3.0, 1e7 + 1]), (1, [1e7, 5.0, 1e7]), (2, [1e7, 5.0, 1e7 + 2]), (40, [0.5, 0.5, 0.5])]
    assert run(spark, rows) == plain(rows)
    rows[0] = (20, [1e8, 3.0, 1e7 + 1 / 64])
    assert run(spark, rows) == plain(rows)
    with pytest.raises(Exception, match="64 bits"):
        run(spark, [(20, [1e9]), (1, [1e9]), (2, [1.0])])


def test_small_tables(spark):
    prepare(spark)
    assert run(spark, []) == []
    assert run(spark, [(20, [1.0])]) == []
    assert run(spark, [(1, [1.0]), (3, None)]) == []


def test_query(spark):
    from ledgerloom.llm.queries import QUERIES
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted(map(tuple, QUERIES["op9_exact_top_k"](spark, folder).collect())) == plain(rows)
