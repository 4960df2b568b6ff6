import numpy as np
import pytest
from pyspark.sql import types as T

from ledgerloom.llm import caps
from ledgerloom.llm.common import prepare


def sound(label, v):
    return label is not None and bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)


def plain(rows, similarity=0.93):
    n = len(rows)
    root, links = list(range(n)), [0] * n

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    pairs = set()
    for i, (_, v, k) in enumerate(rows):
        for j in range(i):
            w, m = rows[j][1:]
            if k == m and sound(k, v) and sound(m, w) and len(v) == len(w):
                a, b = np.array(v, float), np.array(w, float)
                if list(v) == list(w) or a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= similarity:
                    links[i] += 1
                    links[j] += 1
                    pairs.add((j, i))
                    root[max(find(i), find(j))] = min(find(i), find(j))
    out = []
    for i, (vec, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(n) if find(j) == find(i) and rows[j][0] is not None]
        low = min(ids, default=None)
        out.append((vec, links[i], low, vec == low))
    return out, pairs


def near(draw, v, cos):
    w = draw.normal(size=len(v))
    w -= (w @ v) / (v @ v) * v
    return cos * v / np.linalg.norm(v) + np.sqrt(1 - cos * cos) * w / np.linalg.norm(w)


def test_recall():
    """Random pairs at the limit and above share a filter."""
    draw = np.random.default_rng(3)
    a = draw.normal(size=(600, 64))
    for cos, least in ((0.93, 0.95), (0.96, 0.98), (0.99, 0.995)):
        b = np.stack([near(draw, x, cos) for x in a])
        both = np.concatenate([a / np.linalg.norm(a, axis=1, keepdims=True), b])
        row, found = caps.filters(64).decode(both)
        lists = np.split(found, np.searchsorted(row, np.arange(1, len(both))))
        assert all(len(x) for x in lists)
        assert np.mean([len(np.intersect1d(lists[i], lists[600 + i])) > 0 for i in range(600)]) >= least


def test_decode_is_complete():
    f = caps.Filters(8)
    x = np.random.default_rng(0).normal(size=(20, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    row, found = f.decode(x)
    got = set(zip(row.tolist(), found.tolist()))
    for r, (turn, (c1, c2)) in enumerate(f.parts):
        y = x @ turn
        score = ((y[:, :4] @ c1.T)[:, :, None] + (y[:, 4:] @ c2.T)[:, None, :]).reshape(20, -1) / np.sqrt(2)
        want = {(i, k + r * caps.CODES**2) for i, k in zip(*np.nonzero(score >= f.threshold))}
        own = {(i, k) for i, k in got if k // caps.CODES**2 == r}
        assert want <= own and len(own - want) <= 20


@pytest.mark.parametrize("max_bucket", [3, 1_024])
def test_vectors(spark, max_bucket):
    prepare(spark)
    draw = np.random.default_rng(max_bucket)
    rows, i = [], 10
    for size, label in ((14, 1), (5, 1), (3, 2), (1, 2), (1, 3)):
        v = draw.normal(size=16)
        for _ in range(size):
            v = near(draw, v, 0.985) * draw.uniform(0.1, 50)
            rows.append((i, v.astype(np.float32).tolist(), label))
            i += 1
    one = rows[0][1]
    rows += [(1, one, 1), (900, one, 1), (900, one, 1), (901, one, 2), (902, one, None), (None, one, 1), (None, None, 1), (903, [], 1),
             (904, [0.0] * 16, 1), (905, [0.0] * 16, 1), (906, [None, *one[1:]], 1), (907, [float("nan"), *one[1:]], 1),
             (908, [float("inf"), *one[1:]], 1), (909, one[:8], 1), (910, one[:8], 1), (911, [1e30] * 16, 4), (912, [1e-30] * 16, 4)]
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                           T.StructField("label", T.IntegerType()), T.StructField("kept", T.StringType())])
    table = spark.createDataFrame([(*r, "x") for r in rows], schema)
    want, pairs = plain(rows)
    got = caps.near_duplicates(table, max_bucket=max_bucket).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert len(pairs) > 60 and caps.near_duplicates(table.limit(0)).count() == 0


def test_query(spark):
    from ledgerloom.llm.queries import QUERIES
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    want, pairs = plain(rows)
    got = sorted(map(tuple, QUERIES["op6_embedding_caps"](spark, folder).collect()))
    assert got == sorted(want)


def test_clusters_in_64_dimensions(spark):
    prepare(spark)
    draw = np.random.default_rng(9)
    rows = []
    for k in range(40):
        centre = draw.normal(size=64)
        rows += [(len(rows) + j, near(draw, centre, draw.uniform(0.96, 0.999)).tolist(), k % 3) for j in range(draw.integers(1, 12))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long")
    want, pairs = plain(rows)
    got = sorted(map(tuple, caps.near_duplicates(table).collect()))
    assert all(a[1] <= b[1] for a, b in zip(got, sorted(want)))
    assert sum(r[1] for r in got) >= 0.97 * 2 * len(pairs) > 0
