"""Ordered calculations give the same with groups cut and uncut, even with one
group that holds a third of all rows."""
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import joins as J, windows as W
from ledgerloom.operators.aggregates import path_array, tree_success


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    out = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else f"k{rnd.randrange(40)}"
        out.append((key, i, rnd.choice([None, None, rnd.randrange(100)]), rnd.randrange(2)))
    rnd.shuffle(out)
    return out


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "k string, i int, v int, m int")


def brute(rows):
    by = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1])):
        by.setdefault(r[0], []).append(r)
    return by


@pytest.mark.parametrize("max_rows", [None, 100])
def test_ordinal_running_and_neighbours(df, rows, max_rows):
    out = W.ordinal(df, "k", ["i"], "n", max_rows=max_rows)
    out = W.running_group(out, "k", ["i"], "m", "g", max_rows=max_rows)
    out = W.running_max(out, "k", ["i"], F.col("v"), "top", max_rows=max_rows)
    out = W.fill_both(out, ["v"], "k", ["i"], {"v": -1}, max_rows=max_rows)
    out = W.prev_value(out, "v", "k", ["i"], "before", max_rows=max_rows)
    out = W.next_value(out, "v", "k", ["i"], "after", max_rows=max_rows)
    got = {(r.k, r.i): r for r in out.collect()}
    assert len(got) == len(rows)
    for key, group in brute(rows).items():
        for p, (k, i, v, m) in enumerate(group):
            r = got[(k, i)]
            past = [x[2] for x in group[:p] if x[2] is not None]
            later = [x[2] for x in group[p + 1:] if x[2] is not None]
            seen = past + ([v] if v is not None else [])
            assert r.n == p + 1
            assert r.g == sum(x[3] for x in group[:p + 1])
            assert r.top == (max(seen) if seen else None)
            assert r.before == (past[-1] if past else None)
            assert r.after == (later[0] if later else None)
            assert r.v_fill == (v if v is not None else past[-1] if past else later[0] if later else -1)


@pytest.mark.parametrize("max_rows", [None, 100])
def test_assign_to_next(df, rows, max_rows):
    marks, targets = df.filter("m = 1").select("k", "i", "v"), df.filter("m = 0").select("k", "i")
    got = {(r.k, r.i): r.nxt for r in J.assign_to_next(marks, targets, "k", "i", "nxt", max_rows=max_rows).collect()}
    want = {}
    for key, group in brute(rows).items():
        for k, i, v, m in group:
            later = [x[1] for x in group if x[3] == 0 and x[1] > i]
            if m == 1 and later:
                want[(k, i)] = min(later)
    assert got == want


def test_top1_with_ties(spark):
    d = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("a", 3, 1), ("b", 1, 0)], "k string, i int, x int")
    assert {(r.k, r.i): r.sale_amount for r in W.top1_else_zero(d, "k", "x", "i").collect()} == {
        ("a", 1): 5, ("a", 2): 0, ("a", 3): 0, ("b", 1): 0}
    assert {(r.k, r.i) for r in W.drop_largest(d, "k", "x", "i").collect()} == {("a", 2), ("a", 3)}


def test_latest_puts_null_times_first_or_last(spark):
    d = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("b", 1, 3), ("b", 2, 4)], "k string, t int, x int")
    assert {r.k: r.x for r in W.latest(d, "k", "t").collect()} == {"a": 1, "b": 4}
    assert {r.k: r.x for r in W.latest_nulls_last(d, "k", ["t"]).collect()} == {"a": 2, "b": 4}


@pytest.mark.parametrize("max_rows", [None, 5])
def test_tree_failure_is_inherited(spark, max_rows):
    rnd = random.Random(5)
    rows, want = [], {}
    for tx in range(20):
        paths, todo = ["ORIGIN"], [()]
        while todo and len(paths) < 30:
            p = todo.pop(0)
            for i in range(rnd.randrange(0, 12 if not p else 3)):
                q = p + (i,)
                paths.append("_".join(map(str, q)))
                todo.append(q)
        errors = {p for p in paths if rnd.random() < 0.1}
        for p in paths:
            rows.append((tx, p, "bad" if p in errors else None))
            above = [p] + ["_".join(p.split("_")[:n]) for n in range(1, p.count("_") + 1)] + ["ORIGIN"]
            want[(tx, p)] = not any(a in errors for a in above)
    d = spark.createDataFrame(rows, "tx int, trace_address string, error string")
    got = {(r.tx, r.trace_address): r.trace_succeeded for r in tree_success(d, "tx", max_rows=max_rows).collect()}
    assert got == want
    order = W.preorder_index(d.withColumn("a", path_array("trace_address")), "tx", "a", max_rows=max_rows)
    for tx in range(20):
        seen = sorted([(r.trace_index, r.trace_address) for r in order.filter(f"tx = {tx}").collect()])
        key = lambda p: [-1] if p == "ORIGIN" else [int(x) for x in p.split("_")]
        assert [p for _, p in seen] == sorted([p for t, p, _ in rows if t == tx], key=key)


@pytest.mark.parametrize("key", ["cast(i as double) / 7", "timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, i)",
                                 "timestamp '2024-01-01' + make_dt_interval(0, 0, i)", "date '2024-01-01' + i",
                                 "lpad(cast(i as string), 9, '0')", "array(i, 1)"])
def test_groups_are_cut_by_any_ordered_column(df, rows, key):
    from ledgerloom.operators.groups import with_chunks
    d = df.withColumn("o", F.expr(key))
    cut, found = with_chunks(d, "k", F.col("o"), 100)
    sizes = [r["count"] for r in cut.filter("k = 'hot'").groupBy("_chunk").count().collect()]
    assert found and max(sizes) < 200
    got = {(r.k, r.i): r.n for r in W.ordinal(d, "k", ["o"], "n", max_rows=100).collect()}
    assert got == {(k, i): p + 1 for k, g in brute(rows).items() for p, (_, i, _, _) in enumerate(g)}


def test_descending_order_needs_a_split(df):
    with pytest.raises(ValueError):
        W.ordinal(df, "k", [F.desc("i")])
    assert W.ordinal(df, "k", [F.desc("i")], "n", split_by=-F.col("i"), max_rows=100).filter("n = 1 and k = 'hot'").first().i == 2997
