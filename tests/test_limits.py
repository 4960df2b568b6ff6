"""Sizes and shapes at which earlier layouts lost rows or left work in one task."""
import datetime as dt
import json
import random
import time

import pytest
from pyspark.sql import functions as F

from ledgerloom import functions as L
from ledgerloom.operators import groups, incremental as inc, windows as W
from ledgerloom.operators.aggregates import high_water, object_agg, tree_success
from ledgerloom.operators.groups import with_chunks
from ledgerloom.operators.quality import sequence_gaps
from ledgerloom.operators.setops import batches, minus
from ledgerloom.operators.tree import MALFORMED, flatten_tree, holds
from ledgerloom.plans import checks as C, silver as S
from ledgerloom.sources import landed, sinks
from ledgerloom.streaming import run_stream


def tree(depth):
    return '{"result":' + '{"calls":[' * depth + '{"type":"leaf"}' + "]}" * depth + "}"


def test_many_hot_groups_with_a_common_prefix(spark):
    n, per = 1500, 12
    d = spark.range(n * per).select((F.col("id") % n).alias("k"), F.concat(F.lit("0x00000000"), F.lpad((F.col("id") / n).cast("int").cast("string"), 4, "0")).alias("o"))
    cut, found = with_chunks(d, "k", F.col("o"), 4)
    pieces = cut.groupBy("k").agg(F.countDistinct("_chunk").alias("p"))
    assert found and pieces.filter("p < 2").count() == 0
    got = W.ordinal(d, "k", ["o"], "n", max_rows=4)
    assert got.filter(F.col("n") != F.substring("o", 11, 4).cast("int") + 1).count() == 0 and got.count() == n * per


def test_one_group_below_one_first_element(spark):
    d = spark.range(3000).select(F.lit(1).alias("k"), F.array(F.lit(0), F.col("id")).alias("path"))
    cut, _ = with_chunks(d, "k", F.col("path"), 100)
    assert cut.groupBy("_chunk").count().agg(F.max("count")).first()[0] < 200
    assert W.preorder_index(d, "k", "path", max_rows=100).filter("trace_index <> path[1]").count() == 0


def test_deep_and_malformed_trees(spark):
    docs = [(i, tree(d)) for i, d in enumerate((0, 400, 520, 1024))] + [(7, '{"result": {'), (8, '{"result": null}'), (9, "[1]"), (10, None)]
    d = spark.createDataFrame(docs, "i int, doc string").filter(holds(F.col("doc"), "result"))
    assert sorted(r.i for r in d.collect()) == [0, 1, 2, 3, 7]
    out = flatten_tree(d, "doc", "i", within="result", malformed="keep")
    assert {r.i: r["count"] for r in out.groupBy("i").count().collect()} == {0: 1, 1: 401, 2: 521, 3: 1025, 7: 1}
    bad = out.filter("i = 7").first()
    assert bad.trace_address is None and bad.trace_json == {MALFORMED: docs[4][1]}
    with pytest.raises(Exception, match="not a JSON document"):
        flatten_tree(d, "doc", "i", within="result").count()


def test_full_build_reads_all_partitions(spark):
    d = spark.createDataFrame([(24_999_999,), (25_000_001,)], "p long")
    assert inc.backfill_slice(d, None, "p").count() == 2
    assert inc.backfill_slice(d, None, "p", first=25_000_000).count() == 1
    assert inc.backfill_slice(d, d.limit(1), "p", back=0, step=1).count() == 1


def test_fee_of_any_gas(spark):
    r = spark.createDataFrame([(25.0, 20_000_000_000), (1e-9, 2**62)], "price double, gas long").select(inc.fee_precise("price", "gas").alias("f"))
    assert [x.f for x in r.collect()] == ["500", "4.611686018427387904"]


def test_hex_takes_one_prefix(spark):
    r = spark.createDataFrame([(x,) for x in ("xX0x1f", "0x0x1f", "0x1f", "1f", "0X001f", "0x", "x1f", "00")], "h string").select(L.hex_to_dec("h").alias("d"))
    assert [x.d for x in r.collect()] == [None, None, "31", "31", "31", None, None, "0"]


def test_partition_number_without_root(spark, tmp_path):
    spark.createDataFrame([(1,)], "x int").write.json(f"{tmp_path}/a/b_1/21248000_x")
    assert landed.read_landed(spark, str(tmp_path), fmt="json", schema="x int").first().partition_key == 21_248_000


def test_upsert_reads_touched_partitions_only(spark, tmp_path):
    path, bucket = f"{tmp_path}/t", {"bucket": L.bucket_1000("k")}
    sinks.upsert_table(spark.range(20_000).select(F.col("id").alias("k"), F.lit(1).alias("x")), path, "k", bucket)
    one = spark.createDataFrame([(5, 2)], "k long, x int").withColumns(bucket)
    near = sinks._touched(sinks.read_table(spark, path), one, ["bucket"])
    every = len(sinks.read_table(spark, path).inputFiles())
    scans = [json.loads(near._jdf.queryExecution().optimizedPlan().prettyJson())]
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert scans and "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1][:80]
    read = near.select(F.input_file_name().alias("f")).distinct().count()
    assert read == 1 < every
    sinks.upsert_table(one.drop("bucket"), path, "k", bucket)
    got = sinks.read_table(spark, path)
    assert got.count() == 20_000 and got.filter("x = 2").first().k == 5


def test_set_difference_by_words(spark):
    make = lambda xs: spark.createDataFrame([(x,) for x in xs], "k long")
    wide = [None, -1, -64, -65, 0, 5, 63, 64, 127, 2**62, -2**63, 2**63 - 1]
    for have in ([], [5, 5, 64, 9], wide, [None], [-1, 2**62]):
        got = minus(make(wide + [5, 5]), make(have), "k", dense=True)
        assert sorted(map(str, (r.k for r in got.collect()))) == sorted(map(str, set(wide) - set(have)))
    plan = minus(spark.range(10**6).toDF("k"), spark.range(5).toDF("k"), "k", dense=True)
    assert plan.count() == 10**6 - 5
    assert minus(make([1, 2]).selectExpr("cast(k as int) k"), make([1]), "k", dense=True).schema["k"].dataType.simpleString() == "int"


def test_batches_of_any_size_without_one_task(spark):
    d = spark.range(1_300_000).select((F.col("id") * 7919 % 1_300_000).alias("k"))
    got = batches(d, 5_000, 1_000, F.desc("k"), cap=1_200_000)
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()
    wrong = F.floor((F.lit(1_299_999) - F.col("k")) / 1_000) != F.col("worker_batch")
    assert got.count() == 1_200_000 and got.filter(wrong).count() == 0
    assert got.agg(F.max("producer_batch")).first()[0] == 239
    assert batches(d.limit(0), 5, 1, "k").count() == 0


def test_gaps_by_words(spark):
    rng = random.Random(4)
    for values in ([], [7], [-200, -3, -2, 63, 64, 65, 127, 128, 3_000_000, 3_000_002], [rng.randrange(500) for _ in range(300)]):
        d = spark.createDataFrame([(v, v % 2) for v in values + values[:3]], "k int, g int")
        own = sorted(set(values))
        want = [(a, b, b - a - 1) for a, b in zip(own, own[1:]) if b - a > 1]
        assert sorted(map(tuple, sequence_gaps(d, "k", width=128).collect())) == want
        split = {g: [v for v in own if v % 2 == g] for g in (0, 1)}
        want = sorted((g, a, b, b - a - 1) for g, vs in split.items() for a, b in zip(vs, vs[1:]) if b - a > 1)
        assert sorted(map(tuple, sequence_gaps(d, "k", "g", width=128).collect())) == want


def test_failure_below_one_first_call_is_cut(spark):
    """All calls under one first call: the ranges are cut by the whole path."""
    n = 600
    d = spark.range(n).select(F.lit(1).alias("k"), F.concat(F.lit("0_"), F.col("id").cast("string")).alias("trace_address"),
                              F.when(F.col("id") == 7, "x").alias("error"))
    got = tree_success(d, "k", max_rows=50)
    assert [r.trace_address for r in got.filter("not trace_succeeded").collect()] == ["0_7"] and got.count() == n


def test_maps_in_pieces(spark):
    d = spark.range(100).select(F.lit("a").alias("k"), F.col("id").cast("string").alias("n"), "id")
    got = object_agg(d, "k", "n", "id", pieces=4).collect()
    assert len(got) == 4 and {x: y for r in got for x, y in r.obj.items()} == {str(i): i for i in range(100)}


def files_of(df, c="block_number"):
    return {r.f.split("bucket=")[1].split("/")[0] for r in df.select(F.input_file_name().alias("f")).distinct().collect()}


def test_healing_opens_the_buckets_of_pending_rows(spark, tmp_path):
    """One row waiting since block 1 and one at the head: two buckets are read, not all between them."""
    path, bucket = f"{tmp_path}/t", {"bucket": L.bucket_1000("block_number")}
    sinks.upsert_table(spark.range(40_000).select(F.col("id").alias("block_number"), F.lit(1).alias("x")), path, "block_number", bucket)
    waiting = spark.createDataFrame([(1,), (39_400,), (39_499,), (None,)], "block_number long")
    table = sinks.read_table(spark, path)
    near, plain = inc.in_blocks_of(waiting, table, table.drop("bucket"))
    assert files_of(near) == {"0", "39000"} and len(table.inputFiles()) > 40
    assert near.join(waiting, "block_number").count() == 3
    pushed = plain._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(block_number,500)" in pushed and plain.count() <= 2 * 1_001
    none, = inc.in_blocks_of(waiting.limit(0), table)
    assert none.count() == 0


def test_healing_of_very_many_buckets_joins_them(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(inc, "MAX_BUCKETS", 3)
    rows = spark.range(0, 9_000, 1_000).toDF("block_number")
    near, = inc.in_blocks_of(rows, spark.range(20_000).toDF("block_number"))
    assert near.agg(F.min("block_number"), F.max("block_number")).first() == (0, 8_499)
    monkeypatch.setattr(inc, "MAX_BUCKETS", 100)
    monkeypatch.setattr(inc, "MAX_RANGES", 2)
    assert inc._ranges([0, 1000, 5000, 90_000]) == [(-500, 5500), (89_500, 90_500)]
    near, = inc.in_blocks_of(rows, spark.range(20_000).toDF("block_number"))
    assert near.join(rows, "block_number").count() == 9


T = [dt.datetime(2024, 5, 1, h) for h in range(9)]


def test_marks_are_committed_and_read_without_the_table(spark, tmp_path):
    path, bucket = f"{tmp_path}/m", {"bucket": L.bucket_1000("block_number")}
    make = lambda rows: spark.createDataFrame(rows, "block_number long, _inserted_timestamp timestamp_ntz, x string")
    assert sinks.read_marks(spark, path) == {}
    sinks.upsert_table(make([(1, T[1], "a"), (5_000, T[5], "b")]), path, "block_number", bucket)
    assert sinks.read_marks(spark, path) == {"block_number": 5_000, "_inserted_timestamp": T[5]}
    sinks.upsert_table(make([(5_000, T[3], "older"), (2, T[2], None)]), path, "block_number", bucket)
    marks = sinks.read_marks(spark, path)
    assert marks == {"block_number": 5_000, "_inserted_timestamp": T[3]}  # the newest row was replaced

    unreadable = make([(0, T[0], "")]).withColumn("_inserted_timestamp", F.raise_error(F.lit("the table was read")).cast("timestamp_ntz"))
    src = make([(i, T[i], None) for i in range(1, 7)])
    kept = lambda df: sorted(r.block_number for r in df.collect())
    assert kept(inc.since_inclusive(src, unreadable, marks=marks)) == [3, 4, 5, 6]
    assert kept(inc.since_exclusive(src, unreadable, "_inserted_timestamp", marks)) == [4, 5, 6]
    assert kept(inc.since_lookback(src, unreadable, "_inserted_timestamp", 2, marks=marks)) == [1, 2, 3, 4, 5, 6]
    assert inc.recent_join_floor(unreadable, marks=marks) is not None
    assert inc.Run(T[0], marks=marks).knowing(unreadable, "_inserted_timestamp").marks == marks
    with pytest.raises(Exception, match="the table was read"):
        inc.since_inclusive(src, unreadable).count()

    fails = make([(9, T[8], "z")]).withColumn("x", F.when(F.col("block_number") == 9, F.raise_error(F.lit("stop"))).otherwise("x"))
    with pytest.raises(Exception, match="stop"):
        sinks.upsert_table(fails, path, "block_number", bucket)
    again = sinks.read_marks(spark, path)
    assert again.get("_inserted_timestamp", T[3]) == T[3]
    assert kept(inc.since_inclusive(src, sinks.read_table(spark, path), marks=again)) == [3, 4, 5, 6]
    sinks.upsert_table(make([(9, T[4], "z")]), path, "block_number", bucket)
    assert sinks.read_marks(spark, path)["_inserted_timestamp"] == T[4]


def test_marks_after_a_write_that_ended_halfway(spark, tmp_path, monkeypatch):
    """Data committed, marks not: nothing is noted, the table is asked, and the next commit notes all of it."""
    path, bucket = f"{tmp_path}/h", {"bucket": L.bucket_1000("block_number")}
    make = lambda *rows: spark.createDataFrame(rows, "block_number long, _inserted_timestamp timestamp_ntz")
    sinks.upsert_table(make((1, T[1]), (7_000, T[2])), path, "block_number", bucket)
    with monkeypatch.context() as m:
        m.setattr(sinks, "_commit_marks", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            sinks.upsert_table(make((7_000, T[7])), path, "block_number", bucket)
    assert sinks.read_marks(spark, path) == {}
    assert high_water(sinks.read_table(spark, path), "_inserted_timestamp", marks={}) == T[7]
    sinks.upsert_table(make((2, T[3])), path, "block_number", bucket)
    assert sinks.read_marks(spark, path)["_inserted_timestamp"] == T[7]


def test_upsert_wants_a_partition(spark, tmp_path):
    with pytest.raises(ValueError, match="partition"):
        sinks.upsert_table(spark.range(3).toDF("k"), f"{tmp_path}/n", "k", {})


def test_a_repeated_stream_batch_is_added_once(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / d) for d in ("src", "out", "ckpt"))
    spark.range(5).write.parquet(src)
    calls = []

    def sink(df, number):
        sinks.append_once(df, out, number)
        calls.append(number)
        if len(calls) == 1:
            raise RuntimeError("after the commit of the rows")

    go = lambda: run_stream(spark, src, "id long", lambda b: b, sink, ckpt, numbered=True)
    with pytest.raises(Exception, match="after the commit"):
        go()
    go()
    assert calls == [0, 0] and sorted(r.id for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3, 4]
    spark.range(5, 7).write.mode("append").parquet(src)
    go()
    assert calls == [0, 0, 1] and spark.read.parquet(out).count() == 7


def test_bucketed_tables_join_without_moving_rows(spark, tmp_path):
    """Transactions and receipts laid out by (block, hash): their left join, as in the silver plan, has no exchange."""
    keys = ["block_number", "tx_hash"]
    make = lambda n, c: spark.range(n).select((F.col("id") % 97).alias("block_number"), F.col("id").cast("string").alias("tx_hash"), F.lit(1).alias(c))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, df in (("txs_b", make(5_000, "gas")), ("receipts_b", make(4_000, "used"))):
            sinks.write_bucketed(df, name, keys, 8, str(tmp_path / name))
        out = spark.table("txs_b").join(spark.table("receipts_b"), keys, "left")
        assert out.count() == 5_000 and out.filter("used is null").count() == 1_000
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
        per_key = spark.table("txs_b").groupBy(*keys).agg(F.sum("gas"))
        assert per_key.count() == 5_000 and "Exchange" not in per_key._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in ("txs_b", "receipts_b"):
            spark.sql(f"drop table if exists {name}")


def test_small_inputs_are_not_counted(spark, tmp_path):
    """Nothing runs while the plan of a small input is built; a large one is counted by its keys."""
    bad = spark.range(10).select(F.col("id"), F.raise_error(F.lit("it ran")).cast("bigint").alias("k"))
    W.ordinal(bad, "k", ["id"], "n")
    with pytest.raises(Exception, match="it ran"):
        W.ordinal(bad, "k", ["id"], "n", max_rows=2)
    assert W.ordinal(spark.range(100).withColumn("k", F.lit(1)), "k", ["id"], "n", max_rows=20).filter("n <> id + 1").count() == 0


def test_rules_of_a_table(spark):
    t = dt.datetime(2024, 5, 1)
    rows = [(1, t, "0xa", "0xc", 0, False), (2, t, None, "c", 0, False), (2, None, "0xb", None, 2, True)]
    df = spark.createDataFrame(rows, "block_number long, block_timestamp timestamp_ntz, tx_hash string, contract_address string, "
                                     "event_index long, is_pending boolean").withColumn("_log_id", F.lit("x"))
    got = {(r.rule, r.column_name): r.n_failures for r in C.report(df, C.LOGS, t + dt.timedelta(days=9)).collect()}
    assert got[("not_null", "tx_hash")] == 1 and got[("hex", "contract_address")] == 1 and got[("not_null", "block_timestamp")] == 0
    assert got[("unique", "_log_id")] == 1 and got[("recent", "block_timestamp")] == 1 and got[("number", "event_index")] == 0
    assert not any(c == "topics" for _, c in got)
    assert sorted(r.broken for r in C.failing_rows(df, C.LOGS).collect()) == [
        ["not_null contract_address"], ["not_null tx_hash", "hex contract_address"]]
    assert C.report(df.limit(0), C.LOGS, t).filter("n_failures > 0").count() == 1  # nothing recent


def test_newest_documents_stay_where_they_are(spark, tmp_path):
    """Of documents landed twice the newest stays; what is shuffled is keys, times and addresses, no document."""
    t = [dt.datetime(2024, 5, 1, h) for h in range(4)]
    doc = lambda kind: '{"result":{"type":"%s","calls":[{"type":"inner"}]}}' % kind
    rows = [(f'{{"BLOCK_NUMBER":{b},"array_index":0}}', d, None, b, ts) for b, d, ts in (
        (1, doc("old"), t[0]), (1, doc("new"), t[2]), (2, doc("only"), t[1]), (3, doc("kept"), t[1]), (3, '{"result":null}', t[3]), (4, None, t[0]))]
    root = str(tmp_path / "land")
    for i, part in enumerate((rows[:3], rows[3:])):
        spark.createDataFrame(part, landed.ENVELOPE).coalesce(1).write.parquet(f"{root}/a/b/traces/{i}_x")
    src = landed.read_landed(spark, root, root=root, address=True)
    assert src.select("_file", "_row").distinct().count() == 6 and "_metadata" not in src.columns
    out = S.silver_traces(src, None, inc.Run(t[0]))
    root_types = {r.block_number: r.trace_json["type"] for r in out.collect() if r.trace_address == "ORIGIN"}
    assert root_types == {1: "new", 2: "only", 3: "kept"} and out.count() == 6
    plain = S.silver_traces(src.drop("_file", "_row"), None, inc.Run(t[0]))
    assert sorted(map(str, plain.select("block_number", "trace_address", "trace_json").collect())) == sorted(
        map(str, out.select("block_number", "trace_address", "trace_json").collect()))
    shuffles = lambda df: [x for x in df._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hash" in x]
    below = lambda df: df._jdf.queryExecution().optimizedPlan().toString().split("Window")[-1].split("\n")[1]
    assert shuffles(out) and "DATA" not in below(out) and "DATA" in below(plain)
    assert S.silver_blocks(src.withColumn("DATA", F.lit('{"result":{"number":"0x1"}}')), None, inc.Run(t[0])).count() == 4


def test_kept_rows_leave_no_shuffle_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(groups, "_checkpoint_folder", lambda _: str(tmp_path))
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def left():
        blocks = disk.getAllBlocks()
        return sum(blocks.apply(i).isShuffle() for i in range(blocks.length()))
    before, flag = left(), spark.conf.get(groups._CLEANUP, None)
    d = groups.keep(spark.range(20_000).groupBy((F.col("id") % 5_000).alias("k")).count())
    for _ in range(100):  # files are removed in the background
        if left() <= before:
            break
        time.sleep(0.1)
    assert left() <= before and spark.conf.get(groups._CLEANUP, None) == flag
    assert d.count() == 5_000 and d.filter("count <> 4").count() == 0

