"""Sinks, landed files, streams and late data, on files."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom import functions as L
from ledgerloom.operators import quality as Q
from ledgerloom.operators.incremental import Run
from ledgerloom.plans import gold as G, ingest as I, silver as S
from ledgerloom.sources import landed, sinks
from ledgerloom.streaming import run_stream

RUN = Run(dt.datetime(2024, 5, 1), "t")


def bucket():
    return {"bucket": L.bucket_1000("block_number")}




def batch(spark, rows):
    return spark.createDataFrame(rows, "block_number bigint, x string")


def rows_of(spark, path):
    return sorted((r.block_number, r.x) for r in sinks.read_table(spark, path).select("block_number", "x").collect())


def test_delete_insert_replaces_whole_blocks(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.read_table(spark, path) is None
    sinks.upsert_table(batch(spark, [(1, "a"), (1, "b"), (2, "c"), (5000, "far")]), path, "block_number", bucket())
    again = batch(spark, [(1, "new"), (3, "d")])
    for _ in range(2):  # a repeated batch changes nothing
        sinks.upsert_table(again, path, "block_number", bucket())
        assert rows_of(spark, path) == [(1, "new"), (2, "c"), (3, "d"), (5000, "far")]


def test_merge_partial_keeps_other_columns(spark, tmp_path):
    path = str(tmp_path / "m")
    make = lambda rows: spark.createDataFrame(rows, "block_number bigint, a string, b string")
    sinks.upsert_table(make([(1, "a1", "b1"), (2, "a2", "b2")]), path, "block_number", bucket())
    sinks.upsert_table(make([(1, "A", "B"), (3, "a3", "b3")]), path, "block_number", bucket(), update_cols=["a"])
    got = sorted((r.block_number, r.a, r.b) for r in sinks.read_table(spark, path).collect())
    assert got == [(1, "A", "b1"), (2, "a2", "b2"), (3, "a3", "b3")]


def test_new_columns_widen_the_table(spark, tmp_path):
    path = str(tmp_path / "e")
    sinks.upsert_table(batch(spark, [(1, "a")]), path, "block_number", bucket())
    sinks.upsert_table(batch(spark, [(7000, "b")]).withColumn("y", F.lit(1)), path, "block_number", bucket())
    got = {(r.block_number, r.y) for r in sinks.read_table(spark, path).collect()}
    assert got == {(1, None), (7000, 1)}


def test_range_pruned_merge_leaves_far_rows(spark):
    make = lambda rows: spark.createDataFrame(rows, "k bigint, d int, x string")
    out = sinks.range_pruned_merge(make([(1, 10, "old"), (2, 99, "far")]), make([(1, 10, "new"), (2, 11, "twice")]), "k", "d")
    assert sorted((r.k, r.x) for r in out.collect()) == [(1, "new"), (2, "far"), (2, "twice")]


def test_landed_files_and_partition_number(spark, tmp_path):
    root = tmp_path / "land"
    for n in (21248000, 21249000):
        spark.createDataFrame([(n,)], "block_number bigint").write.json(str(root / "a" / "b" / "blocks" / f"{n}_x"))
    df = landed.read_landed(spark, str(root), root=str(root), fmt="json", schema="block_number bigint")
    assert {(r.block_number, r.partition_key) for r in df.collect()} == {(21248000, 21248000), (21249000, 21249000)}
    assert landed.read_landed(spark, str(root), since=dt.datetime(2100, 1, 1), root=str(root), fmt="json",
                              schema="block_number bigint").count() == 0


def land_blocks(spark, numbers, ts, miner):
    make = lambda n: (f'{{"BLOCK_NUMBER":{n}}}',
                      f'{{"result":{{"number":"{hex(n)}","hash":"0x{n}","miner":"{miner}","timestamp":"0x{1_714_000_000 + n:x}","transactions":["0x{n}t"],"uncles":[]}}}}',
                      None, n, ts)
    return spark.createDataFrame([make(n) for n in numbers], landed.ENVELOPE)


def test_stream_over_landed_files_equals_one_batch(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / d) for d in ("src", "out", "ckpt"))
    t = lambda h: dt.datetime(2024, 5, 1, h)
    first, second = land_blocks(spark, [1, 2, 3], t(1), "old"), land_blocks(spark, [3, 4], t(2), "new")

    def sink(df):
        sinks.upsert_table(df, out, "block_number", bucket(), merge=True)

    for part in (first, second):
        part.write.mode("append").parquet(src)
        run_stream(spark, src, landed.ENVELOPE, lambda b: S.silver_blocks(b, sinks.read_table(spark, out), RUN), sink, ckpt)
    got = sorted((r.block_number, r.miner) for r in sinks.read_table(spark, out).collect())
    whole = S.silver_blocks(first.unionByName(second), None, RUN)
    assert got == sorted((r.block_number, r.miner) for r in whole.collect()) == [(1, "old"), (2, "old"), (3, "new"), (4, "new")]


def land(spark, rows):
    return spark.createDataFrame([(f'{{"BLOCK_NUMBER":{b},"array_index":0}}', data, None, b, ts) for b, data, ts in rows], landed.ENVELOPE)


def receipt(b, status='"0x1"', to="0xt", gas='"0x5208"', inner=None):
    return (f'{{"blockHash":"0xh","blockNumber":"{hex(inner or b)}","effectiveGasPrice":"{hex(25 * 10**9)}","from":"0xf",'
            f'"gasUsed":{gas},"status":{status},"to":"{to}","transactionHash":"0x{b}t","transactionIndex":"0x0","type":"0x2",'
            f'"logs":[{{"address":"0xc","blockHash":"0xh","data":"0x","logIndex":"0x0","removed":false,"topics":["0x1","0x2"]}}]}}')


def tx(b):
    return (f'{{"blockHash":"0xh","blockNumber":"{hex(b)}","from":"0xf","gas":"0x5208","gasPrice":"{hex(25 * 10**9)}","hash":"0x{b}t",'
            f'"input":"0xa9059cbb0000","value":"{hex(15 * 10**17)}","nonce":"0x1","to":"","transactionIndex":"0x0","type":"0x2"}}')


def test_receipt_rules(spark):
    t = dt.datetime(2024, 5, 1)
    rows = land(spark, [(1, receipt(1, status="null", to=""), t), (2, receipt(2, gas="null"), t), (3, receipt(3, inner=9), t),
                        (4, "[1]", t)])
    got = {r.block_number: r for r in S.silver_receipts(rows, None, RUN).collect()}
    assert set(got) == {1, 2}
    assert got[1].tx_status is False and got[1].to_address is None and got[2].gas_used == 0
    assert got[2].effective_gas_price == 25.0


def test_late_blocks_and_receipts_heal(spark):
    """A transaction before its block and receipt, then both arrive: the
    incremental result equals a full build."""
    t1, t2 = dt.datetime(2024, 5, 1, 1), dt.datetime(2024, 5, 1, 2)
    txs = land(spark, [(1, tx(1), t1)])
    none_r = S.silver_receipts(land(spark, [(9, receipt(9), t1)]), None, RUN)
    none_b = S.silver_blocks(land_blocks(spark, [9], t1, "m"), None, RUN)
    first = S.silver_transactions(txs, none_b, none_r, None, RUN)
    assert first.first().is_pending and first.first().tx_fee == 0.0
    logs_first = S.silver_logs(S.silver_receipts(land(spark, [(1, receipt(1), t1)]), None, RUN), first, None, RUN)
    assert logs_first.first().is_pending

    blocks, receipts = S.silver_blocks(land_blocks(spark, [1], t2, "m"), None, RUN), S.silver_receipts(land(spark, [(1, receipt(1), t2)]), None, RUN)
    healed = S.silver_transactions(land(spark, [(2, tx(2), t2)]), blocks, receipts, first, RUN)
    full = S.silver_transactions(txs, blocks, receipts, None, RUN)
    cols = ["tx_hash", "block_timestamp", "is_pending", "gas_used", "tx_fee", "tx_fee_precise", "value_precise", "to_address"]
    row = lambda d: d.filter("block_number = 1").select(*cols).first()
    assert row(healed) == row(full)
    assert row(full).tx_fee_precise == "0.000525" and row(full).value_precise == "1.5" and row(full).to_address is None
    logs = S.silver_logs(receipts.limit(0), healed, logs_first, RUN).first()
    assert not logs.is_pending and logs.origin_function_signature == "0xa9059cbb"
    published = G.gold_event_logs(logs_first, None).first()
    assert (published.topic_1, published.topic_2) == ("0x2", None)


def test_traces_walk_any_depth_and_heal(spark):
    deep = '{"type":"CALL","from":"0xa","error":"x"}'
    for i in range(150):
        deep = f'{{"type":"CALL","from":"0x{i}","value":"0x1","calls":[{deep}]}}'
    t = dt.datetime(2024, 5, 1)
    rows = land(spark, [(1, f'{{"result":{deep}}}', t)]).withColumn("partition_key", F.lit(0))
    silver = S.silver_traces(rows, None, RUN)
    assert silver.count() == 151
    assert silver.filter("parent_trace_address is null").count() == 1
    txs = S.silver_transactions(land(spark, [(1, tx(1), t)]), S.silver_blocks(land_blocks(spark, [1], t, "m"), None, RUN),
                                S.silver_receipts(land(spark, [(1, receipt(1), t)]), None, RUN), None, RUN)
    early = G.gold_traces(silver, txs.limit(0), None, RUN)
    assert early.filter("tx_hash is null").count() == 151
    late = G.gold_traces(silver.filter("false"), txs, early, RUN)
    assert late.count() == 151 and late.filter("tx_hash = '0x1t' and tx_succeeded").count() == 151
    full = {r.trace_address: r for r in G.gold_traces(silver, txs, None, RUN).collect()}
    assert full["ORIGIN"].trace_succeeded and not [r for r in full.values() if r.error_reason][0].trace_succeeded
    assert full["0_0"].sub_traces == 1 and full["0_0"].trace_index == 2


def test_backlog_is_expected_minus_done(spark):
    look = spark.createDataFrame([(105,)], "block_number bigint")
    done = spark.createDataFrame([(106,), (103,)], "block_number bigint")
    got = I.backlog_realtime("traces", I.expected_blocks(spark, 108, 100), done, look).collect()
    assert [r.block_number for r in got] == [108, 107, 105]
    assert got[0].request == ('{"id":"108","jsonrpc":"2.0","method":"debug_traceBlockByNumber",'
                              '"params":["0x6c",{"tracer":"callTracer","timeout":"180s"}]}')
    assert [r.block_number for r in I.backlog_history("blocks", I.expected_blocks(spark, 108, 100), done, look).collect()] == [101, 102, 104]


def test_quality_on_pipeline_output(spark, tmp_path):
    d = spark.createDataFrame([(1, "0xab"), (2, "0xcd"), (5, "zz"), (250_000, None)], "block_number bigint, hash string")
    assert Q.unique(d, "block_number").count() == 0
    gaps = {(r.previous_value, r.current_value, r.missing) for r in Q.sequence_gaps(d, "block_number").collect()}
    assert gaps == {(2, 5, 2), (5, 250_000, 249_994)}
    assert Q.matches(d, "hash", "0[xX][0-9a-fA-F]+").count() == 1 and Q.not_null(d, "hash").count() == 1
    assert Q.type_in(d, "hash", ["bigint"]).count() == 1 and Q.type_in(d, "hash", ["string"]).count() == 0
    Q.store_failures(Q.not_null(d, "hash"), str(tmp_path / "bad"))
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 1
