"""What a task, the driver and the disk hold must follow the input, not the plan's estimates."""
import os

from pyspark.sql import functions as F

from ledgerloom.operators import groups
from ledgerloom.operators.tree import flatten_tree
from ledgerloom.plans.nft import seaport as Z
from ledgerloom.session import bounded_tasks, measured_broadcasts
from showcase import REGISTRY, chain

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_broadcast_by_estimate(spark):
    estimated, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = {k: spark.conf.get(k, None) for k in (estimated, measured)}
    try:
        spark.conf.set(estimated, "5MB")
        spark.conf.unset(measured)
        assert "BroadcastHashJoin" not in plan(REGISTRY["gold_transactions"][0](spark, FOLDER))
        assert spark.conf.get(estimated) == "-1" and spark.conf.get(measured) == "5MB"
        measured_broadcasts(spark)
        assert spark.conf.get(measured) == "5MB"
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_kept_rows_are_a_compressed_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(groups, "_checkpoint_folder", lambda spark: str(tmp_path))
    rows = spark.range(20_000).select("id", F.lpad(F.hex("id"), 1_000, "0").alias("text"),
                                      F.create_map(F.lit("k"), F.col("id").cast("string")).alias("m"))
    kept = groups.keep(rows)
    assert sorted(map(str, kept.collect())) == sorted(map(str, rows.collect())) and kept.dtypes == rows.dtypes
    held = sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(tmp_path) for f in fs)
    assert 0 < held < 20_000 * 1_000 / 10


def test_a_task_sorts_a_bounded_part_of_a_shuffle(spark):
    """Shuffles start from more partitions than a session names, and few bytes of them are merged; its own choice stays."""
    start, size = (f"spark.sql.adaptive.{k}" for k in ("coalescePartitions.initialPartitionNum", "advisoryPartitionSizeInBytes"))
    before, parallel = {k: spark.conf.getAll.get(k) for k in (start, size)}, "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    rows = spark.range(200_000).select(F.xxhash64("id").alias("id"), F.sha2(F.col("id").cast("string"), 512).alias("text"))  # 20 MB shuffled
    tasks = lambda: rows.groupBy("id").agg(F.max("text")).rdd.getNumPartitions()
    try:
        spark.conf.unset(start), spark.conf.unset(size)
        spark.conf.set(parallel, "100KB")
        REGISTRY["expected_blocks"][0](spark, FOLDER)
        assert spark.conf.get(start) == "400" and spark.conf.get(size) == "16MB"
        spark.conf.set(size, "1MB")
        bounded_tasks(spark)
        assert spark.conf.get(size) == "1MB" and tasks() > 10  # 4 by the session's shuffle partitions
    finally:
        spark.conf.unset(parallel)
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_tasks_follow_the_size_of_the_files(spark, monkeypatch):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    monkeypatch.setattr(chain, "SPREAD_BYTES", groups.estimated_bytes(orders) // 50)
    assert chain.spread(orders, "o_orderkey").rdd.getNumPartitions() >= 50


def test_matched_pairs_parse_orders_once(spark):
    """A listing and its bid, listed by two match events: one sale a pair; an unknown hash and a null one match nothing."""
    item = lambda kind, token, n, to: f'{{"itemType":"{kind}","token":"{token}","identifier":"7","amount":"{n}","recipient":"{to}"}}'

    def order(h, offerer, recipient, offer, asks):
        h = "null" if h is None else f'"{h}"'
        return (f'{{"orderHash":{h},"offerer":"{offerer}","recipient":"{recipient}","zone":"z","offer":[{offer}],"consideration":[{asks}]}}')

    nft, fee = lambda to: item(2, "0xn", 1, to), Z.FEE_WALLETS[0]
    listing = lambda h: order(h, "s", "b", nft("s"), item(1, "0xc", 90, "s") + "," + item(1, "0xc", 4, fee))
    bid = lambda h: order(h, "b", "s", item(1, "0xc", 100, "b"), nft("b") + "," + item(1, "0xc", 6, "x"))
    log = [("t", i, "OrderFulfilled", "0xa", doc) for i, doc in enumerate([listing("0x1"), bid("0x2"), bid("0x9"), bid(None)])]
    decoded = spark.createDataFrame(log, "tx_hash string, event_index long, event_name string, contract_address string, decoded_log string") \
        .withColumn("modified_timestamp", F.lit("2024-01-01").cast("timestamp_ntz"))
    pairs = spark.createDataFrame([("t", [("p", "0x1", "0x2"), ("q", "0x2", "0x1"), ("r", "0x5", None)])],
                                  "tx_hash string, pairs array<struct<pair:string,orderhash_1:string,orderhash_2:string>>")
    out = Z.matched_pair(decoded, pairs)
    rows = out.select("orderhash", "offerer", "recipient", "tokenid", *[F.col(c).cast("double") for c in
                      ("total_sale_amount_raw", "platform_fee_raw", "creator_fee_raw")]).collect()
    assert [tuple(r) for r in rows] == [("0x2", "s", "b", "7", 100.0, 4.0, 6.0)] * 2
    assert plan(out).count("Scan ExistingRDD") == 2  # the orders and the pairs, each read once


def test_matched_orders_are_dealt_once(spark):
    """However many partitions a session's shuffles start from, orders and facts are each dealt once by transaction, and merged."""
    start = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.getAll.get(start)
    orders = spark.range(1_000).select(F.col("id").cast("string").alias("tx_hash"), F.lit(1).cast("bigint").alias("event_index"),
                                       F.lit("0x1").alias("orderhash"), F.lit("0x2").alias("other"))
    of = lambda *hashes: orders.groupBy("tx_hash").agg(*hashes)
    listed = F.collect_set("orderhash").alias("matched")
    facts = of(F.array(F.lit(2).cast("bigint")).alias("matches"), listed,
               F.collect_list(F.struct("event_index", "orderhash")).alias("filled"))
    pairs = of(F.collect_list(F.struct(F.lit("p").alias("pair"), F.col("orderhash").alias("orderhash_1"),
                                       F.col("other").alias("orderhash_2"))).alias("pairs"))
    try:
        spark.conf.set(start, "50")
        for out in (Z.in_groups(orders, facts), Z.in_pairs(orders, pairs)):
            assert plan(out).count("Exchange hashpartitioning(tx_hash") == 2 and "REPARTITION_BY_NUM" not in plan(out)
            assert out.count() == 1_000 and out.rdd.getNumPartitions() < 50
    finally:
        spark.conf.unset(start) if before is None else spark.conf.set(start, before)


def test_deep_trees_use_every_core(spark, monkeypatch):
    """A table of few bytes holds many payloads: it is dealt before they are built, and read by no filter before that."""
    out = REGISTRY["fn_flatten_recursive"][0](spark, FOLDER)
    assert out.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert plan(out).index("ArrowEvalPython") < plan(out).index("REPARTITION_BY_NUM")  # plans are printed from the last step on
    suppliers = spark.read.parquet(f"{FOLDER}/supplier.parquet").select("s_suppkey")
    monkeypatch.setattr(chain, "SPREAD_BYTES", groups.estimated_bytes(suppliers))
    assert chain.spread(suppliers, "s_suppkey", groups.estimated_bytes(suppliers) // 50).rdd.getNumPartitions() >= 50


def test_parents_of_long_paths(spark):
    leaf = lambda n: '{"calls":[' + ",".join(["{}"] * n) + "]}"
    rows = spark.createDataFrame([(1, '{"calls":[' + ",".join([leaf(0)] * 11 + [leaf(12)]) + "]}")], "id int, doc string")
    out = {r["trace_address"]: r["parent_trace_address"] for r in flatten_tree(rows, "doc", "id").collect()}
    assert out == {"ORIGIN": None, **{str(i): "ORIGIN" for i in range(12)}, **{f"11_{i}": "11" for i in range(12)}}


def test_what_a_step_shuffles_goes_before_the_next(spark, tmp_path, monkeypatch):
    """Markets and both sides of the call trees are kept tables, so their shuffles do not add up with the last step's."""
    monkeypatch.setattr(groups, "_checkpoint_folder", lambda spark: str(tmp_path))
    for name, raw in (("sales_complete_markets", "decoded_log"), ("gold_traces", "TX_HASH")):
        assert raw not in plan(REGISTRY[name][0](spark, FOLDER))
