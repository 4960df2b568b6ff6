"""Sources and sinks. Sinks are shown in their pure form: the new target."""
from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import functions as F

from ledgerloom.operators import incremental as I
from ledgerloom import functions as L
from ledgerloom.sources import (aggregator_rows, clustered, delete_insert, evolve, literal, merge_upsert,
                                range_pruned_merge, read_table, upsert_table)
from ledgerloom.sources.landed import read_landed
from ledgerloom.sources.constants import FEE_WALLETS
from ledgerloom.streaming import run_stream
from . import chain
from .base import query, shared_folder, table
from .chain import BLOCK_SQL, TX_SQL


@query("src_landed_recent", """
  select event_id, 21248000 + event_id % 4 * 1000 as partition_key from events where event_id % 4 >= 2""")
def src_landed_recent(spark, sf):
    """Events landed in four folders named by number; two of them before the time asked for."""
    root, e = f"{shared_folder(spark)}/raw/blocks", table(spark, sf, "events")
    since = None
    for k in range(4):
        if k == 2:
            time.sleep(2)
            since = dt.datetime.now(dt.timezone.utc).replace(microsecond=0, tzinfo=None)
        e.filter(F.col("event_id") % 4 == k).write.parquet(f"{root}/{21_248_000 + k * 1000}_x")
    return read_landed(spark, root, since=since).select("event_id", "partition_key")


@query("src_landed_full", "select user_id, count(*) as n, min(ts) as first_ts from events group by user_id")
def src_landed_full(spark, sf):
    e = read_landed(spark, f"{sf}/events.parquet", since=dt.datetime(2100, 1, 1), full=True, root=sf)
    return e.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"))


@query("src_number_sequence", "select x as block_number from unnest(range(101, (select max(o_orderkey) + 1 from orders))) t(x)")
def src_number_sequence(spark, sf):
    top = table(spark, sf, "orders").agg(F.max("o_orderkey")).first()[0]
    return I.number_sequence(spark, 100, top)


@query("src_values", """
  with ids(k, id, aggregator, is_wallet) as (values
    (0, '0', '0', false), (1, '0x0000000000000000000000000000000000000000', 'name', false),
    (2, '0x0000a26b00c1f0df003000390027140000faa719', null, true), (3, '0x8de9c5a032463c561423387a9648c5c7bcc5bc90', null, true),
    (4, '0x5b3256965e7c3cf26e11fcaf296dfc8807c01073', null, true))
  select s_suppkey, id, aggregator, coalesce(is_wallet, false) as is_wallet from supplier left join ids on s_suppkey % 6 = k""")
def src_values(spark, sf):
    """Suppliers under the placeholder labels' and fee wallets' addresses in turn, every sixth under none."""
    labels, wallets = aggregator_rows(spark), literal(spark, [(w, True) for w in FEE_WALLETS], "id string, w boolean")
    known = [r[0] for r in labels.select("aggregator_identifier").orderBy("aggregator_identifier").collect()] + FEE_WALLETS
    s = table(spark, sf, "supplier").withColumn("id", F.get(F.array(*map(F.lit, known)), (F.col("s_suppkey") % 6).cast("int")))
    return (s.join(F.broadcast(labels.withColumnRenamed("aggregator_identifier", "id")), "id", "left")
            .join(F.broadcast(wallets), "id", "left")
            .select("s_suppkey", "id", "aggregator", F.coalesce("w", F.lit(False)).alias("is_wallet")))


@query("src_explode_txs", f"""
  select {BLOCK_SQL} as block_number, {TX_SQL} as tx_hash from orders
  union all select {BLOCK_SQL}, printf('0x%064x', o_orderkey + 1099511627776) from orders""")
def src_explode_txs(spark, sf):
    from ledgerloom.plans.ingest import expected_txs
    o = chain.orders(spark, sf)
    return expected_txs(o.select("block_number", F.array("tx_hash", chain.hx(F.col("o_orderkey") + 2 ** 40, 64)).alias("transactions")))


LINE = ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_quantity"]
OLD = "l_linestatus = 'F'"
NEW = "l_linestatus = 'O'"


def halves(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.filter(OLD).select(*LINE), li.filter(NEW).select(*LINE)


@query("sink_delete_insert", f"""
  select {', '.join(LINE)} from lineitem where {NEW}
  union all select {', '.join(LINE)} from lineitem where {OLD} and l_orderkey not in (select l_orderkey from lineitem where {NEW})""")
def sink_delete_insert(spark, sf):
    return delete_insert(*halves(spark, sf), "l_orderkey")


TARGET = "(select o_orderkey, o_custkey, o_totalprice, o_orderdate, 'old' as state from orders where o_orderdate < timestamp '2000-01-01')"
BATCH = "(select o_orderkey, o_custkey + 1 as o_custkey, o_totalprice, o_orderdate, 'new' as state from orders where o_orderdate >= timestamp '1998-01-01')"


def versions(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    at = lambda d: F.lit(d).cast("timestamp_ntz")
    return (o.filter(F.col("o_orderdate") < at("2000-01-01")).withColumn("state", F.lit("old")),
            o.filter(F.col("o_orderdate") >= at("1998-01-01")).withColumns({"o_custkey": F.col("o_custkey") + 1, "state": F.lit("new")}))


@query("sink_merge_upsert", f"""
  select * from {BATCH} union all select * from {TARGET} where o_orderkey not in (select o_orderkey from {BATCH})""")
def sink_merge_upsert(spark, sf):
    return merge_upsert(*versions(spark, sf), "o_orderkey")


@query("sink_merge_partial", f"""
  select coalesce(t.o_orderkey, b.o_orderkey) as o_orderkey, case when b.o_orderkey is not null then b.o_custkey else t.o_custkey end as o_custkey,
         coalesce(t.o_totalprice, b.o_totalprice) as o_totalprice, coalesce(t.o_orderdate, b.o_orderdate) as o_orderdate,
         coalesce(t.state, b.state) as state
  from {TARGET} t full join {BATCH} b on t.o_orderkey = b.o_orderkey""")
def sink_merge_partial(spark, sf):
    return merge_upsert(*versions(spark, sf), "o_orderkey", update_cols=["o_custkey"])


@query("sink_merge_keep", f"""
  select coalesce(t.o_orderkey, b.o_orderkey) as o_orderkey, case when b.o_orderkey is not null then b.o_custkey else t.o_custkey end as o_custkey,
         coalesce(t.o_totalprice, b.o_totalprice) as o_totalprice, coalesce(t.o_orderdate, b.o_orderdate) as o_orderdate,
         coalesce(t.state, b.state) as state
  from {TARGET} t full join {BATCH} b on t.o_orderkey = b.o_orderkey""")
def sink_merge_keep(spark, sf):
    return merge_upsert(*versions(spark, sf), "o_orderkey", keep_cols=["state"])


@query("sink_range_pruned_merge", f"""
  select * from {BATCH}
  union all select * from {TARGET} where o_orderkey not in (select o_orderkey from {BATCH})
     or o_orderdate < (select min(o_orderdate) from {BATCH}) or o_orderdate > (select max(o_orderdate) from {BATCH})""")
def sink_range_pruned_merge(spark, sf):
    return range_pruned_merge(*versions(spark, sf), "o_orderkey", "o_orderdate")


@query("sink_clustered", """
  select o_orderkey, cast(round(o_orderkey, -3) as bigint) as bucket, cast(o_orderdate as date) as day from orders""")
def sink_clustered(spark, sf):
    out = clustered(table(spark, sf, "orders"), {"bucket": L.bucket_1000("o_orderkey")}, ["o_orderkey"])
    return out.select("o_orderkey", "bucket", F.to_date("o_orderdate").alias("day"))


@query("sink_append_new_columns", """
  select l_orderkey, l_quantity, null as l_tax, 'old' as side from lineitem where l_linestatus = 'F'
  union all select l_orderkey, l_quantity, l_tax, null from lineitem where l_linestatus = 'O'""")
def sink_append_new_columns(spark, sf):
    li = table(spark, sf, "lineitem")
    return evolve(li.filter(OLD).select("l_orderkey", "l_quantity", F.lit("old").alias("side")),
                  li.filter(NEW).select("l_orderkey", "l_quantity", "l_tax"))


@query("sink_delete_insert_table", f"""
  select l_orderkey, l_linenumber, l_partkey, l_quantity from lineitem where {NEW}
  union all select l_orderkey, l_linenumber, l_partkey, l_quantity from lineitem
  where {OLD} and l_orderkey not in (select l_orderkey from lineitem where {NEW})""")
def sink_delete_insert_table(spark, sf):
    """The same update on a partitioned table: two writes, then a read."""
    path, cols = f"{shared_folder(spark)}/lines", ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]
    for part in halves(spark, sf):
        upsert_table(part.select(*cols), path, "l_orderkey", {"bucket": L.bucket_1000("l_orderkey")})
    return read_table(spark, path).select(*cols)


@query("stream_micro_batch", """
  select event_id, user_id, event_type, cast(json_extract_string(props, '$.k') as bigint) as k from events""")
def stream_micro_batch(spark, sf):
    """Landed event files as a stream into a table, run twice: the second run
    finds nothing new."""
    folder = shared_folder(spark)
    schema = table(spark, sf, "events").schema
    for _ in range(2):
        run_stream(spark, f"{sf}/event*.parquet", schema,
                   lambda b: b.select("event_id", "user_id", "event_type", L.jget("props", "$.k", "bigint").alias("k")),
                   lambda b: upsert_table(b, f"{folder}/table", "event_id", {"bucket": L.bucket_1000("event_id")}),
                   f"{folder}/progress")
    return read_table(spark, f"{folder}/table").drop("bucket")
