"""Incremental operators: orders up to a date are the target, later ones the batch."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom import functions as L
from ledgerloom.operators import incremental as I, joins as J
from ledgerloom.operators.windows import latest_complete
from . import chain, nft
from .base import query, table
from .chain import BLOCK_SQL, RUN, TX_SQL

SPLIT = "1999-01-01"


def split(df, ts="o_orderdate"):
    at = F.lit(SPLIT).cast("timestamp_ntz")
    return df.filter(F.col(ts) < at), df


@query("inc_hwm_inclusive", f"""
  select o_orderkey, o_orderdate from orders where o_orderdate >= (select max(o_orderdate) from orders where o_orderdate < timestamp '{SPLIT}')""")
def inc_hwm_inclusive(spark, sf):
    target, src = split(table(spark, sf, "orders"))
    return I.since_inclusive(src, target, "o_orderdate").select("o_orderkey", "o_orderdate")


@query("inc_hwm_exclusive", f"""
  select o_orderkey, o_orderdate from orders where o_orderdate > (select max(o_orderdate) from orders where o_orderdate < timestamp '{SPLIT}')""")
def inc_hwm_exclusive(spark, sf):
    target, src = split(table(spark, sf, "orders"))
    return I.since_exclusive(src, target, "o_orderdate").select("o_orderkey", "o_orderdate")


@query("inc_hwm_lookback", f"""
  select event_id, ts from events where ts >= (select max(ts) - interval 12 hour from events where event_type = 'click')""")
def inc_hwm_lookback(spark, sf):
    e = table(spark, sf, "events")
    return I.since_lookback(e, e.filter("event_type = 'click'"), "ts", 12).select("event_id", "ts")


@query("inc_hard_floor", "select event_id from events where ts >= timestamp '2024-01-18 00:00:00'")
def inc_hard_floor(spark, sf):
    return I.floor_days(table(spark, sf, "events"), "ts", dt.datetime(2024, 1, 25), 7).select("event_id")


@query("inc_range_backfill", """
  select event_id from events where event_id between (select max(event_id) from events where event_type = 'click') - 1000
         and (select max(event_id) from events where event_type = 'click') + 2000""")
def inc_range_backfill(spark, sf):
    e = table(spark, sf, "events")
    return I.backfill_slice(e, e.filter("event_type = 'click'"), "event_id", 1000, 2000, 0).select("event_id")


def tx_shaped(spark, sf):
    """Target transactions: status P lack block and receipt; a third of all."""
    o = chain.orders(spark, sf)
    late = F.col("o_orderstatus") == "P"
    hide = lambda c: F.when(~late, c)
    return o, o.select(
        "block_number", "tx_hash", F.lit(0).cast("bigint").alias("position"), hide(F.col("o_orderdate")).alias("block_timestamp"),
        late.alias("is_pending"), hide(F.col("cents")).alias("gas_used"), hide(F.lit(True)).alias("tx_status"),
        hide(F.col("cents")).alias("cumulative_gas_used"), hide(F.lit(1.0)).alias("effective_gas_price"),
        hide(F.lit(2).cast("bigint")).alias("tx_type"), F.lit(None).cast("string").alias("tx_fee_precise"),
        F.lit(0.0).alias("tx_fee"), F.col("o_orderdate").alias("_inserted_timestamp"),
        hide(F.lit("0xa9059cbb")).alias("origin_function_signature"))


def block_side(o, days=5):
    return o.select("block_number", F.col("o_orderdate").alias("block_timestamp"),
                    F.expr(f"o_orderdate + make_dt_interval({days})").alias("_inserted_timestamp"))


@query("inc_heal_pending_tx", f"""
  select {BLOCK_SQL} as block_number, o_orderstatus = 'P' and o_orderpriority = '1-URGENT' as is_pending,
         case when not (o_orderstatus = 'P' and o_orderpriority = '1-URGENT') then o_orderdate end as block_timestamp,
         case when o_orderstatus = 'P' and o_orderpriority <> '1-URGENT' then o_orderdate + interval 9 day else o_orderdate end as _inserted_timestamp,
         case when o_orderstatus = 'P' and o_orderpriority <> '1-URGENT' then cast(o_custkey as double) * 1000 / 1e9 else 0 end as tx_fee
  from orders""")
def inc_heal_pending_tx(spark, sf):
    """Receipts of all but 1-URGENT orders have arrived by now."""
    o, target = tx_shaped(spark, sf)
    receipts = o.filter("o_orderpriority <> '1-URGENT'").select(
        "block_number", "tx_hash", F.lit(1000).cast("bigint").alias("gas_used"), F.lit(True).alias("tx_status"),
        F.col("cents").alias("cumulative_gas_used"), F.col("o_custkey").cast("double").alias("effective_gas_price"),
        F.lit(2).cast("bigint").alias("type"), F.expr("o_orderdate + make_dt_interval(9)").alias("_inserted_timestamp"))
    out = I.heal_tx(target, target, block_side(o), receipts)
    return latest_complete(out, ["block_number", "position"], "_inserted_timestamp", "is_pending").select(
        "block_number", "is_pending", "block_timestamp", "_inserted_timestamp", "tx_fee")


@query("inc_heal_pending_logs", f"""
  select {BLOCK_SQL} as block_number, o_orderstatus = 'P' and o_orderpriority = '1-URGENT' as is_pending,
         case when o_orderstatus = 'P' and o_orderpriority <> '1-URGENT' then o_orderdate + interval 5 day else o_orderdate end as _inserted_timestamp
  from orders""")
def inc_heal_pending_logs(spark, sf):
    o, target = tx_shaped(spark, sf)
    target = target.withColumn("event_index", F.lit(0).cast("bigint"))
    txs = block_side(o.filter("o_orderpriority <> '1-URGENT'")).withColumns({
        "tx_hash": L.int_to_hex(F.col("block_number") - chain.BASE), "origin_function_signature": F.lit("0xa9059cbb")})
    txs = txs.withColumn("tx_hash", chain.hx(F.col("block_number") - chain.BASE, 64))
    out = I.heal_logs(target, target, txs)
    return latest_complete(out, ["block_number", "event_index"], "_inserted_timestamp", "is_pending").select(
        "block_number", "is_pending", "_inserted_timestamp")


@query("inc_heal_missing_traces", f"""
  select {BLOCK_SQL} as block_number, {TX_SQL} as tx_hash, true as tx_succeeded from orders
  where o_orderstatus = 'P' and o_orderdate >= timestamp '2000-12-18'""")
def inc_heal_missing_traces(spark, sf):
    o, target = tx_shaped(spark, sf)
    late = F.col("is_pending")
    target = target.select("block_number", F.col("position").alias("tx_position"), F.when(~late, F.col("tx_hash")).alias("tx_hash"),
                           "block_timestamp", "origin_function_signature", F.lit(None).cast("string").alias("origin_from_address"),
                           F.lit(None).cast("string").alias("origin_to_address"), F.col("tx_status").alias("tx_succeeded"))
    txs = o.select("block_number", F.lit(0).cast("bigint").alias("position"), "tx_hash", F.col("o_orderdate").alias("block_timestamp"),
                   F.lit("0xa9059cbb").alias("origin_function_signature"), chain.hx("o_custkey", 40).alias("from_address"),
                   chain.hx("o_orderkey", 40).alias("to_address"), F.lit(True).alias("tx_status"))
    return I.heal_traces(target, txs, dt.datetime(2001, 1, 1)).select("block_number", "tx_hash", "tx_succeeded")


@query("inc_heal_attributes", """
  with t as (select o_orderkey, o_custkey, o_orderdate, o_custkey % 10 as d, case when o_orderstatus <> 'P' then 'known' end as project,
                    case when o_orderstatus = 'F' then 'agg' end as aggregator from orders),
  old as (select * from t where o_orderdate < (select max(o_orderdate) from orders) - interval 4 hour)
  select o_orderkey from t where o_orderkey in (
    select o_orderkey from old where project is null and o_custkey in (select p_partkey from part where p_size > 10)
    union select o_orderkey from old where aggregator is null and d in (1, 3, 5, 7, 9) and d < (select count(*) from supplier)
    union select o_orderkey from old where d = 9)""")
def inc_heal_attributes(spark, sf):
    o = table(spark, sf, "orders")
    target = o.select(
        F.col("o_orderkey").alias("block_number"), F.col("o_orderdate").alias("_inserted_timestamp"),
        F.when(F.col("o_orderstatus") != "P", "known").alias("project_name"),
        F.when(F.col("o_orderstatus") == "F", "agg").alias("aggregator_name"),
        chain.hx("o_custkey", 40).alias("nft_address"),
        F.concat(F.lit("0x"), F.lpad(F.hex(F.col("o_custkey") % 10), 8, "0")).alias("input_data"),
        F.when(F.col("o_custkey") % 10 == 9, "0x02").otherwise("0x01").alias("origin_to_address"))
    return I.heal_sales(target, nft.contracts(spark, sf, "2003-01-01"), nft.aggregators(spark, sf, "2003-01-01"),
                        dt.datetime(2003, 1, 2)).select(F.col("block_number").alias("o_orderkey"))


@query("inc_heal_skip", f"""
  select 'a' as source, count(*) as n from orders
  union all select 'b', count(*) from orders where o_orderdate >= (select max(o_orderdate) from orders where o_orderdate < timestamp '{SPLIT}') - interval 4 hour""")
def inc_heal_skip(spark, sf):
    target, src = split(table(spark, sf, "orders"))
    both = [I.incremental_or_full(src, target, n, {"a"}, "o_orderdate").agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("source"), "n")
            for n in ("a", "b")]
    return both[0].unionByName(both[1])


@query("inc_overflow_union", """
  select l_orderkey as block_number, l_linenumber, l_partkey, l_shipdate from lineitem
  where l_orderkey in (select o_orderkey from orders where o_orderpriority = '1-URGENT')""")
def inc_overflow_union(spark, sf):
    blocks = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("block_number"))
    li = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "block_number")
    return I.reemit_blocks(li, blocks).select("block_number", "l_linenumber", "l_partkey", "l_shipdate")


@query("inc_complete_set", """
  select l_orderkey, max(l_shipdate) as _inserted_timestamp, md5(cast(l_orderkey as varchar)) as id from lineitem group by l_orderkey""")
def inc_complete_set(spark, sf):
    li = table(spark, sf, "lineitem").withColumnRenamed("l_shipdate", "_inserted_timestamp")
    return I.complete_set(li, None, "l_orderkey", "id", RUN).select("l_orderkey", "_inserted_timestamp", "id")


LOOK = "(select min(l_orderkey) + 100 from lineitem)"


def backlog_parts(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("block_number"))
    li = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("block_number"))
    look = table(spark, sf, "lineitem").agg((F.min("l_orderkey") + 100).alias("block_number"))
    return o, li, look


@query("inc_backlog_realtime", f"""
  select o_orderkey as block_number, cast(round(o_orderkey, -3) as bigint) as partition_key from orders where o_orderkey >= {LOOK}
   and o_orderkey not in (select l_orderkey from lineitem where l_returnflag = 'R')""")
def inc_backlog_realtime(spark, sf):
    return I.backlog(*backlog_parts(spark, sf), side="ge")


@query("inc_backlog_history", f"""
  select o_orderkey as block_number, cast(round(o_orderkey, -3) as bigint) as partition_key from orders where o_orderkey < {LOOK}
   and o_orderkey not in (select l_orderkey from lineitem where l_returnflag = 'R')""")
def inc_backlog_history(spark, sf):
    return I.backlog(*backlog_parts(spark, sf), side="lt")


@query("inc_request_rows", """
  select o_orderkey as block_number, '{"id":"' || o_orderkey || '","jsonrpc":"2.0","method":"eth_getBlockReceipts","params":["' ||
         printf('0x%x', o_orderkey) || '"]}' as request from orders""")
def inc_request_rows(spark, sf):
    todo = table(spark, sf, "orders").select(F.col("o_orderkey").alias("block_number"))
    return I.with_request(todo, "eth_getBlockReceipts", F.concat(F.lit('"'), L.int_to_hex("block_number"), F.lit('"')))
