"""Projections and filters."""
from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom import functions as L
from ledgerloom.operators import project as P
from ledgerloom.operators.windows import earliest
from . import chain
from .base import query, table
from .chain import BASE, BLOCK_SQL, TX_SQL, hx


@query("proj_json_paths", f"""
  select {BLOCK_SQL} as block_number, o_custkey as base_fee_per_gas, cast(round(o_totalprice * 100) as bigint) as gas_used,
         {TX_SQL} as hash, o_custkey * 7 as size, printf('0x%064x', o_orderkey + 1099511627776) as second_tx
  from orders where o_orderstatus <> 'P'
  union all
  select {BLOCK_SQL}, o_custkey, cast(round(o_totalprice * 100) as bigint), {TX_SQL}, o_custkey * 7, printf('0x%064x', o_orderkey + 1099511627776)
  from orders, unnest([0, 1]) as t(landing) where o_orderstatus = 'P'""")
def proj_json_paths(spark, sf):
    return P.json_project(chain.landed_blocks(spark, sf), "DATA", {
        "base_fee_per_gas": ("$.result.baseFeePerGas", L.hex_to_long),
        "gas_used": ("$.result.gasUsed", L.hex_to_long), "hash": ("$.result.hash",),
        "size": ("$.result.size", L.hex_to_long), "second_tx": ("$.result.transactions[1]",)},
        keep=["block_number"])


@query("proj_coalesce_paths", f"select {BLOCK_SQL} as known, {BLOCK_SQL} as found from orders")
def proj_coalesce_paths(spark, sf):
    landed = chain.landed_txs(spark, sf).withColumnRenamed("block_number", "known")
    return P.coalesce_paths(landed, [("VALUE", "$.BLOCK_NUMBER"), ("metadata", "$.request.data.id"),
                                     ("metadata", "$.request.data", "$.id")], "found", "bigint").select("known", "found")


@query("proj_alias_chain", """
  with a as (select l_orderkey, l_linenumber, l_partkey, l_shipdate, l_extendedprice * l_discount as fee,
             l_extendedprice * l_tax as tax from lineitem),
       b as (select *, fee + tax as total_fees from a)
  select l_orderkey, l_linenumber, l_partkey, l_shipdate, fee, tax, total_fees, total_fees / 2 as half from b""")
def proj_alias_chain(spark, sf):
    return P.derive_chain(table(spark, sf, "lineitem"), [
        ("fee", F.col("l_extendedprice") * F.col("l_discount")), ("tax", F.col("l_extendedprice") * F.col("l_tax")),
        ("total_fees", F.col("fee") + F.col("tax")), ("half", F.col("total_fees") / 2)]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "fee", "tax", "total_fees", "half")


@query("filter_is_object", f"select {BLOCK_SQL} as block_number from orders where o_orderpriority <> '3-MEDIUM'")
def filter_is_object(spark, sf):
    return P.where_json_object(chain.landed_txs(spark, sf), "DATA").select("block_number")


LOGS_SQL = f"""
  select {BLOCK_SQL} as block_number, {TX_SQL} as tx_hash, o_orderstatus, i as event_index,
         printf('0x%040x', o_custkey + i) as contract_address, o_orderdate as block_timestamp,
         list_slice(['0xaa', printf('0x%064x', o_custkey), printf('0x%064x', i), printf('0x%064x', o_orderkey)], 1, i + 1) as topics
  from orders, unnest(range(0, o_custkey % 4)) as t(i)"""


def flat_logs(spark, sf):
    """Event logs as a table: one row per log of each order."""
    o = chain.orders(spark, sf).withColumn("n", F.col("o_custkey") % 4).filter("n > 0")
    o = o.withColumn("event_index", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)))
    return o.select(
        "block_number", "tx_hash", "o_orderstatus", "event_index",
        hx(F.col("o_custkey") + F.col("event_index"), 40).alias("contract_address"),
        F.col("o_orderdate").alias("block_timestamp"), (F.col("o_orderstatus") == "F").alias("tx_succeeded"),
        F.slice(F.array(F.lit("0xaa"), hx("o_custkey", 64), hx("event_index", 64), hx("o_orderkey", 64)), F.lit(1),
                (F.col("event_index") + 1).cast("int")).alias("topics"))


@query("filter_contract_events", f"""
  select block_number, event_index, contract_address from ({LOGS_SQL})
  where contract_address in ('0x0000000000000000000000000000000000000005', '0x0000000000000000000000000000000000000006',
        '0x000000000000000000000000000000000000000b') and o_orderstatus = 'F'
    and block_timestamp >= timestamp '1996-01-01'""")
def filter_contract_events(spark, sf):
    wanted = ["0x" + "0" * 39 + d for d in "56b"]
    return P.select_events(flat_logs(spark, sf), wanted, topics=["0xaa"], since="1996-01-01", ok_only=True).select(
        "block_number", "event_index", "contract_address")


@query("filter_json_not_null", f"""
  select {BLOCK_SQL} as block_number from orders where o_orderstatus <> 'O' and o_orderpriority <> '3-MEDIUM'""")
def filter_json_not_null(spark, sf):
    return P.where_path_present(chain.landed_txs(spark, sf), "DATA", "$.gasPrice").select("block_number")


@query("proj_topic_label", """
  select event_id, case event_type when 'click' then 'CommissionSent' when 'purchase' then 'PayoutCompleted' end as name
  from events""")
def proj_topic_label(spark, sf):
    e = table(spark, sf, "events").withColumn("topics", F.array("event_type", F.col("user_id").cast("string")))
    return P.label_topics(e, {"click": "CommissionSent", "purchase": "PayoutCompleted"}, "name").select("event_id", "name")


@query("proj_trade_type", """
  select l_orderkey, l_linenumber, l_partkey, l_shipdate,
         case when l_linenumber in (2, 3) then 'buy' when l_linenumber = 1 then 'offer_accepted' end as trade_type
  from lineitem""")
def proj_trade_type(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate",
                                               P.trade_type("l_linenumber").alias("trade_type"))


@query("proj_side_swap", """
  select l_orderkey, l_linenumber, l_shipdate, l_partkey,
         case when p_type like '%PROMO%' then l_suppkey else l_partkey end as seller_address,
         case when p_type like '%PROMO%' then l_partkey else l_suppkey end as buyer_address
  from lineitem join part on l_partkey = p_partkey""")
def proj_side_swap(spark, sf):
    li = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return P.swap_sides(li, F.col("p_type").like("%PROMO%"), "l_partkey", "l_suppkey").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "seller_address", "buyer_address")


@query("proj_sale_category", """
  select o_orderkey, case when o_custkey = 0 then 'private' else 'public' end as category from orders""")
def proj_sale_category(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", P.sale_category(hx("o_custkey", 40)).alias("category"))


@query("proj_topics_split", f"""
  select block_number, event_index, topics[1] as topic_0, topics[2] as topic_1, topics[3] as topic_2, topics[4] as topic_3
  from ({LOGS_SQL})""")
def proj_topics_split(spark, sf):
    return P.split_topics(flat_logs(spark, sf)).select("block_number", "event_index", *[f"topic_{i}" for i in range(4)])


@query("proj_status_flag", """
  select o_orderkey, coalesce(case o_orderstatus when 'F' then 1 when 'O' then 0 end = 1, false) as ok from orders""")
def proj_status_flag(spark, sf):
    o = table(spark, sf, "orders").withColumn(
        "status", F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 0))
    return o.select("o_orderkey", P.status_flag("status").alias("ok"))


@query("proj_blank_to_null", """
  select event_id, nullif(case when event_type = 'error' then '' else event_type end, '') as kind from events""")
def proj_blank_to_null(spark, sf):
    e = table(spark, sf, "events").withColumn("kind", F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type")))
    return P.blank_to_null(e, "kind").select("event_id", "kind")


@query("proj_position_guard", f"""
  select {BLOCK_SQL} as block_number, cast(0 as bigint) as position from orders where o_orderpriority <> '1-URGENT'""")
def proj_position_guard(spark, sf):
    r = P.json_project(chain.landed_receipts(spark, sf), "DATA", {
        "payload_block": ("$.blockNumber", L.hex_to_long), "position": ("$.transactionIndex", L.hex_to_long)},
        keep=["block_number"])
    return P.guard_position(r).select("block_number", "position")


@query("proj_pending_flag", """
  select doc_id, quality is null or toxic is null as is_pending from documents left join labels using (doc_id)""")
def proj_pending_flag(spark, sf):
    d = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return P.pending_flag(d, ["quality", "toxic"]).select("doc_id", "is_pending")


@query("filter_recent_blocks", f"""
  select {BLOCK_SQL} as block_number, o_orderdate from orders
  where o_orderkey >= (select coalesce(min(o_orderkey), 0) from orders where o_orderdate >= timestamp '2001-07-29'
                       and o_orderdate < timestamp '2001-07-30')""")
def filter_recent_blocks(spark, sf):
    from ledgerloom.operators.aggregates import min_or
    o = chain.orders(spark, sf)
    day = F.col("o_orderdate").between(F.lit("2001-07-29").cast("timestamp_ntz"),
                                       F.lit("2001-07-29 23:59:59.999999").cast("timestamp_ntz"))
    return P.recent(o, min_or(o, "block_number", BASE, day)).select("block_number", "o_orderdate")


@query("proj_gold_rename", """
  select event_id as fact_id, ts as block_timestamp, coalesce(case when event_type <> 'error' then event_type end, '1') as quantity,
         coalesce(case when user_id > 10 then ts end, timestamp '2000-01-01') as modified_timestamp from events""")
def proj_gold_rename(spark, sf):
    e = table(spark, sf, "events").withColumns({
        "q": F.when(F.col("event_type") != "error", F.col("event_type")), "m": F.when(F.col("user_id") > 10, F.col("ts"))})
    return P.publish(e, ["event_id", "ts", "q", "m"],
                     {"event_id": "fact_id", "ts": "block_timestamp", "q": "quantity", "m": "modified_timestamp"},
                     {"q": "1", "m": "2000-01-01"})


@query("filter_case_insensitive_addr", "select p_partkey, p_brand from part where lower(p_brand) in ('brand#2', 'brand#17')")
def filter_case_insensitive_addr(spark, sf):
    return P.match_address(table(spark, sf, "part"), "p_brand", ["BRAND#2", "brand#17"]).select("p_partkey", "p_brand")


@query("proj_native_symbol", """
  select o_orderkey, case when o_custkey = 7 then 'AVAX' else printf('0x%040x', o_custkey) end as currency from orders""")
def proj_native_symbol(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", P.native_symbol(hx("o_custkey", 40), "0x" + "0" * 39 + "7").alias("currency"))


@query("filter_scalar_subquery", """
  select o_orderkey, o_totalprice from orders where o_totalprice > (select avg(o_totalprice) from orders)""")
def filter_scalar_subquery(spark, sf):
    o = table(spark, sf, "orders")
    return P.where_vs_scalar(o, "o_totalprice", ">", o.agg(F.avg("o_totalprice"))).select("o_orderkey", "o_totalprice")
