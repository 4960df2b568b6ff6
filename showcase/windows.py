"""Window operators."""
from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import windows as W
from .base import query, table
from .plans import NODES_SQL, traces

TOTAL = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
T = ", ".join(TOTAL)


def last_of(li, how):
    return how(li).select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_quantity")


@query("win_latest_per_key", f"""
  select l_orderkey, l_linenumber, l_shipdate, l_partkey, l_quantity from lineitem
  qualify row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc, l_partkey, l_suppkey) = 1""")
def win_latest_per_key(spark, sf):
    return last_of(table(spark, sf, "lineitem"), lambda d: W.latest(
        d, ["l_orderkey", "l_linenumber"], "l_shipdate", "l_partkey", "l_suppkey"))


@query("win_latest_prefer_complete", """
  with x as (select o_custkey, date_trunc('year', o_orderdate) as year, o_orderstatus = 'P' as is_pending, max(o_orderkey) as k
             from orders group by all)
  select o_custkey, year, is_pending, k from x
  qualify row_number() over (partition by o_custkey order by year desc, is_pending) = 1""")
def win_latest_prefer_complete(spark, sf):
    x = (table(spark, sf, "orders")
         .withColumn("year", F.date_trunc("year", "o_orderdate").cast("timestamp_ntz"))
         .groupBy("o_custkey", "year", (F.col("o_orderstatus") == "P").alias("is_pending")).agg(F.max("o_orderkey").alias("k")))
    return W.latest_complete(x, "o_custkey", "year", "is_pending").select("o_custkey", "year", "is_pending", "k")


@query("win_latest_nulls_last", """
  with x as (select o_custkey, case when o_orderstatus <> 'P' then o_orderdate end as d, o_orderpriority as p, max(o_orderkey) as k
             from orders group by all)
  select o_custkey, p, d, k from x
  qualify row_number() over (partition by o_custkey order by p desc, d desc nulls last) = 1""")
def win_latest_nulls_last(spark, sf):
    x = (table(spark, sf, "orders")
         .groupBy("o_custkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("d"),
                  F.col("o_orderpriority").alias("p")).agg(F.max("o_orderkey").alias("k")))
    return W.latest_nulls_last(x, "o_custkey", ["p", "d"]).select("o_custkey", "p", "d", "k")


@query("win_earliest_per_key", """
  select user_id, event_id, event_type from events qualify row_number() over (partition by user_id order by ts, event_id) = 1""")
def win_earliest_per_key(spark, sf):
    return W.earliest(table(spark, sf, "events"), "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("win_ordinal", """
  select event_id, user_id, row_number() over (partition by user_id order by event_id) as n from events""")
def win_ordinal(spark, sf):
    return W.ordinal(table(spark, sf, "events"), "user_id", ["event_id"], "n").select("event_id", "user_id", "n")


@query("win_top1_flag", f"""
  select l_orderkey, l_linenumber, l_shipdate, l_partkey,
         case when row_number() over (partition by l_orderkey order by l_extendedprice desc, l_linenumber, l_shipdate, l_partkey) = 1
              then l_extendedprice else 0 end as sale_amount
  from lineitem""")
def win_top1_flag(spark, sf):
    return W.top1_else_zero(table(spark, sf, "lineitem"), "l_orderkey", "l_extendedprice",
                            ["l_linenumber", "l_shipdate", "l_partkey"]).select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "sale_amount")


@query("win_drop_top1", f"""
  select l_orderkey, l_linenumber, l_shipdate, l_partkey, l_extendedprice from lineitem
  qualify row_number() over (partition by l_orderkey order by l_extendedprice desc, l_linenumber, l_shipdate, l_partkey) > 1""")
def win_drop_top1(spark, sf):
    return W.drop_largest(table(spark, sf, "lineitem"), "l_orderkey", "l_extendedprice",
                          ["l_linenumber", "l_shipdate", "l_partkey"]).select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_extendedprice")


@query("win_running_sum", """
  select event_id, user_id, cast(sum(case when event_type = 'purchase' then 1 else 0 end)
         over (partition by user_id order by event_id) as bigint) as grp from events""")
def win_running_sum(spark, sf):
    marker = F.when(F.col("event_type") == "purchase", 1).otherwise(0)
    return W.running_group(table(spark, sf, "events"), "user_id", ["event_id"], marker).select("event_id", "user_id", "grp")


def purchases(spark, sf):
    return table(spark, sf, "events").withColumn("v", F.when(F.col("event_type") == "purchase", F.col("value")))


BASE = "(select *, case when event_type = 'purchase' then value end as v from events)"
NEXT = "first_value(v ignore nulls) over (partition by user_id order by event_id rows between 1 following and unbounded following)"
PREV = "last_value(v ignore nulls) over (partition by user_id order by event_id rows between unbounded preceding and 1 preceding)"


@query("win_lead_ignore_nulls", f"select event_id, {NEXT} as next_v from {BASE}")
def win_lead_ignore_nulls(spark, sf):
    return W.next_value(purchases(spark, sf), "v", "user_id", ["event_id"], "next_v").select("event_id", "next_v")


@query("win_lag_ignore_nulls", f"select event_id, {PREV} as prev_v from {BASE}")
def win_lag_ignore_nulls(spark, sf):
    return W.prev_value(purchases(spark, sf), "v", "user_id", ["event_id"], "prev_v").select("event_id", "prev_v")


@query("win_fill_both_ways", f"select event_id, coalesce(v, {PREV}, {NEXT}, 0) as v_fill from {BASE}")
def win_fill_both_ways(spark, sf):
    return W.fill_both(purchases(spark, sf), ["v"], "user_id", ["event_id"], {"v": 0.0}).select("event_id", "v_fill")


@query("win_preorder_index", f"""
  select block_number, trace_address,
         row_number() over (partition by block_number order by case depth when 0 then -1 else i end, depth) - 1 as trace_index
  from ({NODES_SQL})""")
def win_preorder_index(spark, sf):
    from ledgerloom.operators.aggregates import path_array
    nodes = traces(spark, sf).withColumn("number_array", path_array("trace_address"))
    return W.preorder_index(nodes, ["block_number", "tx_position"], "number_array").select(
        "block_number", "trace_address", "trace_index")
