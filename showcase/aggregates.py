"""Aggregations."""
from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import aggregates as A
from .base import query, table
from .plans import NODES_SQL, traces


def dec(c):
    """Money columns as exact cents, so that sums do not depend on order."""
    return F.round(F.col(c) * 100).cast("bigint")


@query("agg_sum_multi", """
  select l_orderkey, cast(sum(case when l_returnflag = 'R' then cents else 0 end) as bigint) as sale,
         cast(sum(case when l_returnflag = 'A' then cents else 0 end) as bigint) as platform,
         cast(sum(case when l_returnflag = 'N' then cents else 0 end) as bigint) as creator
  from (select *, cast(round(l_extendedprice * 100) as bigint) as cents from lineitem) group by l_orderkey""")
def agg_sum_multi(spark, sf):
    li = table(spark, sf, "lineitem")
    part = lambda f: F.when(F.col("l_returnflag") == f, dec("l_extendedprice")).otherwise(0)
    return A.sums(li, "l_orderkey", {"sale": part("R"), "platform": part("A"), "creator": part("N")})


@query("agg_group_by_all", """
  select l_returnflag, l_linestatus, cast(sum(l_quantity) as double) as l_quantity, cast(sum(cents) as bigint) as cents
  from (select l_returnflag, l_linestatus, l_quantity, cast(round(l_extendedprice * 100) as bigint) as cents from lineitem)
  group by all""")
def agg_group_by_all(spark, sf):
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", dec("l_extendedprice").alias("cents"))
    return A.sums_all(li, ["l_quantity", "cents"])


@query("agg_count_children", f"""
  select block_number, parent_trace_address, count(*) as sub_traces from ({NODES_SQL})
  where parent_trace_address is not null group by all""")
def agg_count_children(spark, sf):
    return A.child_count(traces(spark, sf), ["block_number", "tx_position"]).select(
        "block_number", "parent_trace_address", "sub_traces")


@query("agg_count_items", """
  select o_orderkey, cast(len(list_filter(range(0, o_custkey % 9), lambda x: x % 4 in (2, 3))) as integer) as n from orders""")
def agg_count_items(spark, sf):
    o = table(spark, sf, "orders")
    items = F.filter(F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("o_custkey") % 9),
                                 lambda i: F.struct(i.alias("i"), (i % 4).alias("item_type"))),
                     lambda x: x["i"] < F.col("o_custkey") % 9)
    return o.select("o_orderkey", A.count_items(items, (2, 3)).alias("n"))


@query("agg_having", """
  select l_orderkey, count(*) as n from lineitem group by l_orderkey having count(*) > 5""")
def agg_having(spark, sf):
    return A.count_having(table(spark, sf, "lineitem"), "l_orderkey", F.col("n") > 5)


@query("agg_array_first", """
  select user_id, arg_min(value, event_id) filter (where event_type = 'purchase') as first_purchase,
         arg_min(event_id, event_id) filter (where event_type = 'click') as first_click
  from events group by user_id""")
def agg_array_first(spark, sf):
    e = table(spark, sf, "events")
    a = A.first_value_per(e, "user_id", F.when(F.col("event_type") == "purchase", F.col("value")), "event_id", "first_purchase")
    b = A.first_value_per(e, "user_id", F.when(F.col("event_type") == "click", F.col("event_id")), "event_id", "first_click")
    return a.join(b, "user_id")


@query("agg_object", """
  select l_orderkey, string_agg(k || '=' || v, ',' order by k) as obj
  from (select l_orderkey, cast(l_linenumber as varchar) as k, min(cast(l_partkey as varchar)) as v
        from lineitem group by all) group by l_orderkey""")
def agg_object(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("string").alias("k"),
                                             F.col("l_partkey").cast("string").alias("v"))
    text = F.array_join(F.transform(F.array_sort(F.map_entries("obj")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return A.object_agg(li, "l_orderkey", "k", "v").select("l_orderkey", text.alias("obj"))


@query("agg_min_default", """
  select coalesce((select min(o_orderkey) from orders where o_orderdate >= timestamp '2050-01-01'), 21248026) as o_orderkey""")
def agg_min_default(spark, sf):
    o = table(spark, sf, "orders")
    return A.min_or(o, "o_orderkey", 21_248_026, F.col("o_orderdate") >= F.lit("2050-01-01").cast("timestamp_ntz")) \
        .withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


@query("agg_max_watermark", """
  select o_orderkey, o_orderdate from orders where o_orderdate >= (select max(o_orderdate) from orders)""")
def agg_max_watermark(spark, sf):
    o = table(spark, sf, "orders")
    top = A.high_water(o, "o_orderdate", "1970-01-01")
    return o.filter(F.col("o_orderdate") >= F.lit(str(top)).cast("timestamp_ntz")).select("o_orderkey", "o_orderdate")


@query("agg_distinct", "select distinct l_orderkey, l_returnflag from lineitem")
def agg_distinct(spark, sf):
    return A.distinct(table(spark, sf, "lineitem"), ["l_orderkey", "l_returnflag"])


@query("agg_any_error", f"""
  select block_number, trace_address,
         not (o_orderpriority = '1-URGENT' or (o_orderpriority = '2-HIGH' and i = 0)) as trace_succeeded
  from ({NODES_SQL})""")
def agg_any_error(spark, sf):
    nodes = traces(spark, sf).withColumn("error", F.try_element_at("trace_json", F.lit("error")))
    return A.tree_success(nodes, ["block_number", "tx_position"]).select("block_number", "trace_address", "trace_succeeded")


@query("agg_array_ordered", f"""
  select block_number, trace_address, case depth when 0 then '-1' else replace(trace_address, '_', ',') end as path
  from ({NODES_SQL})""")
def agg_array_ordered(spark, sf):
    return traces(spark, sf).select("block_number", "trace_address",
                                    F.array_join(A.path_array("trace_address").cast("array<string>"), ",").alias("path"))


@query("agg_offer_length_sum", """
  select l_orderkey, count(*) as offer_length from lineitem group by l_orderkey
  having count(*) filter (where l_returnflag = 'R') > 0""")
def agg_offer_length_sum(spark, sf):
    return A.items_per_group(table(spark, sf, "lineitem"), "l_orderkey", F.col("l_returnflag") == "R")


@query("agg_min_date", "select cast(min(o_orderdate) as date) as min_date from orders")
def agg_min_date(spark, sf):
    return A.min_date(table(spark, sf, "orders"), "o_orderdate")
