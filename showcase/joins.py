"""Joins."""
from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import joins as J
from .base import query, table
from .plans import NODES_SQL, traces

LINE = "l_orderkey, l_linenumber, l_shipdate, l_partkey"
LINES = LINE.split(", ")


def prices(spark, sf):
    """Hourly price of each event type: the mean of its events' values."""
    e = table(spark, sf, "events")
    cents = F.round(F.col("value") * 100).cast("bigint")
    return (e.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"), F.col("event_type").alias("token_address"))
             .agg((F.sum(cents) / F.count(F.lit(1))).alias("price")))


PRICES_SQL = """
  select date_trunc('hour', ts) as hour, event_type as token_address,
         cast(sum(cast(round(value * 100) as bigint)) as double) / count(*) as price from events group by all"""


@query("join_inner_using", f"select {LINE}, o_custkey, o_orderstatus from lineitem join orders on l_orderkey = o_orderkey")
def join_inner_using(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus")
    return J.inner_using(table(spark, sf, "lineitem"), o, "l_orderkey").select(*LINES, "o_custkey", "o_orderstatus")


@query("join_left_multi", """
  select doc_id, source, quality, n_name from documents left join labels using (doc_id)
  left join nation on n_nationkey = doc_id""")
def join_left_multi(spark, sf):
    n = table(spark, sf, "nation").select(F.col("n_nationkey").cast("bigint").alias("doc_id"), "n_name")
    d = J.enrich(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id", ["quality"])
    return J.enrich(d, n, "doc_id", ["n_name"]).select("doc_id", "source", "quality", "n_name")


@query("join_left_time_bounded", f"""
  select {LINE}, o_custkey, o_custkey is null as is_pending from lineitem
  left join (select * from orders where o_orderdate >= timestamp '1999-12-31') on l_orderkey = o_orderkey""")
def join_left_time_bounded(spark, sf):
    o = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    return (J.enrich_recent(table(spark, sf, "lineitem"), o, "l_orderkey", ["o_custkey"], "o_orderdate",
                            F.lit("1999-12-31").cast("timestamp_ntz"))
            .select(*LINES, "o_custkey", F.col("o_custkey").isNull().alias("is_pending")))


@query("join_full_outer_filtered", """
  select d.doc_id as doc_id, source, quality from labels l full join documents d using (doc_id) where n_chars is not null""")
def join_full_outer_filtered(spark, sf):
    return J.outer_then_filter(table(spark, sf, "labels"), table(spark, sf, "documents"), "doc_id", "n_chars").select(
        "doc_id", "source", "quality")


@query("join_semi", "select o_orderkey from orders where o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R')")
def join_semi(spark, sf):
    li = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return J.keep_in(table(spark, sf, "orders"), li, "o_orderkey").select("o_orderkey")


@query("join_anti", "select o_orderkey from orders where o_orderkey not in (select l_orderkey from lineitem)")
def join_anti(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return J.drop_in(table(spark, sf, "orders"), li, "o_orderkey").select("o_orderkey")


@query("join_exists_correlated", """
  select o_orderkey from orders o where exists (select 1 from lineitem where l_orderkey = o_orderkey
         and l_shipdate > o_orderdate and l_returnflag = 'A')""")
def join_exists_correlated(spark, sf):
    o, li = table(spark, sf, "orders"), table(spark, sf, "lineitem").filter("l_returnflag = 'A'")
    return J.keep_exists(o, li, (li["l_orderkey"] == o["o_orderkey"]) & (li["l_shipdate"] > o["o_orderdate"])).select("o_orderkey")


@query("join_asof_next", """
  with c as (select * from events where event_type = 'click'), p as (select * from events where event_type = 'purchase'),
  m as (select c.user_id, c.event_id, p.event_id as sale, row_number() over (partition by c.event_id order by p.event_id) as rn
        from c join p on c.user_id = p.user_id and p.event_id > c.event_id)
  select user_id, event_id, sale from m where rn = 1""")
def join_asof_next(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", "event_type")
    return J.assign_to_next(e.filter("event_type = 'click'"), e.filter("event_type = 'purchase'"), "user_id", "event_id",
                            "sale").select("user_id", "event_id", "sale")


@query("join_ancestor_prefix", f"""
  with n as ({NODES_SQL}),
  e as (select block_number, trace_address from n where (o_orderpriority = '1-URGENT' and depth = 0)
        or (o_orderpriority = '2-HIGH' and depth = 1 and i = 0)),
  w as (select block_number, trace_address, string_split(trace_address, '_') as parts from n),
  above as (select block_number, trace_address, unnest(list_transform(range(1, len(parts) + 1), lambda k: array_to_string(parts[1:k], '_'))) as prefix from w),
  hit as (select a.block_number, a.trace_address, a.prefix as error_address from above a
          join e on e.block_number = a.block_number and e.trace_address = a.prefix)
  select n.block_number, n.trace_address, hit.error_address
  from n left join hit on n.block_number = hit.block_number and n.trace_address = hit.trace_address""")
def join_ancestor_prefix(spark, sf):
    nodes = traces(spark, sf).withColumn("error", F.try_element_at("trace_json", F.lit("error")))
    keys = ["block_number", "tx_position"]
    return J.with_ancestors(nodes, nodes.filter("error is not null"), keys).select(
        "block_number", "trace_address", "error_address")


@query("join_tree_self", f"""
  select block_number, trace_address,
         case depth when 0 then n when 1 then (case when o_orderkey % 2 = 0 then 1 else 0 end) else 0 end as sub_traces
  from ({NODES_SQL})""")
def join_tree_self(spark, sf):
    return J.tree_self(traces(spark, sf), ["block_number", "tx_position"]).select("block_number", "trace_address", "sub_traces")


@query("join_hourly_price", f"""
  with p as ({PRICES_SQL})
  select event_id, a.price as hourly_price, b.price as native_price from events
  left join p a on date_trunc('hour', ts - interval 1 hour) = a.hour and event_type = a.token_address
  left join p b on date_trunc('hour', ts - interval 1 hour) = b.hour and b.token_address = 'view'""")
def join_hourly_price(spark, sf):
    e = table(spark, sf, "events").withColumn("at", F.expr("ts - interval 1 hour"))
    return J.price_at_hour(e, prices(spark, sf), "at", "event_type", native="view").select(
        "event_id", "hourly_price", "native_price")


@query("join_dim_lookup", """
  select p_partkey, p_brand, s_name, n_name from part left join supplier on p_partkey % 128 = s_suppkey
  left join nation on s_nationkey = n_nationkey""")
def join_dim_lookup(spark, sf):
    p = table(spark, sf, "part").withColumn("key", (F.col("p_partkey") % 128).cast("string"))
    s = table(spark, sf, "supplier").withColumn("skey", F.col("s_suppkey").cast("string"))
    d = J.lookup(p, s, p["key"] == s["skey"], {"s_name": "s_name", "s_nationkey": "s_nationkey"})
    n = table(spark, sf, "nation")
    return J.lookup(d, n, d["s_nationkey"] == n["n_nationkey"], {"n_name": "n_name"}).select(
        "p_partkey", "p_brand", "s_name", "n_name")


@query("join_either_key", f"""
  select {LINE}, l_returnflag, o_custkey from lineitem left join (
    select o_orderkey as h, o_orderstatus as st, o_custkey from orders union all
    select o_orderkey + 3, o_orderstatus, o_custkey from orders) on h = l_orderkey and st = l_linestatus""")
def join_either_key(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("l_linestatus"), "o_custkey",
                                          F.col("o_orderkey").alias("hash_1"), (F.col("o_orderkey") + 3).alias("hash_2"))
    li = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "hash")
    return J.join_either(li, o, "l_linestatus", "hash", ["hash_1", "hash_2"], ["o_custkey"]).select(
        F.col("hash").alias("l_orderkey"), *LINES[1:], "l_returnflag", "o_custkey")


@query("join_lateral_flatten", """
  select vec_id, cast(i as integer) as idx, cast(embedding[i + 1] as double) as x
  from embeddings, unnest(range(0, len(embedding))) t(i)""")
def join_lateral_flatten(spark, sf):
    return J.flatten(table(spark, sf, "embeddings"), "embedding", "idx", "v").select(
        "vec_id", "idx", F.col("v").cast("double").alias("x"))


@query("join_reciprocal_payment", """
  with m as (select o_custkey, min(o_orderkey) as k, count(*) as n from orders where o_orderstatus = 'F' group by all),
       p as (select o_custkey, min(o_orderkey) as k, count(*) as n, max(o_totalprice) as paid from orders where o_orderstatus = 'O' group by all)
  select m.o_custkey as giver, m.n as taker, m.k, paid from m left join p
    on p.n = m.n and p.o_custkey = m.o_custkey and m.k % 2 = p.k % 2""")
def join_reciprocal_payment(spark, sf):
    o = table(spark, sf, "orders").withColumn("tx", F.lit("t"))
    agg = lambda st: (o.filter(F.col("o_orderstatus") == st).groupBy("tx", "o_custkey").agg(
        F.min("o_orderkey").alias("k"), F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("paid")))
    moves = agg("F").select("tx", F.col("o_custkey").alias("giver"), F.col("n").alias("taker"), "k",
                            (F.col("k") % 2).alias("nth"))
    pays = agg("O").select("tx", F.col("n").alias("payer"), F.col("o_custkey").alias("payee"), (F.col("k") % 2).alias("nth"), "paid")
    return J.attach_payment(moves, pays, "tx", columns=["paid"]).select("giver", "taker", "k", "paid")


@query("join_operator_transfer", f"""
  select {LINE}, coalesce(t.addr, l_suppkey) as nft_address from lineitem
  left join (select ps, lk, max(l_suppkey) + 1000000 as addr from (select l_partkey as ps, l_orderkey as lk, l_suppkey from lineitem
             where l_returnflag = 'R') group by all) t on l_partkey = ps and l_orderkey = lk""")
def join_operator_transfer(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("nft_address", F.col("l_suppkey"))
    t = (li.filter("l_returnflag = 'R'").groupBy("l_partkey", "l_orderkey")
           .agg((F.max("l_suppkey") + 1_000_000).alias("nft_address_from_transfers")))
    return J.override_asset(li, t, ["l_partkey", "l_orderkey"]).select(*LINES, "nft_address")


@query("join_ordinal_align", """
  with c as (select *, row_number() over (partition by user_id order by event_id) as nth from events where event_type = 'click'),
       p as (select *, row_number() over (partition by user_id order by event_id) as nth from events where event_type = 'purchase')
  select c.user_id, nth, c.event_id, p.value as paid from c join p using (user_id, nth)""")
def join_ordinal_align(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value")
    return J.align_nth(e.filter("event_type = 'click'"), e.filter("event_type = 'purchase'").withColumnRenamed("value", "paid"),
                       "user_id", ["event_id"], ["event_id"], ["paid"]).select("user_id", "nth", "event_id", "paid")
