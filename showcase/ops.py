"""Set operations, ordering and caps."""
from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import setops as S
from .base import query, table


@query("sort_backlog", "select o_orderkey as block_number, o_custkey from orders")
def sort_backlog(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("block_number"), "o_custkey")
    return S.order_backlog(o, asc=False)


@query("limit_backlog", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10000")
def limit_backlog(spark, sf):
    return S.cap(table(spark, sf, "orders"), 10_000, F.desc("o_totalprice"), "o_orderkey").select("o_orderkey", "o_totalprice")


@query("batch_assign", """
  with c as (select o_orderkey, row_number() over (order by o_orderkey) - 1 as rn from orders order by o_orderkey limit 10000)
  select o_orderkey, rn // 5000 as producer_batch, rn // 1000 as worker_batch from c""")
def batch_assign(spark, sf):
    return S.batches(table(spark, sf, "orders").select("o_orderkey"), 5_000, 1_000, "o_orderkey", cap=10_000)


@query("set_union_all", """
  select s_suppkey as k, s_name as name, s_acctbal as bal from supplier
  union all select c_custkey, c_name, c_acctbal from customer
  union all select p_partkey, p_name, p_retailprice from part""")
def set_union_all(spark, sf):
    pick = lambda t, *c: table(spark, sf, t).select(*[F.col(x).alias(n) for x, n in zip(c, ("k", "name", "bal"))])
    return S.union_all(pick("supplier", "s_suppkey", "s_name", "s_acctbal"), pick("customer", "c_custkey", "c_name", "c_acctbal"),
                       pick("part", "p_partkey", "p_name", "p_retailprice"))


@query("set_union_distinct", """
  select l_orderkey, l_returnflag from lineitem union select o_orderkey, o_orderstatus from orders""")
def set_union_distinct(spark, sf):
    return S.union_distinct(table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag"),
                            table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                                              F.col("o_orderstatus").alias("l_returnflag")))


@query("set_except", "select o_orderkey from orders except select l_orderkey from lineitem")
def set_except(spark, sf):
    done = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return S.minus(table(spark, sf, "orders"), done, "o_orderkey", dense=True)
