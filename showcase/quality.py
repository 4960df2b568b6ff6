"""Data-quality checks."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.operators import quality as Q
from ledgerloom.plans import checks as C, silver as S
from . import chain
from .base import query, shared_folder, table
from .nft import ALL_COLUMNS, ALL_COLUMNS_SQL, all_sales
from .plans import BLOCKS_SQL, LOGS_SQL, NODES_SQL, TXS_SQL, blocks, logs, txs


@query("dq_unique_combination", """
  select l_orderkey, l_linenumber, count(*) as n_records from lineitem group by all having count(*) > 1""")
def dq_unique_combination(spark, sf):
    return Q.unique(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


GAPS = """
  select {part} previous_value, current_value, current_value - previous_value - 1 as missing from (
    select distinct {part} lag({c}) over ({over} order by {c}) as previous_value, {c} as current_value from {src})
  where current_value - previous_value > 1"""


@query("dq_sequence_gaps", GAPS.format(part="", c="l_orderkey", over="", src="(select distinct l_orderkey from lineitem)"))
def dq_sequence_gaps(spark, sf):
    return Q.sequence_gaps(table(spark, sf, "lineitem"), "l_orderkey")


@query("dq_sequence_gaps_grouped", GAPS.format(part="l_orderkey,", c="l_linenumber", over="partition by l_orderkey",
                                               src="(select distinct l_orderkey, l_linenumber from lineitem where l_returnflag <> 'N')"))
def dq_sequence_gaps_grouped(spark, sf):
    return Q.sequence_gaps(table(spark, sf, "lineitem"), "l_linenumber", "l_orderkey", F.col("l_returnflag") != "N")


@query("dq_not_null", "select doc_id from documents left join labels using (doc_id) where source <> 'x' and quality is null")
def dq_not_null(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return Q.not_null(d, "quality", F.col("source") != "x").select("doc_id")


@query("dq_match_regex", "select p_partkey, p_brand from part where p_size > 5 and not regexp_matches(p_brand, '#[12][0-9]*$')")
def dq_match_regex(spark, sf):
    return Q.matches(table(spark, sf, "part"), "p_brand", "#[12][0-9]*$", F.col("p_size") > 5).select("p_partkey", "p_brand")


@query("dq_in_set", "select o_orderkey, o_orderstatus from orders where o_orderstatus not in ('F', 'O')")
def dq_in_set(spark, sf):
    return Q.in_set(table(spark, sf, "orders"), "o_orderstatus", ["F", "O"]).select("o_orderkey", "o_orderstatus")


@query("dq_type_in", """
  select 'o_totalprice' as column_name, 'double' as actual_type, count(*) as n_rows from orders""")
def dq_type_in(spark, sf):
    o = table(spark, sf, "orders")
    bad = Q.type_in(o, "o_totalprice", ["bigint", "decimal"]).unionByName(Q.type_in(o, "o_orderkey", ["bigint", "decimal"]))
    return bad.withColumn("n_rows", o.agg(F.count(F.lit(1))).scalar())


@query("dq_recent_data", "select max(ts) as newest from events having max(ts) < timestamp '2024-02-10'")
def dq_recent_data(spark, sf):
    return Q.recent(table(spark, sf, "events"), "ts", 10, dt.datetime(2024, 2, 20))


@query("dq_tx_block_count", """
  select l_partkey, min(l_suppkey) as first_block, max(l_suppkey) as last_block from lineitem group by l_partkey
  having count(distinct l_suppkey) > 1""")
def dq_tx_block_count(spark, sf):
    return Q.one_block_per_tx(table(spark, sf, "lineitem"), "l_partkey", "l_suppkey")


@query("dq_severity", """
  select count(*) as n_failures, case when count(*) > 10 then 'error' when count(*) <> 0 then 'warn' else 'pass' end as status
  from orders where o_orderstatus = 'P'
  union all select count(*), case when count(*) > 10000000000 then 'error' when count(*) <> 0 then 'warn' else 'pass' end
  from orders where o_orderstatus = 'P'
  union all select count(*), 'pass' from orders where o_orderstatus = 'X'""")
def dq_severity(spark, sf):
    o = table(spark, sf, "orders")
    bad = o.filter("o_orderstatus = 'P'")
    return (Q.grade(bad, "!=0", ">10").unionByName(Q.grade(bad, "!=0", ">10000000000"))
            .unionByName(Q.grade(o.filter("o_orderstatus = 'X'"))))


@query("dq_store_failures", """
  select l_orderkey, l_suppkey, count(*) as n_records from lineitem group by all having count(*) > 1""")
def dq_store_failures(spark, sf):
    """Failing rows stored as a table and read back from there."""
    path = f"{shared_folder(spark)}/failures"
    Q.store_failures(Q.unique(table(spark, sf, "lineitem"), ["l_orderkey", "l_suppkey"]), path)
    return spark.read.parquet(path)


# -- the suites of the library's own tables --------------------------------------

ASKED = dt.datetime(1999, 1, 1)


def report_sql(rows: str, suite, columns) -> str:
    """The suite's counts, over rows that the twin of a table computes from the orders."""
    own, part = suite.over(columns), []
    add = lambda rule, c, n: part.append(f"select '{rule}' as rule, '{c}' as column_name, {n} as n_failures")
    for r in own.rows:
        bad = f"{r.column} is null" if r.name == "not_null" else f"not regexp_matches({r.column}, '{C.HEX}')"
        add(r.name, r.column, f"(select count(*) from t where {bad}{f' and ({r.where})' if r.where else ''})")
    for c in own.numbers:
        add("number", c, 0)
    key = ", ".join(own.key)
    add("unique", ",".join(own.key), f"(select count(*) from (select {key} from t group by all having count(*) > 1))")
    if own.gaps:
        c, by = own.gaps[0], ", ".join(own.gaps[1])
        src = f"(select distinct {by + ',' if by else ''} {c} from t where block_timestamp < timestamp '{ASKED}' - interval 1 day)"
        part_by = f"partition by {by}" if by else ""
        add("gaps", c, f"(select count(*) from ({GAPS.format(part=by + ',' if by else '', c=c, over=part_by, src=src)}))")
    if own.one_block:
        add("one_block", "tx_hash", "(select count(*) from (select tx_hash from t group by tx_hash having count(distinct block_number) > 1))")
    if own.recent:
        add("recent", own.recent, f"(select count(*) from (select max({own.recent}) as m from t) where m is null or m < timestamp '{ASKED}' - interval 1 day)")
    return f"with t as ({rows}) select *, case when n_failures = 0 then 'pass' else 'error' end as status from ({' union all '.join(part)})"


def _suite(name: str, suite, rows: str, columns: str, make):
    columns = columns.split()

    @query(name, report_sql(rows, suite, columns))
    def run(spark, sf):
        return C.report(make(spark, sf).select(*columns), suite, ASKED)


_suite("dq_silver_blocks", C.BLOCKS, BLOCKS_SQL,
       "block_number block_timestamp gas_used hash parent_hash miner nonce size total_difficulty", blocks)
_suite("dq_silver_transactions", C.TRANSACTIONS, TXS_SQL,
       "block_number block_timestamp tx_hash nonce from_address to_address gas_price gas origin_function_signature is_pending "
       "tx_status gas_used tx_fee", txs)
_suite("dq_silver_logs", C.LOGS, LOGS_SQL,
       "block_number block_timestamp tx_hash event_index contract_address topics data _log_id is_pending", logs)
_suite("dq_silver_traces", C.TRACES, f"select *, 0 as tx_position from ({NODES_SQL})", "block_number tx_position trace_address",
       lambda spark, sf: S.silver_traces(chain.landed_traces(spark, sf), None, chain.RUN))


@query("dq_failing_logs", f"""
  select _log_id, 1 as n_broken, 'not_null origin_function_signature' as broken from ({LOGS_SQL}) where is_pending and event_index > 0""")
def dq_failing_logs(spark, sf):
    """Rows with the rules they break: here every waiting log must have its signature already, but the first of a transaction."""
    strict = C.Suite(("_log_id",), (C.Rule("not_null", "origin_function_signature", "event_index > 0"), C.Rule("hex", "tx_hash")))
    return C.failing_rows(logs(spark, sf), strict).select(
        "_log_id", F.size("broken").alias("n_broken"), F.array_join("broken", ",").alias("broken"))


@query("dq_sales", report_sql(ALL_COLUMNS_SQL, C.SALES, ALL_COLUMNS))
def dq_sales(spark, sf):
    """Sales of all seven markets; deals of assets for assets have no currency, which the suite allows."""
    return C.report(all_sales(spark, sf).select(*ALL_COLUMNS), C.SALES, ASKED)
