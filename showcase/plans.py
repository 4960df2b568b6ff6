"""Silver, gold and ingest plans over chain-shaped payloads."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.operators import incremental as inc
from ledgerloom.operators.groups import keep
from ledgerloom.operators.incremental import Run
from ledgerloom.operators.tree import MALFORMED, flatten_tree, holds
from ledgerloom.plans import gold as G, ingest as I, silver as S
from ledgerloom.sources import delete_insert
from . import chain
from .base import query, table
from .chain import BASE, BLOCK_SQL, RUN, TX_SQL

DEPTH = "cast(s_suppkey * 41 % 1025 as int)"
CENTS = "cast(round(o_totalprice * 100) as bigint)"


def blocks(spark, sf):
    return S.silver_blocks(chain.landed_blocks(spark, sf), None, RUN)


def receipts(spark, sf):
    return S.silver_receipts(chain.landed_receipts(spark, sf), None, RUN)


def txs(spark, sf, r=None):
    r = receipts(spark, sf) if r is None else r
    return S.silver_transactions(chain.landed_txs(spark, sf), blocks(spark, sf), r, None, RUN)


def logs(spark, sf):
    r = receipts(spark, sf)
    return S.silver_logs(r, txs(spark, sf, r), None, RUN)


def traces(spark, sf):
    """The silver traces as a table: what reads them reads them more than once."""
    return keep(S.silver_traces(chain.landed_traces(spark, sf), None, RUN))


@query("fn_flatten_recursive", """
  with s as (select s_suppkey, s_suppkey * 41 % 1025 as depth from supplier)
  select s_suppkey, case when i = 0 then 'ORIGIN' else rtrim(repeat('0_', i), '_') end as trace_address,
         case when i = 1 then 'ORIGIN' when i > 1 then rtrim(repeat('0_', i - 1), '_') end as parent_trace_address,
         case when i = depth then 'leaf' end as kind, false as malformed
  from (select s_suppkey, depth, unnest(range(depth + 1)) as i from s where s_suppkey % 10 <> 3)
  union all select s_suppkey, null, null, null, true from s where s_suppkey % 10 = 3""")
def fn_flatten_recursive(spark, sf):
    """Call trees as deep as the chain allows (1,024), and documents that are not JSON."""
    doc = lambda end: F.concat(F.lit('{"result":'), F.expr(f"repeat('{{\"calls\":[', {DEPTH})"), F.lit('{"type":"leaf"}'),
                               F.expr(f"repeat(']}}', {DEPTH})"), F.lit(end))
    # a supplier's payload is thousands of times its size in the file; a generator keeps filters after the exchange
    s = chain.spread(table(spark, sf, "supplier").select("s_suppkey"), "s_suppkey", chain.SPREAD_BYTES // 64)
    s = s.select(F.inline(F.array(F.struct("s_suppkey", F.when(F.col("s_suppkey") % 10 == 3, doc("")).otherwise(doc("}")).alias("doc")))))
    found = flatten_tree(s.filter(holds(F.col("doc"), "result")), "doc", "s_suppkey", within="result", malformed="keep")
    return found.select("s_suppkey", "trace_address", "parent_trace_address",
                        F.try_element_at("trace_json", F.lit("type")).alias("kind"),
                        F.try_element_at("trace_json", F.lit(MALFORMED)).isNotNull().alias("malformed"))


BLOCKS_SQL = f"""
  select {BLOCK_SQL} as block_number, o_custkey as base_fee_per_gas, {CENTS} as gas_used, {TX_SQL} as hash,
         printf('0x%040x', o_custkey) as miner, printf('0x%064x', o_orderkey + 1) as parent_hash,
         cast(66 as bigint) as nonce, o_custkey * 7 as size,
         o_orderdate + to_seconds(o_orderkey) as block_timestamp, cast(2 as integer) as tx_count,
         cast(cast(o_custkey + 1 as hugeint) * 1208925819614629174706176 as varchar) as total_difficulty,
         o_orderdate + case when o_orderstatus = 'P' then interval 1 day else interval 1 day end as _inserted_timestamp,
         md5(cast({BLOCK_SQL} as varchar)) as blocks_id
  from orders"""


@query("silver_blocks", BLOCKS_SQL)
def silver_blocks(spark, sf):
    b = blocks(spark, sf).withColumn("total_difficulty", F.col("total_difficulty").cast("string")) \
        .withColumn("nonce", F.col("nonce").cast("bigint"))
    return b.select("block_number", "base_fee_per_gas", "gas_used", "hash", "miner", "parent_hash", "nonce", "size",
                    "block_timestamp", "tx_count", "total_difficulty", "_inserted_timestamp", "blocks_id")


@query("gold_blocks", f"""
  select block_number, hash as block_hash, block_timestamp, 'mainnet' as network, tx_count, size, miner, gas_used,
         blocks_id as fact_blocks_id, timestamp '2002-01-01' as modified_timestamp from ({BLOCKS_SQL})""")
def gold_blocks(spark, sf):
    return G.gold_blocks(blocks(spark, sf), None).select(
        "block_number", "block_hash", "block_timestamp", "network", "tx_count", "size", "miner", "gas_used",
        "fact_blocks_id", "modified_timestamp")


RECEIPTS_SQL = f"""
  select {BLOCK_SQL} as block_number, {TX_SQL} as tx_hash, cast(0 as bigint) as position,
         {CENTS} as cumulative_gas_used, cast(o_custkey as double) as effective_gas_price,
         printf('0x%040x', o_custkey) as from_address,
         case when o_orderpriority = '2-HIGH' then 0 else {CENTS} end as gas_used,
         o_orderstatus = 'F' as tx_status,
         case when o_orderpriority <> '5-LOW' then printf('0x%040x', o_orderkey) end as to_address,
         cast(2 as bigint) as type
  from orders where o_orderpriority <> '1-URGENT'"""


@query("silver_receipts", RECEIPTS_SQL)
def silver_receipts(spark, sf):
    return receipts(spark, sf).select("block_number", "tx_hash", "position", "cumulative_gas_used",
                                      "effective_gas_price", "from_address", "gas_used", "tx_status", "to_address", "type")


FEE = "cast(o_custkey as hugeint) * r.gas_used * 1000000000"
TXS_SQL = f"""
  with r as ({RECEIPTS_SQL}),
  t as (
    select {BLOCK_SQL} as block_number, {TX_SQL} as tx_hash, printf('0x%040x', o_custkey) as from_address,
           {CENTS} as gas, case when o_orderstatus = 'O' then 0.0 else cast(o_custkey as double) end as gas_price,
           '0xa9059cbb' as origin_function_signature,
           cast(cast({CENTS} as hugeint) * 1152921504606846976 as varchar) as value_precise_raw,
           case when o_orderpriority <> '5-LOW' then printf('0x%040x', o_orderkey) end as to_address,
           o_orderdate + to_seconds(o_orderkey) as block_timestamp, o_custkey, o_orderkey as nonce
    from orders where o_orderpriority <> '3-MEDIUM')
  select t.*, r.tx_status is null as is_pending, r.gas_used, r.tx_status, {FEE} as fee_wei,
         coalesce(cast(cast({FEE} // 1000000000000000000 as varchar) || '.' ||
                       lpad(cast({FEE} % 1000000000000000000 as varchar), 18, '0') as double), 0) as tx_fee
  from t left join r using (block_number, tx_hash)"""


@query("silver_transactions", f"select * exclude (o_custkey, fee_wei) from ({TXS_SQL})")
def silver_transactions(spark, sf):
    return txs(spark, sf).select(
        "block_number", "tx_hash", "from_address", "gas", "gas_price", "origin_function_signature", "value_precise_raw",
        "to_address", "block_timestamp", "nonce", "is_pending", "gas_used", "tx_status", "tx_fee")


@query("gold_transactions", f"""
  select block_number, tx_hash, tx_status as tx_succeeded, gas as gas_limit, cast(0 as bigint) as tx_position,
         case when fee_wei is null then null when fee_wei = 0 then '0' else
           regexp_replace(regexp_replace(cast(fee_wei // 1000000000000000000 as varchar) || '.' ||
             lpad(cast(fee_wei % 1000000000000000000 as varchar), 18, '0'), '0+$', ''), '[.]$', '') end as tx_fee_precise,
         md5(tx_hash) as fact_transactions_id from ({TXS_SQL})""")
def gold_transactions(spark, sf):
    return G.gold_transactions(txs(spark, sf), None).select(
        "block_number", "tx_hash", "tx_succeeded", "gas_limit", "tx_position", "tx_fee_precise", "fact_transactions_id")


LOGS_SQL = f"""
  select {BLOCK_SQL} as block_number, {TX_SQL} as tx_hash, i as event_index, cast(0 as bigint) as tx_position,
         printf('0x%040x', o_custkey + i) as contract_address, o_orderstatus = 'F' as tx_status,
         '0x' || printf('%064x', {CENTS}) || printf('%064x', o_custkey) as data,
         list_slice(['0xaa', printf('0x%064x', o_custkey), printf('0x%064x', i), printf('0x%064x', o_orderkey)], 1, i + 1) as topics,
         case when o_orderpriority <> '3-MEDIUM' then o_orderdate + to_seconds(o_orderkey) end as block_timestamp,
         o_orderpriority = '3-MEDIUM' as is_pending, {TX_SQL} || '-' || i as _log_id
  from orders, unnest(range(0, o_custkey % 4)) as t(i) where o_orderpriority <> '1-URGENT'"""


@query("silver_logs", f"select * replace (array_to_string(topics, ',') as topics) from ({LOGS_SQL})")
def silver_logs(spark, sf):
    return logs(spark, sf).withColumn("topics", F.array_join("topics", ",")).select(
        "block_number", "tx_hash", "event_index", "tx_position", "contract_address", "tx_status", "data", "topics",
        "block_timestamp", "is_pending", "_log_id")


@query("gold_event_logs", f"""
  select block_number, event_index, topics[1] as topic_0, topics[2] as topic_1, topics[3] as topic_2, topics[4] as topic_3,
         tx_status as tx_succeeded, md5(_log_id) as fact_event_logs_id from ({LOGS_SQL})""")
def gold_event_logs(spark, sf):
    return G.gold_event_logs(logs(spark, sf), None).select(
        "block_number", "event_index", "topic_0", "topic_1", "topic_2", "topic_3", "tx_succeeded", "fact_event_logs_id")


# Every node of the synthetic call trees, from the same rule that builds them.
NODES_SQL = f"""
  with o as (select *, {BLOCK_SQL} as block_number, {CENTS} as cents, o_custkey % 13 as n from orders),
  nodes as (
    select block_number, o_orderkey, o_custkey, cents, o_orderpriority, n, 'ORIGIN' as trace_address, null as parent_trace_address,
           cast(-1 as bigint) as i, 0 as depth from o
    union all
    select block_number, o_orderkey, o_custkey, cents, o_orderpriority, n, cast(i as varchar), 'ORIGIN', i, 1 from o, unnest(range(0, n)) t(i)
    union all
    select block_number, o_orderkey, o_custkey, cents, o_orderpriority, n, i || '_0', cast(i as varchar), i, 2
    from o, unnest(range(0, n)) t(i) where o_orderkey % 2 = 0)
  select * from nodes"""


@query("silver_traces", f"""
  select block_number, cast(0 as bigint) as tx_position, trace_address, parent_trace_address, cast(depth as integer) as depth,
         case depth when 2 then 'STATICCALL' else 'CALL' end as type,
         case depth when 1 then printf('0x%x', i) when 2 then printf('0x%x', cents + i) end as value_hex,
         case when o_orderpriority = '1-URGENT' and depth = 0 then 'execution reverted'
              when o_orderpriority = '2-HIGH' and depth = 1 and i = 0 then 'out of gas' end as error
  from ({NODES_SQL})""")
def silver_traces(spark, sf):
    j = lambda k: F.try_element_at("trace_json", F.lit(k))
    depth = F.when(F.col("trace_address") == "ORIGIN", 0).otherwise(F.size("trace_address_array"))
    return S.silver_traces(chain.landed_traces(spark, sf), None, RUN).select(
        "block_number", "tx_position", "trace_address", "parent_trace_address", depth.alias("depth"), j("type").alias("type"), j("value").alias("value_hex"),
        j("error").alias("error"))


GOLD_TRACES_SQL = f"""
  select n.block_number, cast(0 as bigint) as tx_position, trace_address,
         case depth when 0 then n when 1 then (case when o_orderkey % 2 = 0 then 1 else 0 end) else 0 end as sub_traces,
         case when depth = 0 then 0 when o_orderkey % 2 = 0 then 2 * i + depth else i + 1 end as trace_index,
         not (o_orderpriority = '1-URGENT' or (o_orderpriority = '2-HIGH' and i = 0)) as trace_succeeded,
         case depth when 0 then '0' when 1 then cast(i as varchar) else cast(cents + i as varchar) end as value_precise_raw,
         t.tx_hash, t.tx_status as tx_succeeded
  from ({NODES_SQL}) n left join ({TXS_SQL}) t on n.block_number = t.block_number"""


@query("gold_traces", GOLD_TRACES_SQL)
def gold_traces(spark, sf):
    # both sides are tables: what their plans shuffle is gone before the calls are dealt by transaction
    t = txs(spark, sf).select("block_number", "position", "tx_hash", "block_timestamp", "origin_function_signature",
                              "from_address", "to_address", "tx_status", "modified_timestamp")
    return G.gold_traces(traces(spark, sf), keep(t), None, RUN).select(
        "block_number", "tx_position", "trace_address", "sub_traces", "trace_index", "trace_succeeded",
        "value_precise_raw", "tx_hash", "tx_succeeded")


# -- incremental runs --------------------------------------------------------

# Orders are 1995 to 2001; a first run sees what had landed by then, a second one the rest.
FIRST_RUN = dt.datetime(1998, 6, 1)


def in_two_runs(landed, plan, keys):
    """A plan's table after a first run over what had landed early and a second over everything."""
    early = landed.filter(F.col("_inserted_timestamp") <= inc.ts_lit(FIRST_RUN))
    first = keep(plan(early, None))
    return delete_insert(first, plan(landed, first), keys)


@query("silver_blocks_two_runs", f"select * from ({BLOCKS_SQL})")
def silver_blocks_two_runs(spark, sf):
    out = in_two_runs(chain.landed_blocks(spark, sf), lambda landed, t: S.silver_blocks(landed, t, RUN), "block_number")
    return out.withColumn("total_difficulty", F.col("total_difficulty").cast("string")).withColumn(
        "nonce", F.col("nonce").cast("bigint")).select(
        "block_number", "base_fee_per_gas", "gas_used", "hash", "miner", "parent_hash", "nonce", "size",
        "block_timestamp", "tx_count", "total_difficulty", "_inserted_timestamp", "blocks_id")


@query("silver_receipts_two_runs", RECEIPTS_SQL)
def silver_receipts_two_runs(spark, sf):
    out = in_two_runs(chain.landed_receipts(spark, sf), lambda landed, t: S.silver_receipts(landed, t, RUN), ["block_number", "position"])
    return out.select("block_number", "tx_hash", "position", "cumulative_gas_used", "effective_gas_price", "from_address",
                      "gas_used", "tx_status", "to_address", "type")


@query("silver_transactions_healed", f"select * exclude (o_custkey, fee_wei) from ({TXS_SQL})")
def silver_transactions_healed(spark, sf):
    """A first run before any receipt of every second order had landed; a second run heals those transactions."""
    b, r = blocks(spark, sf), receipts(spark, sf)
    landed = chain.landed_txs(spark, sf)
    first = keep(S.silver_transactions(landed, b, r.filter("block_number % 2 = 0"), None, RUN))
    second = S.silver_transactions(landed.filter(F.lit(False)), b, r, first, RUN)
    return delete_insert(first, second, ["block_number", "position"]).select(
        "block_number", "tx_hash", "from_address", "gas", "gas_price", "origin_function_signature", "value_precise_raw",
        "to_address", "block_timestamp", "nonce", "is_pending", "gas_used", "tx_status", "tx_fee")


@query("silver_traces_two_runs", f"""
  select block_number, cast(0 as bigint) as tx_position, trace_address, parent_trace_address from ({NODES_SQL})""")
def silver_traces_two_runs(spark, sf):
    out = in_two_runs(chain.landed_traces(spark, sf), lambda landed, t: S.silver_traces(landed, t, RUN), ["block_number", "tx_position"])
    return out.select("block_number", "tx_position", "trace_address", "parent_trace_address")


@query("gold_traces_two_runs", GOLD_TRACES_SQL)
def gold_traces_two_runs(spark, sf):
    """A first run over the traces that had landed early, when no transaction of an odd block was known; a second one over
    the rest, which completes the published calls of those blocks, whatever their age."""
    first_run = Run(FIRST_RUN, "first")
    landed, t = chain.landed_traces(spark, sf), keep(txs(spark, sf))
    early = landed.filter(F.col("_inserted_timestamp") <= inc.ts_lit(FIRST_RUN))
    silver = keep(S.silver_traces(early, None, first_run))
    first = keep(G.gold_traces(silver, t.filter("block_number % 2 = 0"), None, first_run))
    keys = ["block_number", "tx_position"]
    silver = keep(delete_insert(silver, S.silver_traces(landed, silver, RUN), keys))
    out = delete_insert(first, G.gold_traces(silver, t, first, RUN, heal_days=None), keys)
    return out.select("block_number", "tx_position", "trace_address", "sub_traces", "trace_index", "trace_succeeded",
                      "value_precise_raw", "tx_hash", "tx_succeeded")


# -- ingest ------------------------------------------------------------------

# 72 hours before this run lies 2001-07-29 04:00, which holds some blocks.
LATE = Run(dt.datetime(2001, 8, 1, 4, 30), "run")
LOOKBACK_SQL = f"""
  select coalesce(min(block_number), {BASE}) as block_number from ({BLOCKS_SQL})
  where block_number >= {BASE} and block_timestamp >= timestamp '2001-07-29 04:00:00'
    and block_timestamp < timestamp '2001-07-29 05:00:00'"""


@query("lookback_block", LOOKBACK_SQL)
def lookback_block(spark, sf):
    return I.lookback_block(blocks(spark, sf), LATE)


def head(spark, sf):
    return table(spark, sf, "orders").agg(F.max("o_orderkey")).first()[0] + BASE + 500


@query("expected_blocks", f"""
  select b as block_number, printf('0x%X', b) as block_number_hex
  from unnest(range({BASE} + 1, (select max(o_orderkey) + {BASE} + 501 from orders))) t(b)""")
def expected_blocks(spark, sf):
    return I.expected_blocks(spark, head(spark, sf))


@query("expected_txs", f"""
  select {BLOCK_SQL} as block_number, {TX_SQL} as tx_hash from orders
  union all select {BLOCK_SQL}, printf('0x%064x', o_orderkey + 1099511627776) from orders""")
def expected_txs(spark, sf):
    return I.expected_txs(blocks(spark, sf))


def _landed(spark, sf, kind):
    """Landings of one kind: blocks of some order statuses only."""
    keep = {"blocks": "OF", "receipts": "F", "receipts_by_hash": "FO", "traces": "FP", "transactions": "OP"}[kind]
    o = chain.orders(spark, sf).filter(F.col("o_orderstatus").isin(*keep))
    return o.select(F.to_json(F.struct(F.col("block_number").alias("BLOCK_NUMBER"), F.col("tx_hash").alias("TX_HASH"))).alias("VALUE"),
                    F.col("o_orderdate").alias("_inserted_timestamp"))


def _done_sql(keep):
    return f"select {BLOCK_SQL} as block_number, {TX_SQL} as tx_hash, o_orderdate as _inserted_timestamp from orders where o_orderstatus in ({keep})"


DONE = {"blocks": "'O', 'F'", "receipts": "'F'", "receipts_by_hash": "'F', 'O'", "traces": "'F', 'P'", "transactions": "'O', 'P'"}


def _add_ingest(kind):
    done = _done_sql(DONE[kind])
    by_hash = kind == "receipts_by_hash"
    key = "block_number, tx_hash" if by_hash else "block_number"
    ident = "md5(block_number || '-' || tx_hash)" if by_hash else "md5(cast(block_number as varchar))"

    @query(f"complete_{kind}", f"select {key}, _inserted_timestamp, {ident} as complete_{kind}_id from ({done})")
    def complete(spark, sf):
        cols = key.split(", ")
        return I.complete_sets(kind, _landed(spark, sf, kind), None, RUN).select(
            *cols, "_inserted_timestamp", f"complete_{kind}_id")

    method, asc = I.KINDS[kind]
    hexed = "printf('0x%x', block_number)"
    params = {"blocks": f"'\"' || {hexed} || '\",false'", "transactions": f"'\"' || {hexed} || '\",true'",
              "receipts": f"'\"' || {hexed} || '\"'", "receipts_by_hash": "'\"' || tx_hash || '\"'",
              "traces": f"'\"' || {hexed} || '\",{{\"tracer\":\"callTracer\",\"timeout\":\"180s\"}}'"}[kind]
    exp = (f"select {BLOCK_SQL} as block_number, {TX_SQL} as tx_hash from orders union all select {BLOCK_SQL}, "
           f"printf('0x%064x', o_orderkey + 1099511627776) from orders") if by_hash else \
        f"select b as block_number from unnest(range({BASE} + 1, (select max(o_orderkey) + {BASE} + 501 from orders))) t(b)"

    def todo_sql(side, limits):
        order = f"block_number {'asc' if asc else 'desc'}" + (", tx_hash" if by_hash else "")
        return f"""
          with todo as (select {key} from ({exp}) where block_number {side} ({LOOKBACK_SQL})
                        except select {key} from ({done})),
          capped as (select *, row_number() over (order by {order}) - 1 as rn from todo order by {order} limit {limits['cap']})
          select {key}, cast(round(block_number, -3) as bigint) as partition_key, rn // {limits['producer']} as producer_batch,
                 rn // {limits['worker']} as worker_batch,
                 '{{"id":"' || block_number || '","jsonrpc":"2.0","method":"{method}","params":[' || {params} || ']}}' as request
          from capped"""

    def expected(spark, sf):
        return I.expected_txs(blocks(spark, sf)) if by_hash else I.expected_blocks(spark, head(spark, sf)).select("block_number")

    @query(f"backlog_realtime_{kind}", todo_sql(">=", I.REALTIME_BY_HASH if by_hash else I.REALTIME))
    def realtime(spark, sf):
        done = I.complete_sets(kind, _landed(spark, sf, kind), None, RUN)
        return I.backlog_realtime(kind, expected(spark, sf), done, I.lookback_block(blocks(spark, sf), LATE))

    if not by_hash:
        @query(f"backlog_history_{kind}", todo_sql("<", I.HISTORY))
        def history(spark, sf):
            done = I.complete_sets(kind, _landed(spark, sf, kind), None, RUN)
            return I.backlog_history(kind, expected(spark, sf), done, I.lookback_block(blocks(spark, sf), LATE))


for _kind in DONE:
    _add_ingest(_kind)


@query("complete_receipts_seeded", f"""
  select block_number, max(_inserted_timestamp) as _inserted_timestamp
  from (({_done_sql("'F'")}) union all ({_done_sql("'F', 'O'")})) group by all""")
def complete_receipts_seeded(spark, sf):
    seed = I.complete_sets("receipts_by_hash", _landed(spark, sf, "receipts_by_hash"), None, RUN)
    return I.complete_sets("receipts", _landed(spark, sf, "receipts"), None, RUN, seed).select(
        "block_number", "_inserted_timestamp")
