"""Marketplace plans over events derived from the orders table."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.operators.groups import keep
from ledgerloom.operators.incremental import Run
from ledgerloom.plans.nft import element as E, joepegs as J, salvor as S, seaport as Z
from ledgerloom.plans.nft.aggregators import aggregator_list
from ledgerloom.plans.nft.common import NATIVE, SALE_COLUMNS, WRAPPED_NATIVE
from ledgerloom.plans.nft.complete import gold_nft_sales, sales_complete
from ledgerloom.sources import delete_insert
from ledgerloom.sources.constants import aggregator_rows
from . import market as M
from .base import query, table
from .chain import BASE, BLOCK_SQL, TX_SQL

RUN = Run(dt.datetime(2033, 1, 1), "run")
CENTS = "cast(round(o_totalprice * 100) as bigint)"
LOG = ["tx_hash", "event_index", "event_type", "seller_address", "buyer_address", "nft_address", "tokenid", "erc1155_value",
       "currency_address", "total_price_raw", "total_fees_raw", "platform_fee_raw", "creator_fee_raw", "nft_log_id"]


def shaped(df):
    """Comparable columns: exact amounts as doubles, which hold them exactly."""
    return df.select(*[F.col(c).cast("double").alias(c) if c.endswith("_raw") else F.col(c) for c in LOG])


def adr(e):
    return f"printf('0x%040x', {e})"


JOEPEGS_SQL = f"""
  with s as (select *, {TX_SQL} as tx_hash, {CENTS} as cents, o_custkey % 3 + 1 as n from orders, unnest(range(0, o_custkey % 3 + 1)) t(k)),
  x as (select *, case when o_orderstatus = 'F' then o_custkey + k else 0 end as creator,
               case when o_orderpriority in ('2-HIGH', '5-LOW') then 0 when o_orderstatus <> 'O' then 100 + k
                    when k > 0 then 99 + k else 0 end as platform from s)
  select tx_hash, 10 * k + 5 as event_index, case when k % 2 = 0 then 'sale' else 'bid_won' end as event_type,
         {adr("case when k % 2 = 0 then o_custkey + 1 else o_custkey + 2 end")} as seller_address,
         {adr("case when k % 2 = 0 then o_custkey + 2 else o_custkey + 1 end")} as buyer_address,
         {adr("o_custkey + k")} as nft_address, cast(k as varchar) as tokenid,
         case when (o_custkey + k) % 2 = 1 then '3' end as erc1155_value, '{WRAPPED_NATIVE}' as currency_address,
         cast(cents as double) as total_price_raw, cast(platform + creator as double) as total_fees_raw,
         cast(platform as double) as platform_fee_raw, cast(creator as double) as creator_fee_raw,
         {adr("o_custkey + k")} || '-' || k || '-' || tx_hash || '-' || (10 * k + 5) || '-JoepegExchange' as nft_log_id,
         {BLOCK_SQL} as block_number, o_orderdate + interval 10000 day as block_timestamp, o_custkey
  from x"""


def joepegs(spark, sf):
    decoded, transfers, txs = M.joepegs(spark, sf)
    return J.sales_joepegs(decoded, transfers, txs, None, RUN)


@query("sales_joepegs", f"select * exclude (block_number, block_timestamp, o_custkey) from ({JOEPEGS_SQL})")
def q_joepegs(spark, sf):
    return shaped(joepegs(spark, sf))


SALVOR_SQL = f"""
  with s as (select *, {TX_SQL} as tx_hash, {CENTS} as cents from orders),
  t as (select *, unnest(case o_orderpriority when '2-HIGH' then [null] when '3-MEDIUM' then [0, 1] else [0] end) as i from s)
  select tx_hash, cast(9 as bigint) as event_index,
         case when o_orderpriority = '1-URGENT' or o_orderstatus = 'O' then 'bid_won' else 'sale' end as event_type,
         {adr("o_custkey + 1")} as seller_address, case when i is not null then {adr("o_custkey + 5 + i")} end as buyer_address,
         {adr("o_custkey")} as nft_address, cast(o_orderkey as varchar) as tokenid, cast(null as varchar) as erc1155_value,
         'AVAX' as currency_address,
         cast(case o_orderstatus when 'F' then cents + 18 when 'O' then cents + 1000 else cents + 11 end as double) as total_price_raw,
         cast(case o_orderstatus when 'F' then 18 else 0 end as double) as total_fees_raw,
         cast(case o_orderstatus when 'F' then 7 else 0 end as double) as platform_fee_raw,
         cast(case o_orderstatus when 'F' then 11 else 0 end as double) as creator_fee_raw,
         {adr("o_custkey")} || '-' || o_orderkey || '-' || tx_hash || '-9-salvor v1' as nft_log_id
  from t"""


def salvor(spark, sf):
    logs, transfers, txs = M.salvor(spark, sf)
    return S.sales_salvor(logs, transfers, txs, None, RUN)


@query("sales_salvor", SALVOR_SQL)
def q_salvor(spark, sf):
    return shaped(salvor(spark, sf))


ELEMENT_SQL = f"""
  with s as (select *, {TX_SQL} as tx_hash, {CENTS} as cents, o_orderdate + interval 9000 day as ts
             from orders, unnest(range(0, o_custkey % 3 + 1)) t(k) where o_orderdate + interval 9000 day >= timestamp '2022-04-15'),
  x as (select *, ts <= timestamp '2022-10-21 03:41:33' as early, o_orderstatus = 'F' as native from s),
  y as (select *, case when early and native then 2e18 when early then 20 when o_orderstatus = 'P' then 0 else 3 end as platform,
               case when early and native then 1e18 when early then 10 when o_orderstatus = 'P' then 0 else 9 end as creator,
               case when early and native then (k + 10) * 1e18 when early then cents + 80 else cents end as price from x)
  select tx_hash, 10 * k + 9 as event_index, case when k = 1 then 'bid_won' else 'sale' end as event_type,
         {adr("case when k = 1 then o_custkey + 2 else o_custkey + 1 end")} as seller_address,
         {adr("case when k = 1 then o_custkey + 1 else o_custkey + 2 end")} as buyer_address,
         {adr("o_custkey")} as nft_address, cast(k as varchar) as tokenid, case when k = 2 then '6' end as erc1155_value,
         case when native then 'AVAX' else '{M.TOKEN}' end as currency_address, cast(price as double) as total_price_raw,
         cast(platform + creator as double) as total_fees_raw, cast(platform as double) as platform_fee_raw,
         cast(creator as double) as creator_fee_raw,
         {adr("o_custkey")} || '-' || k || '-element v1-' || tx_hash || '-' || (10 * k + 9) as nft_log_id
  from y"""


def element(spark, sf):
    return E.sales_element(*M.element(spark, sf), None, RUN)


@query("sales_element", ELEMENT_SQL)
def q_element(spark, sf):
    return shaped(element(spark, sf))


# Single orders: one row per sold asset of each kind of order.
SELLER, BUYER, NFT = adr("o_custkey + 1"), adr("o_custkey + 2"), adr("o_custkey + 1000")


def singles_sql(version, select=""):
    return f"""
      with s as (select *, {TX_SQL} as tx_hash, {CENTS} as cents, o_orderpriority as p, o_orderstatus as st from orders),
      a as (
        select *, 'sale' as event_type, '0' as part, 'AVAX' as cur, cents + 30.0 as price, 10.0 as platform, 20.0 as creator, null as v1155 from s where p = '1-URGENT'
        union all select *, 'sale', '0', 'AVAX', (cents + 30) / 2.0, 5.0, 10.0, null from s where p = '2-HIGH'
        union all select *, 'sale', '1', 'AVAX', (cents + 30) / 2.0, 5.0, 10.0, '5' from s where p = '2-HIGH'
        union all select *, 'sale', '0', 'AVAX', cents, 0.0, 0.0, null from s where p = '3-MEDIUM'
        union all select *, 'bid_won', '0', '{M.TOKEN}', cents, 10.0, 20.0, null from s where p = '4-NOT SPECIFIED'
        union all select *, 'bid_won', '0', '{M.TOKEN}', cents, 0.0, 0.0, null from s where p = '5-LOW' and st = 'F'
        union all select *, 'bid_won', '0', null, 0.0, 0.0, 0.0, null from s where p = '5-LOW' and st = 'O'
        union all select *, 'sale', '0', null, 0.0, 0.0, 0.0, null from s where p = '5-LOW' and st = 'P'),
      b as (select *, cast(o_orderkey as varchar) || case when part = '1' then '077' else '' end as tokenid,
                   case when p = '1-URGENT' and st = 'O' then {adr("o_custkey")} else {NFT} end as nft from a)
      select tx_hash, cast(1 as bigint) as event_index, event_type,
             case when p = '5-LOW' and st = 'O' then {BUYER} else {SELLER} end as seller_address, {BUYER} as buyer_address,
             nft as nft_address, tokenid, v1155 as erc1155_value, cur as currency_address, cast(price as double) as total_price_raw,
             cast(platform + creator as double) as total_fees_raw, cast(platform as double) as platform_fee_raw,
             cast(creator as double) as creator_fee_raw,
             nft || '-' || tokenid || '-seaport_{version}-1-' || tx_hash as nft_log_id
      from b"""


def matched_sql(version):
    """Rows of matched groups: the bid's asset, priced by the listing."""
    row = lambda index, ident, price, platform, creator, cur, seller, buyer, where: f"""
      select tx_hash, cast({index} as bigint) as event_index, 'bid_won' as event_type, {seller} as seller_address,
             {buyer} as buyer_address, {NFT} as nft_address, {ident} as tokenid, cast(null as varchar) as erc1155_value,
             {cur} as currency_address, cast({price} as double) as total_price_raw,
             cast({platform} + {creator} as double) as total_fees_raw, cast({platform} as double) as platform_fee_raw,
             cast({creator} as double) as creator_fee_raw,
             {NFT} || '-' || {ident} || '-seaport_{version}-{index}-' || tx_hash as nft_log_id
      from s where {where}"""
    key, tok = "cast(o_orderkey as varchar)", f"'{M.TOKEN}'"
    return f"""
      with s as (select *, {TX_SQL} as tx_hash, {CENTS} as cents from orders)
      {row(11, key, 'cents + 30', 10, 20, tok, SELLER, BUYER, "o_orderstatus in ('F', 'P')")}
      union all {row(14, key + " || '5'", 'cents + 4 + 30', 10, 20, tok, SELLER, BUYER, "o_orderstatus = 'P'")}
      union all {row(10, key + " || '9'", 'cents', 0, 0, tok, BUYER, SELLER, "o_orderstatus = 'O'")}
      union all {row(11, key, '0', 0, 0, 'null', SELLER, BUYER, "o_orderstatus = 'O'")}"""


def pairs_sql():
    """Rows of matched pairs: the bid states the price; the deal holds no bid."""
    row = lambda index, ident, where: f"""
      select tx_hash, cast({index} as bigint) as event_index, 'bid_won' as event_type, {SELLER} as seller_address,
             {BUYER} as buyer_address, {NFT} as nft_address, {ident} as tokenid, cast(null as varchar) as erc1155_value,
             '{M.TOKEN}' as currency_address, cast(cents + 30 as double) as total_price_raw, cast(30 as double) as total_fees_raw,
             cast(10 as double) as platform_fee_raw, cast(20 as double) as creator_fee_raw,
             {NFT} || '-' || {ident} || '-seaport_1_4-{index}-' || tx_hash as nft_log_id
      from s where {where}"""
    key = "cast(o_orderkey as varchar)"
    return f"""
      with s as (select *, {TX_SQL} as tx_hash, {CENTS} as cents from orders)
      {row(11, key, "o_orderstatus in ('F', 'P')")} union all {row(14, key + " || '5'", "o_orderstatus = 'P'")}"""


DAYS = {"1_1": 10_500, "1_4": 10_500, "1_5": 10_600, "1_6": 11_000}


def seaport(spark, sf, version):
    decoded, logs, txs = M.seaport(spark, sf, version, DAYS[version])
    return Z.sales_seaport(version, decoded, logs, txs, None, RUN)


@query("sales_seaport_1_1", singles_sql("1_1"))
def seaport_1_1(spark, sf):
    return shaped(seaport(spark, sf, "1_1"))


@query("sales_seaport_fulfilled", f"select * from ({singles_sql('1_6')})")
def seaport_fulfilled(spark, sf):
    """Only single orders, with the later version's rules."""
    df = M.base(spark, sf, DAYS["1_6"])
    contract = Z.VERSIONS["1_6"].contract
    ev = M.events(df, M.single_orders(contract))
    _, logs, txs = M.seaport(spark, sf, "1_6", DAYS["1_6"])
    return shaped(Z.sales_seaport("1_6", ev, logs.filter(F.get("topics", F.lit(0)) != Z.MATCHED), txs, None, RUN))


@query("sales_seaport_1_5", f"select * from ({singles_sql('1_5')}) union all select * from ({matched_sql('1_5')})")
def seaport_1_5(spark, sf):
    return shaped(seaport(spark, sf, "1_5"))


@query("sales_seaport_1_6", f"select * from ({singles_sql('1_6')}) union all select * from ({matched_sql('1_6')})")
def seaport_1_6(spark, sf):
    return shaped(seaport(spark, sf, "1_6"))


@query("sales_seaport_matched_group", matched_sql("1_6"))
def seaport_matched_group(spark, sf):
    df = M.base(spark, sf, DAYS["1_6"])
    ev = M.events(df, M.matched_orders(Z.VERSIONS["1_6"].contract))
    return shaped(Z.sales_seaport("1_6", ev, ev, M.transactions(df), None, RUN))


@query("sales_seaport_matched_pair", pairs_sql())
def seaport_matched_pair(spark, sf):
    df = M.base(spark, sf, DAYS["1_4"])
    ev = M.events(df, M.matched_orders(Z.VERSIONS["1_4"].contract, deals=False))
    return shaped(Z.sales_seaport("1_4", ev, ev, M.transactions(df), None, RUN))


@query("sales_seaport_1_4", f"select * from ({singles_sql('1_4')}) union all select * from ({pairs_sql()})")
def seaport_1_4(spark, sf):
    return shaped(seaport(spark, sf, "1_4"))


@query("aggregator_list", """
  select '0' as aggregator_identifier, '0' as aggregator, 'calldata' as aggregator_type, timestamp '2020-01-01' as _inserted_timestamp
  union all select '0x0000000000000000000000000000000000000000', 'name', 'router', timestamp '2020-01-01'
  union all select 's' || s_suppkey, 'label of ' || s_name, 'calldata', timestamp '2020-01-01' from supplier""")
def q_aggregator_list(spark, sf):
    """Placeholders, then one label per supplier twice, then a batch that
    renames them all: first-listed times stay."""
    s = table(spark, sf, "supplier").select(
        F.concat(F.lit("s"), F.col("s_suppkey")).alias("aggregator_identifier"), F.col("s_name").alias("aggregator"),
        F.lit("calldata").alias("aggregator_type"), F.lit("2020-01-01").cast("timestamp_ntz").alias("_inserted_timestamp"))
    older = s.withColumns({"aggregator": F.lit("old"), "_inserted_timestamp": F.lit("2019-01-01").cast("timestamp_ntz")})
    target = aggregator_list(aggregator_rows(spark).unionByName(s).unionByName(older), None)
    batch = s.withColumns({"aggregator": F.concat(F.lit("label of "), "aggregator"),
                           "_inserted_timestamp": F.lit("2021-01-01").cast("timestamp_ntz")})
    return aggregator_list(batch, target)


# -- all markets -------------------------------------------------------------

def prices(spark, sf):
    """Price of the wrapped coin at midnight of every order's day but Sundays."""
    days = table(spark, sf, "orders").select("o_orderdate").distinct().filter(F.dayofweek("o_orderdate") != 1)
    return days.select(F.expr("o_orderdate + interval 10000 days").alias("hour"), F.lit("WAVAX").alias("symbol"),
                       F.lit(WRAPPED_NATIVE).alias("token_address"), F.lit(18).alias("decimals"),
                       (F.dayofmonth("o_orderdate") + 10.0).alias("price"))


def contracts(spark, sf, day="2020-01-01"):
    p = table(spark, sf, "part")
    return p.select(M.addr("p_partkey").alias("contract_address"), F.lit(None).cast("string").alias("token_symbol"),
                    F.when(F.col("p_size") > 10, F.col("p_name")).alias("token_name"), F.lit(None).cast("int").alias("token_decimals"),
                    F.lit(day).cast("timestamp_ntz").alias("_inserted_timestamp"))


def aggregators(spark, sf, day="2020-01-01"):
    s = table(spark, sf, "supplier")
    rows = s.select(F.lpad(F.col("s_suppkey").cast("string"), 8, "0").alias("aggregator_identifier"), F.col("s_name").alias("aggregator"),
                    F.when(F.col("s_suppkey") % 2 == 1, "calldata").otherwise("router").alias("aggregator_type"))
    router = s.filter("s_suppkey = 0").select(F.lit("0x02").alias("aggregator_identifier"), F.lit("routed").alias("aggregator"),
                                              F.lit("router").alias("aggregator_type"))
    return rows.unionByName(router).withColumn("_inserted_timestamp", F.lit(day).cast("timestamp_ntz"))


COMPLETE_SQL = f"""
  with j as ({JOEPEGS_SQL}),
  p as (select distinct o_orderdate + interval 10000 day as hour, dayofmonth(o_orderdate) + 10.0 as price from orders
        where dayofweek(o_orderdate) <> 0),
  a as (select lpad(cast(s_suppkey as varchar), 8, '0') as tail, s_name as label from supplier where s_suppkey % 2 = 1)
  select j.tx_hash, j.event_index, j.nft_log_id, case when o_custkey % 10 = 9 then 'routed' else 'joepegs' end as platform_name,
         label as aggregator_name, case when p_size > 10 then p_name end as project_name,
         case when price is not null then 'WAVAX' end as currency_symbol, total_price_raw / 1e18 as price,
         coalesce(total_price_raw / 1e18 * price, 0) as price_usd, total_fees_raw / 1e18 as total_fees,
         coalesce(creator_fee_raw / 1e18 * price, 0) as creator_fee_usd, o_custkey / 1000 as tx_fee,
         o_custkey / 1000 * price as tx_fee_usd,
         md5(j.tx_hash || '-' || j.event_index || '-' || nft_address || '-' || tokenid || '-JoepegExchange') as complete_nft_sales_id
  from j left join p on j.block_timestamp = p.hour
  left join a on tail = lpad(cast(o_custkey % 10 as varchar), 8, '0')
  left join (select {adr('p_partkey')} as addr, * from part) on addr = nft_address"""
COMPLETE = ["tx_hash", "event_index", "nft_log_id", "platform_name", "aggregator_name", "project_name", "currency_symbol", "price",
            "price_usd", "total_fees", "creator_fee_usd", "tx_fee", "tx_fee_usd", "complete_nft_sales_id"]


def _tables(markets):
    """The sales tables of some markets, as tables: what one market's plan shuffles is gone when the next begins."""
    return {k: keep(df) for k, df in markets.items()}


def complete(spark, sf):
    return sales_complete({"joepegs": joepegs(spark, sf)}, prices(spark, sf), contracts(spark, sf), aggregators(spark, sf), None, RUN)


@query("sales_complete", COMPLETE_SQL)
def q_complete(spark, sf):
    return complete(spark, sf).select(*COMPLETE)


@query("sales_complete_markets", """
  select platform_name, platform_exchange_version, count(*) as n from (
    select case when o_custkey % 10 = 9 then 'routed' else 'joepegs' end as platform_name, 'JoepegExchange' as platform_exchange_version
    from orders, unnest(range(0, o_custkey % 3 + 1)) t(k)
    union all
    select 'salvor', 'salvor v1' from orders
    union all
    select case when o_custkey % 10 = 9 then 'routed' else 'element' end, 'element v1' from orders, unnest(range(0, o_custkey % 3 + 1)) t(k)
    where o_orderdate + interval 9000 day >= timestamp '2022-04-15') group by all""")
def q_complete_markets(spark, sf):
    made = {"joepegs": joepegs(spark, sf), "salvor": salvor(spark, sf), "element": element(spark, sf)}
    out = sales_complete(_tables(made), prices(spark, sf), contracts(spark, sf), aggregators(spark, sf), None, RUN)
    return out.groupBy("platform_name", "platform_exchange_version").agg(F.count(F.lit(1)).alias("n"))


def _seven(spark, sf):
    """The sales tables of all markets: two runs and their healing read them several times."""
    made = {"joepegs": joepegs(spark, sf), "salvor": salvor(spark, sf), "element": element(spark, sf),
            **{"seaport_" + v: seaport(spark, sf, v) for v in ("1_1", "1_4", "1_5", "1_6")}}
    return _tables(made)


# Each market: version, name, contract, days its orders are shifted by, how its log id is put together, its rows.
_TX_FIRST, _TX_LAST = "tx_hash || '-' || event_index", "event_index || '-' || tx_hash"
_MARKETS = [("JoepegExchange", "joepegs", J.EXCHANGE, 10_000, _TX_FIRST, [JOEPEGS_SQL]),
            ("salvor v1", "salvor", S.MARKET, 11_000, _TX_FIRST, [SALVOR_SQL]),
            ("element v1", "element", E.MARKET, 9_000, _TX_FIRST, [ELEMENT_SQL]),
            *[("seaport_" + v, "opensea", Z.VERSIONS[v].contract, DAYS[v], _TX_LAST, [singles_sql(v), *more]) for v, more in (
                ("1_1", []), ("1_4", [pairs_sql()]), ("1_5", [matched_sql("1_5")]), ("1_6", [matched_sql("1_6")]))]]
_ALL_SALES_SQL = " union all ".join(
    f"select {', '.join(LOG)}, '{version}' as platform_exchange_version, '{name}' as own_name, '{contract}' as platform_address, "
    f"{days} as days, {log_id} as _log_id from ({q})" for version, name, contract, days, log_id, parts in _MARKETS for q in parts)
_AMOUNTS = {"price": "total_price_raw", "total_fees": "total_fees_raw", "platform_fee": "platform_fee_raw", "creator_fee": "creator_fee_raw"}
_COIN = f"(currency_address is not null and currency_address in ('{NATIVE}', '{WRAPPED_NATIVE}'))"

#: Every column of every market's sales, computed from the orders. Of two sales with one id the first buyer's stays.
ALL_COLUMNS_SQL = f"""
  with sales as ({_ALL_SALES_SQL}),
  one as (select * from sales qualify row_number() over (partition by nft_log_id order by buyer_address) = 1),
  o as (select {TX_SQL} as tx_hash, {BLOCK_SQL} as block_number, o_custkey, o_orderpriority, o_orderdate from orders),
  p as (select distinct o_orderdate + interval 10000 day as hour, dayofmonth(o_orderdate) + 10.0 as hourly from orders
        where dayofweek(o_orderdate) <> 0),
  a as (select lpad(cast(s_suppkey as varchar), 8, '0') as tail, s_name as label from supplier where s_suppkey % 2 = 1),
  n as (select {adr('p_partkey')} as addr, case when p_size > 10 then p_name end as p_name from part),
  routed as (select count(*) as n from supplier where s_suppkey = 0),
  full_ as (
    select one.*, block_number, o_orderdate + to_days(days) as block_timestamp, o_custkey / 1000 as tx_fee,
           case when platform_exchange_version <> 'salvor v1' then {adr('o_custkey')}
                when o_orderpriority = '1-URGENT' then {adr('o_custkey + 1')} else '0x02' end as origin_from_address,
           case when platform_exchange_version <> 'salvor v1' and o_custkey % 10 = 9 then '0x02' else '0x01' end as origin_to_address,
           '0xa9059cbb' as origin_function_signature, '0x' || lpad(cast(o_custkey % 10 as varchar), 8, '0') as input_data
    from one join o using (tx_hash))
  select tx_hash, block_number, block_timestamp, event_index, event_type, platform_address,
         case when origin_to_address = '0x02' and routed.n > 0 then 'routed' else own_name end as platform_name,
         platform_exchange_version, seller_address, buyer_address, nft_address, erc1155_value, tokenid, currency_address,
         {', '.join(_AMOUNTS.values())}, tx_fee, origin_from_address, origin_to_address, origin_function_signature,
         input_data, nft_log_id, _log_id, block_timestamp as _inserted_timestamp,
         {', '.join(f"case when {_COIN} then {raw} / 1e18 else {raw} end as {c}" for c, raw in _AMOUNTS.items())},
         {', '.join(f"case when {_COIN} then coalesce({raw} / 1e18 * hourly, 0) else 0.0 end as {c}_usd" for c, raw in _AMOUNTS.items())},
         case when hourly is null then null when currency_address = '{NATIVE}' then '{NATIVE}'
              when currency_address = '{WRAPPED_NATIVE}' then 'WAVAX' end as currency_symbol,
         tx_fee * hourly as tx_fee_usd, label as aggregator_name, p_name as project_name,
         md5(tx_hash || '-' || event_index || '-' || nft_address || '-' || tokenid || '-' || platform_exchange_version) as complete_nft_sales_id,
         timestamp '2033-01-01' as inserted_timestamp, timestamp '2033-01-01' as modified_timestamp
  from full_ left join p on block_timestamp = hour left join a on tail = right(input_data, 8)
  left join n on addr = nft_address cross join routed"""


ALL_COLUMNS = [*SALE_COLUMNS, *_AMOUNTS, *[c + "_usd" for c in _AMOUNTS], "currency_symbol", "tx_fee_usd", "aggregator_name",
               "project_name", "complete_nft_sales_id"]


def all_sales(spark, sf):
    return sales_complete(_seven(spark, sf), prices(spark, sf), contracts(spark, sf), aggregators(spark, sf), None, RUN)


@query("sales_complete_rows", ALL_COLUMNS_SQL)
def q_complete_rows(spark, sf):
    """All seven markets, every row and column."""
    return all_sales(spark, sf).drop("_invocation_id")


@query("sales_complete_healed", ALL_COLUMNS_SQL)
def q_complete_healed(spark, sf):
    """All seven markets in two runs: the first knows no collection's name, the second brings the newest sales and
    names the earlier ones. Every row and column is as after one run."""
    markets, named = _seven(spark, sf), contracts(spark, sf, "2032-12-31")
    side = prices(spark, sf), named, aggregators(spark, sf)
    half = dt.datetime(2025, 6, 1)
    early = {k: df.filter(F.col("_inserted_timestamp") <= F.lit(str(half)).cast("timestamp_ntz")) for k, df in markets.items()}
    first = keep(sales_complete(early, side[0], named.withColumn("token_name", F.lit(None).cast("string")), side[2], None, RUN))
    second = sales_complete(markets, *side, first, RUN, heal=True)
    return delete_insert(first, second, "nft_log_id").drop("_invocation_id")


GOLD_SALES_SQL = f"""
  select block_number, block_timestamp, tx_hash, event_index, event_type, platform_address, platform_name, platform_exchange_version,
         aggregator_name, seller_address, buyer_address, nft_address as contract_address, project_name as name, tokenid as token_id,
         coalesce(erc1155_value, '1') as quantity, case when erc1155_value is null then 'erc721' else 'erc1155' end as token_standard,
         currency_symbol, currency_address, price, price_usd, total_fees, platform_fee, creator_fee, total_fees_usd,
         platform_fee_usd, creator_fee_usd, tx_fee, tx_fee_usd, origin_from_address, origin_to_address, origin_function_signature,
         complete_nft_sales_id as ez_nft_sales_id, inserted_timestamp, modified_timestamp from ({ALL_COLUMNS_SQL})"""


@query("gold_nft_sales", GOLD_SALES_SQL)
def q_gold_nft_sales(spark, sf):
    """The public view of all seven markets, every column."""
    return gold_nft_sales(all_sales(spark, sf))


# -- each market in two runs ---------------------------------------------------

def in_two_runs(plan, inputs, days: int):
    """A market's table after a first run over what had happened by the middle of 1998 and a second over everything.
    The markets' own seven days do not bound the second run, which comes years later."""
    half = F.lit(str(dt.datetime(1998, 6, 1) + dt.timedelta(days=days))).cast("timestamp_ntz")
    early = [df.filter(F.col("modified_timestamp") <= half) for df in inputs]
    first = keep(plan(*early, None, RUN))
    return delete_insert(first, plan(*inputs, first, RUN._replace(days=float("inf"))), "nft_log_id")


@query("sales_joepegs_two_runs", f"select * exclude (block_number, block_timestamp, o_custkey) from ({JOEPEGS_SQL})")
def joepegs_two_runs(spark, sf):
    return shaped(in_two_runs(J.sales_joepegs, M.joepegs(spark, sf), 10_000))


@query("sales_salvor_two_runs", SALVOR_SQL)
def salvor_two_runs(spark, sf):
    logs, transfers, txs = M.salvor(spark, sf)
    return shaped(in_two_runs(lambda ev, tx, target, run: S.sales_salvor(ev, transfers, tx, target, run), [logs, txs], 11_000))


@query("sales_element_two_runs", ELEMENT_SQL)
def element_two_runs(spark, sf):
    return shaped(in_two_runs(E.sales_element, M.element(spark, sf), 9_000))


@query("sales_seaport_1_6_two_runs", f"select * from ({singles_sql('1_6')}) union all select * from ({matched_sql('1_6')})")
def seaport_two_runs(spark, sf):
    return shaped(in_two_runs(lambda *a: Z.sales_seaport("1_6", *a), M.seaport(spark, sf, "1_6", DAYS["1_6"]), DAYS["1_6"]))
