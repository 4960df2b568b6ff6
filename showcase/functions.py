"""Scalar functions over whole tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom import functions as L
from ledgerloom.operators import project as P
from .base import query, table
from .chain import spread

HEX64 = "printf('0x%064x', {})"


def hex_of(c, width: int = 0):
    """0x-hex text of a bigint column, optionally padded."""
    h = F.lower(F.hex(F.col(c) if isinstance(c, str) else c))
    return F.concat(F.lit("0x"), F.lpad(h, width, "0") if width else h)


@query("fn_hex_to_int", """
  select o_orderkey, cast(o_custkey as varchar) as short_dec, o_custkey as short_long,
         cast(cast(o_custkey as hugeint) * 1208925819614629174706176 + o_orderkey as varchar) as wide_dec
  from orders""")
def fn_hex_to_int(spark, sf):
    o = spread(table(spark, sf, "orders"), "o_orderkey")
    wide = F.concat(hex_of("o_custkey"), F.lpad(F.lower(F.hex("o_orderkey")), 20, "0"))
    return o.select("o_orderkey", L.hex_to_dec(hex_of("o_custkey")).alias("short_dec"),
                    L.hex_to_long(hex_of("o_custkey")).alias("short_long"),
                    L.hex_to_dec(wide).alias("wide_dec"))


@query("fn_hex_to_int_256", """
  select o_orderkey, '115792089237316195423570985008687907853269984665640564039457584007913129' ||
         cast(639935 - o_custkey as varchar) as near_max
  from orders""")
def fn_hex_to_int_256(spark, sf):
    o = spread(table(spark, sf, "orders"), "o_orderkey")
    low = F.lpad(F.lower(F.hex(F.lit(0xffffffff) - F.col("o_custkey"))), 8, "0")
    return o.select("o_orderkey", L.hex_to_dec(F.concat(F.lit("0x" + "f" * 56), low)).alias("near_max"))


@query("fn_int_to_hex", """
  select o_orderkey, printf('0x%x', o_orderkey) as hex_lower, printf('0x%X', o_orderkey) as hex_upper from orders""")
def fn_int_to_hex(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", L.int_to_hex("o_orderkey").alias("hex_lower"),
        L.int_to_hex("o_orderkey", upper=True).alias("hex_upper"))


@query("fn_decimal_adjust", """
  with x as (select o_orderkey, cast(round(o_totalprice * 100) as bigint) as n from orders)
  select o_orderkey,
         case when n % 100 = 0 then cast(n // 100 as varchar)
              else cast(n // 100 as varchar) || '.' || rtrim(printf('%02d', n % 100), '0') end as price,
         case when n = 0 then '0' else '0.' || rtrim(printf('%018d', n), '0') end as small
  from x""")
def fn_decimal_adjust(spark, sf):
    o = table(spark, sf, "orders").withColumn("n", F.round(F.col("o_totalprice") * 100).cast("bigint"))
    return o.select("o_orderkey", L.decimal_adjust("n", 2).alias("price"), L.decimal_adjust("n", 18).alias("small"))


@query("fn_try_to_number", """
  select c_custkey, cast(try_cast(replace(c_name, 'Customer#', '') as bigint) as bigint) as from_name,
         cast(null as bigint) as bad
  from customer""")
def fn_try_to_number(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey",
                    L.try_number(F.regexp_replace("c_name", "Customer#", "")).cast("bigint").alias("from_name"),
                    L.try_number("c_name").cast("bigint").alias("bad"))


def _event_data(o):
    """ABI-shaped data: word of the order, word of the customer, a cut-off tail."""
    return o.withColumn("data", F.concat(hex_of("o_orderkey", 64), F.lpad(F.lower(F.hex("o_custkey")), 64, "0"),
                                         F.lit("abcdef")))


@query("fn_split_words", """
  select o_orderkey, 2 as n_words, printf('%064x', o_orderkey) as word_0, printf('%064x', o_custkey) as word_1
  from orders""")
def fn_split_words(spark, sf):
    o = _event_data(spread(table(spark, sf, "orders"), "o_orderkey")).withColumn("w", L.words64("data"))
    return o.select("o_orderkey", F.size("w").alias("n_words"), L.at("w", 0).alias("word_0"),
                    L.at("w", 1).alias("word_1"))


@query("fn_word_to_address", """
  select o_orderkey, printf('0x%040x', o_custkey) as from_word, printf('0x%040x', o_orderkey) as from_topic
  from orders""")
def fn_word_to_address(spark, sf):
    o = _event_data(spread(table(spark, sf, "orders"), "o_orderkey"))
    return o.select("o_orderkey", L.word_address(L.at(L.words64("data"), 1)).alias("from_word"),
                    L.word_address(hex_of("o_orderkey", 64), 27).alias("from_topic"))


@query("fn_abi_dynamic_array", """
  select o_orderkey, i as idx, printf('%064x', o_custkey + i) as word
  from orders, unnest(range(0, 1 + o_custkey % 4)) as t(i)""")
def fn_abi_dynamic_array(spark, sf):
    n = F.lit(1) + F.col("o_custkey") % 4
    word = lambda c: F.lpad(F.lower(F.hex(c)), 64, "0")
    items = F.array_join(F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1),
                                     lambda i: word(F.col("o_custkey") + i)), "")
    o = spread(table(spark, sf, "orders"), "o_orderkey").withColumn(
        "data", F.concat(F.lit("0x"), word(F.lit(32)), word(n), items, word(F.lit(7))))
    return o.select("o_orderkey", F.posexplode(L.abi_array(L.words64("data"))).alias("idx", "word")) \
        .withColumn("idx", F.col("idx").cast("bigint"))


@query("fn_substr_right", """
  select c_custkey, substr(c_name, 1, 10) as selector, right(c_name, 8) as tail, substr(c_name, 10, 3) as middle
  from customer""")
def fn_substr_right(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", L.selector("c_name").alias("selector"), L.right_n("c_name", 8).alias("tail"),
        F.substring("c_name", 10, 3).alias("middle"))


@query("fn_regexp_path_normalise", """
  select event_id, regexp_replace(regexp_replace('result.calls[' || user_id || '].calls[' || (event_id % 7) || '].to',
         '[^0-9]+', '_', 'g'), '^_|_$', '', 'g') as path,
         regexp_replace(cast(user_id as varchar) || '_' || (event_id % 7), '_[0-9]+$', '') as parent
  from events""")
def fn_regexp_path_normalise(spark, sf):
    e = table(spark, sf, "events")
    raw = F.concat(F.lit("result.calls["), "user_id", F.lit("].calls["), (F.col("event_id") % 7).cast("string"),
                   F.lit("].to"))
    path = L.normalise_path(raw)
    return e.select("event_id", path.alias("path"), F.regexp_replace(path, "_[0-9]+$", "").alias("parent"))


@query("fn_rlike", """
  select p_partkey, regexp_full_match(p_name, '[a-z]+ (ring|widget)') as whole,
         regexp_matches(p_name, 'ring') as part_of
  from part""")
def fn_rlike(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", L.full_match("p_name", "[a-z]+ (ring|widget)").alias("whole"),
        F.col("p_name").rlike("ring").alias("part_of"))


@query("fn_split", """
  select c_custkey, split_part(c_name, '#', 2) as num, cast(strpos(c_name, '#') as integer) as pos,
         string_split(c_name, '#')[1] as head
  from customer""")
def fn_split(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", L.split_part("c_name", "#", 2).alias("num"), F.locate("#", "c_name").alias("pos"),
        L.at(F.split("c_name", "#"), 0).alias("head"))


@query("fn_concat_ids", """
  select event_id, event_type || '-' || user_id || '-' || event_id as log_id from events""")
def fn_concat_ids(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", L.dash_id("event_type", "user_id", "event_id").alias("log_id"))


@query("fn_surrogate_key", """
  select o_orderkey, md5(cast(o_orderkey as varchar) || '-' || o_orderstatus) as id,
         md5(cast(o_orderkey as varchar) || '-' ||
             coalesce(nullif(o_orderstatus, 'P'), '_dbt_utils_surrogate_key_null_')) as id_null
  from orders""")
def fn_surrogate_key(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", L.surrogate_key("o_orderkey", "o_orderstatus").alias("id"),
        L.surrogate_key("o_orderkey", F.nullif("o_orderstatus", F.lit("P"))).alias("id_null"))


@query("fn_epoch_hex_to_ts", """
  select o_orderkey, o_orderdate + to_seconds(o_orderkey) as ts from orders""")
def fn_epoch_hex_to_ts(spark, sf):
    o = table(spark, sf, "orders")
    secs = (L.micros("o_orderdate") / 1_000_000).cast("bigint") + F.col("o_orderkey")
    return o.select("o_orderkey", L.epoch_hex_ts(hex_of(secs)).alias("ts"))


@query("fn_date_ops", """
  select event_id, date_trunc('hour', ts) as hour, cast(ts as date) as day, ts - interval 12 hour as earlier,
         cast(date_trunc('day', ts) as timestamp) as midnight
  from events""")
def fn_date_ops(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", L.hour_of("ts").alias("hour"), F.to_date("ts").alias("day"),
        L.minus_hours("ts", 12).alias("earlier"), F.to_date("ts").cast("timestamp_ntz").alias("midnight"))


@query("fn_round_thousands", """
  select o_orderkey, cast(round(o_orderkey, -3) as bigint) as bucket from orders""")
def fn_round_thousands(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", L.bucket_1000("o_orderkey").alias("bucket"))


@query("fn_pow_scale", """
  select p_partkey, p_retailprice / pow(10, p_size % 7) as scaled, p_size / pow(10, 9) as gwei from part""")
def fn_pow_scale(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", L.scale_down("p_retailprice", F.col("p_size") % 7).alias("scaled"),
        L.scale_down("p_size", 9).alias("gwei"))


@query("fn_null_family", """
  with x as (select o_orderkey, o_custkey, case when o_orderstatus <> 'P' then o_orderkey end as k from orders)
  select o_orderkey, coalesce(k, -1) as filled, case when k is null then 'none' else 'some' end as state,
         case when k is not null then greatest(k, o_custkey) end as strict_greatest,
         greatest(k, o_custkey) as loose_greatest
  from x""")
def fn_null_family(spark, sf):
    o = table(spark, sf, "orders").withColumn(
        "k", F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")))
    return o.select("o_orderkey", F.coalesce("k", F.lit(-1).cast("bigint")).alias("filled"),
                    F.when(F.col("k").isNull(), "none").otherwise("some").alias("state"),
                    L.greatest_strict("k", "o_custkey").alias("strict_greatest"),
                    F.greatest("k", "o_custkey").alias("loose_greatest"))


@query("fn_array_access", """
  select vec_id, len(embedding) as n, cast(embedding[1] as double) as first, cast(embedding[100000] as double) as absent
  from embeddings""")
def fn_array_access(spark, sf):
    return table(spark, sf, "embeddings").select(
        "vec_id", L.size0("embedding").cast("bigint").alias("n"), L.at("embedding", 0).cast("double").alias("first"),
        L.at("embedding", 99_999).cast("double").alias("absent"))


@query("fn_json_build", """
  select o_orderkey, '{"id":"' || o_orderkey || '","jsonrpc":"2.0","method":"eth_getBlockByNumber","params":["' ||
         printf('0x%x', o_orderkey) || '",false]}' as body
  from orders""")
def fn_json_build(spark, sf):
    block = F.concat(F.lit('"'), L.int_to_hex("o_orderkey"), F.lit('"'))
    return table(spark, sf, "orders").select(
        "o_orderkey", L.rpc_body("o_orderkey", "eth_getBlockByNumber", block, F.lit("false")).alias("body"))


@query("fn_json_parse", """
  select event_id, cast(json_extract_string(props, '$.k') as bigint) as k,
         json_extract_string(props, '$.missing') as missing
  from events""")
def fn_json_parse(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", L.jget("props", "$.k", "bigint").alias("k"), L.jget("props", "$.missing").alias("missing"))


@query("fn_price_split", """
  select l_orderkey, l_linenumber, l_partkey, l_shipdate,
         round(cast(l_extendedprice * 100 as decimal(18,0)) / l_linenumber, 6) as each_raw, l_linenumber > 1 as is_estimated
  from (select l_orderkey, l_linenumber, l_partkey, l_shipdate, round(l_extendedprice * 100) as l_extendedprice_c,
        l_extendedprice from lineitem)""")
def fn_price_split(spark, sf):
    li = table(spark, sf, "lineitem")
    raw = F.round(F.col("l_extendedprice") * 100)
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate",
                     L.per_item(raw, "l_linenumber").cast("double").alias("each_raw"),
                     (F.col("l_linenumber") > 1).alias("is_estimated"))


# The first two wallets stand for platform wallets.
@query("fn_fee_split", """
  select event_id, case when event_id % 5 = 0 then value else 0 end as sale_amount,
         case when event_id % 5 > 0 and user_id in (1, 2, 3) then value else 0 end as platform_fee,
         case when event_id % 5 > 0 and user_id not in (1, 2, 3) then value else 0 end as creator_fee
  from events""")
def fn_fee_split(spark, sf):
    e = table(spark, sf, "events").withColumns({
        "idx": F.col("event_id") % 5, "wallet": F.col("user_id").cast("string")})
    return P.split_fee(e, "value", "wallet", ["1", "2", "3"], "idx").select(
        "event_id", "sale_amount", "platform_fee", "creator_fee")
