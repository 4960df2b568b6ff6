"""Chain-shaped payloads derived row by row from the orders table.

One order is one block with one transaction. Nothing here groups or shuffles:
each payload is a JSON text computed from its own order, so the work of every
query built on it grows with the table.

Block number is BASE + o_orderkey; hashes are padded hex of the order key.
Blocks of status P land twice, first with another miner.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom import functions as L
from ledgerloom.operators.groups import estimated_bytes
from ledgerloom.operators.incremental import Run
from .base import table

BASE = 21_248_026
RUN = Run(dt.datetime(2002, 1, 1), "run")
TX_SQL = "printf('0x%064x', o_orderkey)"
BLOCK_SQL = f"{BASE} + o_orderkey"


def hx(c, width: int = 0) -> Column:
    h = F.lower(F.hex((F.col(c) if isinstance(c, str) else c).cast("bigint")))
    return F.concat(F.lit("0x"), F.lpad(h, width, "0") if width else h)


#: Bytes of a table file whose derived payloads one task builds: some 17,000 orders, whose payloads take some 50 MB.
SPREAD_BYTES = 256 * 1024


def spread(df: DataFrame, key: str, task_bytes: int | None = None) -> DataFrame:
    """Use every core on a table stored as few files, and bound what one task derives from it.

    The payloads derived from a row are hundreds of times its size in the file, and tasks sort them; so the number
    of tasks follows the size of the files, ``SPREAD_BYTES`` a task or as given. A table that is read in as many parts is
    left as it is read.
    """
    n = max(df.sparkSession.sparkContext.defaultParallelism, -(-estimated_bytes(df) // (task_bytes or SPREAD_BYTES)))
    return df if df.rdd.getNumPartitions() >= n else df.repartition(n, key)


def orders(spark, sf) -> DataFrame:
    return spread(table(spark, sf, "orders"), "o_orderkey").withColumns({
        "block_number": F.col("o_orderkey") + BASE, "tx_hash": hx("o_orderkey", 64),
        "cents": F.round(F.col("o_totalprice") * 100).cast("bigint"),
        "epoch": (L.micros("o_orderdate") / 1_000_000).cast("bigint") + F.col("o_orderkey")})


def envelope(df: DataFrame, data: Column, ts: Column | None = None, index: Column | None = None) -> DataFrame:
    """Landed rows. The block number sits in VALUE, in request metadata, or in
    metadata that is JSON inside a string, depending on the order's status."""
    bn = F.col("block_number").cast("string")
    status = F.col("o_orderstatus")
    value = F.when(status == "F", F.concat(F.lit('{"BLOCK_NUMBER":'), bn, F.lit(',"array_index":0,"TX_HASH":"'),
                                           F.col("tx_hash"), F.lit('"}'))) \
             .otherwise(F.concat(F.lit('{"array_index":0,"TX_HASH":"'), F.col("tx_hash"), F.lit('"}')))
    meta = F.when(status == "O", F.concat(F.lit('{"request":{"data":{"id":"'), bn, F.lit('"}}}'))) \
            .when(status == "P", F.concat(F.lit('{"request":{"data":"{\\"id\\":\\"'), bn, F.lit('\\"}"}}')))
    row = F.struct(F.col("block_number"), value.alias("VALUE"), data.alias("DATA"), meta.alias("metadata"),
                   L.bucket_1000("block_number").alias("partition_key"),
                   (F.col("o_orderdate") if ts is None else ts).alias("_inserted_timestamp"))
    # a generator keeps the payload text from being built again for each use
    return df.select(F.inline(F.array(row)))


def landed_blocks(spark, sf) -> DataFrame:
    o = orders(spark, sf)
    twice = o.withColumn("landing", F.explode(
        F.when(F.col("o_orderstatus") == "P", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))))
    miner = hx(F.when(F.col("landing") == 1, F.col("o_custkey")).otherwise(F.lit(0)), 40)
    result = F.struct(
        hx("o_custkey").alias("baseFeePerGas"), F.lit("0x1").alias("difficulty"), F.lit("0xd883").alias("extraData"),
        hx(F.lit(30_000_000)).alias("gasLimit"), hx("cents").alias("gasUsed"), F.col("tx_hash").alias("hash"),
        F.lit("0x00").alias("logsBloom"), miner.alias("miner"), F.lit("0x0").alias("mixHash"),
        F.lit("0x0000000000000042").alias("nonce"), hx("block_number").alias("number"),
        hx(F.col("o_orderkey") + 1, 64).alias("parentHash"), hx("o_custkey", 64).alias("receiptsRoot"),
        F.lit("0x1dcc").alias("sha3Uncles"), hx(F.col("o_custkey") * 7).alias("size"),
        hx("o_custkey", 64).alias("stateRoot"), hx("epoch").alias("timestamp"),
        F.concat(hx(F.col("o_custkey") + 1), F.lit("0" * 20)).alias("totalDifficulty"),
        F.array("tx_hash", hx(F.col("o_orderkey") + 2 ** 40, 64)).alias("transactions"),
        F.lit("0x2").alias("transactionsRoot"), F.array().cast("array<string>").alias("uncles"))
    return envelope(twice, F.to_json(F.struct(result.alias("result"))),
                    F.expr("o_orderdate + make_dt_interval(landing)"))


def landed_receipts(spark, sf) -> DataFrame:
    """Receipts: status F ok, O failed, P absent; blank recipient for 5-LOW;
    1-URGENT names another block; 0 to 3 logs, by customer key."""
    o = orders(spark, sf)
    n = (F.col("o_custkey") % 4).cast("int")
    log = lambda i: F.struct(
        hx(F.col("o_custkey") + i, 40).alias("address"), F.col("tx_hash").alias("blockHash"),
        F.concat(hx("cents", 64), F.lpad(F.lower(F.hex("o_custkey")), 64, "0")).alias("data"),
        hx(i).alias("logIndex"), F.lit(False).alias("removed"),
        F.slice(F.array(F.lit("0xaa"), hx("o_custkey", 64), hx(i, 64), hx("o_orderkey", 64)), F.lit(1),
                (i + 1).cast("int")).alias("topics"))
    logs = F.when(n == 0, F.lit("[]")).otherwise(
        F.to_json(F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), log)))
    status = F.when(F.col("o_orderstatus") == "F", "0x1").when(F.col("o_orderstatus") == "O", "0x0")
    inner = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("block_number") + 1).otherwise(F.col("block_number"))
    head = F.to_json(F.struct(
        F.col("tx_hash").alias("blockHash"), hx(inner).alias("blockNumber"),
        hx("cents").alias("cumulativeGasUsed"), hx(F.col("o_custkey") * 1_000_000_000).alias("effectiveGasPrice"),
        hx("o_custkey", 40).alias("from"),
        F.when(F.col("o_orderpriority") != "2-HIGH", hx("cents")).alias("gasUsed"),
        F.lit("0x00").alias("logsBloom"), status.alias("status"),
        F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(hx("o_orderkey", 40)).alias("to"),
        F.col("tx_hash").alias("transactionHash"), F.lit("0x0").alias("transactionIndex"), F.lit("0x2").alias("type")))
    data = F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(',"logs":'), logs, F.lit("}"))
    return envelope(o, data)


def landed_txs(spark, sf) -> DataFrame:
    """Transactions; 3-MEDIUM ones are an array instead of an object."""
    o = orders(spark, sf)
    body = F.to_json(F.struct(
        F.col("tx_hash").alias("blockHash"), hx("block_number").alias("blockNumber"),
        hx("o_custkey", 40).alias("from"), hx("cents").alias("gas"),
        F.when(F.col("o_orderstatus") != "O", hx(F.col("o_custkey") * 1_000_000_000)).alias("gasPrice"),
        F.col("tx_hash").alias("hash"),
        F.concat(F.lit("0xa9059cbb"), F.lpad(F.lower(F.hex("o_custkey")), 64, "0")).alias("input"),
        F.concat(hx("cents"), F.lit("0" * 15)).alias("value"), hx("o_orderkey").alias("nonce"),
        F.lit("0x1").alias("r"), F.lit("0x2").alias("s"),
        F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(hx("o_orderkey", 40)).alias("to"),
        F.lit("0x0").alias("transactionIndex"), F.lit("0x2").alias("type"), F.lit("0x1b").alias("v")))
    data = F.when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(F.lit("["), body, F.lit("]"))).otherwise(body)
    return envelope(o, data)


def landed_traces(spark, sf) -> DataFrame:
    """Call trees: o_custkey % 13 calls below the root, each with one call of
    its own when the order key is even. 1-URGENT fails at the root, 2-HIGH in
    the first call."""
    o = orders(spark, sf)
    leaf = lambda i: F.to_json(F.struct(
        hx(F.col("o_custkey") + i, 40).alias("from"), hx("o_orderkey", 40).alias("to"), F.lit("0x5").alias("gas"),
        F.lit("0x4").alias("gasUsed"), hx(F.col("cents") + i).alias("value"), F.lit("0xee").alias("input"),
        F.lit("STATICCALL").alias("type")))

    def call(i):
        error = F.when((F.col("o_orderpriority") == "2-HIGH") & (i == 0), "out of gas")
        own = F.to_json(F.struct(
            hx("o_custkey", 40).alias("from"), hx(F.col("o_custkey") + i, 40).alias("to"), F.lit("0x7").alias("gas"),
            F.lit("0x6").alias("gasUsed"), hx(i).alias("value"), F.lit("0xdd").alias("input"),
            F.lit("CALL").alias("type"), error.alias("error")))
        return F.when(F.col("o_orderkey") % 2 == 0, F.concat(
            F.regexp_replace(own, r"\}$", ""), F.lit(',"calls":['), leaf(i), F.lit("]}"))).otherwise(own)

    n = (F.col("o_custkey") % 13).cast("int")
    calls = F.when(n == 0, F.lit("")).otherwise(F.array_join(
        F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), call), ","))
    root = F.to_json(F.struct(
        hx("o_custkey", 40).alias("from"), hx("o_orderkey", 40).alias("to"), hx("cents").alias("gas"),
        hx("o_custkey").alias("gasUsed"), F.lit("0xcc").alias("input"), F.lit("CALL").alias("type"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "execution reverted").alias("error")))
    data = F.concat(F.lit('{"result":'), F.regexp_replace(root, r"\}$", ""), F.lit(',"calls":['), calls, F.lit("]}}"))
    return envelope(o, data)
