"""Landed payloads to parsed, de-duplicated tables.

Each function returns the batch to write; ``target`` is the table so far, or
None for a first build. Payload columns are single JSON paths, so a query that
needs three columns parses three paths.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import functions as L
from ..operators import incremental as inc
from ..operators.incremental import Run
from ..operators.joins import enrich_recent, flatten
from ..operators.project import (blank_to_null, coalesce_paths, guard_position, json_project, pending_flag,
                                 status_flag, where_json_object)
from ..operators.tree import flatten_tree, where_holds
from ..operators.windows import ADDRESS, latest, latest_complete, latest_in_place

BLOCK_PATHS = [("VALUE", "$.BLOCK_NUMBER"), ("metadata", "$.request.data.id"),
               ("metadata", "$.request.data", "$.id")]


def _wide(raw: Column) -> Column:
    return L.try_number(L.hex_to_dec(raw))


def _gwei(raw: Column) -> Column:
    return L.scale_down(L.hex_to_long(raw), 9)


def _address(src: DataFrame) -> list[str]:
    return [c for c in ADDRESS if c in src.columns]


_LONG = L.hex_to_long


def silver_blocks(landed: DataFrame, target: DataFrame | None, run: Run) -> DataFrame:
    """Block headers, newest landing per block."""
    src = coalesce_paths(inc.since_inclusive(landed, target, marks=run.marks), BLOCK_PATHS, "block_number", "bigint")
    src = latest_in_place(src.select("block_number", "DATA", "_inserted_timestamp", *_address(src)), "block_number", "_inserted_timestamp")
    out = json_project(src, "DATA", {
        "base_fee_per_gas": ("$.result.baseFeePerGas", _LONG),
        "difficulty": ("$.result.difficulty", _LONG),
        "extra_data": ("$.result.extraData",),
        "gas_limit": ("$.result.gasLimit", _LONG),
        "gas_used": ("$.result.gasUsed", _LONG),
        "hash": ("$.result.hash",),
        "logs_bloom": ("$.result.logsBloom",),
        "miner": ("$.result.miner",),
        "mix_hash": ("$.result.mixHash",),
        "nonce": ("$.result.nonce", _wide),
        "number": ("$.result.number", _LONG),
        "parent_hash": ("$.result.parentHash",),
        "receipts_root": ("$.result.receiptsRoot",),
        "sha3_uncles": ("$.result.sha3Uncles",),
        "size": ("$.result.size", _LONG),
        "state_root": ("$.result.stateRoot",),
        "block_timestamp": ("$.result.timestamp", L.epoch_hex_ts),
        "total_difficulty": ("$.result.totalDifficulty", _wide),
        "tx_count": ("$.result.transactions", F.json_array_length),
        "transactions_root": ("$.result.transactionsRoot",),
        "transactions": ("$.result.transactions", lambda raw: F.from_json(raw, "array<string>")),
        "uncles": ("$.result.uncles", lambda raw: F.from_json(raw, "array<string>")),
    }, keep=["block_number", "_inserted_timestamp"])
    return inc.stamp(out.withColumn("blocks_id", L.surrogate_key("block_number")), run)


def silver_receipts(landed: DataFrame, target: DataFrame | None, run: Run) -> DataFrame:
    """Receipts with a transaction and a position, newest per (block, position)."""
    src = where_json_object(inc.since_inclusive(landed, target, marks=run.marks), "DATA")
    src = coalesce_paths(src, BLOCK_PATHS, "block_number", "bigint")
    out = json_project(src, "DATA", {
        "block_hash": ("$.blockHash",),
        "payload_block": ("$.blockNumber", _LONG),
        "contract_address": ("$.contractAddress",),
        "cumulative_gas_used": ("$.cumulativeGasUsed", _LONG),
        "effective_gas_price": ("$.effectiveGasPrice", _gwei),
        "from_address": ("$.from",),
        "gas_used": ("$.gasUsed", lambda raw: F.coalesce(L.hex_to_long(raw), F.lit(0).cast("bigint"))),
        "logs": ("$.logs",),
        "logs_bloom": ("$.logsBloom",),
        "status": ("$.status", _LONG),
        "to_address": ("$.to",),
        "tx_hash": ("$.transactionHash",),
        "position": ("$.transactionIndex", _LONG),
        "type": ("$.type", _LONG),
    }, keep=["block_number", "_inserted_timestamp"])
    out = blank_to_null(out.withColumn("tx_status", status_flag("status")), ["to_address"])
    out = guard_position(out.filter(F.col("tx_hash").isNotNull()))
    return latest(out, ["block_number", "position"], "_inserted_timestamp")


def silver_transactions(landed: DataFrame, blocks: DataFrame, receipts: DataFrame,
                        target: DataFrame | None, run: Run) -> DataFrame:
    """Transactions with block time and receipt outcome, including earlier ones
    whose block or receipt arrived late."""
    run = run.knowing(target, "_inserted_timestamp")
    src = where_json_object(inc.since_inclusive(landed, target, marks=run.marks), "DATA")
    tx = json_project(src, "DATA", {
        "block_hash": ("$.blockHash",),
        "block_number": ("$.blockNumber", _LONG),
        "from_address": ("$.from",),
        "gas": ("$.gas", _LONG),
        "gas_price": ("$.gasPrice", lambda raw: F.coalesce(_gwei(raw), F.lit(0.0))),
        "tx_hash": ("$.hash",),
        "input_data": ("$.input",),
        "value_precise_raw": ("$.value", L.hex_to_dec),
        "max_fee_per_gas": ("$.maxFeePerGas", _gwei),
        "max_priority_fee_per_gas": ("$.maxPriorityFeePerGas", _gwei),
        "nonce": ("$.nonce", _LONG),
        "r": ("$.r",), "s": ("$.s",),
        "to_address": ("$.to",),
        "position": ("$.transactionIndex", _LONG),
        "type": ("$.type",), "v": ("$.v",),
    }, keep=["_inserted_timestamp", F.col("DATA").alias("data")]).filter(F.col("block_hash").isNotNull())
    tx = blank_to_null(tx, ["to_address"]).withColumns({
        "origin_function_signature": L.selector("input_data"),
        "value_precise": L.decimal_adjust("value_precise_raw", 18)})
    tx = tx.withColumn("value", F.col("value_precise").cast("double"))

    out = tx.join(blocks.select("block_number", "block_timestamp"), "block_number", "left")
    out = enrich_recent(out, receipts.withColumnRenamed("type", "tx_type"), ["block_number", "tx_hash"],
                        ["gas_used", "tx_status", "cumulative_gas_used", "effective_gas_price", "tx_type"],
                        "_inserted_timestamp", inc.recent_join_floor(target, marks=run.marks))
    out = pending_flag(out, ["block_timestamp", "tx_status"]).withColumn(
        "tx_fee_precise", inc.fee_precise("effective_gas_price", "gas_used"))
    out = out.withColumn("tx_fee", F.coalesce(F.col("tx_fee_precise").cast("double"), F.lit(0.0)))
    if target is not None:
        out = inc.heal_tx(target, out, blocks, receipts)
    out = latest_complete(out, ["block_number", "position"], "_inserted_timestamp", "is_pending")
    return inc.stamp(out.withColumn("transactions_id", L.surrogate_key("tx_hash")), run)


LOG_ARRAY = "array<struct<address:string,blockHash:string,data:string,logIndex:string,removed:boolean,topics:array<string>>>"


def silver_logs(receipts: DataFrame, txs: DataFrame, target: DataFrame | None, run: Run) -> DataFrame:
    """One row per event log, with the transaction's time and selector."""
    run = run.knowing(target, "_inserted_timestamp")
    base = inc.since_inclusive(receipts.filter(F.json_array_length("logs") > 0), target, marks=run.marks)
    flat = flatten(base.select("block_number", "tx_hash", F.col("position").alias("tx_position"),
                               F.col("from_address").alias("origin_from_address"),
                               F.col("to_address").alias("origin_to_address"),
                               "tx_status", "_inserted_timestamp", "logs"),
                   F.from_json("logs", LOG_ARRAY), "log_index", "log").drop("logs")
    flat = flat.select(
        "block_number", "tx_hash", "tx_position", "origin_from_address", "origin_to_address", "tx_status",
        F.col("log.address").alias("contract_address"), F.col("log.blockHash").alias("block_hash"),
        F.col("log.data").alias("data"), L.hex_to_long("log.logIndex").alias("event_index"),
        F.col("log.removed").alias("event_removed"), F.col("log.topics").alias("topics"), "_inserted_timestamp")
    out = enrich_recent(flat, txs, ["block_number", "tx_hash"], ["block_timestamp", "origin_function_signature"],
                        "_inserted_timestamp", inc.recent_join_floor(target, marks=run.marks))
    out = pending_flag(out, ["block_timestamp", "origin_function_signature"])
    out = out.withColumn("_log_id", L.dash_id("tx_hash", "event_index"))
    if target is not None:
        out = inc.heal_logs(target, out, txs)
    out = latest_complete(out, ["block_number", "event_index"], "_inserted_timestamp", "is_pending")
    return inc.stamp(out.withColumn("logs_id", L.surrogate_key("tx_hash", "event_index")), run)


def silver_traces(landed: DataFrame, target: DataFrame | None, run: Run, full_reload: bool = False,
                  first: int | None = None, step: int | None = None, malformed: str = "raise") -> DataFrame:
    """One row per call, with its path, parent and own fields.

    A first build reads every partition, unless ``first`` and ``step`` bound it (see ``backfill_slice``).
    ``malformed`` says what becomes of documents that are not JSON (see ``flatten_tree``).
    """
    if full_reload or target is None:
        src = inc.backfill_slice(landed, target, "partition_key", step=step, first=first, marks=run.marks)
    else:
        src = inc.since_inclusive(landed, target, marks=run.marks)
    src = where_holds(src, "DATA", "result")
    src = src.select("block_number", "partition_key",
                     F.get_json_object("VALUE", "$.array_index").try_cast("bigint").alias("tx_position"),
                     "DATA", "_inserted_timestamp", *_address(src))
    src = latest_in_place(src, ["block_number", "tx_position"], "_inserted_timestamp")
    out = flatten_tree(src, "DATA", ["block_number", "tx_position", "partition_key", "_inserted_timestamp"],
                       within="result", malformed=malformed)
    return inc.stamp(out.withColumn(
        "traces_id", L.surrogate_key("block_number", "tx_position", "trace_address")), run)
