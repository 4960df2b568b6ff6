"""What to fetch next: expected rows, what has landed, and request bodies."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import functions as L
from ..operators import incremental as inc
from ..operators.aggregates import min_or
from ..operators.incremental import Run, ts_lit
from ..operators.setops import batches

# First block with trace history, and per-run caps and batches.
FLOOR_BLOCK = 21_248_026
REALTIME = {"cap": 10_000, "producer": 5_000, "worker": 1_000}
REALTIME_BY_HASH = {"cap": 25_000, "producer": 10_000, "worker": 2_000}
HISTORY = {"cap": 100_000, "producer": 10_000, "worker": 2_000}
KINDS = {
    "blocks": ("eth_getBlockByNumber", True),
    "transactions": ("eth_getBlockByNumber", True),
    "receipts": ("eth_getBlockReceipts", False),
    "receipts_by_hash": ("eth_getTransactionReceipt", True),
    "traces": ("debug_traceBlockByNumber", False),
}


def lookback_block(blocks: DataFrame, run: Run, floor: int = FLOOR_BLOCK) -> DataFrame:
    """First block of the hour that began 72 hours before the run's hour."""
    hour = run.ts.replace(minute=0, second=0, microsecond=0)
    within = ((F.col("block_number") >= floor)
              & (F.col("block_timestamp") >= ts_lit(hour - dt.timedelta(hours=72)))
              & (F.col("block_timestamp") < ts_lit(hour - dt.timedelta(hours=71))))
    return min_or(blocks, "block_number", floor, within)


def expected_blocks(spark: SparkSession, head: int, floor: int = FLOOR_BLOCK) -> DataFrame:
    seq = inc.number_sequence(spark, floor, head)
    return seq.withColumn("block_number_hex", L.int_to_hex("block_number", upper=True))


def expected_txs(blocks: DataFrame) -> DataFrame:
    """(block, transaction hash) from each block's transaction list."""
    return blocks.select("block_number", F.explode("transactions").alias("tx_hash"))


def _params(kind: str):
    """JSON fragments of a request's parameters."""
    block = F.concat(F.lit('"'), L.int_to_hex("block_number"), F.lit('"'))
    if kind == "blocks":
        return [block, F.lit("false")]
    if kind == "transactions":
        return [block, F.lit("true")]
    if kind == "traces":
        return [block, F.lit('{"tracer":"callTracer","timeout":"180s"}')]
    if kind == "receipts_by_hash":
        return [F.concat(F.lit('"'), F.col("tx_hash"), F.lit('"'))]
    return [block]


def _to_do(kind, expected, done, lookback, side, limits):
    keys = ["block_number", "tx_hash"] if kind == "receipts_by_hash" else ["block_number"]
    method, ascending = KINDS[kind]
    todo = inc.backlog(expected, done, lookback, side, keys)
    if limits is not None:
        order = [F.asc("block_number") if ascending else F.desc("block_number"), *keys[1:]]
        todo = batches(todo, limits["producer"], limits["worker"], *order, cap=limits["cap"])
    return inc.with_request(todo, method, *_params(kind))


_DEFAULT = object()


def backlog_realtime(kind: str, expected: DataFrame, done: DataFrame, lookback: DataFrame, limits=_DEFAULT) -> DataFrame:
    """Missing rows from the lookback block up, with request bodies.

    ``limits`` (cap, producer, worker) bounds a run and numbers its batches; by default as one run
    of the chain's ingest does. ``None`` gives all missing rows, without batch numbers.
    """
    if limits is _DEFAULT:
        limits = REALTIME_BY_HASH if kind == "receipts_by_hash" else REALTIME
    return _to_do(kind, expected, done, lookback, "ge", limits)


def backlog_history(kind: str, expected: DataFrame, done: DataFrame, lookback: DataFrame, limits=_DEFAULT) -> DataFrame:
    """Missing rows below the lookback block, with request bodies; ``limits`` as above."""
    return _to_do(kind, expected, done, lookback, "lt", HISTORY if limits is _DEFAULT else limits)


def complete_sets(kind: str, landed: DataFrame, target: DataFrame | None, run: Run,
                  seed: DataFrame | None = None) -> DataFrame:
    """Bookkeeping of what has landed for one kind of payload."""
    src = landed.select(F.get_json_object("VALUE", "$.BLOCK_NUMBER").try_cast("bigint").alias("block_number"),
                        F.get_json_object("VALUE", "$.TX_HASH").alias("tx_hash"), "_inserted_timestamp")
    keys = ["block_number", "tx_hash"] if kind == "receipts_by_hash" else ["block_number"]
    return inc.complete_set(src, target, keys, f"complete_{kind}_id", run, seed)
