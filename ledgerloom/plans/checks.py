"""What must hold of the library's own tables, and a report of what does not.

A suite lists rules. All rules that look at one row are counted in a single pass over the table, the rules
that compare rows (one row per key, no gaps, one block per transaction) in an aggregation each.
``report`` counts failures by rule, ``failing_rows`` returns the rows with the rules they break.
"""
from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from ..operators import quality as Q
from ..operators.setops import union_all

# The pattern of hashes and addresses, and what counts as a number.
HEX = "0[xX][0-9a-fA-F]+"
NUMBER = ("bigint", "int", "double", "float", "decimal")
SETTLED = "not is_pending"


class Rule(NamedTuple):
    """One rule on one column; ``where`` (SQL) limits the rows it holds for."""
    name: str
    column: str
    where: str | None = None

    def broken(self) -> Column:
        c = F.col(self.column)
        bad = c.isNull() if self.name == "not_null" else ~c.rlike(HEX)
        return F.coalesce(bad if self.where is None else bad & F.expr(self.where), F.lit(False))


class Suite(NamedTuple):
    """Rules of a table."""
    key: tuple[str, ...]
    rows: tuple[Rule, ...]
    numbers: tuple[str, ...] = ()
    gaps: tuple[str, tuple[str, ...]] | None = None  # a sequence and the columns it starts anew by
    one_block: bool = False
    recent: str | None = None

    def over(self, columns) -> Suite:
        """The rules on these columns only."""
        has = set(columns).issuperset
        return Suite(self.key, tuple(r for r in self.rows if has([r.column])), tuple(c for c in self.numbers if has([c])),
                     self.gaps if self.gaps and has([self.gaps[0], *self.gaps[1], "block_timestamp"]) else None,
                     self.one_block and has(["tx_hash", "block_number"]), self.recent if has([self.recent]) else None)


def _rows(not_null: str, hexes: str = "", settled: str = "", **where) -> tuple[Rule, ...]:
    return (*[Rule("not_null", c) for c in not_null.split()], *[Rule("not_null", c, SETTLED) for c in settled.split()],
            *[Rule("not_null", c, w) for c, w in where.items()], *[Rule("hex", c) for c in hexes.split()])


BLOCKS = Suite(("block_number",), _rows(
    "block_number block_timestamp difficulty total_difficulty extra_data gas_limit gas_used hash parent_hash miner nonce "
    "receipts_root sha3_uncles size", "hash parent_hash miner receipts_root sha3_uncles"),
    ("block_number", "difficulty", "total_difficulty", "gas_limit", "gas_used", "nonce", "size"), ("block_number", ()))
TRANSACTIONS = Suite(("tx_hash",), _rows(
    "block_number block_timestamp tx_hash nonce position from_address value block_hash gas_price gas input_data "
    "origin_function_signature", "tx_hash from_address to_address block_hash",
    "tx_status gas_used cumulative_gas_used tx_fee effective_gas_price"),
    ("block_number", "nonce", "position", "gas_price", "gas_used", "cumulative_gas_used", "tx_fee"),
    ("position", ("block_number",)), recent="block_timestamp")
LOGS = Suite(("_log_id",), _rows(
    "block_number tx_hash event_index contract_address topics data event_removed _log_id origin_from_address",
    "tx_hash contract_address origin_from_address origin_to_address", "block_timestamp origin_function_signature"),
    ("block_number", "event_index"), ("event_index", ("block_number", "tx_hash")), True, "block_timestamp")
TRACES = Suite(("block_number", "tx_position", "trace_address"), _rows("block_number tx_position trace_address"),
               ("block_number", "tx_position"))
SALES = Suite(("nft_log_id",), _rows(
    "block_number block_timestamp tx_hash event_index platform_address platform_name seller_address buyer_address nft_address tokenid "
    "price total_fees platform_fee creator_fee tx_fee nft_log_id _log_id origin_from_address origin_to_address "
    "origin_function_signature event_type input_data",
    "tx_hash platform_address seller_address buyer_address nft_address origin_from_address origin_to_address origin_function_signature",
    currency_address="platform_exchange_version not like 'seaport%'"),
    ("block_number", "price", "price_usd", "total_fees", "platform_fee", "creator_fee", "total_fees_usd", "platform_fee_usd",
     "creator_fee_usd", "tx_fee"), recent="block_timestamp")


def failing_rows(df: DataFrame, suite: Suite) -> DataFrame:
    """Rows that break a rule on single rows, with ``broken``: the rules' names and columns. One pass."""
    rules = suite.over(df.columns).rows
    names = F.array(*[F.when(r.broken(), F.lit(f"{r.name} {r.column}")) for r in rules])
    return df.withColumn("broken", F.array_compact(names)).filter(F.size("broken") > 0)


def report(df: DataFrame, suite: Suite, run_ts: dt.datetime, days: int = 1) -> DataFrame:
    """Rows (rule, column_name, n_failures, status) of a suite, for the columns that the table has.

    The newest ``days`` are left out of gap checks, as their rows may still come, and must hold a row where a suite asks for recent data.
    """
    own = suite.over(df.columns)
    line = lambda rule, column, n: F.struct(F.lit(rule).alias("rule"), F.lit(column).alias("column_name"), n.alias("n_failures"))
    typed = {c: int(df.schema[c].dataType.simpleString().split("(")[0] not in NUMBER) for c in own.numbers}
    counts = df.agg(*[F.count_if(r.broken()).alias(f"_{i}") for i, r in enumerate(own.rows)])
    lines = [*[line(r.name, r.column, F.col(f"_{i}")) for i, r in enumerate(own.rows)],
             *[line("number", c, F.lit(n).cast("bigint")) for c, n in typed.items()]]
    parts = [counts.select(F.inline(F.array(*lines)))]
    several = [("unique", ",".join(own.key), Q.unique(df, own.key))]
    if own.gaps:
        before = F.col("block_timestamp") < F.lit(str(run_ts - dt.timedelta(days=days))).cast("timestamp_ntz")
        several.append(("gaps", own.gaps[0], Q.sequence_gaps(df, own.gaps[0], own.gaps[1], before)))
    if own.one_block:
        several.append(("one_block", "tx_hash", Q.one_block_per_tx(df)))
    if own.recent:
        several.append(("recent", own.recent, Q.recent(df, own.recent, days, run_ts)))
    parts += [bad.agg(F.count(F.lit(1)).alias("n_failures")).select(F.lit(rule).alias("rule"), F.lit(c).alias("column_name"), "n_failures")
              for rule, c, bad in several]
    return union_all(*parts).withColumn("status", F.when(F.col("n_failures") == 0, "pass").otherwise("error"))
