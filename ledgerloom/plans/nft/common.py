"""Shared parts of the marketplace plans.

Windows here stay within one transaction. A log costs at least 375 gas, so the
block gas limit bounds a transaction's events; such groups need no cutting
(``max_rows=None``). Nothing is grouped by contract, currency or wallet.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ...columns import names
from ...operators import incremental as inc
from ...operators.incremental import Run

# Native coin, its wrapped token and its placeholder addresses.
NATIVE = "AVAX"
WRAPPED_NATIVE = "0xb31f66aa3c1e785363f0875a1b74e27b85fd66c7"
NATIVE_PLACEHOLDER = "0xeeeeeeeeeeeeeeeeeeeeeeeeeeeeeeeeeeeeeeee"

# Columns every market's sales share.
SALE_COLUMNS = [
    "block_number", "block_timestamp", "tx_hash", "event_index", "event_type", "platform_address", "platform_name",
    "platform_exchange_version", "seller_address", "buyer_address", "nft_address", "erc1155_value", "tokenid",
    "currency_address", "total_price_raw", "total_fees_raw", "platform_fee_raw", "creator_fee_raw", "tx_fee",
    "origin_from_address", "origin_to_address", "origin_function_signature", "input_data", "nft_log_id", "_log_id",
    "_inserted_timestamp"]

AMOUNT = "decimal(38,0)"


def fresh(src: DataFrame, target: DataFrame | None, run: Run, hours: int = 12, days: int | None = 7) -> DataFrame:
    """Source rows modified since shortly before the target's newest row; the run may set other ``hours`` and ``days``."""
    if target is None:
        return src
    hours, days = hours if run.hours is None else run.hours, days if run.days is None else run.days
    out = inc.since_lookback(src, target, "modified_timestamp", hours, "_inserted_timestamp", run.marks)
    return out if days is None or days == float("inf") else inc.floor_days(out, "modified_timestamp", run.ts, days)


def from_date(src: DataFrame, day: str) -> DataFrame:
    return src.filter(F.col("block_timestamp") >= F.lit(day).cast("timestamp_ntz"))


def with_tx(sales: DataFrame, txs: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Inner join of transaction columns, renamed."""
    side = txs.select("tx_hash", *[F.col(src).alias(name) for name, src in columns.items()])
    return sales.join(side, "tx_hash", "inner")


ORIGIN = {"origin_from_address": "from_address", "origin_to_address": "to_address",
          "origin_function_signature": "origin_function_signature", "tx_fee": "tx_fee", "input_data": "input_data"}


def amount(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).try_cast(AMOUNT)


def zero() -> Column:
    return F.lit(0).cast(AMOUNT)


def largest_and_fees(rows: DataFrame, keys, value: str, is_platform: Column, order: str) -> DataFrame:
    """Per group: the largest amount is the sale, amounts to the platform are
    its fee, and the rest is the creators' fee. One aggregation."""
    top = F.struct(F.col(value), (-F.col(order)).alias("o"))
    out = rows.groupBy(*names(keys)).agg(
        F.max(value).alias("net_sale_raw"),
        F.coalesce(F.sum(F.when(is_platform, F.col(value))), zero()).cast(AMOUNT).alias("platform_fee_raw"),
        F.coalesce(F.sum(F.when(~is_platform, F.col(value))), zero()).cast(AMOUNT).alias("_others"),
        F.max_by(is_platform, top).alias("_top_is_platform"))
    return out.withColumn("creator_fee_raw", (F.col("_others") - F.when(F.col("_top_is_platform"), zero())
                                              .otherwise(F.col("net_sale_raw"))).cast(AMOUNT)) \
              .drop("_others", "_top_is_platform")
