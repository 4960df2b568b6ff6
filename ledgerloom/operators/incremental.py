"""Incremental reads, late enrichment and ingest bookkeeping.

Every operator is a plain function of DataFrames, so a batch job, a test and a
``foreachBatch`` sink all call the same code. High-water marks are read once
and enter the plan as literals, which lets them prune files at the scan.
"""
from __future__ import annotations

import datetime as dt
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import functions as L
from ..columns import names
from .aggregates import high_water
from .setops import minus, union_all
from .windows import latest


class Run(NamedTuple):
    """Inputs of a run besides its tables; explicit, so that results repeat.

    ``marks`` are the high-water marks of the run's target, as its last commit left them
    (``sources.read_marks``). Without them the target is asked. ``hours`` and ``days`` replace a market
    plan's own look-back and oldest day; infinity lifts them.
    """
    ts: dt.datetime
    id: str = "run"
    marks: dict | None = None
    hours: float | None = None
    days: float | None = None

    def knowing(self, target: DataFrame | None, *columns: str) -> Run:
        """This run with the marks of these columns, looked up together where a commit left none."""
        return self._replace(marks=known_marks(target, self.marks, *columns))


def ts_lit(value) -> Column:
    """Zone-free timestamp literal, independent of the session's zone."""
    return F.lit(str(value)).cast("timestamp_ntz")


def _mark(value) -> Column:
    return ts_lit(value) if isinstance(value, dt.datetime) else F.lit(value)


def stamp(df: DataFrame, run: Run) -> DataFrame:
    """Bookkeeping columns of a run."""
    return df.withColumns({"inserted_timestamp": ts_lit(run.ts), "modified_timestamp": ts_lit(run.ts),
                           "_invocation_id": F.lit(run.id)})


# -- where to resume ---------------------------------------------------------

def known_marks(target: DataFrame | None, marks: dict | None, *columns: str) -> dict:
    """The marks of these columns, looked up together where a commit left none."""
    marks = dict(marks or {})
    lacking = [c for c in columns if c not in marks]
    if target is not None and lacking:
        marks |= zip(lacking, target.agg(*[F.max(c) for c in lacking]).first())
    return marks


def since_inclusive(src: DataFrame, target: DataFrame | None, ts: str = "_inserted_timestamp",
                    marks: dict | None = None) -> DataFrame:
    """Rows from the newest target time on, the last batch included."""
    top = high_water(target, ts, marks=marks)
    return src if top is None else src.filter(F.col(ts) >= _mark(top))


def since_exclusive(src: DataFrame, target: DataFrame | None, ts: str = "modified_timestamp",
                    marks: dict | None = None) -> DataFrame:
    """Rows newer than the newest target time."""
    top = high_water(target, ts, marks=marks)
    return src if top is None else src.filter(F.col(ts) > _mark(top))


def lookback_floor(target: DataFrame | None, ts: str, hours: float, marks: dict | None = None):
    """Newest target time minus a lookback, or None for an empty target."""
    top = None if hours == float("inf") else high_water(target, ts, marks=marks)
    return None if top is None else top - dt.timedelta(hours=hours)


def since_lookback(src: DataFrame, target: DataFrame | None, ts: str, hours: float,
                   target_ts: str | None = None, marks: dict | None = None) -> DataFrame:
    floor = lookback_floor(target, target_ts or ts, hours, marks)
    return src if floor is None else src.filter(F.col(ts) >= ts_lit(floor))


def floor_days(src: DataFrame, ts: str, run_ts: dt.datetime, days: int) -> DataFrame:
    """Hard lower bound: at most some days before the run."""
    return src.filter(F.col(ts) >= ts_lit(run_ts - dt.timedelta(days=days)))


def backfill_slice(src: DataFrame, target: DataFrame | None, c: str, back: int = 100_000,
                   step: int | None = None, first: int | None = None, marks: dict | None = None) -> DataFrame:
    """History from ``back`` before the target's frontier on. Without bounds that is all of it;
    ``step`` limits how far past the frontier one run goes, ``first`` how far the first run goes."""
    top = high_water(target, c, marks=marks)
    if top is None:
        return src if first is None else src.filter(F.col(c) <= first)
    near = src.filter(F.col(c) >= top - back)
    return near if step is None else near.filter(F.col(c) <= top + step)


def incremental_or_full(src: DataFrame, target: DataFrame | None, name: str, heal_sources: set[str],
                        ts: str = "_inserted_timestamp", hours: float = 4, marks: dict | None = None) -> DataFrame:
    """Recent rows, or the whole source if it is listed for a reload."""
    return src if name in heal_sources else since_lookback(src, target, ts, hours, marks=marks)


def recent_join_floor(target: DataFrame | None, ts: str = "_inserted_timestamp", marks: dict | None = None):
    """Start of the day before the newest target time."""
    top = high_water(target, ts, marks=marks)
    if top is None:
        return None
    return ts_lit(dt.datetime.combine(top.date() - dt.timedelta(days=1), dt.time()))


# -- late enrichment ---------------------------------------------------------

def fee_precise(price_gwei: str | Column, gas_used: str | Column) -> Column:
    """Gas price in gwei times gas used, in coin units, as exact text."""
    from ..columns import col
    # 19 + 19 digits: a product that a decimal of 38 holds for any 64-bit gas and any price below 10^10 coins
    wei = F.round(col(price_gwei) * 1e9).cast("decimal(19,0)")
    return L.decimal_adjust((wei * col(gas_used).cast("decimal(19,0)")).cast("decimal(38,0)").cast("string"), 18)


#: Buckets of a thousand blocks that a filter names one by one; beyond it they are joined.
MAX_BUCKETS = 10_000
#: Ranges of blocks in a filter; beyond it the nearest ranges become one.
MAX_RANGES = 100
#: Partition column of tables laid out by ``bucket_1000`` of the block; a column of that name must hold nothing else.
BUCKET = "bucket"


def _ranges(buckets: list[int]) -> list[tuple[int, int]]:
    """The blocks of sorted buckets as at most ``MAX_RANGES`` ranges."""
    gaps = sorted(range(1, len(buckets)), key=lambda i: buckets[i] - buckets[i - 1], reverse=True)
    cuts = sorted(i for i in gaps[:MAX_RANGES - 1] if buckets[i] - buckets[i - 1] > 1_000)
    return [(buckets[a] - 500, buckets[z - 1] + 500) for a, z in zip([0, *cuts], [*cuts, len(buckets)])]


def in_blocks_of(rows: DataFrame, *others: DataFrame) -> list[DataFrame]:
    """Each of ``others`` in the buckets of a thousand blocks that ``rows`` lie in, and little else.

    The buckets become literal filters: on the partition column ``BUCKET`` of tables that have it, which opens
    those partitions only, and as ranges of blocks, which skip files and row groups of any table sorted by
    block. A row of the first block and one of the last so cost two buckets. Beyond ``MAX_BUCKETS``
    the buckets are joined, and Spark prunes while running. The filter is for pruning; joins on the block follow.
    """
    own = rows.filter(F.col("block_number").isNotNull()).select(L.bucket_1000("block_number").alias("_bucket")).distinct()
    buckets = sorted(r[0] for r in own.limit(MAX_BUCKETS + 1).collect())
    out = []
    for other in others:
        laid_out = BUCKET in other.columns
        here = F.col(BUCKET) if laid_out else L.bucket_1000("block_number")
        if len(buckets) > MAX_BUCKETS:
            out.append(other.join(own, here == own["_bucket"], "left_semi"))
        elif not buckets:
            out.append(other.filter(F.lit(False)))
        else:
            near = other.filter(F.col(BUCKET).isin(buckets)) if laid_out else other
            within = [F.col("block_number").between(lo, hi) for lo, hi in _ranges(buckets)]
            out.append(near.filter(reduce(lambda a, b: a | b, within)))
    return out


def heal_tx(target: DataFrame, batch: DataFrame, blocks: DataFrame, receipts: DataFrame) -> DataFrame:
    """The batch plus pending target transactions whose block and receipt have
    arrived. Overlaps are settled by the caller's newest-row rule."""
    pending = target.filter("is_pending")
    blocks, receipts = in_blocks_of(pending, blocks, receipts)
    b = blocks.select("block_number", F.col("block_timestamp").alias("_bts"),
                                       F.col("_inserted_timestamp").alias("_bins"))
    r = receipts.select("block_number", "tx_hash", *[F.col(c).alias("_r_" + c) for c in
                        ("gas_used", "tx_status", "cumulative_gas_used", "effective_gas_price", "type",
                         "_inserted_timestamp")])
    fee = fee_precise("_r_effective_gas_price", "_r_gas_used")
    healed = (pending.join(b, "block_number").join(r, ["block_number", "tx_hash"])
              .withColumns({
                  "block_timestamp": F.col("_bts"), "is_pending": F.lit(False),
                  "gas_used": F.col("_r_gas_used"), "tx_status": F.col("_r_tx_status"),
                  "cumulative_gas_used": F.col("_r_cumulative_gas_used"),
                  "effective_gas_price": F.col("_r_effective_gas_price"), "tx_type": F.col("_r_type"),
                  "tx_fee_precise": fee, "tx_fee": F.coalesce(fee.cast("double"), F.lit(0.0)),
                  "_inserted_timestamp": L.greatest_strict("_inserted_timestamp", "_bins",
                                                           "_r__inserted_timestamp")})
              .select(*batch.columns))
    return union_all(batch, healed)


def heal_logs(target: DataFrame, batch: DataFrame, txs: DataFrame) -> DataFrame:
    """The batch plus pending target logs whose transaction is known by now."""
    pending = target.filter("is_pending")
    txs, = in_blocks_of(pending, txs)
    t = txs.select("block_number", "tx_hash", F.col("block_timestamp").alias("_bts"),
                   F.col("origin_function_signature").alias("_sig"),
                   F.col("_inserted_timestamp").alias("_tins"))
    healed = (pending.join(t, ["block_number", "tx_hash"])
              .withColumns({
                  "block_timestamp": F.col("_bts"), "origin_function_signature": F.col("_sig"),
                  "is_pending": F.col("_bts").isNull() | F.col("_sig").isNull(),
                  "_inserted_timestamp": L.greatest_strict("_inserted_timestamp", "_tins")})
              .select(*batch.columns))
    return union_all(batch, healed)


def heal_traces(target: DataFrame, txs: DataFrame, run_ts: dt.datetime, days: int | None = 14) -> DataFrame:
    """Published traces lacking transaction columns, completed from the transactions of the last ``days``
    (of any age where that is None)."""
    lacking = target.filter(F.col("tx_hash").isNull() | F.col("block_timestamp").isNull() | F.col("tx_succeeded").isNull())
    recent, = in_blocks_of(lacking, txs if days is None else floor_days(txs, "block_timestamp", run_ts, days))
    fill = {"tx_hash": "tx_hash", "block_timestamp": "block_timestamp",
            "origin_function_signature": "origin_function_signature",
            "origin_from_address": "from_address", "origin_to_address": "to_address",
            "tx_succeeded": "tx_status"}
    side = recent.select("block_number", F.col("position").alias("tx_position"),
                         *[F.col(src).alias("_x_" + dst) for dst, src in fill.items()])
    return (lacking.join(side, ["block_number", "tx_position"])
            .withColumns({d: F.col("_x_" + d) for d in fill}).select(*target.columns))


def heal_sales(target: DataFrame, contracts: DataFrame, aggs: DataFrame, run_ts: dt.datetime,
               hours: float = 4, name_days: int | None = 14, label_days: int | None = 2, marks: dict | None = None) -> DataFrame:
    """Blocks of earlier sales that a new contract name or aggregator can label: names of the last
    ``name_days``, aggregators of the last ``label_days`` (None: of any age).

    Returns all target rows of those blocks, to be labelled again. One pass over the target finds the blocks.
    """
    floor = lookback_floor(target, "_inserted_timestamp", hours, marks)
    if floor is None:
        return target
    recent = lambda df, days: df if days is None else df.filter(
        F.col("_inserted_timestamp") > ts_lit(run_ts - dt.timedelta(days=days)))
    old = target.filter(F.col("_inserted_timestamp") < ts_lit(floor)).select(
        "block_number", "nft_address", "origin_to_address", F.right("input_data", F.lit(8)).alias("_tail"),
        F.col("project_name").isNull().alias("_unnamed"), F.col("aggregator_name").isNull().alias("_unlabelled"))
    fresh = recent(aggs, label_days)
    hits = {"_named": ("nft_address", recent(contracts, name_days).filter("token_name is not null"), "contract_address"),
            "_called": ("_tail", fresh.filter("aggregator_type = 'calldata'"), "aggregator_identifier"),
            "_routed": ("origin_to_address", fresh.filter("aggregator_type = 'router'"), "aggregator_identifier")}
    for flag, (own, side, key) in hits.items():
        side = side.select(F.col(key).alias("_k" + flag), F.lit(True).alias(flag)).distinct()
        old = old.join(side, old[own] == side["_k" + flag], "left")
    blocks = old.filter("(_unnamed and _named) or (_unlabelled and _called) or _routed").select("block_number").distinct()
    return reemit_blocks(target, blocks)


def reemit_blocks(target: DataFrame, blocks: DataFrame) -> DataFrame:
    """All target rows of the listed blocks, to go through the sink again."""
    return target.join(blocks.select("block_number").distinct(), "block_number", "left_semi")


# -- ingest bookkeeping ------------------------------------------------------

def number_sequence(spark: SparkSession, lo: int, hi: int) -> DataFrame:
    """Integers above ``lo`` up to ``hi``."""
    return spark.range(lo + 1, hi + 1).withColumnRenamed("id", "block_number")


def complete_set(landed: DataFrame, target: DataFrame | None, keys, id_col: str, run: Run,
                 seed: DataFrame | None = None) -> DataFrame:
    """Which blocks (or transactions) have landed; the newest landing wins.

    ``seed`` adds an earlier set on the first build only.
    """
    keys = names(keys)
    new = since_inclusive(landed, target, marks=run.marks).select(*keys, "_inserted_timestamp")
    if seed is not None and target is None:
        new = union_all(new, seed.select(*keys, "_inserted_timestamp"))
    return stamp(latest(new, keys, "_inserted_timestamp").withColumn(id_col, L.surrogate_key(*keys)), run)


def backlog(expected: DataFrame, done: DataFrame, lookback: DataFrame, side: str = "ge", keys="block_number") -> DataFrame:
    """Expected keys not yet done, at or above ('ge') or below ('lt') the lookback block.

    Block numbers are dense, so a row stands for 64 of them until the gaps are known; (block, hash) pairs meet as they are.
    """
    edge = lookback.scalar()
    within = (lambda d: d.filter(F.col("block_number") >= edge)) if side == "ge" else \
             (lambda d: d.filter(F.col("block_number") < edge))
    want = within(expected)
    for k in names(keys):
        want = want.filter(F.col(k).isNotNull())
    return minus(want, within(done), keys, dense=True).withColumn("partition_key", L.bucket_1000("block_number"))


def with_request(todo: DataFrame, method: str, *params: Column) -> DataFrame:
    """The JSON-RPC request body of each row. Nothing is sent."""
    return todo.withColumn("request", L.rpc_body("block_number", method, *params))
