"""Data-quality checks. Each returns the failing rows."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..columns import names
from .bitwords import BITS, values_in, words
from .windows import prev_value


def _where(df: DataFrame, where) -> DataFrame:
    return df if where is None else df.filter(where)


def unique(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*names(keys)).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")


def sequence_gaps(df: DataFrame, c: str, part=(), where=None, width: int = 1_000_000) -> DataFrame:
    """Places where an integer sequence skips values, optionally per group.

    Values travel as words of 64 (see ``bitwords``). A word whose count fits its ends is not taken apart. The
    words are compared by value range, so even one table-wide sequence is
    compared in many tasks; each range passes only its end to the next.
    """
    part = names(part)
    one = [*part, "_all"]
    d = (words(_where(df, where), c, part).withColumns(
        {"_all": F.lit(0), "_range": F.floor(F.col("word") * BITS / width).cast("bigint")}))
    inner = prev_value(d, "hi", [*one, "_range"], ["word"], "_prev", max_rows=None)  # at most ``width`` values per group
    ends = d.groupBy(*one, "_range").agg(F.max("hi").alias("_end"))
    before = prev_value(ends, "_end", one, ["_range"], "_before").select(*part, "_range", "_before")
    both = inner.alias("i").join(before.alias("b"), _keys_equal("i", "b", [*part, "_range"]), "left")
    step = lambda a, b: F.struct(a.alias("previous_value"), b.alias("current_value"))
    last, lo, none = F.coalesce("_prev", "_before"), F.col("lo"), F.array().cast("array<struct<previous_value:bigint,current_value:bigint>>")
    held = values_in("word", "bits")
    steps = F.zip_with(F.slice(held, F.lit(1), F.size(held) - 1), F.slice(held, F.lit(2), F.size(held)), step)
    broken = F.bit_count("bits") != F.col("hi") - lo + 1
    gaps = F.concat(F.when(lo - last > 1, F.array(step(last, lo))).otherwise(none),
                    F.when(broken, F.filter(steps, lambda x: x["current_value"] - x["previous_value"] > 1)).otherwise(none))
    kind = df.schema[c].dataType
    return (both.select(*[F.col("i." + p) for p in part], F.explode(gaps).alias("_gap"))
                .select(*part, F.col("_gap.previous_value").cast(kind).alias("previous_value"),
                        F.col("_gap.current_value").cast(kind).alias("current_value"),
                        (F.col("_gap.current_value") - F.col("_gap.previous_value") - 1).cast(kind).alias("missing")))


def _keys_equal(a: str, b: str, keys) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return out


def not_null(df: DataFrame, c: str, where=None) -> DataFrame:
    return _where(df, where).filter(F.col(c).isNull())


def matches(df: DataFrame, c: str, regex: str, where=None) -> DataFrame:
    """Rows whose text does not contain a match."""
    return _where(df, where).filter(~F.col(c).rlike(regex))


def in_set(df: DataFrame, c: str, values, where=None) -> DataFrame:
    return _where(df, where).filter(~F.col(c).isin(list(values)))


def type_in(df: DataFrame, c: str, types) -> DataFrame:
    """One row if a column's type is not among the allowed ones. Reads no data."""
    actual = df.schema[c].dataType.simpleString().split("(")[0]
    rows = [] if actual in {t.lower() for t in names(types)} else [(c, actual)]
    return df.sparkSession.createDataFrame(rows, "column_name string, actual_type string")


def recent(df: DataFrame, c: str, days: int, run_ts: dt.datetime) -> DataFrame:
    """One row if the newest value is older than some days before the run."""
    floor = F.lit(str(run_ts - dt.timedelta(days=days))).cast("timestamp_ntz")
    return df.agg(F.max(c).alias("newest")).filter(F.col("newest").isNull() | (F.col("newest") < floor))


def one_block_per_tx(df: DataFrame, tx: str = "tx_hash", block: str = "block_number") -> DataFrame:
    """Transactions seen in more than one block."""
    return (df.groupBy(tx).agg(F.min(block).alias("first_block"), F.max(block).alias("last_block"))
              .filter("first_block <> last_block"))


def grade(failures: DataFrame, warn_if: str = "!=0", error_if: str = "!=0") -> DataFrame:
    """One row: number of failures and pass, warn or error by thresholds."""
    rule = lambda r: F.expr("n_failures " + r.replace("!=", "<>"))
    return (failures.agg(F.count(F.lit(1)).alias("n_failures"))
            .withColumn("status", F.when(rule(error_if), "error").when(rule(warn_if), "warn").otherwise("pass")))


def store_failures(df: DataFrame, path: str) -> None:
    """Write the failing rows for later inspection."""
    df.write.mode("overwrite").parquet(path)
