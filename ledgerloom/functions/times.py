"""Times are zone-free timestamps throughout, read as UTC."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..columns import col
from .hexes import hex_to_long

_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def epoch_ts(seconds: str | Column) -> Column:
    s = col(seconds)
    return F.expr(_EPOCH) + F.make_dt_interval(
        F.floor(s / 86400).cast("int"), F.lit(0), F.lit(0), F.pmod(s, F.lit(86400)).cast("decimal(18,6)"))


def epoch_hex_ts(c: str | Column) -> Column:
    """Hex epoch seconds to a timestamp."""
    return epoch_ts(hex_to_long(c))


def micros(c: str | Column) -> Column:
    """Microseconds since the epoch of a zone-free timestamp."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), col(c))


def hour_of(c: str | Column) -> Column:
    return F.date_trunc("hour", col(c)).cast("timestamp_ntz")


def minus_hours(c: str | Column, n: int) -> Column:
    return col(c) - F.expr(f"INTERVAL '{n}' HOUR")
