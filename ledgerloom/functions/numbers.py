"""Exact and approximate number helpers."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..columns import col


def try_number(c: str | Column) -> Column:
    """decimal(38,0), or null for text that is no such number."""
    return col(c).try_cast("decimal(38,0)")


def decimal_adjust(c: str | Column, places: int) -> Column:
    """Move the decimal point of integer text left, exactly, as text."""
    raw = col(c).cast("string")
    sign = F.when(raw.startswith("-"), F.lit("-")).otherwise("")
    digits = F.ltrim(raw, F.lit("-"))
    body = F.lpad(digits, F.greatest(F.length(digits), F.lit(places + 1)), "0")
    cut = F.length(body) - places
    whole = F.ltrim(F.substr(body, F.lit(1), cut - 1), F.lit("0"))
    frac = F.rtrim(F.concat(F.lit("."), F.substr(body, cut + 1)), F.lit("0"))
    valid = (digits != "") & (F.translate(digits, "0123456789", "") == "")
    return F.when(valid, F.concat(sign, whole, F.substr(body, cut, F.lit(1)), F.rtrim(frac, F.lit("."))))


def scale_down(c: str | Column, places: str | int | Column) -> Column:
    """Amount over 10^places, as a double."""
    p = F.lit(places) if isinstance(places, int) else col(places)
    return col(c).cast("double") / F.pow(F.lit(10.0), p)


def bucket_1000(c: str | Column) -> Column:
    """Nearest thousand, halves up: the partition number of a block."""
    return F.round(col(c), -3).cast("bigint")


def per_item(c: str | Column, n: str | Column) -> Column:
    """Exact amount per item at six decimals."""
    return (col(c).cast("decimal(38,0)") / col(n).cast("decimal(38,0)")).cast("decimal(38,6)")


def greatest_strict(*items: str | Column) -> Column:
    """Greatest value, null as soon as one input is null."""
    cs = [col(c) for c in items]
    known = cs[0].isNotNull()
    for c in cs[1:]:
        known = known & c.isNotNull()
    return F.when(known, F.greatest(*cs))
