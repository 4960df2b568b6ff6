"""Text helpers for addresses, paths and identifiers."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..columns import col


def selector(c: str | Column) -> Column:
    """Function selector: 0x and four bytes of call data."""
    return F.substring(col(c), 1, 10)


def right_n(c: str | Column, n: int) -> Column:
    return F.right(col(c), F.lit(n))


def normalise_path(c: str | Column) -> Column:
    """Runs of non-digits to single underscores, none at the edges."""
    return F.regexp_replace(F.regexp_replace(col(c), "[^0-9]+", "_"), "^_|_$", "")


def full_match(c: str | Column, pattern: str) -> Column:
    """Regex test of the whole text."""
    return col(c).rlike(f"^(?:{pattern})$")


def split_part(c: str | Column, sep: str, n: int) -> Column:
    return F.split_part(col(c), F.lit(sep), F.lit(n))


def dash_id(*items: str | Column) -> Column:
    """Parts joined by dashes; null if any part is null."""
    out: list[Column] = []
    for c in items:
        out += [F.lit("-"), col(c).cast("string")]
    return F.concat(*out[1:])


def blank_null(c: str | Column) -> Column:
    return F.nullif(col(c), F.lit(""))
