"""Small shared helpers for code that accepts a column by name or expression."""
from __future__ import annotations

from pyspark.sql import Column, functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cols(items) -> list[Column]:
    return [col(c) for c in ([items] if isinstance(items, (str, Column)) else items)]


def names(items) -> list[str]:
    return [items] if isinstance(items, str) else list(items)
