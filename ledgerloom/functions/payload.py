"""JSON text and arrays."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..columns import col


def jget(c: str | Column, path: str, type_: str = "string") -> Column:
    """Value at a JSON path, cast leniently."""
    value = F.get_json_object(col(c), path)
    return value if type_ == "string" else value.try_cast(type_)


def at(c: str | Column, i: int | Column) -> Column:
    """Zero-based element; null out of range."""
    return F.get(col(c), F.lit(i) if isinstance(i, int) else i)


def size0(c: str | Column) -> Column:
    """Array length; null for null."""
    return F.when(col(c).isNotNull(), F.size(col(c)))


def rpc_body(id_: str | Column, method: str, *params: Column) -> Column:
    """JSON-RPC 2.0 request body as text. ``params`` are JSON fragments."""
    quoted = F.to_json(F.struct(col(id_).cast("string").alias("id"),
                                F.lit("2.0").alias("jsonrpc"),
                                F.lit(method).alias("method")))
    return F.concat(F.regexp_replace(quoted, r"\}$", ',"params":['),
                    F.concat_ws(",", *params), F.lit("]}"))
