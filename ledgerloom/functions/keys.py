"""Row identifiers."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..columns import col

# Fixed value: the token that stands for null in surrogate keys.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*items: str | Column) -> Column:
    """md5 of the dash-joined parts, nulls replaced by a fixed token."""
    return F.md5(F.concat_ws("-", *[F.coalesce(col(c).cast("string"), F.lit(NULL_TOKEN))
                                    for c in items]))
