"""Set operations and backlog ordering."""
from __future__ import annotations

from functools import reduce

from itertools import accumulate

from pyspark.sql import DataFrame, functions as F, types as T

from ..columns import names
from .bitwords import minus_dense
from .groups import keep


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return union_all(*dfs).distinct()


def minus(expected: DataFrame, done: DataFrame, keys, dense: bool = False) -> DataFrame:
    """Distinct expected keys not among the done ones; nulls compare equal.

    ``dense`` says that a single integer key is a dense one, such as a block number: then 64 keys travel as a row.
    """
    keys = names(keys)
    if dense and len(keys) == 1 and all(isinstance(d.schema[keys[0]].dataType, T.IntegralType) for d in (expected, done)):
        return minus_dense(expected, done, keys[0])
    return expected.select(*keys).subtract(done.select(*keys))


def order_backlog(df: DataFrame, asc: bool = True, by: str = "block_number") -> DataFrame:
    return df.orderBy(F.asc(by) if asc else F.desc(by))


def cap(df: DataFrame, n: int, *order) -> DataFrame:
    """The first n rows: a top-n per task, then of those."""
    return df.orderBy(*order).limit(n)


def numbered(df: DataFrame, *order, as_: str = "_n") -> DataFrame:
    """Position of each row in a total order, from 0.

    Rows are dealt by ranges of the order and numbered within their range; the
    ranges' sizes (one number a partition) give each range its first number.
    No task holds more than a range.
    """
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = keep(df.repartitionByRange(*order).sortWithinPartitions(*order)
                  .withColumns({"_part": F.spark_partition_id(), as_: within}))
    sizes = dict(ranged.groupBy("_part").agg(F.count(F.lit(1))).collect())
    before = list(accumulate((sizes.get(i, 0) for i in range(max(sizes, default=-1) + 1)), initial=0))
    return ranged.withColumn(as_, F.col(as_) + F.element_at(F.lit(before), F.col("_part") + 1)).drop("_part")


def batches(df: DataFrame, producer: int, worker: int, *order, cap: int | None = None) -> DataFrame:
    """Number a backlog into producer batches and worker batches; ``cap`` keeps the first rows only."""
    n = F.col("_n")
    out = numbered(df, *order)
    return ((out if cap is None else out.filter(n < cap))
            .withColumns({"producer_batch": F.floor(n / producer).cast("bigint"), "worker_batch": F.floor(n / worker).cast("bigint")})
            .drop("_n"))
