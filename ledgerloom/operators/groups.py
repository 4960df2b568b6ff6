"""Cutting groups that are too large for one task.

A window over a group runs in one task, so a group holding a large share of a
table would stall the job. ``with_chunks`` finds such groups and cuts them into
consecutive pieces along the window order; the operators in ``windows`` then
work per piece and carry a small summary from piece to piece. Detection decides
only how work is laid out, never what the result is.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..columns import col, names

CHUNK = "_chunk"
MAX_GROUP_ROWS = 5_000_000
#: Bytes a row is taken to have at least where Spark's size estimate rules out a large group.
ROW_BYTES = 16
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def keep(df: DataFrame) -> DataFrame:
    """Cut a reused result's lineage where the session has a shared checkpoint folder: the rows are written there as a
    compressed table, of which later reads open only the columns they need, and nothing else of the run that made them
    stays on disk. Otherwise hold it on disk."""
    folder = _checkpoint_folder(df.sparkSession)
    if folder is None:
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if not _storable(df):
        return df.checkpoint(eager=True)
    path = f"{folder.rstrip('/')}/kept-{uuid.uuid4()}"
    with _shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Let shuffle files go with the execution that wrote them, not when the driver happens to collect its garbage.

    Only for executions that nobody can repeat, such as a write: a DataFrame run twice would have to write them again.
    """
    own = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if own is None else spark.conf.set(_CLEANUP, own)


def _checkpoint_folder(spark: SparkSession) -> str | None:
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir", None)
    if folder and sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(folder)
    known = sc._jsc.sc().getCheckpointDir()
    return folder or (None if known.isEmpty() else known.get())


def _storable(df: DataFrame) -> bool:
    """Whether a Parquet file holds these columns as they are."""
    lower = [c.lower() for c in df.columns]
    text = df.schema.simpleString()
    return len(lower) == len(set(lower)) > 0 and not any(t in text for t in (":void", "<void", ",void", "interval", "struct<>"))


def estimated_bytes(df: DataFrame) -> int:
    """The optimiser's size estimate, from file sizes: no job runs for it."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def with_chunks(df: DataFrame, part, split_by, max_rows: int | None = MAX_GROUP_ROWS) -> tuple[DataFrame, bool]:
    """Add the piece number of each row if any group needs cutting, and say so.

    ``split_by`` is a column, or columns, that never decrease along the window
    order (nulls first). The rows of all groups above ``max_rows`` are dealt by
    ranges of group and ``split_by``, of about half that many rows each; a range
    is a piece. Any number of groups, any size and any orderable type will do;
    only rows equal in ``split_by`` stay together. The cut rows are kept, so that
    whoever reads them sees the same pieces. Groups are counted by their key columns, and only where the input is
    estimated to exceed what one task may hold anyway. ``max_rows=None`` skips detection,
    for groups with a bound of their own.
    """
    part = names(part)
    by = [col(c) for c in (split_by if isinstance(split_by, (list, tuple)) else [split_by])]
    if max_rows is None or estimated_bytes(df) <= max_rows * ROW_BYTES:
        return df, False  # all of it is about one task's share
    hot = keep(df.groupBy(*part).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max_rows))
    total = hot.agg(F.sum("_n")).first()[0]
    if not total:
        return df, False
    keys = hot.select(*[F.col(p).alias(f"_k{i}") for i, p in enumerate(part)])
    same = _all(df[p].eqNullSafe(keys[f"_k{i}"]) for i, p in enumerate(part))
    ranges = -(-2 * total // max_rows)
    cut = keep(df.join(keys, same, "left_semi").repartitionByRange(ranges, *[F.col(p) for p in part], *by)
               .withColumn(CHUNK, F.spark_partition_id()))
    rest = df.join(keys, same, "left_anti").withColumn(CHUNK, F.lit(0))
    return rest.unionByName(cut), True


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def same_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return _all(a[k].eqNullSafe(b[k]) for k in keys)
