"""Table updates.

The pure forms map (target, batch) to the new target. ``upsert_table`` applies
them to a partitioned Parquet table, reading and rewriting only the partitions
a batch touches. Each commit leaves the table's high-water marks beside its files, so
that the next run need not ask the table how far it is.
"""
from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..columns import names
from ..operators.groups import _all, keep


def evolve(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Target and batch together; columns only one has are null in the other."""
    return target.unionByName(batch, allowMissingColumns=True)


def delete_insert(target: DataFrame, batch: DataFrame, keys) -> DataFrame:
    """Drop target rows whose key occurs in the batch, then add the batch."""
    keys = names(keys)
    kept = target.join(batch.select(*keys).distinct(), keys, "left_anti").select(*target.columns)
    return evolve(kept, batch)


def merge_upsert(target: DataFrame, batch: DataFrame, keys, update_cols=None, keep_cols=()) -> DataFrame:
    """Update matching rows and insert new ones.

    ``update_cols`` limits what a match updates; ``keep_cols`` are never
    updated. The batch has one row per key.
    """
    keys = names(keys)
    if update_cols is None and not keep_cols:
        return delete_insert(target, batch, keys)
    rest = [c for c in target.columns if c not in keys]
    update = set(rest if update_cols is None else names(update_cols)) - set(names(keep_cols))
    t = target.withColumn("_t", F.lit(True)).alias("t")
    b = batch.withColumn("_b", F.lit(True)).alias("b")
    on = F.lit(True)
    for k in keys:
        on = on & (F.col("t." + k) == F.col("b." + k))
    in_t, in_b = F.col("_t").isNotNull(), F.col("_b").isNotNull()

    def pick(c: str) -> Column:
        new, old = F.col("b." + c), F.col("t." + c)
        take_new = in_b if c in update else (in_b & ~in_t)
        return F.when(take_new, new).otherwise(old).alias(c)

    return t.join(b, on, "full").select(
        *[F.coalesce("t." + k, "b." + k).alias(k) if c_is_key else pick(k)
          for k, c_is_key in ((c, c in keys) for c in target.columns)])


def range_pruned_merge(target: DataFrame, batch: DataFrame, keys, range_col: str) -> DataFrame:
    """Upsert that looks for matches only inside the batch's value range.

    Target rows outside the range pass through, even with a key of the batch.
    """
    lo, hi = batch.agg(F.min(range_col), F.max(range_col)).first()
    if lo is None:
        return target
    within = F.col(range_col).between(F.lit(lo), F.lit(hi))
    if not isinstance(lo, (int, float, str)):
        within = F.col(range_col).between(F.lit(str(lo)).cast("timestamp_ntz"), F.lit(str(hi)).cast("timestamp_ntz"))
    outside = target.filter(~F.coalesce(within, F.lit(False)))
    return outside.unionByName(merge_upsert(target.filter(within), batch, keys))


def _layout(df: DataFrame, order: list[str]) -> DataFrame:
    """Rows in ranges of ``order``, sorted inside. A hash of the row comes last
    in the ranges, so that one value holding many rows still spreads over
    several tasks."""
    plain = [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return (df.withColumn("_spread", F.xxhash64(*plain)).repartitionByRange(*order, "_spread")
              .drop("_spread").sortWithinPartitions(*order))


def clustered(df: DataFrame, exprs: dict[str, Column], sort=()) -> DataFrame:
    """Rows laid out by cluster columns."""
    return _layout(df.withColumns(exprs), [*exprs, *names(sort)])


def write_clustered(df: DataFrame, path: str, exprs: dict[str, Column], sort=(), mode: str = "overwrite") -> None:
    """Write partitioned by the cluster columns, few large files each."""
    (clustered(df, exprs, sort).write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy(*exprs).parquet(path))


def write_bucketed(df: DataFrame, table: str, keys, buckets: int, path: str | None = None) -> None:
    """Write a catalog table dealt into ``buckets`` files by a hash of the keys, sorted in each.

    Tables with the same keys and number of buckets join and aggregate on those keys without moving a row:
    blocks, receipts, transactions and logs all meet on (block, transaction), again in every plan. Rows are dealt
    before the write, so that a bucket is one file.
    """
    keys = names(keys)
    writer = (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys))
    (writer if path is None else writer.option("path", path)).saveAsTable(table)


#: Folder beside a table's files that holds its schema; readers of the files pass it by.
SCHEMA = "_schema"
#: Distinct partition values a batch's filter names; beyond it the filter is a range.
MAX_VALUES = 10_000


def _schema_of(spark: SparkSession, path: str) -> T.StructType | None:
    try:
        return T.StructType.fromJson(json.loads(spark.read.text(f"{path}/{SCHEMA}").first()[0]))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at a path, or None before its first write.

    Tables written by ``upsert_table`` carry their schema, so no file is opened to
    learn it; for others the schemas of all files are merged.
    """
    known = _schema_of(spark, path)
    try:
        return spark.read.schema(known).parquet(path) if known else spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _touched(target: DataFrame, batch: DataFrame, parts: list[str]) -> DataFrame:
    """The target's rows in partitions that the batch has rows in, by literal filters that prune the scan."""
    values = batch.select(*parts).distinct().limit(MAX_VALUES + 1).collect()
    near = target
    for p in parts:
        c = F.col(p)
        if len(values) > MAX_VALUES:
            lo, hi, some = batch.agg(F.min(p), F.max(p), F.count_if(F.isnull(p))).first()
            near = near.filter(c.between(F.lit(lo), F.lit(hi)) | (F.lit(bool(some)) & c.isNull()))
        else:
            own = {r[p] for r in values}
            named = c.isin(*[v for v in own if v is not None])
            near = near.filter(named | c.isNull() if None in own else named)
    listed = batch.select(*[F.col(p).alias("_p_" + p) for p in parts]).distinct()
    return near.join(listed, _all(near[p].eqNullSafe(listed["_p_" + p]) for p in parts), "left_semi") if len(parts) > 1 else near


#: Folder that holds the marks of the last commit, and folder of each partition's marks.
MARKS, PART_MARKS = "_marks", "_part_marks"
#: Columns whose greatest values are kept, where a table has them.
MARKED = ("_inserted_timestamp", "modified_timestamp", "block_number", "partition_key")
_PARSE = {"timestamp_ntz": dt.datetime.fromisoformat, "date": dt.date.fromisoformat,
          "bigint": int, "int": int, "smallint": int, "tinyint": int}


def _put_text(spark: SparkSession, path: str, value: str) -> None:
    spark.createDataFrame([(value,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def _marks_file(spark: SparkSession, path: str) -> dict:
    """What the last commit noted; empty if nothing is known, as after a write that failed."""
    try:
        row = spark.read.text(f"{path}/{MARKS}").first()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise
    return json.loads(row[0]) if row else {}


def read_marks(spark: SparkSession, path: str) -> dict:
    """Greatest values of a table's marked columns as of its last commit, for ``Run.marks``. Reads one
    small file, none of the table's; columns that no commit noted are absent."""
    noted = _marks_file(spark, path).get("tops", {})
    return {c: None if value is None else _PARSE[kind](value) for c, (kind, value) in noted.items()}


def _commit_marks(path: str, batch: DataFrame, parts: list[str], before: dict, columns) -> None:
    """Note the marks of the table as it is now. Only the partitions a batch touched are read;
    a replaced row may have held the greatest value, so marks are kept by partition."""
    spark = batch.sparkSession
    table = read_table(spark, path)
    columns = [c for c in columns if c in table.columns and c not in parts and table.schema[c].dataType.simpleString() in _PARSE]
    if not columns:
        return
    old = before.get("parts") if set(before.get("tops", {})) == set(columns) else None
    near = table if old is None else _touched(table, batch, parts)
    now = near.groupBy(*parts).agg(*[F.max(c).alias(c) for c in columns])
    if old is not None:
        held = spark.read.schema(now.schema).parquet(f"{path}/{PART_MARKS}/{old}")
        same = _all(held[p].eqNullSafe(F.col("_p_" + p)) for p in parts)
        touched = batch.select(*[F.col(p).cast(now.schema[p].dataType).alias("_p_" + p) for p in parts]).distinct()
        now = held.join(touched, same, "left_anti").unionByName(now)
    version = uuid.uuid4().hex
    now.coalesce(1).write.parquet(f"{path}/{PART_MARKS}/{version}")
    tops = spark.read.schema(now.schema).parquet(f"{path}/{PART_MARKS}/{version}").agg(*[F.max(c).alias(c) for c in columns]).first()
    kinds = {c: table.schema[c].dataType.simpleString() for c in columns}
    text = lambda v: None if v is None else v if isinstance(v, int) else v.isoformat()
    _put_text(spark, f"{path}/{MARKS}", json.dumps({"parts": version, "tops": {c: (kinds[c], text(tops[c])) for c in columns}}))


def upsert_table(batch: DataFrame, path: str, keys, partition: dict[str, Column],
                 update_cols=None, keep_cols=(), merge: bool = False, sort=(), marked=MARKED) -> None:
    """Apply a batch to the Parquet table at ``path``.

    ``partition`` columns are functions of the keys, so a key never moves to
    another partition, and the old rows of a batch are all in the partitions
    the batch touches. Those are found by partition pruning, rewritten and
    swapped in on commit; a failed job leaves the table as it was.

    The greatest values of ``marked`` columns are noted after the data (see ``read_marks``). While data
    are written no marks are noted, so after a failure between the two the table is asked again.
    """
    if not partition:
        raise ValueError("upsert_table needs partition columns: it rewrites the partitions a batch touches while it reads the others")
    spark = batch.sparkSession
    batch = keep(batch.withColumns(partition))
    target, before = read_table(spark, path), _marks_file(spark, path)
    if target is not None:
        near = _touched(target, batch, list(partition))
        if merge or update_cols is not None or keep_cols:
            for c in batch.columns:
                if c not in near.columns:
                    near = near.withColumn(c, F.lit(None).cast(batch.schema[c].dataType))
            new = merge_upsert(near, batch, keys, update_cols, keep_cols)
        else:
            new = delete_insert(near, batch, keys)
    else:
        new = batch
    # first the schema: columns that no file has yet read as null
    _put_text(spark, f"{path}/{SCHEMA}", new.schema.json())
    if before:
        _put_text(spark, f"{path}/{MARKS}", "{}")
    (_layout(new, [*partition, *(names(sort) or names(keys))])
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition).parquet(path))
    _commit_marks(path, batch, list(partition), before, marked)
    batch.unpersist()


#: Partition column of rows added by a stream: the number of their batch.
BATCH = "_batch"


def append_once(df: DataFrame, path: str, batch: int) -> None:
    """Add a numbered batch's rows to the table at ``path``, once.

    A batch is a partition of its own, which a repeated batch replaces on commit; so neither a
    failure before nor one after the commit doubles or loses rows.
    """
    (df.withColumn(BATCH, F.lit(batch).cast("bigint")).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(path))
