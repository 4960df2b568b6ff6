"""Landed payload files."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# Envelope of a landed row; the payloads stay JSON text.
ENVELOPE = T.StructType([T.StructField("VALUE", T.StringType()), T.StructField("DATA", T.StringType()),
                         T.StructField("metadata", T.StringType()),
                         T.StructField("block_number", T.LongType()),
                         T.StructField("_inserted_timestamp", T.TimestampNTZType())])


def partition_number(path, depth: int = 4) -> Column:
    """Integer before the first underscore of a path's n-th part."""
    return F.split_part(F.split_part(path, F.lit("/"), F.lit(depth)), F.lit("_"), F.lit(1)).try_cast("bigint")


def _with_file_columns(df: DataFrame, root: str, depth: int) -> DataFrame:
    path = F.col("_metadata.file_path")
    if root:
        number = partition_number(F.substring_index(path, root.rstrip("/") + "/", -1), depth)
    else:  # the last part of the path that begins with a number and an underscore
        number = F.regexp_extract(path, r"^.*/(\d+)_[^/]*(?:/.*)?$", 1).try_cast("bigint")
    return df.select("*", F.col("_metadata.file_modification_time").alias("_file_time"), number.alias("partition_key"))


def read_landed(spark: SparkSession, path: str, since: dt.datetime | None = None, full: bool = False,
                root: str = "", depth: int = 4, fmt: str = "parquet", schema=None, address: bool = False) -> DataFrame:
    """Landed rows with the partition number from their file's name.

    The number is the one before the first underscore of the ``depth``-th part of
    the path below ``root``, or without a root that of the deepest part that has one.
    ``since`` keeps files modified from then on: the file reader skips older
    files before opening them. ``full`` reads the whole history.
    """
    reader = spark.read.format(fmt).option("recursiveFileLookup", "true")
    if schema is not None:
        reader = reader.schema(schema)
    if since is not None and not full:
        reader = reader.option("modifiedAfter", since.strftime("%Y-%m-%dT%H:%M:%S"))
    rows = reader.load(path)
    if address:
        rows = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"), "_metadata")
    out = _with_file_columns(rows, root, depth)
    return out.drop("_metadata") if address else out


def landed_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int = 10_000,
                  root: str = "", depth: int = 4) -> DataFrame:
    """Newly landed rows as a stream, with the same file columns."""
    return _with_file_columns(spark.readStream.format(fmt).schema(schema).option("recursiveFileLookup", "true")
                              .option("maxFilesPerTrigger", files_per_batch).load(path), root, depth)
