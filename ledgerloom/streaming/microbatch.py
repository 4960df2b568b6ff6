"""Structured Streaming wrapper around the batch functions."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.landed import landed_stream


def run_stream(spark: SparkSession, path: str, schema, pipeline: Callable[[DataFrame], DataFrame],
               sink: Callable[..., None], checkpoint: str, fmt: str = "parquet", numbered: bool = False):
    """Process all files landed since the last run, then stop.

    Progress is kept in ``checkpoint``, a folder all executors share. A batch
    repeated after a failure changes nothing where ``sink`` replaces by key. With ``numbered``, ``sink`` also
    gets the batch's number, the same when it is repeated, under which ``append_once`` files rows.
    """
    query = (landed_stream(spark, path, schema, fmt).writeStream
             .foreachBatch(lambda batch, number: sink(pipeline(batch), *[number] * numbered))
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query
