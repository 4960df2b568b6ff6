"""Session settings the library is tuned for."""
from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution sizes and splits shuffle partitions from what each stage
# really wrote, so a cluster starts from many partitions and merges small ones.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # payloads take some ten times their shuffled, compressed size in the sort of a task, so a task gets few bytes, and
    # as many partitions are there to be merged as large inputs need
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "400",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a table's file size says little of the rows derived from it (payloads, exploded arrays), and a broadcast passes
    # through the driver: joins are broadcast by what a stage has really written, not by an estimate
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # the call sites of Column expressions cost more to gather than the plans of this library to build
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build(app: str = "ledgerloom", master: str | None = None, **extra: str) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**SETTINGS, **extra}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def measured_broadcasts(spark: SparkSession) -> SparkSession:
    """Let a session that somebody else built broadcast by measured sizes only, up to the size it allowed for estimates.

    Without adaptive execution nothing is measured, and the session stays as it is.
    """
    estimated, measured = (f"spark.sql.{k}autoBroadcastJoinThreshold" for k in ("", "adaptive."))
    limit = spark.conf.get(estimated)
    if spark.conf.get("spark.sql.adaptive.enabled") == "true" and limit != "-1":
        if spark.conf.get(measured, None) is None:
            spark.conf.set(measured, limit)
        spark.conf.set(estimated, "-1")
    return spark


def bounded_tasks(spark: SparkSession) -> SparkSession:
    """Let a session that somebody else built start shuffles from enough partitions, and merge no more of them than a
    task can sort, so that a task's memory stays as the input grows.

    What that session sets itself stays, more shuffle partitions among it; without adaptive execution nothing is merged.
    """
    own = spark.conf.getAll  # of settings without a default, those that somebody has set
    if all(spark.conf.get(f"spark.sql.adaptive.{k}") == "true" for k in ("enabled", "coalescePartitions.enabled")):
        start, size = (f"spark.sql.adaptive.{k}" for k in ("coalescePartitions.initialPartitionNum", "advisoryPartitionSizeInBytes"))
        if start not in own and int(spark.conf.get("spark.sql.shuffle.partitions")) < int(SETTINGS[start]):
            spark.conf.set(start, SETTINGS[start])
        if size not in own:
            spark.conf.set(size, SETTINGS[size])
    return spark
