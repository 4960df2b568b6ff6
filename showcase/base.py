"""Query registration and table access."""
from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.session import bounded_tasks, measured_broadcasts

REGISTRY: dict[str, tuple[Callable, str | None]] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        @functools.wraps(fn)
        def run(spark, *args):
            return fn(bounded_tasks(measured_broadcasts(spark)), *args)
        REGISTRY[name] = (run, sql)
        return fn
    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder all executors can reach: inside the session's checkpoint
    folder, or a temporary one where the driver is the only machine."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/{uuid.uuid4()}" if root else tempfile.mkdtemp()
