"""What the operators of this subpackage share: sessions, folders, text as bytes."""
from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Rows an Arrow batch holds at most, so that a batch of long texts stays small.
BATCH_ROWS = 1_000
WORD_SPACE = r"[\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    """Make the package loadable in workers, bound Arrow batches and name a checkpoint folder where none is set."""
    sc = spark.sparkContext
    if not getattr(sc, "_ledgerloom_shipped", False):
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(), "ledgerloom.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(top):
                for n in names:
                    if n.endswith(".py"):
                        full = os.path.join(folder, n)
                        z.write(full, os.path.relpath(full, os.path.dirname(top)))
        sc.addPyFile(path)
        sc._ledgerloom_shipped = True
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    shared(spark)
    return spark


def shared(spark: SparkSession) -> str:
    """The folder every executor reaches: ``spark.checkpoint.dir``. Where it is unset, as in
    local tests, a temporary one. A cluster must set it."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = getattr(sc, "_ledgerloom_folder", None) or tempfile.mkdtemp()
        sc._ledgerloom_folder = root
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def written(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """The rows from a table in the shared folder: later reads survive the loss of any executor, and are columnar."""
    path = f"{shared(df.sparkSession)}/ledgerloom-{uuid.uuid4()}"
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_bytes(c: str | Column) -> Column:
    """UTF-8 bytes of a text; null counts as empty."""
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("binary"), F.lit(b""))


def remainder(c: str | Column, m: int) -> Column:
    """crc32 of an id written as decimal text, modulo ``m``; null for a null id."""
    return (F.crc32((F.col(c) if isinstance(c, str) else c).cast("string").cast("binary")) % m).cast("int")


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
