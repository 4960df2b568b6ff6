"""Input tables by logical name."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Catalog:
    """Maps logical names to paths (Parquet) or to session tables."""

    def __init__(self, spark: SparkSession, places: dict[str, str]):
        self.spark, self.places = spark, places

    def table(self, name: str) -> DataFrame:
        place = self.places.get(name, name)
        return self.spark.read.parquet(place) if "/" in place else self.spark.table(place)
