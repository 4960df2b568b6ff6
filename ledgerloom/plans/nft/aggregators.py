"""Labels of trade aggregators."""
from __future__ import annotations

from pyspark.sql import DataFrame

from ...operators.windows import latest
from ...sources.sinks import merge_upsert

UPDATED = ["aggregator", "aggregator_type"]


def aggregator_list(rows: DataFrame, target: DataFrame | None) -> DataFrame:
    """The label table after a batch: the newest label per identifier. A known
    identifier keeps the time it was first listed."""
    batch = latest(rows, "aggregator_identifier", "_inserted_timestamp")
    return batch if target is None else merge_upsert(target, batch, "aggregator_identifier", update_cols=UPDATED)
