"""Nested call trees to one row per call."""
from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..columns import names

ROOT = "ORIGIN"
#: Field under which a document that is not JSON keeps its text.
MALFORMED = "_malformed"
_SLICE = 50_000


@F.pandas_udf(T.BooleanType())
def _holds(docs: pd.Series, key: pd.Series) -> pd.Series:
    def one(doc, k):
        try:
            tree = json.loads(doc)
        except ValueError:
            return True  # left to whoever reads the document
        return isinstance(tree, dict) and tree.get(k) is not None
    return pd.Series([None if d is None else one(d, k) for d, k in zip(docs, key)], dtype=object)


def holds(doc: Column, key: str) -> Column:
    """Whether a JSON document has a value under a top-level key, at any nesting.

    The JVM's parser answers for almost all; what it refuses, above all documents
    nested deeper than 1,000 levels, goes to Python, which gets nulls for the rest.
    """
    found = F.get_json_object(doc, "$." + key).isNotNull()
    readable = F.get_json_object(doc, "$").isNotNull()
    return doc.isNotNull() & (found | F.coalesce(_holds(F.when(~found & ~readable, doc), F.lit(key)), F.lit(False)))


def where_holds(df: DataFrame, c: str, key: str) -> DataFrame:
    """Rows whose document ``holds`` a key; the JVM parses a document for it once."""
    found, doc = F.col("_found"), F.col(c)
    refused = F.when(~found & F.get_json_object(doc, "$").isNull(), doc)
    return (df.filter(doc.isNotNull()).withColumn("_found", F.get_json_object(doc, "$." + key).isNotNull())
            .filter(found | F.coalesce(_holds(refused, F.lit(key)), F.lit(False))).drop("_found"))


def _text(v) -> str:
    return v if isinstance(v, str) else json.dumps(v, separators=(",", ":"))


class _Slice:
    """Columns of the nodes found so far, in Arrow's flat layout."""

    def __init__(self):
        self.rows, self.paths, self.ends, self.keys, self.values = [], [], [0], [], []

    def walk(self, row: int, tree: dict, child: str) -> None:
        """Add every node of a tree, any depth: its path and own fields."""
        todo = [(tree, "")]
        while todo:
            node, path = todo.pop()
            for k, v in node.items():
                if k != child and v is not None:
                    self.keys.append(k)
                    self.values.append(v if type(v) is str else _text(v))
            self.ends.append(len(self.keys))
            self.rows.append(row)
            self.paths.append(path or ROOT)
            prefix = path + "_" if path else ""
            for i, sub in enumerate(node.get(child) or ()):
                if isinstance(sub, dict):
                    todo.append((sub, f"{prefix}{i}"))

    def reject(self, row: int, doc: str) -> None:
        self.keys.append(MALFORMED)
        self.values.append(doc)
        self.ends.append(len(self.keys))
        self.rows.append(row)
        self.paths.append(None)

    def batch(self, source: pa.RecordBatch, keep: list[str]) -> pa.RecordBatch:
        kept = source.select(keep).take(pa.array(self.rows, pa.int32()))
        fields = pa.MapArray.from_arrays(pa.array(self.ends, pa.int32()), pa.array(self.keys, pa.string()),
                                         pa.array(self.values, pa.string()))
        return pa.RecordBatch.from_arrays([*kept.columns, pa.array(self.paths, pa.string()), fields],
                                          [*keep, "trace_address", "trace_json"])


def flatten_tree(df: DataFrame, json_col: str, keep, child_key: str = "calls", within: str | None = None,
                 malformed: str = "raise") -> DataFrame:
    """One row per node of the tree held as JSON text, under the key ``within`` if given.

    Trees have no depth limit, which rules out a fixed set of explodes; a
    recursive query would shuffle and re-read every level. Each document is
    walked once instead, in Arrow batches, inside the scan's own tasks. Rows
    leave in slices, so memory does not grow with a batch's node count.

    A document that is not JSON fails the job (``malformed="raise"``), or gives one
    row without a path that keeps its text under ``MALFORMED`` ("keep").
    """
    if malformed not in ("raise", "keep"):
        raise ValueError("malformed is raise or keep")
    keep = names(keep)
    schema = T.StructType([df.schema[k] for k in keep] + [
        T.StructField("trace_address", T.StringType()),
        T.StructField("trace_json", T.MapType(T.StringType(), T.StringType()))])

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _Slice()
            for row, doc in enumerate(batch.column(json_col).to_pylist()):
                try:
                    tree = json.loads(doc) if doc else None
                except ValueError as e:
                    if malformed == "raise":
                        raise ValueError(f"not a JSON document: {doc[:200]}") from e
                    found.reject(row, doc)
                    continue
                if within is not None:
                    tree = tree.get(within) if isinstance(tree, dict) else None
                if isinstance(tree, dict):
                    found.walk(row, tree, child_key)
                    if len(found.rows) >= _SLICE:
                        yield found.batch(batch, keep)
                        found = _Slice()
            if found.rows:
                yield found.batch(batch, keep)

    path = F.col("trace_address")
    # paths are ASCII and long in deep trees: cut as bytes, no characters are counted
    last, text = F.octet_length(F.substring_index(path, "_", -1)), path.cast("binary")
    parent = text.substr(F.lit(1), F.octet_length(path) - last - 1).cast("string")
    return df.select(*keep, json_col).mapInArrow(nodes, schema).withColumns({
        "parent_trace_address": F.when(path.contains("_"), parent).when(path != ROOT, ROOT),
        "trace_address_array": F.split(path, "_")})
