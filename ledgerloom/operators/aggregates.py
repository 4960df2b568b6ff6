"""Aggregations. All combine on the map side before shuffling."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import functions as L
from ..columns import col, names


def sums(df: DataFrame, keys, measures: dict[str, Column]) -> DataFrame:
    return df.groupBy(*names(keys)).agg(*[F.sum(e).alias(n) for n, e in measures.items()])


def sums_all(df: DataFrame, measures) -> DataFrame:
    """Sums grouped by every column that is not summed."""
    measures = names(measures)
    return sums(df, [c for c in df.columns if c not in measures], {m: F.col(m) for m in measures})


def child_count(nodes: DataFrame, keys, parent: str = "parent_trace_address",
                as_: str = "sub_traces") -> DataFrame:
    return nodes.filter(F.col(parent).isNotNull()).groupBy(*names(keys), parent).agg(F.count(F.lit(1)).alias(as_))


def count_items(items, types, field: str = "item_type") -> Column:
    """Number of array elements of some types, without exploding."""
    return F.size(F.filter(col(items), lambda x: x[field].isin(*types)))


def count_having(df: DataFrame, keys, cond: Column, as_: str = "n") -> DataFrame:
    return df.groupBy(*names(keys)).agg(F.count(F.lit(1)).alias(as_)).filter(cond)


def first_value_per(df: DataFrame, keys, value: Column, order, as_: str) -> DataFrame:
    """Earliest non-null value per key."""
    order = F.struct(*names(order))
    return df.groupBy(*names(keys)).agg(
        F.min_by(value, F.when(value.isNotNull(), order)).alias(as_))


def object_agg(df: DataFrame, keys, k: str, v: str, as_: str = "obj", pieces: int = 1) -> DataFrame:
    """Map of names to values per key; null values are left out.

    Rows are reduced to one per name first, so a map never gathers more than
    the distinct names of its key. A map is one value of one row; where a key may have
    more names than that, ``pieces`` deals them by hash over that many rows a key (column ``piece``).
    """
    one = (df.filter(F.col(v).isNotNull() & F.col(k).isNotNull())
             .groupBy(*names(keys), k).agg(F.min(v).alias(v)))
    keys = names(keys)
    if pieces > 1:
        one, keys = one.withColumn("piece", F.pmod(F.xxhash64(k), F.lit(pieces))), [*keys, "piece"]
    return one.groupBy(*keys).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(k, v)))).alias(as_))


def entries_to_map(items, name: str = "name", value: str = "value") -> Column:
    """Map from an array of named values, in place."""
    known = F.filter(col(items), lambda x: x[value].isNotNull())
    return F.map_from_entries(F.transform(known, lambda x: F.struct(x[name], x[value])))


def min_or(df: DataFrame, c: str, default, where: Column | None = None) -> DataFrame:
    """One row: the least value, or a default where nothing qualifies."""
    src = df if where is None else df.filter(where)
    return src.agg(F.coalesce(F.min(c), F.lit(default)).alias(c))


def high_water(target: DataFrame | None, c: str, default=None, marks: dict | None = None):
    """Greatest value in a target table, as a plain value.

    ``marks`` are the values a table's last commit left beside it (``sources.read_marks``); only a column that they
    lack is looked up in the table itself.
    """
    if target is None:
        return default
    top = marks[c] if marks and c in marks else target.agg(F.max(c)).first()[0]
    return default if top is None else top


def distinct(df: DataFrame, columns) -> DataFrame:
    return df.select(*names(columns)).distinct()


def tree_success(nodes: DataFrame, keys, path: str = "trace_address", error: str = "error",
                 **kw) -> DataFrame:
    """Nodes with ``trace_succeeded``: no error at the node, above it or at the root.

    In depth-first order the subtree of an errored node is the run of paths
    from its own up to its next sibling's. Subtrees nest or are apart, so a
    node has failed exactly when some earlier such run ends after it: one
    running maximum, and no join of nodes with their ancestors.
    """
    from .windows import running_max
    p = path_array(path)
    last = F.element_at("_path", -1)
    end = F.when(F.col(path) == "ORIGIN", F.array(F.lit(2**31 - 1))).otherwise(
        F.concat(F.slice("_path", F.lit(1), F.size("_path") - 1), F.array(last + 1)))
    out = running_max(nodes.withColumn("_path", p), keys, ["_path"], F.when(F.col(error).isNotNull(), end), "_end", **kw)
    return (out.withColumn("trace_succeeded", ~F.coalesce(F.col("_path") < F.col("_end"), F.lit(False)))
               .drop("_path", "_end"))


def path_array(path) -> Column:
    """Path text to integers, the root being -1."""
    return F.transform(F.split(col(path), "_"),
                       lambda x: F.when(x == "ORIGIN", -1).otherwise(x.try_cast("int")))


def items_per_group(df: DataFrame, keys, priced: Column, as_: str = "offer_length") -> DataFrame:
    """Rows per group, for groups with at least one priced row."""
    return (df.groupBy(*names(keys))
              .agg(F.count(F.when(priced, 1)).alias("_priced"), F.count(F.lit(1)).alias(as_))
              .filter("_priced > 0").drop("_priced"))


def min_date(df: DataFrame, c: str) -> DataFrame:
    return df.agg(F.to_date(F.min(c)).alias("min_date"))
