"""Joins. All are equi-joins; adaptive execution splits their hot keys."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import functions as L
from ..columns import col, names
from .windows import next_value, ordinal


def enrich(df: DataFrame, other: DataFrame, keys, columns, how: str = "left") -> DataFrame:
    """Columns of another table, on shared key names."""
    keys = names(keys)
    return df.join(other.select(*keys, *[c for c in columns if c not in keys]), keys, how)


def inner_using(df: DataFrame, other: DataFrame, keys) -> DataFrame:
    return df.join(other, names(keys), "inner")


def enrich_recent(df: DataFrame, other: DataFrame, keys, columns, ts: str, floor) -> DataFrame:
    """Left join that looks only at recent rows of the other table.

    The bound is applied below the join, where it prunes the scan.
    """
    if floor is not None:
        other = other.filter(F.col(ts) >= floor)
    return enrich(df, other, keys, columns)


def outer_then_filter(left: DataFrame, right: DataFrame, keys, not_null: str) -> DataFrame:
    """Full outer join reduced to rows where a right column is known."""
    return left.join(right, names(keys), "full").filter(F.col(not_null).isNotNull())


def keep_in(df: DataFrame, other: DataFrame, keys) -> DataFrame:
    return df.join(other.select(*names(keys)), names(keys), "left_semi")


def drop_in(df: DataFrame, other: DataFrame, keys) -> DataFrame:
    """NOT IN against known keys. A null on the left never passes NOT IN."""
    keys = names(keys)
    known = other.select(*keys)
    for k in keys:
        known, df = known.filter(F.col(k).isNotNull()), df.filter(F.col(k).isNotNull())
    return df.join(known, keys, "left_anti")


def keep_exists(df: DataFrame, other: DataFrame, cond: Column) -> DataFrame:
    return df.join(other, cond, "left_semi")


def assign_to_next(marks: DataFrame, targets: DataFrame, part, order: str, as_: str = "next_order",
                   **kw) -> DataFrame:
    """For each mark, the order value of the next target in its group.

    Both streams are laid on one line and each mark looks ahead to the nearest
    target, so there is one shuffle and no range join. Marks without a later
    target are dropped.
    """
    part = names(part)
    line = marks.withColumn("_target", F.lit(None).cast(targets.schema[order].dataType)) \
        .withColumn("_is_mark", F.lit(1)) \
        .unionByName(targets.select(*part, order).distinct()
                     .withColumn("_target", F.col(order)).withColumn("_is_mark", F.lit(0)),
                     allowMissingColumns=True)
    # at equal order a target sorts first, so it is not after the mark
    return (next_value(line, "_target", part, [order, "_is_mark"], as_, **kw)
            .filter((F.col("_is_mark") == 1) & F.col(as_).isNotNull())
            .drop("_target", "_is_mark"))


def ancestors(path) -> Column:
    """Dotted-by-underscore path to itself and every prefix of it."""
    parts = F.split(col(path), "_")
    return F.transform(F.sequence(F.lit(1), F.size(parts)),
                       lambda i: F.array_join(F.slice(parts, F.lit(1), i), "_"))


def with_ancestors(nodes: DataFrame, errs: DataFrame, keys, path: str = "trace_address",
                   error: str = "error") -> DataFrame:
    """Nodes paired with each errored node on their path, themselves included.

    Only trees that hold an error are expanded, each node to the prefixes of
    its own path, and matched by equality.
    """
    keys = names(keys)
    bad = errs.select(*keys, F.col(path).alias("_ancestor"), F.col(error).alias("any_error"))
    hit = (nodes.join(bad.select(*keys).distinct(), keys, "left_semi")
                .select(*keys, path, F.explode(ancestors(path)).alias("_ancestor"))
                .join(bad, [*keys, "_ancestor"], "inner")
                .select(*keys, path, F.col("_ancestor").alias("error_address"), "any_error"))
    return nodes.join(hit, [*keys, path], "left")


def tree_self(nodes: DataFrame, keys, path: str = "trace_address",
              parent: str = "parent_trace_address") -> DataFrame:
    """Nodes with the number of their children."""
    from .aggregates import child_count
    keys = names(keys)
    counts = child_count(nodes, keys, parent).withColumnRenamed(parent, path)
    return (nodes.join(counts, [*keys, path], "left")
                 .withColumn("sub_traces", F.coalesce("sub_traces", F.lit(0).cast("bigint"))))


def price_at_hour(df: DataFrame, prices: DataFrame, ts: str, token: str, price: str = "price",
                  native: str | None = None) -> DataFrame:
    """Price of a row's token, and of a native coin, in the row's hour."""
    p = prices.select(F.col("hour").alias("_hour"), F.col("token_address").alias("_token"), F.col(price).alias("hourly_price"))
    d = df.withColumn("_h", L.hour_of(ts))
    out = d.join(p, (d["_h"] == p["_hour"]) & (d[token] == p["_token"]), "left").drop("_hour", "_token")
    if native is not None:
        n = prices.filter(F.col("token_address") == native).select(F.col("hour").alias("_hour"), F.col(price).alias("native_price"))
        out = out.join(n, out["_h"] == n["_hour"], "left").drop("_hour")
    return out.drop("_h")


def lookup(df: DataFrame, dim: DataFrame, on: Column, columns: dict[str, str]) -> DataFrame:
    """Left join of dimension columns, renamed."""
    d = dim
    return df.join(d, on, "left").select(
        *[df[c] for c in df.columns], *[d[src].alias(name) for name, src in columns.items()])


def join_either(left: DataFrame, right: DataFrame, part, left_key: str, right_keys,
                columns, how: str = "left") -> DataFrame:
    """Match a value against either of two columns, by unpivoting them."""
    part = names(part)
    side = (right.select(*part, *columns, F.explode(F.array_distinct(F.array(*names(right_keys)))).alias(left_key))
                 .filter(F.col(left_key).isNotNull()))
    return left.join(side, [*part, left_key], how)


def flatten(df: DataFrame, array, index: str = "index", value: str = "value") -> DataFrame:
    """One row per array element with its position; empty and null arrays drop."""
    return df.select("*", F.posexplode(col(array)).alias(index, value))


def attach_payment(moves: DataFrame, payments: DataFrame, part, giver: str = "giver", taker: str = "taker",
                   payer: str = "payer", payee: str = "payee", nth: str = "nth", columns=()) -> DataFrame:
    """The payment going the other way for an asset movement of the same rank."""
    side = payments.select(*names(part), F.col(payer).alias(taker), F.col(payee).alias(giver), nth, *columns)
    return moves.join(side, [*names(part), taker, giver, nth], "left")


def override_asset(sales: DataFrame, transfers: DataFrame, keys, address: str = "nft_address",
                   override: str = "nft_address_from_transfers") -> DataFrame:
    """Asset address of the matching transfer, where there is one."""
    side = transfers.select(*names(keys), override)
    return (sales.join(side, names(keys), "left")
                 .withColumn(address, F.coalesce(F.col(override), F.col(address))).drop(override))


def align_nth(left: DataFrame, right: DataFrame, part, l_order, r_order, columns, nth: str = "nth",
              **kw) -> DataFrame:
    """Pair the n-th row of each group on the left with the n-th on the right."""
    part = names(part)
    lhs = ordinal(left, part, l_order, nth, **kw)
    rhs = ordinal(right, part, r_order, nth, **kw).select(*part, nth, *columns)
    return lhs.join(rhs, [*part, nth], "inner")
