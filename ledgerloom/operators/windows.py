"""Row selection and ordered calculations within groups.

Keeping one row per key is a ``row_number() = 1`` filter: Spark trims each map
task's rows to one per key before the shuffle, so a hot key stays small. The
calculations that need a whole ordered group cut large groups into pieces (see
``groups``): the window runs per piece, and one summary row per piece carries
the state across.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..columns import col, cols, names
from .groups import CHUNK, MAX_GROUP_ROWS, with_chunks


# -- one row per key ---------------------------------------------------------

def first_row(df: DataFrame, keys, order) -> DataFrame:
    """The first row of each key in the given order."""
    w = Window.partitionBy(*names(keys)).orderBy(*cols(order))
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def latest(df: DataFrame, keys, ts: str, *ties) -> DataFrame:
    """Newest row per key; a null time counts as newest, as it sorts first."""
    return first_row(df, keys, [F.desc_nulls_first(ts), *ties])


#: Where a landed row lies: its file and its place in it (see ``read_landed``).
ADDRESS = ("_file", "_row")


def latest_in_place(df: DataFrame, keys, ts: str) -> DataFrame:
    """As ``latest``, for rows that carry large payloads and their address.

    Keys, times and addresses alone are compared; the few rows that lost are then left out by address, so a
    payload moves only if the losers are too many to be handed to every task. Equal times are
    settled by address. Rows without an address are compared whole.
    """
    if not set(ADDRESS) <= set(df.columns):
        return latest(df, keys, ts)
    place = F.row_number().over(Window.partitionBy(*names(keys)).orderBy(F.desc_nulls_first(ts), *ADDRESS))
    lost = df.select(*names(keys), ts, *ADDRESS).withColumn("_rn", place).filter("_rn > 1").select(*ADDRESS)
    return df.join(lost, list(ADDRESS), "left_anti").drop(*ADDRESS)


def latest_complete(df: DataFrame, keys, ts: str, pending: str) -> DataFrame:
    """Newest row per key, settled rows before pending ones."""
    return first_row(df, keys, [F.desc_nulls_first(ts), F.asc_nulls_last(pending)])


def latest_nulls_last(df: DataFrame, keys, stamps) -> DataFrame:
    """Newest row per key by several times, the last of them nulls last."""
    head, tail = names(stamps)[:-1], names(stamps)[-1]
    return first_row(df, keys, [*[F.desc_nulls_first(s) for s in head], F.desc_nulls_last(tail)])


def earliest(df: DataFrame, keys, order) -> DataFrame:
    """First-seen row per key."""
    return first_row(df, keys, [F.asc_nulls_last(o) if isinstance(o, str) else o
                                for o in ([order] if isinstance(order, (str, Column)) else order)])


# -- largest of a group ------------------------------------------------------

def _largest(df: DataFrame, part, amount: str, tie) -> DataFrame:
    return first_row(df.select(*names(part), amount, *names(tie)), part,
                     [F.desc_nulls_first(amount), *names(tie)])


def _is_largest(df: DataFrame, part, amount: str, tie) -> DataFrame:
    """Mark each group's largest row. ``tie`` makes rows of a group distinct.

    The winners are found first (one row per group after map-side trimming) and
    matched back on the full row key, so no task holds a whole group.
    """
    keys = [*names(part), *names(tie)]
    won = _largest(df, part, amount, tie).select(*[F.col(k).alias("_w_" + k) for k in keys])
    on = F.lit(True)
    for k in keys:
        on = on & df[k].eqNullSafe(won["_w_" + k])
    return (df.join(won.withColumn("_won", F.lit(True)), on, "left")
              .drop(*["_w_" + k for k in keys])
              .withColumn("_won", F.coalesce("_won", F.lit(False))))


def top1_else_zero(df: DataFrame, part, amount: str, tie, as_: str = "sale_amount") -> DataFrame:
    """The group's largest amount on its own row, 0 on all others."""
    marked = _is_largest(df, part, amount, tie)
    return marked.withColumn(as_, F.when(F.col("_won"), F.col(amount))
                             .otherwise(F.lit(0).cast(df.schema[amount].dataType))).drop("_won")


def drop_largest(df: DataFrame, part, amount: str, tie) -> DataFrame:
    """All rows of each group but the largest."""
    return _is_largest(df, part, amount, tie).filter(~F.col("_won")).drop("_won")


# -- ordered calculations ----------------------------------------------------

def _split(df, part, order, split_by, max_rows):
    if split_by is None and not isinstance(order[0], str):
        raise ValueError("give split_by where the order does not start with an ascending column")
    if split_by is None:  # as many columns of the order as are plainly ascending
        names_ = [isinstance(o, str) for o in order]
        split_by = order[:names_.index(False) if False in names_ else len(order)]
    return with_chunks(df, part, split_by, max_rows)


def _carried(df: DataFrame, part: list[str], piece: DataFrame, carry: dict[str, Column]) -> DataFrame:
    """Attach per-piece carried values. ``piece`` has one row per piece of a cut
    group; the join uses the distribution the windows already have."""
    state = piece.select(*[F.col(p).alias("_p_" + p) for p in part],
                         F.col(CHUNK).alias("_p_chunk"),
                         *[v.alias(k) for k, v in carry.items()])
    on = df[CHUNK] == state["_p_chunk"]
    for p in part:
        on = on & df[p].eqNullSafe(state["_p_" + p])
    return df.join(state, on, "left").drop("_p_chunk", *["_p_" + p for p in part])


def _parts(part: list[str], cut: bool) -> list[str]:
    return [*part, CHUNK] if cut else part


def _pieces(df: DataFrame, part: list[str], **summary: Column) -> DataFrame:
    """Summary per piece, for cut groups only (others have the one piece 0)."""
    every = df.groupBy(*part, CHUNK).agg(*[v.alias(k) for k, v in summary.items()])
    cut = Window.partitionBy(*part)
    return (every.withColumn("_cut", F.max(CHUNK).over(cut) != F.min(CHUNK).over(cut))
                 .filter("_cut").drop("_cut"))


def ordinal(df: DataFrame, part, order, as_: str = "ordinal", split_by=None,
            max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """1-based position of each row within its group."""
    part, order = names(part), [order] if isinstance(order, (str, Column)) else list(order)
    df, cut = _split(df, part, order, split_by, max_rows)
    out = df.withColumn(as_, F.row_number().over(
        Window.partitionBy(*_parts(part, cut)).orderBy(*cols(order))).cast("bigint"))
    if cut:
        before = Window.partitionBy(*part).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        pieces = _pieces(df, part, _n=F.count(F.lit(1)))
        out = _carried(out, part, pieces, {"_before": F.sum("_n").over(before)})
        out = out.withColumn(as_, F.col(as_) + F.coalesce("_before", F.lit(0))).drop("_before")
    return out.drop(CHUNK)


def running_group(df: DataFrame, part, order, marker, as_: str = "grp", split_by=None,
                  max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Running sum of a marker: the number of the group a row falls in."""
    part, order = names(part), [order] if isinstance(order, (str, Column)) else list(order)
    df, cut = _split(df, part, order, split_by, max_rows)
    df = df.withColumn("_step", col(marker).cast("bigint"))
    here = (Window.partitionBy(*_parts(part, cut)).orderBy(*cols(order))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = df.withColumn(as_, F.sum("_step").over(here))
    if cut:
        before = Window.partitionBy(*part).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        pieces = _pieces(df, part, _n=F.sum("_step"))
        out = _carried(out, part, pieces, {"_before": F.sum("_n").over(before)})
        out = out.withColumn(as_, F.when(F.col(as_).isNull() & F.col("_before").isNull(), None)
                             .otherwise(F.coalesce(F.col(as_), F.lit(0)) + F.coalesce("_before", F.lit(0)))
                             ).drop("_before")
    return out.drop(CHUNK, "_step")


def neighbours(df: DataFrame, part, order: list[str], values, prev: str = "prev_", next_: str = "next_",
               split_by=None, max_rows: int | None = MAX_GROUP_ROWS,
               sides: str = "both") -> DataFrame:
    """Nearest earlier and later non-null value of each column.

    ``order`` names ascending columns that order a group totally.
    """
    part, order, values = names(part), names(order), names(values)
    df, cut = _split(df, part, order, split_by, max_rows)
    w = Window.partitionBy(*_parts(part, cut)).orderBy(*order)
    back, ahead = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    do_prev, do_next = sides in ("both", "prev"), sides in ("both", "next")
    new = {}
    for v in values:
        if do_prev:
            new[prev + v] = F.last(v, ignorenulls=True).over(back)
        if do_next:
            # the later side as an earlier side of the reversed order: the frame
            # then grows with the scan instead of being rebuilt for every row
            rev = (Window.partitionBy(*_parts(part, cut)).orderBy(*[F.desc(o) for o in order])
                   .rowsBetween(Window.unboundedPreceding, -1))
            new[next_ + v] = F.last(v, ignorenulls=True).over(rev)
    out = df.withColumns(new)
    if cut:
        at = F.struct(*order)
        summary, carry, drop = {}, {}, []
        pw = Window.partitionBy(*part).orderBy(CHUNK)
        for i, v in enumerate(values):
            summary[f"_l{i}"] = F.max_by(F.when(F.col(v).isNotNull(), F.col(v)),
                                         F.when(F.col(v).isNotNull(), at))
            summary[f"_f{i}"] = F.min_by(F.when(F.col(v).isNotNull(), F.col(v)),
                                         F.when(F.col(v).isNotNull(), at))
            carry[f"_cl{i}"] = F.last(f"_l{i}", ignorenulls=True).over(
                pw.rowsBetween(Window.unboundedPreceding, -1))
            carry[f"_cf{i}"] = F.first(f"_f{i}", ignorenulls=True).over(
                pw.rowsBetween(1, Window.unboundedFollowing))
            drop += [f"_cl{i}", f"_cf{i}"]
        out = _carried(out, part, _pieces(df, part, **summary), carry)
        for i, v in enumerate(values):
            if do_prev:
                out = out.withColumn(prev + v, F.coalesce(prev + v, f"_cl{i}"))
            if do_next:
                out = out.withColumn(next_ + v, F.coalesce(next_ + v, f"_cf{i}"))
        out = out.drop(*drop)
    return out.drop(CHUNK)


def next_value(df: DataFrame, value: str, part, order, as_: str, **kw) -> DataFrame:
    """Next non-null value after each row."""
    return neighbours(df, part, order, [value], next_="_nv_", sides="next", **kw) \
        .withColumnRenamed("_nv_" + value, as_)


def prev_value(df: DataFrame, value: str, part, order, as_: str, **kw) -> DataFrame:
    """Last non-null value before each row."""
    return neighbours(df, part, order, [value], prev="_pv_", sides="prev", **kw) \
        .withColumnRenamed("_pv_" + value, as_)


def fill_both(df: DataFrame, values, part, order, defaults: dict | None = None,
              suffix: str = "_fill", **kw) -> DataFrame:
    """Own value, else the previous, else the next non-null one, else a default."""
    values, defaults = names(values), defaults or {}
    out = neighbours(df, part, order, values, prev="_pv_", next_="_nv_", **kw)
    for v in values:
        out = out.withColumn(v + suffix, F.coalesce(
            F.col(v), F.col("_pv_" + v), F.col("_nv_" + v), F.lit(defaults.get(v))))
    return out.drop(*["_pv_" + v for v in values], *["_nv_" + v for v in values])


def running_max(df: DataFrame, part, order, value: Column, as_: str, split_by=None,
                max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Greatest value from the group's start up to each row."""
    part, order = names(part), [order] if isinstance(order, (str, Column)) else list(order)
    df, cut = _split(df, part, order, split_by, max_rows)
    here = (Window.partitionBy(*_parts(part, cut)).orderBy(*cols(order))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = df.withColumn(as_, F.max(value).over(here))
    if cut:
        before = Window.partitionBy(*part).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        out = _carried(out, part, _pieces(df, part, _m=F.max(value)), {"_before": F.max("_m").over(before)})
        out = out.withColumn(as_, F.greatest(as_, "_before")).drop("_before") \
            if not isinstance(out.schema[as_].dataType, T.ArrayType) else \
            out.withColumn(as_, F.array_max(F.array(as_, "_before"))).drop("_before")
    return out.drop(CHUNK)


def preorder_index(df: DataFrame, part, path: str, as_: str = "trace_index",
                   max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Depth-first position of a node: order of its integer path, from 0."""
    return (ordinal(df, part, [path], as_, max_rows=max_rows)
            .withColumn(as_, F.col(as_) - 1))
