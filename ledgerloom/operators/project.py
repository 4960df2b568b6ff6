"""Row-by-row projections and filters. None of these shuffles."""
from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .. import functions as L
from ..columns import col, cols, names

ZERO_ADDRESS = "0x0000000000000000000000000000000000000000"


def _json_schema(paths: list[list[str]]) -> T.DataType:
    """Nested schema holding the given field paths; everything else is skipped."""
    if [] in paths:
        return T.StringType()
    tree: dict[str, list] = {}
    for head, *rest in paths:
        tree.setdefault(head, []).append(rest)
    if list(tree) == ["[]"]:
        return T.ArrayType(_json_schema(tree["[]"]))
    return T.StructType([T.StructField(k, _json_schema(v)) for k, v in tree.items()])


def json_project(df: DataFrame, payload: str, spec: dict[str, tuple], keep=()) -> DataFrame:
    """Typed columns from JSON paths, the payload being parsed once per row.

    ``spec`` maps an output name to (path,), (path, type) or (path, function).
    A path to an object or array yields its JSON text. The parsed value comes
    out of a generator, which later filters and projections are not moved
    across: otherwise each of them would parse the payload again.
    """
    steps = {n: re.findall(r"[^.\[\]]+|\[\d+\]", s[0].removeprefix("$")) for n, s in spec.items()}
    schema = _json_schema([["[]" if x.startswith("[") else x for x in st] for st in steps.values()])

    def value(name: str) -> Column:
        out = F.col("_json")
        for x in steps[name]:
            out = F.get(out, F.lit(int(x[1:-1]))) if x.startswith("[") else out[x]
        how = spec[name][1] if len(spec[name]) > 1 else None
        return out if how is None else how(out) if callable(how) else out.try_cast(how)

    parsed = df.select("*", F.explode(F.array(F.from_json(payload, schema))).alias("_json"))
    return parsed.select(*cols(keep), *[value(n).alias(n) for n in spec])


def coalesce_paths(df: DataFrame, paths: list[tuple], as_: str, type_: str = "string") -> DataFrame:
    """First non-null of several JSON locations.

    A location is (column, path), or (column, path, inner path) where the
    first path holds JSON written as a string.
    """
    found = []
    for place in paths:
        value = F.get_json_object(col(place[0]), place[1])
        if len(place) == 3:
            value = F.get_json_object(value, place[2])
        found.append(value.try_cast(type_))
    return df.withColumn(as_, F.coalesce(*found))


def derive_chain(df: DataFrame, steps: list[tuple[str, Column]]) -> DataFrame:
    """Columns added in turn, later ones seeing earlier ones."""
    for name, expr in steps:
        df = df.withColumn(name, expr)
    return df


def is_json_object(c) -> Column:
    """The text is one JSON object (not an array, scalar or broken text)."""
    c = col(c)
    return F.ltrim(c).startswith("{") & F.json_object_keys(c).isNotNull()


def where_json_object(df: DataFrame, c: str) -> DataFrame:
    return df.filter(is_json_object(c))


def where_path_present(df: DataFrame, c: str, path: str) -> DataFrame:
    return df.filter(F.get_json_object(col(c), path).isNotNull())


def select_events(logs: DataFrame, contracts=None, events=None, topics=None, since=None,
                  ok_only: bool = False) -> DataFrame:
    """Logs of some contracts, by event name or topic hash, from a date on.

    Plain comparisons only, so all of it reaches the Parquet scan.
    """
    if contracts:
        logs = logs.filter(F.col("contract_address").isin(names(contracts)))
    if events:
        logs = logs.filter(F.col("event_name").isin(names(events)))
    if topics:
        logs = logs.filter(F.get("topics", F.lit(0)).isin(names(topics)))
    if since is not None:
        logs = logs.filter(F.col("block_timestamp") >= F.lit(since).cast("timestamp_ntz"))
    if ok_only:
        logs = logs.filter("tx_succeeded")
    return logs


def label(c, mapping: dict[str, str]) -> Column:
    """Value looked up in a literal mapping; null if absent."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), col(c))


def label_topics(logs: DataFrame, mapping: dict[str, str], as_: str = "topics_event_name") -> DataFrame:
    return logs.withColumn(as_, label(F.get("topics", F.lit(0)), mapping))


def trade_type(item_type) -> Column:
    """Asset offered: buy. Token offered: offer accepted. Else null."""
    c = col(item_type).cast("int")
    return F.when(c.isin(2, 3), "buy").when(c == 1, "offer_accepted")


def swap_sides(df: DataFrame, maker_buys: Column, maker: str = "maker", taker: str = "taker") -> DataFrame:
    """Seller and buyer from maker and taker."""
    return df.withColumns({
        "seller_address": F.when(maker_buys, F.col(taker)).otherwise(F.col(maker)),
        "buyer_address": F.when(maker_buys, F.col(maker)).otherwise(F.col(taker))})


def sale_category(address) -> Column:
    return F.when(col(address) == ZERO_ADDRESS, "private").otherwise("public")


def split_topics(logs: DataFrame, n: int = 4) -> DataFrame:
    return logs.withColumns({f"topic_{i}": F.get("topics", F.lit(i)) for i in range(n)})


def status_flag(c) -> Column:
    return F.coalesce(col(c) == 1, F.lit(False))


def blank_to_null(df: DataFrame, columns) -> DataFrame:
    return df.withColumns({c: L.blank_null(c) for c in names(columns)})


def guard_position(df: DataFrame, outer: str = "block_number", inner: str = "payload_block",
                   position: str = "position") -> DataFrame:
    """Drop rows without a position, or whose payload names another block."""
    guarded = F.when(F.col(outer) != F.col(inner), None).otherwise(F.col(position))
    return df.withColumn(position, guarded).filter(F.col(position).isNotNull())


def pending_flag(df: DataFrame, columns, as_: str = "is_pending") -> DataFrame:
    """True while any of the enriching columns is missing."""
    missing = F.lit(False)
    for c in names(columns):
        missing = missing | F.col(c).isNull()
    return df.withColumn(as_, missing)


def recent(df: DataFrame, lookback: DataFrame, col_: str = "block_number") -> DataFrame:
    """Rows at or above the lookback block, given as a one-row DataFrame."""
    return df.filter(F.col(col_) >= lookback.scalar())


def publish(df: DataFrame, columns: list, renames: dict | None = None, defaults: dict | None = None) -> DataFrame:
    """Select in public order with new names and defaults for nulls."""
    renames, defaults = renames or {}, defaults or {}
    out = []
    for c in columns:
        if isinstance(c, Column):
            out.append(c)
            continue
        e = F.coalesce(F.col(c), F.lit(defaults[c]).cast(df.schema[c].dataType)) if c in defaults else F.col(c)
        out.append(e.alias(renames.get(c, c)))
    return df.select(*out)


def match_address(df: DataFrame, c: str, addresses) -> DataFrame:
    return df.filter(F.lower(F.col(c)).isin([a.lower() for a in names(addresses)]))


def native_symbol(c, sentinel: str = ZERO_ADDRESS, symbol: str = "AVAX") -> Column:
    return F.when(col(c) == sentinel, F.lit(symbol)).otherwise(col(c))


def where_vs_scalar(df: DataFrame, c: str, op: str, scalar: DataFrame) -> DataFrame:
    """Compare a column with the one value of another query."""
    value, left = scalar.scalar(), F.col(c)
    return df.filter({"=": left == value, "<": left < value, "<=": left <= value,
                      ">": left > value, ">=": left >= value, "!=": left != value}[op])


def split_fee(df: DataFrame, amount: str, recipient: str, wallets, index: str | None = None) -> DataFrame:
    """Route a payment to sale, platform fee or creator fee.

    With ``index``, the first payment is the sale. A null recipient is neither
    a platform nor a creator fee.
    """
    a, zero = F.col(amount), F.lit(0).cast(df.schema[amount].dataType)
    inside = F.col(recipient).isin(names(wallets))
    fee = F.col(index) > 0 if index else F.lit(True)
    out = {"platform_fee": F.when(fee & inside, a).otherwise(zero),
           "creator_fee": F.when(fee & ~inside, a).otherwise(zero)}
    if index:
        out["sale_amount"] = F.when(F.col(index) == 0, a).otherwise(zero)
    return df.withColumns(out)
