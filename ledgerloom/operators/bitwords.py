"""Sets of integers as words of 64 bits.

A dense set of integers (block numbers, above all) travels as one row per 64 values instead of one per
value: the words are put together by ``bit_or`` on the map side, compared as
whole numbers, and taken apart only where they differ. All of it stays in generated code.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..columns import col, names

BITS = 64


def word_of(c: str | Column) -> Column:
    """Number of the word a value lies in."""
    return F.shiftright(col(c).cast("bigint"), 6)


def bit_of(c: str | Column) -> Column:
    """The value's bit within its word."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), col(c).cast("bigint").bitwiseAND(F.lit(BITS - 1)).cast("int"))


def values_in(word: str | Column, bits: str | Column) -> Column:
    """Ascending array of the values that a word holds."""
    first = F.shiftleft(col(word), 6)
    held = F.filter(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: F.bit_get(col(bits), i) == 1)
    return F.transform(held, lambda i: first + i)


def words(df: DataFrame, c: str, part=(), **more: Column) -> DataFrame:
    """Rows (part, word, bits, lo, hi) of the distinct values of an integer column; nulls are left out."""
    part = names(part)
    return (df.filter(F.col(c).isNotNull()).groupBy(*part, word_of(c).alias("word"))
              .agg(F.bit_or(bit_of(c)).alias("bits"), F.min(c).cast("bigint").alias("lo"),
                   F.max(c).cast("bigint").alias("hi"), *[v.alias(k) for k, v in more.items()]))


def minus_dense(expected: DataFrame, done: DataFrame, c: str) -> DataFrame:
    """Distinct expected integers not among the done ones; nulls compare equal, as in ``subtract``.

    Both sides meet in one aggregation that carries a row per 64 values.
    """
    key = F.col(c)
    side = lambda df, a, b: df.select(word_of(key).alias("word"), F.coalesce(a, F.lit(0).cast("bigint")).alias("want"),
                                      F.coalesce(b, F.lit(0).cast("bigint")).alias("have"))
    bit, none = F.when(key.isNull(), F.lit(1).cast("bigint")).otherwise(bit_of(key)), F.lit(None).cast("bigint")
    both = side(expected, bit, none).unionByName(side(done, none, bit)).groupBy("word").agg(
        F.bit_or("want").alias("want"), F.bit_or("have").alias("have"))
    open_ = both.withColumn("left", F.col("want").bitwiseAND(F.bitwise_not("have"))).filter("left <> 0")
    value = F.explode(F.when(F.col("word").isNull(), F.array(none)).otherwise(values_in("word", "left")))
    return open_.select(value.alias(c)).select(F.col(c).cast(expected.schema[c].dataType))
