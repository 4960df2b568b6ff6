"""Hex quantities and 32-byte words, exact at any width."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..columns import col

_LIMB = 1_000_000_000
_STEP = 16 ** 6
_BASE = 10 ** 18     # one output limb
_PIECE = 15          # hex digits per input piece: 60 bits, below one limb


def _digits(c: str | Column) -> Column:
    """Hex digits without one 0x and without leading zeros, behind one zero."""
    c = col(c)
    bare = F.when(F.substring(c, 1, 2).isin("0x", "0X"), F.substr(c, F.lit(3))).otherwise(c)
    return F.concat(F.lit("0"), F.ltrim(bare, F.lit("0")))


def _is_hex(c: str | Column, h: Column) -> Column:
    """Something besides the prefix, and hex digits only."""
    return F.unhex(h).isNotNull() & ~col(c).isin("", "0x", "0X")


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _up_to_30(h: Column) -> Column:
    """Decimal text of at most 30 hex digits, as two 60-bit halves."""
    wide = F.lpad(F.substring(h, 2, 2 * _PIECE), 2 * _PIECE, "0")
    half = lambda at: F.conv(F.substring(wide, at, _PIECE), 16, 10).cast("decimal(19,0)")
    return (half(1) * F.lit(16 ** _PIECE).cast("decimal(19,0)") + half(1 + _PIECE)).cast("decimal(38,0)").cast("string")


def _wide_sql() -> str:
    """Lambda text: hex digits to decimal text, for more than 30 digits.

    Up to 64 digits are five pieces of 60 bits. Each piece times the
    base-10^18 digits of its power of two is summed per limb, then carries
    move up once; nothing exceeds 38 decimal digits. Longer text is folded six
    digits at a time into limbs of nine decimal digits.

    The text is built once: as a parsed lambda it costs one call per use.
    """
    n = -(-64 // _PIECE)
    pieces = ", ".join(
        f"cast(conv(substring(lpad(substring(h, 2, 64), {n * _PIECE}, '0'), {1 + _PIECE * (n - 1 - i)}, {_PIECE}), 16, 10)"
        f" as decimal(19,0))" for i in range(n))
    sums = []
    for j in range(n):
        terms = [f"cast(p[{i}] * cast({w} as decimal(18,0)) as decimal(38,0))" for i in range(n)
                 if (w := (1 << (4 * _PIECE * i)) // _BASE ** j % _BASE)]
        total = terms[0] if terms else "cast(0 as decimal(38,0))"
        for t in terms[1:]:
            total = f"cast({total} + {t} as decimal(38,0))"
        sums.append(total)
    base = f"cast({_BASE} as decimal(19,0))"
    up = "cast(s + a.up as decimal(38,0))"
    fixed = (f"transform(array(array({pieces})), p -> aggregate(array({', '.join(sums)}), "
             f"named_struct('up', cast(0 as decimal(38,0)), 'text', ''), (a, s) -> named_struct("
             f"'up', cast({up} div {base} as decimal(38,0)), "
             f"'text', concat(lpad(cast({up} % {base} as string), 18, '0'), a.text)), a -> a.text))[0]")
    total = f"(limb * {_STEP}L + st.carry)"
    fold = (f"aggregate(acc, named_struct('carry', piece, 'out', cast(array() as array<bigint>)), (st, limb) -> "
            f"named_struct('carry', {total} div {_LIMB}L, 'out', concat(st.out, array({total} % {_LIMB}L))), st -> st.out)")
    any_width = (
        "array_join(transform(reverse(aggregate("
        "transform(regexp_extract_all(lpad(h, cast(ceil(length(h) / 6) * 6 as int), '0'), '.{6}', 0),"
        " d -> cast(conv(d, 16, 10) as bigint)), "
        "array_repeat(cast(0 as bigint), cast(ceil(length(h) * 1.2042 / 9) as int) + 1), "
        f"(acc, piece) -> {fold})), limb -> lpad(cast(limb as string), 9, '0')), '')")
    return f"h -> ltrim('0', case when length(h) <= 65 then {fixed} else {any_width} end)"


_WIDE = _wide_sql()


def hex_to_dec(c: str | Column) -> Column:
    """Hex quantity to its exact decimal text; null for null or non-hex text."""
    h = _digits(c)
    n = F.length(h)
    return F.when(_is_hex(c, h),
                  F.when(n <= 16, F.conv(h, 16, 10)).when(n <= 31, _up_to_30(h))
                   .otherwise(F.get(F.call_function("transform", F.array(h), F.expr(_WIDE)), F.lit(0))))


def hex_to_long(c: str | Column) -> Column:
    """Hex quantity to bigint; null when it does not fit."""
    h = _digits(c)
    return F.when(_is_hex(c, h) & (F.length(h) <= 17), F.conv(h, 16, 10).try_cast("bigint"))


def int_to_hex(c: str | Column, upper: bool = False) -> Column:
    text = F.hex(col(c).cast("bigint"))
    return F.concat(F.lit("0x"), text if upper else F.lower(text))


def words64(c: str | Column) -> Column:
    """Event data without its 0x, cut into whole 64-digit words."""
    return F.regexp_extract_all(F.substr(col(c), F.lit(3)), F.lit(".{64}"), F.lit(0))


def word_address(c: str | Column, start: int = 25) -> Column:
    """Address in a padded word: digit 25 of a bare word, 27 of a 0x topic."""
    return F.concat(F.lit("0x"), F.substr(col(c), F.lit(start), F.lit(40)))


def abi_array(words: str | Column, head: int = 0) -> Column:
    """Elements of the dynamic array whose offset is in word ``head``."""
    def cut(w: Column) -> Column:
        start = (hex_to_long(F.get(w, F.lit(head))) / 32).cast("int")
        return _bind(start, lambda s: F.slice(w, s + 2, hex_to_long(F.get(w, s)).cast("int")))
    return _bind(col(words), cut)
