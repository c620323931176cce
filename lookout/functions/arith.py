"""Arithmetic with IEEE double semantics on top of Spark's ANSI arithmetic, which would raise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NAN = float("nan")
INF = float("inf")


def as_double(c) -> Column:
    return (c if isinstance(c, Column) else F.lit(c)).cast("double")


def safe_div(a, b) -> Column:
    """``a / b`` on doubles: x/0 is signed infinity, 0/0 is NaN, null operands give null."""
    a, b = as_double(a), as_double(b)
    by_zero = F.when((a == 0) | F.isnan(a), F.lit(NAN)).when(a > 0, F.lit(INF)).otherwise(F.lit(-INF))
    return F.when(a.isNull() | b.isNull(), F.lit(None).cast("double")).when(b == 0, by_zero).otherwise(a / b)


def safe_mod(a, b) -> Column:
    """``a % b`` on doubles; the sign follows the dividend and a zero divisor gives NaN."""
    a, b = as_double(a), as_double(b)
    return F.when(a.isNull() | b.isNull(), F.lit(None).cast("double")).when(b == 0, F.lit(NAN)).otherwise(a % b)


def int_div(a: Column, b) -> Column:
    """Integer division truncating toward zero."""
    return F.call_function("div", a.cast("bigint"), (b if isinstance(b, Column) else F.lit(b)).cast("bigint"))


def binary(op: str, a, b) -> Column:
    a, b = as_double(a), as_double(b)
    return {
        "+": lambda: a + b,
        "-": lambda: a - b,
        "*": lambda: a * b,
        "/": lambda: safe_div(a, b),
        "%": lambda: safe_mod(a, b),
    }[op]()


COMPARATORS = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    ">": lambda a, b: a > b,
    "<": lambda a, b: a < b,
    ">=": lambda a, b: a >= b,
    "<=": lambda a, b: a <= b,
}


def compare(op: str, a, b) -> Column:
    """1.0 where the comparison holds and 0.0 where it does not; null operands give null. NaN differs from everything."""
    a, b = as_double(a), as_double(b)
    unordered = (F.isnan(a) | F.isnan(b)) & a.isNotNull() & b.isNotNull()
    return F.when(unordered, F.lit(1.0 if op == "!=" else 0.0)).otherwise(COMPARATORS[op](a, b).cast("double"))


def rank_roof(total: Column, rank) -> Column:
    """``round(total * rank / 100)`` evaluated in single precision, half up."""
    scaled = (total.cast("bigint") * (rank if isinstance(rank, Column) else F.lit(rank))).cast("float")
    share = (scaled / F.lit(100.0).cast("float")).cast("float")
    return F.floor(share.cast("double") + F.lit(0.5)).cast("bigint")


def to_metric_long(v: Column) -> Column:
    """Double sample value to a stored long: not above 0 gives 0, below 1 gives 1, else rounded half up."""
    return F.when(v <= 0, F.lit(0)).when(v < 1, F.lit(1)).otherwise(F.floor(v + 0.5)).cast("bigint")


def round_half_up(v: Column, places: int) -> Column:
    """Half-up rounding on the decimal expansion of a double."""
    return F.round(v, places)


def format_two_decimals(v: Column) -> Column:
    """Number to text with at most two decimals, half-even, no trailing zeros."""
    text = F.bround(v, 2).cast("decimal(38,2)").cast("string")
    return F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")
