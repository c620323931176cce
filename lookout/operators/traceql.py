"""Span selection by attribute, duration and status, combined into spansets."""

from __future__ import annotations

from functools import reduce
from typing import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arith import COMPARATORS
from ..functions.timebucket import parse_range_ms
from .promql import matcher


def duration_us(text: str) -> int:
    """``100ms``, ``1.5s``, ``250us`` and so on in microseconds. Literal, evaluated while the plan is built."""
    import re

    m = re.fullmatch(r"(\d+(?:\.\d+)?)(ns|us|µs|ms|s|m|h)", text)
    if not m:
        raise ValueError(f"not a duration: {text!r}")
    return int(float(m.group(1)) * {"ns": 1e-3, "us": 1, "µs": 1, "ms": 1e3, "s": 1e6, "m": 6e7, "h": 3.6e9}[m.group(2)])


def attr(key: str, op: str, want) -> Column:
    """Condition on a tag. Comparisons with a number compare numerically."""
    hits = F.filter("tags", lambda t: t["key"] == key)
    value = F.when(F.size(hits) > 0, F.element_at(hits, -1)["value"])
    if isinstance(want, (int, float)) and not isinstance(want, bool):
        return F.coalesce(COMPARATORS["==" if op == "=" else op](value.try_cast("double"), F.lit(float(want))), F.lit(False))
    if op in (">", "<", ">=", "<="):
        return F.coalesce(COMPARATORS[op](value, F.lit(want)), F.lit(False))
    return matcher(value, op, str(want)) & value.isNotNull()


def field(column: str, op: str, want) -> Column:
    """Condition on an intrinsic: name, service, kind."""
    return matcher(F.col(column), op, str(want))


def exists(key: str) -> Column:
    return F.exists("tags", lambda t: t["key"] == key)


def duration(op: str, text: str) -> Column:
    us = (F.col("end_time") - F.col("start_time")) * 1000
    return COMPARATORS["==" if op == "=" else op](us, F.lit(duration_us(text)))


def status(op: str, want: str) -> Column:
    is_want = F.col("is_error") if want == "error" else ~F.col("is_error")
    return is_want if op == "=" else ~is_want


def negate(c: Column) -> Column:
    return ~c


def spanset(spans: DataFrame, *conditions: Column) -> DataFrame:
    """Spans that satisfy every condition."""
    return reduce(DataFrame.filter, conditions, spans)


def trace_ids(spans: DataFrame) -> DataFrame:
    return spans.select("trace_id").distinct()


def both(a: DataFrame, b: DataFrame) -> DataFrame:
    """Traces matched by both spansets."""
    return trace_ids(a).intersect(trace_ids(b))


def either(a: DataFrame, b: DataFrame) -> DataFrame:
    return trace_ids(a).union(trace_ids(b)).distinct()


def traces_where(spans: DataFrame, sets: Mapping[str, Column], algebra: Callable[..., Column]) -> DataFrame:
    """Trace ids by set algebra over named spansets, in one pass over the spans.

    ``sets`` has the condition of each spanset, at most 63; ``algebra`` combines them, given by name as columns that say
    whether the trace has a span of the set: ``lambda a, b, c: (a & b) | c``. A span is marked with one bit per set that it
    is in and a trace with those of all its spans, so what is shuffled is one number per task and trace. Traces
    without a span in any set are not found, whatever the algebra says of them.
    """
    if len(sets) > 63:
        raise ValueError("at most 63 spansets in one search")
    bits = reduce(Column.bitwiseOR, [F.when(c, F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for i, c in enumerate(sets.values())])
    marked = spans.select("trace_id", bits.alias("_in")).filter(F.col("_in") != 0).groupBy("trace_id").agg(F.bit_or("_in").alias("_in"))
    has = {name: F.col("_in").bitwiseAND(F.lit(1 << i).cast("bigint")) != 0 for i, name in enumerate(sets)}
    return marked.filter(algebra(**has)).select("trace_id")


def all_of(*conditions: Column) -> Column:
    """A spanset's condition from several."""
    return reduce(lambda a, b: a & b, conditions)


def search(spans: DataFrame, ids: DataFrame, limit: int = 20) -> DataFrame:
    """Newest matching traces with start, duration in ms and span count."""
    return (spans.join(ids, "trace_id", "left_semi").groupBy("trace_id")
            .agg(F.min("start_time").alias("start_time"), (F.max("end_time") - F.min("start_time")).alias("duration_ms"),
                 F.count(F.lit(1)).alias("span_count"))
            .orderBy(F.col("start_time").desc(), "trace_id").limit(limit))


def tag_names(spans: DataFrame) -> DataFrame:
    return spans.select(F.explode("tags").alias("t")).select(F.col("t.key").alias("tag")).distinct()


def tag_values(spans: DataFrame, key: str) -> DataFrame:
    return (spans.select(F.explode(F.filter("tags", lambda t: t["key"] == key)).alias("t"))
            .select(F.col("t.value").alias("value")).distinct())
