"""Counter look-back: increase, rate and irate per (name, labels) series.

A long or hot series must not become one sort in one task. Time is cut into chunks; each chunk receives the rows it
can look back to (twice the window, plus the newest earlier row), so every (series, chunk) is evaluated on its own and
the result equals that of one pass over the whole series. Counter resets are not corrected.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.timebucket import parse_range_ms

HOUR_MS = 3_600_000


def _with_context(df: DataFrame, key: Sequence[str], context_ms: int, chunk_ms: int) -> DataFrame:
    """Rows with ``_chunk`` and ``_own`` (false for context copies)."""
    base = df.withColumn("_chunk", F.floor(F.col("ts") / chunk_ms).cast("bigint"))
    own = base.withColumn("_own", F.lit(True))
    # newest row of the nearest earlier chunk, found on one row per (series, chunk)
    newest = base.groupBy(*key, "_chunk").agg(F.max(F.struct("ts", "value")).alias("_n"))
    w = Window.partitionBy(*key).orderBy("_chunk")
    carried = (newest.withColumn("_p", F.lag("_n").over(w)).filter(F.col("_p").isNotNull())
               .select(*key, F.col("_p.ts").alias("ts"), F.col("_p.value").alias("value"), "_chunk", F.lit(False).alias("_own")))
    out = own.unionByName(carried, allowMissingColumns=True)
    if context_ms:
        near = (base.filter(F.pmod(F.col("ts"), F.lit(chunk_ms)) >= chunk_ms - context_ms)
                .withColumn("_chunk", F.col("_chunk") + 1).withColumn("_own", F.lit(False)))
        out = out.unionByName(near)
    return out


def _series(df: DataFrame) -> DataFrame:
    return df.withColumn("_lk", L.key_of(F.col("labels")))


def look_back(df: DataFrame, window_ms: int, chunk_ms: int | None = None, key=("name", "_lk")) -> DataFrame:
    """Adds ``low_ts`` and ``low_value``: the sample at the closed slot nearest to ``ts - window``.

    Samples older than the previous sample's window edge have left the window already. While the window is not yet
    full the oldest sample in it is used, which is the sample itself at the start of a series. A chunk spans at least
    two windows; by default ten, or an hour, so that copied rows stay a small share.
    """
    chunk_ms = max(chunk_ms or max(HOUR_MS, 10 * window_ms), 2 * window_ms)
    rows = _with_context(_series(df), key, 2 * window_ms, chunk_ms)
    part = Window.partitionBy(*key, "_chunk")
    prev = F.max("ts").over(part.orderBy("ts").rangeBetween(Window.unboundedPreceding, -1))
    # A sample stands at its time. Each of the chunk's own also asks at its window's edge, before the samples there, for
    # the nearest ones on both sides: one sorted pass, however many samples a window holds.
    asks = F.explode(F.when(F.col("_own"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False))))
    out = (rows.withColumn("_prev", prev).withColumn("_ask", asks)
           .withColumn("_at", F.when(F.col("_ask"), F.col("ts") - window_ms).otherwise(F.col("ts")))
           .withColumn("_point", F.when(~F.col("_ask"), F.struct("ts", "value"))))
    order = f"PARTITION BY {', '.join(f'`{k}`' for k in key)}, _chunk ORDER BY _at, _ask DESC, _point.value"
    out = (out.withColumn("_a", F.expr(f"lag(_point) IGNORE NULLS OVER ({order})"))
           .withColumn("_b", F.expr(f"lead(_point) IGNORE NULLS OVER ({order})")))
    edge = F.col("ts") - window_ms
    usable = F.col("_a").isNotNull() & (F.col("_a.ts") >= F.col("_prev") - window_ms)
    low = F.when(usable & (edge - F.col("_a.ts") <= F.col("_b.ts") - edge), F.col("_a")).otherwise(F.col("_b"))
    return (out.filter("_ask").withColumn("_low", low)
            .withColumn("low_ts", F.col("_low.ts")).withColumn("low_value", F.col("_low.value"))
            .drop("_low", "_a", "_b", "_prev", "_own", "_ask", "_at", "_point", "_chunk", "_lk"))


def previous(df: DataFrame, chunk_ms: int = HOUR_MS, key=("name", "_lk")) -> DataFrame:
    """Adds ``low_ts`` and ``low_value`` of the preceding sample, the sample itself for the first one."""
    rows = _with_context(_series(df), key, 0, chunk_ms)
    # the carried row sorts before the chunk's own rows
    w = Window.partitionBy(*key, "_chunk").orderBy("ts", "value")
    return (rows.withColumn("low_ts", F.coalesce(F.lag("ts").over(w), F.col("ts")))
            .withColumn("low_value", F.coalesce(F.lag("value").over(w), F.col("value")))
            .filter("_own").drop("_own", "_chunk", "_lk"))


def _per_second() -> Column:
    seconds = F.call_function("div", F.col("ts") - F.col("low_ts"), F.lit(1000).cast("bigint"))
    return F.when(seconds < 1, F.lit(0.0)).otherwise((F.col("value") - F.col("low_value")) / F.greatest(seconds, F.lit(1)))


def increase(df: DataFrame, window: str, **kw) -> DataFrame:
    out = look_back(df, parse_range_ms(window), **kw)
    return out.withColumn("value", F.col("value") - F.col("low_value")).drop("low_ts", "low_value")


def rate(df: DataFrame, window: str, **kw) -> DataFrame:
    return look_back(df, parse_range_ms(window), **kw).withColumn("value", _per_second()).drop("low_ts", "low_value")


def irate(df: DataFrame, **kw) -> DataFrame:
    return previous(df, **kw).withColumn("value", _per_second()).drop("low_ts", "low_value")
