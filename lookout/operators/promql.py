"""Instant and range query operators over series frames."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import arith
from ..functions import labels as L
from ..functions.text import whole
from . import series as S
from .topk import top_n, top_records


def matcher(value: Column, op: str, want: str) -> Column:
    """``=``, ``!=``, ``=~`` and ``!~``; regular expressions match the whole text."""
    full = whole(want)
    hit = {"=": lambda: value == want, "!=": lambda: value != want,
           "=~": lambda: value.rlike(full), "!~": lambda: ~value.rlike(full)}[op]()
    return F.coalesce(hit, F.lit(False))


def match_labels(df: DataFrame, *conditions: tuple[str, str, str]) -> DataFrame:
    for key, op, want in conditions:
        df = df.filter(matcher(L.get(F.col("labels"), key), op, want))
    return df


def aggregate(df: DataFrame, fn: str, by: Sequence[str] | None = None, without: Sequence[str] | None = None) -> DataFrame:
    """``by`` groups on the listed labels, ``without`` on all others."""
    if without is None:
        return S.aggregate_labels(df, fn, by or ())
    ids = S.identities(df) + ([S.TIME] if S.TIME in df.columns else [])
    agg = {"avg": F.avg, "sum": F.sum, "max": F.max, "min": F.min}[fn]
    keyed = df.withColumn(S.LK, L.key_of(L.without(F.col("labels"), without)))
    return S._unkeyed(keyed.groupBy(*ids, S.LK).agg(agg("value").alias("value")))


def matrix_op(left: DataFrame, op: str, right: DataFrame) -> DataFrame:
    """Point by point on equal labels; see :func:`matrix_errors` for the shape check."""
    return S.series_op(left, op, right).filter(F.col("value").isNotNull())


def matrix_errors(left: DataFrame, right: DataFrame) -> DataFrame:
    """Points present on one side only. The operation is valid when this frame is empty."""
    key = lambda df, l, r: (S._keyed(df).select(S.LK, S.TIME, F.lit(l).alias("l"), F.lit(r).alias("r")))
    return (key(left, 1, 0).unionByName(key(right, 0, 1)).groupBy(S.LK, S.TIME)
            .agg(F.sum("l").alias("l"), F.sum("r").alias("r")).filter("l <> r"))


def compare(df: DataFrame, op: str, other, as_bool: bool = False) -> DataFrame:
    """Without ``as_bool`` failing points are dropped and values kept; with it every point becomes 1 or 0."""
    if isinstance(other, DataFrame):
        left, right = S._keyed(df), S._keyed(other)
        on = [c for c in S._series_key(left) if c in S._series_key(right)] + [S.TIME]
        joined = left.join(right.select(*on, F.col("value").alias("_r")), on, "inner").drop(S.LK)
        b: Column = F.col("_r")
    else:
        joined, b = df, F.lit(float(other))
    hit = arith.compare(op, F.col("value"), b)
    out = joined.withColumn("value", hit) if as_bool else joined.filter(hit == 1.0)
    return out.drop("_r")


def formatted(df: DataFrame) -> DataFrame:
    return df.withColumn("value", arith.format_two_decimals(F.col("value")))


def instant(df: DataFrame) -> DataFrame:
    """Last point of every series."""
    return S.over_time(df, "latest").filter(F.col("value").isNotNull())


def select_metric(table: DataFrame, metric: str, duration, layer: str, layers: Sequence[str], entity_id: str | None = None,
                  top: int | None = None, descending: bool = True, sampled: bool = False) -> DataFrame:
    """A metric selector. A valid layer is required; ``top`` turns it into a top-n or record query."""
    if layer not in layers:
        raise ValueError(f"layer {layer!r} is missing or illegal")
    rows = S.scan_metric(table, metric, duration, entity_id)
    if "layer" in table.columns:
        rows = rows.filter(F.col("layer") == layer)
    if top is None:
        return rows
    return top_records(rows, top, descending=descending) if sampled else top_n(rows, top, descending)


# ---- metadata ----

def label_names(series: DataFrame) -> DataFrame:
    return series.select(F.explode(F.map_keys("labels")).alias("label")).distinct()


def label_values(series: DataFrame, label: str) -> DataFrame:
    v = F.try_element_at("labels", F.lit(label))
    return series.select(v.alias("value")).filter(F.col("value").isNotNull()).distinct()


def series_of(series: DataFrame, *matchers: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Distinct label sets selected by any of several matcher lists: one pass, OR of ANDs."""
    any_of = F.lit(False)
    for conditions in matchers:
        all_of = F.lit(True)
        for key, op, want in conditions:
            all_of = all_of & matcher(L.get(F.col("labels"), key), op, want)
        any_of = any_of | all_of
    return series.filter(any_of).select(L.key_of(F.col("labels")).alias("series")).distinct()


def metric_metadata(catalog: DataFrame, pattern: str | None = None, limit: int | None = None) -> DataFrame:
    """Metrics by name pattern with their value type."""
    if pattern:
        catalog = catalog.filter(F.col("metric").rlike(pattern))
    out = catalog.select("metric", "type").distinct()
    return out.orderBy("metric").limit(limit) if limit else out
