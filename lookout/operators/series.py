"""Time-series expressions.

A series frame has ``labels`` (map), ``time_bucket``, ``value`` (null = empty point) and any identity columns, for
example ``entity_id``; every operator works on all identities at once. A frame without a ``labels`` column is an
unlabelled series, one without ``time_bucket`` a single value. Builders return lazy frames, so one plan serves a whole
expression.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import arith
from ..functions import labels as L
from ..functions.timebucket import Duration, bucket_of, coarsen
from .topk import first_per_group

TIME, VALUE, LABELS, LK = "time_bucket", "value", "labels", "_lk"
RESERVED = {TIME, VALUE, LABELS, LK, "trace_id"}


def identities(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in RESERVED]


def is_labeled(df: DataFrame) -> bool:
    return LABELS in df.columns


def _keyed(df: DataFrame) -> DataFrame:
    return df.withColumn(LK, L.key_of(F.col(LABELS))) if is_labeled(df) else df


def _series_key(df: DataFrame) -> list[str]:
    return identities(df) + ([LK] if LK in df.columns else [])


def _unkeyed(df: DataFrame) -> DataFrame:
    return df.withColumn(LABELS, L.from_key(F.col(LK))).drop(LK) if LK in df.columns else df


# ---- scanning and filling ----

def scan_metric(table: DataFrame, metric: str, duration: Duration, entity_id: str | Sequence[str] | None = None) -> DataFrame:
    """Points of a metric in a range. On a table partitioned by metric and day both filters prune partitions."""
    out = table.filter((F.col("metric") == metric) & F.col(TIME).between(duration.start_bucket, duration.end_bucket))
    if "day" in table.columns:
        out = out.filter(F.col("day").between(duration.start_bucket // 10 ** max(len(str(duration.start_bucket)) - 8, 0),
                                              duration.end_bucket // 10 ** max(len(str(duration.end_bucket)) - 8, 0)))
    if entity_id is not None:
        ids = [entity_id] if isinstance(entity_id, str) else list(entity_id)
        out = out.filter(F.col("entity_id").isin(ids))
    return out


def grid_points(duration: Duration) -> Column:
    """Array of the expected time buckets."""
    s, e = int(duration.start.timestamp()), int(duration.end.timestamp())
    seconds = F.sequence(F.lit(s).cast("bigint"), F.lit(e).cast("bigint"), F.lit(duration.step_seconds).cast("bigint"))
    return F.transform(seconds, lambda x: bucket_of(F.timestamp_seconds(x), duration.step.lower()))


def fill(df: DataFrame, duration: Duration, default: float | None = None, entities: Sequence[str] | None = None) -> DataFrame:
    """One row per series and expected point, absent ones null (or ``default``).

    ``entities``: ids of an unlabelled metric that are expected as well; those without any row get all their points.

    Empty points are added to the data and one aggregation folds both, so the data is shuffled once; a series has at
    most one row per point afterwards.
    """
    df = _keyed(df)
    key = _series_key(df)
    grid = df.select(*key).distinct().select(*key, F.explode(grid_points(duration)).alias(TIME))
    if entities:
        if key != ["entity_id"]:
            raise ValueError("expected entities are those of an unlabelled metric")
        ids = F.explode(F.array(*[F.lit(e) for e in dict.fromkeys(entities)]))
        expected = df.sparkSession.range(1).select(ids.alias("entity_id"), F.lit(0).alias("_one"))
        grid = grid.unionByName(expected.select("entity_id", F.explode(grid_points(duration)).alias(TIME)))
    blank = grid.withColumn(VALUE, F.lit(None).cast(df.schema[VALUE].dataType))
    out = (df.select(*key, TIME, VALUE).unionByName(blank)
           .filter(F.col(TIME).between(duration.start_bucket, duration.end_bucket))
           .groupBy(*key, TIME).agg(F.max(VALUE).alias(VALUE)))
    if default is not None:
        out = out.withColumn(VALUE, F.coalesce(F.col(VALUE), F.lit(default)))
    return _unkeyed(out)


def select_labels(df: DataFrame, **wanted: str) -> DataFrame:
    """``p="50,90"`` keeps the series whose label has one of the listed values."""
    for key, values in wanted.items():
        df = df.filter(L.get(F.col(LABELS), key).isin(values.split(",")))
    return df


# ---- binary operators ----

def _operator(op: str):
    if op in ("&&", "||"):
        return lambda a, b: F.when(a.isNull() | b.isNull(), F.lit(None).cast("double")).otherwise(
            (((a == 1) & (b == 1)) if op == "&&" else ((a == 1) | (b == 1))).cast("double"))
    if op in arith.COMPARATORS:
        return lambda a, b: arith.compare(op, a, b)
    return lambda a, b: arith.binary(op, a, b)


def scalar_op(df: DataFrame, op: str, scalar: float, scalar_left: bool = False) -> DataFrame:
    """Every point with a literal; empty points stay empty."""
    a, b = (F.lit(float(scalar)), F.col(VALUE)) if scalar_left else (F.col(VALUE), F.lit(float(scalar)))
    return df.withColumn(VALUE, _operator(op)(a, b))


def single_op(many: DataFrame, op: str, single: DataFrame, single_left: bool = False) -> DataFrame:
    """Every point with the one value of an unlabelled single-value frame, per identity where it has one.

    Without identities the single row is read as a scalar subquery; nothing is joined.
    """
    ids = identities(single)
    if ids:
        joined = many.join(single.select(*ids, F.col(VALUE).alias("_s")), ids, "left")
        s: Column = F.col("_s")
    else:
        joined, s = many, single.select(VALUE).scalar()
    a, b = (s, F.col(VALUE)) if single_left else (F.col(VALUE), s)
    return joined.withColumn(VALUE, _operator(op)(a, b)).drop("_s")


def series_op(left: DataFrame, op: str, right: DataFrame) -> DataFrame:
    """Series with series on time.

    Both plain, or both labelled on equal label sets: the left side is kept and unmatched points become empty.
    Labelled with plain, in either order: the plain series applies to every label set and the labels are kept.
    """
    fn = _operator(op)
    left, right = _keyed(left), _keyed(right)
    on = [c for c in _series_key(left) if c in _series_key(right)]
    if TIME in left.columns and TIME in right.columns:
        on = on + [TIME]
    if LK not in left.columns and LK in right.columns:
        r = right.withColumnRenamed(VALUE, "_r")
        joined = r.join(left.select(*on, F.col(VALUE).alias("_l")), on, "left")
        out = joined.withColumn(VALUE, fn(F.col("_l"), F.col("_r"))).drop("_l", "_r")
    else:
        if not on:
            return single_op(left, op, right)
        joined = left.join(right.select(*on, F.col(VALUE).alias("_r")), on, "left")
        out = joined.withColumn(VALUE, fn(F.col(VALUE), F.col("_r"))).drop("_r")
    return out.drop(LK)


def check_same_size(left: DataFrame, right: DataFrame) -> DataFrame:
    """Error rows (identity, left and right point counts) where two series differ in length."""
    key = [c for c in _series_key(_keyed(left)) if c in _series_key(_keyed(right))]
    sides = (_keyed(left).select(*key, F.lit(1).alias("l"), F.lit(0).alias("r"))
             .unionByName(_keyed(right).select(*key, F.lit(0).alias("l"), F.lit(1).alias("r"))))
    return sides.groupBy(*key).agg(F.sum("l").alias("l"), F.sum("r").alias("r")).filter("l <> r")


def compare(df: DataFrame, op: str, other) -> DataFrame:
    return scalar_op(df, op, other) if isinstance(other, (int, float)) else series_op(df, op, other)


# ---- functions on points ----

def math(df: DataFrame, fn: str, places: int = 0) -> DataFrame:
    v = F.col(VALUE)
    out = {"abs": lambda: F.abs(v), "ceil": lambda: F.ceil(v), "floor": lambda: F.floor(v),
           "round": lambda: arith.round_half_up(v, places)}[fn]()
    return df.withColumn(VALUE, out.cast("double"))


def over_time(df: DataFrame, fn: str) -> DataFrame:
    """Single value per series: avg, sum, count, max, min or latest over the non-empty points.

    avg, max, min and latest of nothing are empty; count and sum of nothing are 0. max, min and latest keep the trace
    id of the chosen point where the frame has one.
    """
    df = _keyed(df)
    key = _series_key(df)
    v = F.col(VALUE)
    traced = "trace_id" in df.columns
    aggs = [_folded(df, fn).alias(VALUE)]
    if traced and fn in ("max", "min", "latest"):
        by = F.when(v.isNotNull(), F.col(TIME)) if fn == "latest" else v
        aggs.append((F.min_by if fn == "min" else F.max_by)("trace_id", by).alias("trace_id"))
    return _unkeyed(df.groupBy(*key).agg(*aggs))


def all_over_time(df: DataFrame, fns: Sequence[str]) -> DataFrame:
    """Several folds of ``over_time`` from one aggregation: one row per series and ``fn``."""
    df = _keyed(df)
    key = _series_key(df)
    folds = F.array(*[F.struct(F.lit(fn).alias("fn"), F.col(f"_{fn}").cast("double").alias(VALUE)) for fn in fns])
    folded = df.groupBy(*key).agg(*[_folded(df, fn).alias(f"_{fn}") for fn in fns])
    return _unkeyed(folded.select(*key, F.explode(folds).alias("_x")).select(*key, "_x.fn", f"_x.{VALUE}"))


def _folded(df: DataFrame, fn: str) -> Column:
    v = F.col(VALUE)
    if fn == "latest" and TIME not in df.columns:
        raise ValueError("latest needs a time series")
    return {"max": lambda: F.max(v), "min": lambda: F.min(v), "avg": lambda: F.avg(v),
            "sum": lambda: F.coalesce(F.sum(v), F.lit(0.0)), "count": lambda: F.count(v).cast("double"),
            "latest": lambda: F.max_by(VALUE, F.when(v.isNotNull(), F.col(TIME)))}[fn]()


def aggregate_labels(df: DataFrame, fn: str, labels: Sequence[str] = ()) -> DataFrame:
    """Per point, fold the label sets that agree on ``labels``; without labels the result is unlabelled."""
    agg = {"avg": F.avg, "sum": F.sum, "max": F.max, "min": F.min}[fn]
    ids = identities(df) + ([TIME] if TIME in df.columns else [])
    cols = [L.get(F.col(LABELS), k).alias(f"_l{i}") for i, k in enumerate(labels)]
    names = [f"_l{i}" for i in range(len(labels))]
    out = df.select(*ids, *cols, VALUE).groupBy(*ids, *names).agg(agg(VALUE).alias(VALUE))
    if labels:
        entries = [x for k, n in zip(labels, names) for x in (F.lit(k), F.col(n))]
        out = out.withColumn(LABELS, F.create_map(*entries)).drop(*names)
    return out


def increase(df: DataFrame, steps: int) -> DataFrame:
    """v[i] - v[i-N] on a filled grid; the first N points are removed.

    A series holds one row per grid point, so its window is as long as the chart axis.
    """
    df = _keyed(df)
    w = Window.partitionBy(*_series_key(df)).orderBy(TIME)
    out = (df.withColumn("_rn", F.row_number().over(w))
           .withColumn(VALUE, F.col(VALUE) - F.lag(VALUE, steps).over(w))
           .filter(F.col("_rn") > steps).drop("_rn"))
    return out.drop(LK)


def rate(df: DataFrame, steps: int, step_seconds: int) -> DataFrame:
    out = increase(df, steps)
    return out.withColumn(VALUE, F.col(VALUE) / F.lit(float(steps * step_seconds)))


# ---- ordering ----

def sort_values(df: DataFrame, fn: str, descending: bool = True, limit: int | None = None) -> DataFrame:
    """Order labelled series by their aggregate and keep the first ones; adds ``rank``. Unlabelled input is unchanged."""
    if not is_labeled(df):
        return df
    keyed = _keyed(df)
    key, ids = _series_key(keyed), identities(df)
    total = over_time(df, fn)
    total = _keyed(total).withColumnRenamed(VALUE, "_agg").select(*key, "_agg")
    order = [F.col("_agg").desc_nulls_last() if descending else F.col("_agg").asc_nulls_last(), F.col(LK).asc()]
    if limit is None:
        ranked = total
    elif ids:
        ranked = first_per_group(total, ids, order, limit)
    else:
        ranked = total.orderBy(*order).limit(limit)
    w = Window.partitionBy(*ids) if ids else Window.partitionBy(F.lit(0))
    if limit is not None or ids:
        ranked = ranked.withColumn("rank", F.row_number().over(w.orderBy(*order)))
        return keyed.join(ranked.drop("_agg"), key, "inner").drop(LK)
    return keyed.join(ranked, key, "inner").orderBy(*order, *([TIME] if TIME in df.columns else [])).drop(LK, "_agg")


def sort_label_values(df: DataFrame, labels: Sequence[str], descending: bool = False) -> DataFrame:
    """Lexicographic order by the listed labels, missing ones as empty text."""
    order = [L.get(F.col(LABELS), k) for k in dict.fromkeys(labels)]
    order = [o.desc() if descending else o.asc() for o in order]
    return df.orderBy(*order, *([TIME] if TIME in df.columns else []))


def relabels(df: DataFrame, key: str, values: str, new_key: str, new_values: str) -> DataFrame:
    if not is_labeled(df):
        raise ValueError("relabels needs a labelled result")
    return df.withColumn(LABELS, L.relabel(F.col(LABELS), key, values.split(","), new_key, new_values.split(",")))


# ---- choice ----

def view_as_seq(results: Sequence[DataFrame]) -> DataFrame:
    """The first result that has any value, else the first one."""
    tagged = reduce(DataFrame.unionByName, [r.withColumn("_ord", F.lit(i)) for i, r in enumerate(results)])
    ids = identities(results[0])
    first = F.coalesce(F.min(F.when(F.col(VALUE).isNotNull(), F.col("_ord"))), F.lit(0)).alias("_first")
    if ids:
        chosen = tagged.groupBy(*ids).agg(first)
        return tagged.join(chosen, ids).filter(F.col("_ord") == F.col("_first")).drop("_ord", "_first")
    return tagged.filter(F.col("_ord") == tagged.agg(first).scalar()).drop("_ord")


def is_present(results: Sequence[DataFrame]) -> DataFrame:
    """1 where any result has a value, else 0."""
    ids = identities(results[0])
    union = reduce(DataFrame.unionByName, [r.select(*ids, VALUE) for r in results])
    present = F.max(F.when(F.col(VALUE).isNotNull(), 1.0).otherwise(0.0))
    if ids:
        return union.groupBy(*ids).agg(present.alias(VALUE))
    return union.agg(F.coalesce(present, F.lit(0.0)).alias(VALUE))


def baseline(points: DataFrame, predictions: DataFrame, step: str, kind: str = "value") -> DataFrame:
    """Predicted value, upper or lower bound at every point.

    Predictions are kept per hour bucket: minute points read the hour they lie in, day points their first hour.
    """
    hour = {"minute": lambda c: coarsen(c, 1), "hour": lambda c: c, "day": lambda c: c * 100}[step.lower()](F.col(TIME))
    ids = [c for c in identities(points) if c in predictions.columns]
    keyed = _keyed(points)
    on = ids + ["_hour"]
    right = predictions.select(*ids, F.col(TIME).alias("_hour"), F.col(kind).cast("double").alias("_p"),
                               *([L.key_of(F.col(LABELS)).alias(LK)] if LABELS in predictions.columns and LK in keyed.columns else []))
    if LK in right.columns:
        on.append(LK)
    return (keyed.withColumn("_hour", hour).join(right, on, "left")
            .withColumn(VALUE, F.col("_p")).drop("_hour", "_p", LK))


# ---- reading values ----

def latest_value(df: DataFrame, default: float = 0.0) -> DataFrame:
    """Last non-empty value in the range, else the default."""
    return over_time(df, "latest").withColumn(VALUE, F.coalesce(F.col(VALUE), F.lit(default)))


def all_entities(table: DataFrame, metric: str, duration: Duration, limit: int = 10) -> DataFrame:
    """Labelled metric without an entity filter, at most ``limit`` rows, newest first."""
    return (scan_metric(table, metric, duration)
            .orderBy(F.col(TIME).desc(), "entity_id", "label").limit(limit))


def heatmap(histogram: DataFrame, duration: Duration, default: int = 0) -> DataFrame:
    """Histogram rows (entity, time, bucket, value) to a dense heat map with bucket bounds.

    ``bucket_max`` is the next bucket of the entity, infinite for the last one. Grid rows come from the distinct
    buckets of each entity, whose number is fixed by the histogram definition.
    """
    buckets = histogram.select("entity_id", "bucket").distinct()
    w = Window.partitionBy("entity_id").orderBy("bucket")
    bounds = buckets.withColumn("bucket_max", F.lead("bucket").over(w))
    grid = (bounds.select("entity_id", "bucket", "bucket_max", F.explode(grid_points(duration)).alias(TIME)))
    return (grid.join(histogram.select("entity_id", TIME, "bucket", "value"), ["entity_id", TIME, "bucket"], "left")
            .select("entity_id", TIME, F.col("bucket").alias("bucket_min"),
                    F.coalesce(F.col("bucket_max").cast("double"), F.lit(float("inf"))).alias("bucket_max"),
                    F.coalesce("value", F.lit(default)).alias("value")))
