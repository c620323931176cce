"""Mergeable aggregate functions.

A function is described by its *states*: one row expression and one of ``sum``/``max``/``min`` per state. The same
three verbs fold rows into a state and merge states, so Spark's partial and final aggregation, the time roll-up, late
merging and streaming all use one definition. Functions with a ``key`` keep one row per (group, key): buckets and
labels live in long form and never in one growing map.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arith import int_div, rank_roof

FOLD = {"sum": F.sum, "max": F.max, "min": F.min}
GROUP = ("entity_id", "time_bucket")
# Ranks reported by the rule percentile functions.
RANKS = (50, 75, 90, 95, 99)
KEY = "key"


@dataclass(frozen=True)
class AggregateFn:
    """``states(value, args)`` gives name -> (row expression, fold); ``value(states, minutes, args)`` finalises."""

    name: str
    states: Callable[[Column | None, Mapping], dict[str, tuple[Column, str]]]
    value: Callable[[Mapping[str, Column], Column, Mapping], Column] | None = None
    key: Callable[[Column | None, Mapping], Column] | None = None
    finish: Callable[[DataFrame, tuple, Mapping], DataFrame] | None = None
    key_type: str = "label"  # what a key is: a number ("le"), a text ("label") or both ("both")


REGISTRY: dict[str, AggregateFn] = {}


def register(fn: AggregateFn) -> AggregateFn:
    """Add a function (also the users' extension point)."""
    REGISTRY[fn.name] = fn
    return fn


def _one() -> Column:
    return F.lit(1).cast("bigint")


def _long(v: Column) -> Column:
    return v.cast("bigint")


def _flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("bigint")


def floor_one_avg(total: Column, n: Column) -> Column:
    """Truncating average that reports 1 instead of 0 while the sum is positive."""
    avg = int_div(total, n)
    return F.when((avg == 0) & (total > 0), F.lit(1).cast("bigint")).otherwise(avg)


def _simple(name, fold, cast, wrap=lambda c: c):
    register(AggregateFn(name, lambda v, a: {"v": (v.cast(cast), fold)}, lambda s, m, a: wrap(s["v"])))


# ---- rule functions ----
register(AggregateFn("count", lambda v, a: {"n": (_one(), "sum")}, lambda s, m, a: s["n"]))
_simple("sum", "sum", "bigint")
_simple("max", "max", "bigint", lambda c: F.greatest(c, F.lit(0).cast("bigint")))
_simple("max_double", "max", "double", lambda c: F.greatest(c, F.lit(0.0)))
_simple("min", "min", "bigint")
_simple("min_double", "min", "double")
register(AggregateFn("long_avg", lambda v, a: {"s": (_long(v), "sum"), "n": (_one(), "sum")},
                     lambda s, m, a: int_div(s["s"], s["n"])))
register(AggregateFn("double_avg", lambda v, a: {"s": (v.cast("double"), "sum"), "n": (_one(), "sum")},
                     lambda s, m, a: s["s"] / s["n"]))
register(AggregateFn("cpm", lambda v, a: {"n": (_one(), "sum")}, lambda s, m, a: int_div(s["n"], m)))
register(AggregateFn("percent", lambda v, a: {"hit": (_flag(a["cond"]), "sum"), "n": (_one(), "sum")},
                     lambda s, m, a: int_div(s["hit"] * 10000, s["n"]).cast("int")))
register(AggregateFn("rate", lambda v, a: {"num": (_flag(a["num"]), "sum"), "den": (_flag(a["den"]), "sum")},
                     lambda s, m, a: F.when(s["den"] == 0, F.lit(0)).otherwise(
                         int_div(s["num"] * 10000, F.greatest(s["den"], _one())).cast("int"))))


def _apdex_states(v, a):
    t, ok = a["threshold"], F.coalesce(a["status"], F.lit(False))
    satisfied = ok & (v <= t)
    tolerated = ok & (v > t) & (v <= t * 4)
    return {"s": (satisfied.cast("bigint"), "sum"), "t": (tolerated.cast("bigint"), "sum"), "n": (_one(), "sum")}


register(AggregateFn("apdex", _apdex_states, lambda s, m, a: int_div(
    s["s"] * 10000 + int_div(s["t"] * 10000, 2), s["n"]).cast("int")))


def rank_scan(counts: DataFrame, group, ranks, key=KEY, n="n") -> DataFrame:
    """Smallest key whose running count reaches the roof of each rank; adds columns ``r0..`` in rank order.

    The input holds one row per (group, key), so a group has at most as many rows as it has distinct keys.
    Ranks must rise. A group whose counts add up to nothing reports 0 for every rank.
    """
    by_key = Window.partitionBy(*group).orderBy(key)
    whole = Window.partitionBy(*group)
    scan = counts.select(*group, key, F.sum(n).over(by_key.rowsBetween(Window.unboundedPreceding, 0)).alias("_cum"),
                         F.sum(n).over(whole).alias("_total"))
    hits = [F.min(F.when(F.col("_cum") >= rank_roof(F.col("_total"), r), F.col(key))).alias(f"_h{i}")
            for i, r in enumerate(ranks)]
    out = scan.groupBy(*group).agg(F.max("_total").alias("_total"), *hits)
    return out.select(*group, *[F.when(F.col("_total") <= 0, F.lit(0).cast("bigint")).otherwise(F.col(f"_h{i}"))
                                .alias(f"r{i}") for i in range(len(ranks))])


def ranks_to_rows(df: DataFrame, group, labels, scale: int = 1, label="p") -> DataFrame:
    """Unpivot ``r0..`` columns to rows (label, value)."""
    items = F.array(*[F.struct(F.lit(str(l)).alias(label), (F.col(f"r{i}") * scale).alias("value"))
                      for i, l in enumerate(labels)])
    return df.select(*group, F.inline(items)).filter(F.col("value").isNotNull())


def _percentile(name, labels):
    register(AggregateFn(
        name,
        lambda v, a: {"n": (_one(), "sum")},
        key_type="le", key=lambda v, a: int_div(v, a["precision"]),
        finish=lambda df, group, a: ranks_to_rows(rank_scan(df, group, RANKS), group, labels, a["precision"])))


_percentile("percentile2", RANKS)
_percentile("percentile", range(len(RANKS)))


def _histogram_finish(df, group, a):
    """One row per bucket, absent ones zero. The packed map has at most ``max_steps + 1`` entries."""
    packed = df.groupBy(*group).agg(F.map_from_entries(F.collect_list(F.struct(KEY, "n"))).alias("_m"))
    grid = F.sequence(F.lit(0).cast("bigint"), F.lit(a["step"] * a["max_steps"]).cast("bigint"),
                      F.lit(a["step"]).cast("bigint"))
    return (packed.select(*group, "_m", F.explode(grid).alias("bucket"))
            .select(*group, "bucket", F.coalesce(F.try_element_at("_m", F.col("bucket")), F.lit(0).cast("bigint")).alias("value")))


register(AggregateFn(
    "histogram",
    lambda v, a: {"n": (_one(), "sum")},
    key_type="le",
    key=lambda v, a: F.least(int_div(v, a["step"]), F.lit(a["max_steps"]).cast("bigint")) * a["step"],
    finish=_histogram_finish))


def _cap_labels(df, group, a):
    """First labels to appear, by event time and then label. Spark limits each map side before the shuffle."""
    order = Window.partitionBy(*group).orderBy("first", KEY)
    return df.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= a.get("max_labels", 50)).drop("_rn")


register(AggregateFn(
    "label_count",
    lambda v, a: {"n": (_one(), "sum"), "first": (a["ts"], "min")},
    key=lambda v, a: a["label"],
    finish=lambda df, group, a: _cap_labels(df, group, a).select(*group, F.col(KEY).alias("label"), F.col("n").alias("value"))))
register(AggregateFn(
    "label_avg",
    lambda v, a: {"s": (_long(v), "sum"), "n": (_one(), "sum"), "first": (a["ts"], "min")},
    key=lambda v, a: a["label"],
    finish=lambda df, group, a: _cap_labels(df, group, a).select(
        *group, F.col(KEY).alias("label"), floor_one_avg(F.col("s"), F.col("n")).alias("value"))))


# ---- meter functions over samples: the same machinery, keyed by the label text or the histogram bucket ----

def _meter_pair(name, states, value):
    """Register ``name`` and ``name_labeled``."""
    register(AggregateFn("meter_" + name, states, value))
    register(AggregateFn(
        f"meter_{name}_labeled", states, key=lambda v, a: a["label"],
        finish=lambda df, group, a: df.select(*group, F.col(KEY).alias("label"), value(
            {c: F.col(c) for c in df.columns}, a["minutes"], a).alias("value"))))


_meter_pair("avg", lambda v, a: {"s": (_long(v), "sum"), "n": (_one(), "sum")},
            lambda s, m, a: floor_one_avg(s["s"], s["n"]))
_meter_pair("sum", lambda v, a: {"s": (_long(v), "sum")}, lambda s, m, a: s["s"])
_meter_pair("sum_per_min", lambda v, a: {"s": (_long(v), "sum")}, lambda s, m, a: int_div(s["s"], m))
# a merged minimum is a true minimum here
_meter_pair("min", lambda v, a: {"v": (_long(v), "min")}, lambda s, m, a: s["v"])
register(AggregateFn("meter_max", lambda v, a: {"v": (_long(v), "max")},
                     lambda s, m, a: F.greatest(s["v"], F.lit(0).cast("bigint"))))
register(AggregateFn("meter_max_labeled", lambda v, a: {"v": (_long(v), "max")}, key=lambda v, a: a["label"],
                     finish=lambda df, group, a: df.select(*group, F.col(KEY).alias("label"), F.col("v").alias("value"))))
# the newest sample by event time; equal times fall back to the larger value
_meter_pair("latest", lambda v, a: {"last": (F.struct(a["ts"].alias("ts"), _long(v).alias("v")), "max")},
            lambda s, m, a: s["last"]["v"])

HIST_KEY = ("label", "le")


def _hist_key(v, a):
    return F.struct(F.coalesce(a.get("label", F.lit("")), F.lit("")).alias("label"), a["le"].cast("bigint").alias("le"))


def _open_key(df, group, value):
    return df.select(*group, F.col(KEY)["label"].alias("label"), F.col(KEY)["le"].alias("le"), value.alias("value"))


def _hist(name, states, value):
    register(AggregateFn(f"meter_{name}_histogram", states, key=_hist_key, key_type="both",
                         finish=lambda df, group, a: _open_key(df, group, value())))

    def pct(df, group, a):
        buckets = _open_key(df, group, value())
        full = (*group, "label")
        scan = rank_scan(buckets, full, a["ranks"], key="le", n="value")
        return ranks_to_rows(scan, full, a["ranks"])

    register(AggregateFn(f"meter_{name}_histogram_percentile", states, key=_hist_key, key_type="both", finish=pct))


_hist("avg", lambda v, a: {"s": (_long(v), "sum"), "n": (_one(), "sum")}, lambda: floor_one_avg(F.col("s"), F.col("n")))
_hist("sum", lambda v, a: {"s": (_long(v), "sum")}, lambda: F.col("s"))


# ---- running one function ----

def fold(df: DataFrame, fn: str, value: Column | None = None, args: Mapping | None = None, group=GROUP) -> DataFrame:
    """Rows to state rows: one per group, or per (group, key) for keyed functions."""
    spec, args = REGISTRY[fn], args or {}
    states = spec.states(value, args)
    keys = [F.col(g) for g in group] + ([spec.key(value, args).alias(KEY)] if spec.key else [])
    projected = df.select(*keys, *[e.alias(n) for n, (e, _) in states.items()])
    names = [*group] + ([KEY] if spec.key else [])
    return projected.groupBy(*names).agg(*[FOLD[f](n).alias(n) for n, (_, f) in states.items()])


def merge(states: DataFrame, fn: str, group=GROUP, args: Mapping | None = None) -> DataFrame:
    """State rows of the same groups, from any number of partials, into one."""
    spec = REGISTRY[fn]
    folds = {n: f for n, (_, f) in spec.states(F.lit(0), _dummy(args)).items()}
    names = [*group] + ([KEY] if spec.key else [])
    return states.groupBy(*names).agg(*[FOLD[f](n).alias(n) for n, f in folds.items()])


class _dummy(dict):
    """Stands in for column arguments when only the fold names of a function are needed."""

    def __init__(self, args=None):
        super().__init__(args or {})

    def __missing__(self, key):
        return F.lit(True) if key in ("cond", "num", "den", "status") else F.lit(0)


def finalise(states: DataFrame, fn: str, args: Mapping | None = None, group=GROUP, minutes: Column | None = None) -> DataFrame:
    """State rows to reported values."""
    from ..functions.timebucket import minutes_in

    spec, args = REGISTRY[fn], dict(args or {})
    m = minutes if minutes is not None else minutes_in(F.col("time_bucket")) if "time_bucket" in group else F.lit(1)
    args.setdefault("minutes", m)
    if spec.finish:
        return spec.finish(states, tuple(group), args)
    cols = {c: F.col(c) for c in states.columns}
    return states.select(*group, spec.value(cols, m, args).alias("value"))


def aggregate(df: DataFrame, fn: str, value: Column | None = None, args: Mapping | None = None, group=GROUP,
              minutes: Column | None = None) -> DataFrame:
    return finalise(fold(df, fn, value, args, group), fn, args, group, minutes)


def rollup(states: DataFrame, fn: str, levels: int = 1, group=GROUP, args: Mapping | None = None) -> DataFrame:
    """Minute states to hour (1 level) or day (2 levels) states: states are merged, never finished values."""
    from ..functions.timebucket import coarsen

    return merge(states.withColumn("time_bucket", coarsen(F.col("time_bucket"), levels)), fn, group, args)


def incompatible_buckets(samples: DataFrame, group=GROUP, le="le") -> DataFrame:
    """Groups fed by reports with differing bucket sets. ``samples`` has a ``report`` column naming the scrape."""
    per_report = (samples.select(*group, "report", F.col(le).cast("bigint").alias("le")).distinct()
                  .groupBy(*group, "report")
                  .agg(F.count("le").alias("n"), F.sum("le").alias("s"), F.sum(F.xxhash64("le").bitwiseAND(0xFFFFFFFF)).alias("h")))
    return (per_report.groupBy(*group)
            .agg(F.max(F.struct("n", "s", "h")).alias("a"), F.min(F.struct("n", "s", "h")).alias("b"))
            .filter(F.col("a") != F.col("b")).select(*group))


def refuse_incompatible(result: DataFrame, samples: DataFrame, group=GROUP) -> DataFrame:
    """``result`` as it is; the query fails on a group whose reports have differing bucket sets."""
    bad = incompatible_buckets(samples, group).withColumn("_bad", F.lit(True))
    joined = result.join(bad, list(group), "left")
    stop = F.raise_error(F.concat_ws(" ", F.lit("reports with differing buckets meet in"), *[F.col(g).cast("string") for g in group]))
    value = F.when(F.col("_bad"), stop.cast(result.schema["value"].dataType)).otherwise(F.col("value"))
    return joined.withColumn("value", value).select(*result.columns)
