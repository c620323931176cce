"""Top-n lists, records, paging."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Above this, Spark no longer limits groups before the shuffle by itself (spark.sql.optimizer.windowGroupLimitThreshold).
GROUP_LIMIT = 1000


def _ordered(col: str, descending: bool) -> Column:
    return F.col(col).desc() if descending else F.col(col).asc()


def first_per_group(df: DataFrame, group, order, n: int, salts: int = 16) -> DataFrame:
    """Exactly the first ``n`` rows of every group.

    Up to 1000 rows per group Spark ranks each map partition first and ships at most ``n`` rows of a group from each.
    Beyond that the same two steps are written out over sub-groups, ``salts`` for each partition of the input, so that a
    sub-group never grows with the data and a hot group is never sorted whole.
    """
    group = list(group)
    if n > GROUP_LIMIT:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*[o for o in df.columns]), F.lit(salts)))
        salted = salted.withColumn("_part", F.spark_partition_id())
        local = Window.partitionBy(*group, "_part", "_salt").orderBy(*order)
        df = salted.withColumn("_rn", F.row_number().over(local)).filter(F.col("_rn") <= n).drop("_rn", "_salt", "_part")
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def top_n(metrics: DataFrame, n: int, descending: bool = True, where: Column | None = None, value="value",
          entity="entity_id", truncate: bool = False) -> DataFrame:
    """Entities by their average over the range, ties by entity."""
    if where is not None:
        metrics = metrics.filter(where)
    avg = F.avg(value)
    ranked = metrics.groupBy(entity).agg((avg.cast("bigint") if truncate else avg).alias("value"))
    return ranked.orderBy(_ordered("value", descending), F.col(entity)).limit(n)


def attr_filter(metrics: DataFrame, **conditions) -> DataFrame:
    """``attr0="x"`` keeps equal rows, ``attr0=("!=", "x")`` keeps the others. Unknown columns are an error."""
    for name, want in conditions.items():
        if name not in metrics.columns:
            raise ValueError(f"{name} is not a queryable column of this metric")
        op, v = want if isinstance(want, tuple) else ("=", want)
        metrics = metrics.filter(F.col(name) == v if op == "=" else F.col(name) != v)
    return metrics


def top_n_of(results, n: int, descending: bool = True, entity="entity_id") -> DataFrame:
    """Merge several top-n lists and keep the best."""
    merged = reduce(DataFrame.unionByName, results)
    return merged.orderBy(_ordered("value", descending), F.col(entity)).limit(n)


def top_records(records: DataFrame, n: int, entity_id: str | None = None, bounds: tuple[int, int] | None = None,
                descending: bool = True, value="latency", tie="statement") -> DataFrame:
    if entity_id is not None:
        records = records.filter(F.col("entity_id") == entity_id)
    if bounds:
        records = records.filter(F.col("time_bucket").between(*bounds))
    return records.orderBy(_ordered(value, descending), F.col(tie)).limit(n)


def sampled_top(records: DataFrame, n: int = 50, value="latency", tie="statement", group=("entity_id", "time_bucket")) -> DataFrame:
    """The ``n`` largest records of each entity and minute."""
    return first_per_group(records, group, [F.col(value).desc(), F.col(tie).asc()], n)


def preaggregated_top(metrics: DataFrame, group_tags, n: int, descending: bool = True) -> DataFrame:
    """Materialisable top-n table per (group tags, time bucket)."""
    return first_per_group(metrics, [*group_tags, "time_bucket"],
                           [_ordered("value", descending), F.col("entity_id")], n)


def page(df: DataFrame, order, size: int, number: int = 1) -> DataFrame:
    """Page ``number`` (0 reads as 1) of ``size`` rows. ``order`` must end in a unique column."""
    start = size * (max(number, 1) - 1)
    ordered = df.orderBy(*order)
    return (ordered.offset(start) if start else ordered).limit(size)


def latest_entities(metrics: DataFrame, limit: int) -> DataFrame:
    """Entities of a metric by their newest bucket."""
    return (metrics.groupBy("entity_id").agg(F.max("time_bucket").alias("time_bucket"))
            .orderBy(F.col("time_bucket").desc(), "entity_id").limit(limit))
