"""Streaming metrics: the batch builders applied to each micro-batch, or to event-time windows."""

from __future__ import annotations

from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timebucket import bucket_of
from ..operators import rules as R
from ..operators.alarms import AlarmRule
from ..operators.topk import first_per_group
from ..sinks import state_table

RuleSource = Sequence[R.Rule] | Callable[[], Sequence[R.Rule]]


def current(rules: RuleSource) -> list[R.Rule]:
    """Rules may be a function: it is asked anew for every batch, so rules can change while a query runs."""
    return list(rules() if callable(rules) else rules)


def upsert_batch(path: str, rules: RuleSource, hour_path: str | None = None, day_path: str | None = None,
                 compact_every: int | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that appends minute states and their hour and day roll-ups, of plain and keyed rules.

    Late rows need no special care: their states join their old bucket when the table is read. ``compact_every``: after
    so many batches the tables fold what they hold.
    """
    targets = [(p, levels) for p, levels in ((path, 0), (hour_path, 1), (day_path, 2)) if p]

    def run(batch: DataFrame, batch_id: int) -> None:
        active = current(rules)
        plain, keyed = [r for r in active if not R.is_keyed(r)], [r for r in active if R.is_keyed(r)]
        parts = []
        if plain:
            parts.append((R.states(batch, plain), lambda df, n: R.rollup(df, plain, n), lambda p: p))
        if keyed:
            parts.append((R.keyed_states(batch, keyed), lambda df, n: R.rollup_keyed(df, keyed, n), state_table.keyed_path))
        for minute, roll, where in parts:
            minute.persist()
            try:
                for target, levels in targets:
                    state_table.append(roll(minute, levels) if levels else minute, where(target), batch_id)
            finally:
                minute.unpersist()
        if compact_every and (batch_id + 1) % compact_every == 0:
            for target, levels in targets:
                state_table.compact(batch.sparkSession, target, [r for r in active if r.downsample or not levels])
    return run


def stream_states(source: DataFrame, path: str, rules: RuleSource, checkpoint: str, hour_path: str | None = None, day_path: str | None = None,
                  trigger: Mapping | None = None, compact_every: int | None = None):
    return (source.writeStream.foreachBatch(upsert_batch(path, rules, hour_path, day_path, compact_every)).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "25 seconds"})).start())


def windowed(source: DataFrame, aggregates: Mapping[str, Column], ts: str = "ts", window: str = "1 minute", slide: str | None = None,
             delay: str = "2 minutes", keys: Sequence[str] = ("entity_id",)) -> DataFrame:
    """Event-time windows with a watermark, for sinks that want finished rows; the same code runs in batch.

    Rows later than ``delay`` are dropped by Spark here; use :func:`upsert_batch` where every row must count.
    """
    rows = source.withWatermark(ts, delay) if source.isStreaming else source
    w = F.window(ts, window, slide) if slide else F.window(ts, window)
    out = rows.groupBy(*keys, w.alias("_w")).agg(*[c.alias(n) for n, c in aggregates.items()])
    return out.select(*keys, F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), bucket_of(F.col("_w.start")).alias("time_bucket"), *aggregates)


def late_rows(source: DataFrame, watermark: Column, ts: str = "ts") -> DataFrame:
    """Rows older than a watermark, for a side table that a batch job merges."""
    return source.filter(F.col(ts) < watermark)


def late_batch(path: str, rule: AlarmRule) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that writes the values an alarm rule may see to ``path/fresh`` and those that come too
    late for its window to ``path/late``, by batch, as :func:`lookout.operators.alarms.split_late` does for arrivals.

    Each batch leaves its newest minute under ``path/newest``; the window ends with the newest of this and all earlier batches. A
    repeated batch looks at earlier ones only and replaces its own rows.
    """
    kind = "newest long, batch long"

    def write(rows: DataFrame, name: str, batch_id: int) -> None:
        (rows.withColumn("batch", F.lit(batch_id).cast("bigint")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch").parquet(f"{path}/{name}"))

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("_tick", F.expr("unix_seconds(cast(minute as timestamp)) div 60")).persist()
        try:
            newest = rows.agg(F.max("_tick")).first()[0]
            if newest is None:
                return
            write(spark.createDataFrame([(newest,)], "newest long"), "newest", batch_id)
            newest = spark.read.schema(kind).parquet(f"{path}/newest").filter(F.col("batch") <= batch_id).agg(F.max("newest")).first()[0]
            late = F.col("_tick") <= newest - rule.period
            write(rows.filter(~late).drop("_tick"), "fresh", batch_id)
            write(rows.filter(late).drop("_tick"), "late", batch_id)
        finally:
            rows.unpersist()
    return run


def top_batch(path: str, n: int = 50, value: str = "latency", tie: str = "statement") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that appends the largest records of each entity and minute of the batch; reading takes
    the largest of all batches again, which gives the same rows as one pass."""
    def run(batch: DataFrame, batch_id: int) -> None:
        best = first_per_group(batch, ["entity_id", "time_bucket"], [F.col(value).desc(), F.col(tie).asc()], n)
        (best.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch").parquet(path))
    return run


def read_top(spark, path: str, n: int = 50, value: str = "latency", tie: str = "statement") -> DataFrame:
    return first_per_group(spark.read.parquet(path).drop("batch"), ["entity_id", "time_bucket"], [F.col(value).desc(), F.col(tie).asc()], n)


def stream_top(source: DataFrame, path: str, checkpoint: str, n: int = 50):
    return (source.writeStream.foreachBatch(top_batch(path, n)).option("checkpointLocation", checkpoint)
            .trigger(processingTime="10 minutes").start())


def first_seen(source: DataFrame, keys: Sequence[str], ts: str = "ts", delay: str = "1 day") -> DataFrame:
    """Inventory rows of a stream: one row per key within the watermark."""
    if not source.isStreaming:
        return source.dropDuplicates(list(keys))
    return source.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))
