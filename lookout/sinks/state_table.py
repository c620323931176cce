"""The metric state table: append-only partial states that are merged when read.

A batch adds its partial states under ``day=/batch=``. Writing is idempotent, because a repeated batch replaces its own
partitions only, and rows that arrive late simply add states to their old bucket, so nothing is ever dropped or
rewritten in place. Compaction folds what the batches of a day hold so far into ``<path>_folded/day=/upto=``, where
``upto`` is the last batch that is in it, and then notes the fold in ``<path>_folds``. A fold counts from that note on.
Readers turn the notes, one number a day, into conditions on the partition columns: the newest fold of each day and the
batches after it, so late rows of a folded day count once, before and after the next fold, and nothing else is listed
into a scan. What a fold replaced stays until :func:`vacuum` removes it, so a reader that started earlier still answers.

Plain rules share one wide frame; percentiles, histograms and labels share one long frame beside it (:func:`keyed_path`).
"""

from __future__ import annotations

import re
import time
from datetime import datetime, timedelta
from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import aggregates as A
from ..operators import rules as R
from ..plans.runtime import delete

BATCH = "batch"
UPTO = "upto"
NOTE = "day long, upto long, made_ms long"


def keyed_path(path: str) -> str:
    return path.rstrip("/") + "_keyed"


def folded_path(path: str) -> str:
    return path.rstrip("/") + "_folded"


def folds_path(path: str) -> str:
    return path.rstrip("/") + "_folds"


def with_day(df: DataFrame) -> DataFrame:
    """Day of a minute, hour or day bucket."""
    digits = F.length(F.col("time_bucket").cast("string"))
    power = F.when(digits == 12, 10_000).when(digits == 10, 100).otherwise(1).cast("bigint")
    return df.withColumn("day", F.call_function("div", F.col("time_bucket"), power))


def _write(df: DataFrame, path: str, *partitions: str) -> None:
    """Rows of a partition are brought together first: few files, and a large partition is split by its size."""
    (df.hint("rebalance", *partitions).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partitions).parquet(path))


def append(states: DataFrame, path: str, batch_id: int) -> None:
    _write(with_day(states).withColumn(BATCH, F.lit(batch_id).cast("bigint")), path, "day", BATCH)


def _partitions(spark: SparkSession, path: str, second: str) -> list[tuple[int, int, str]]:
    """(day, number, folder) of the partitions below ``path``, from the names of the folders."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/day=*/{second}=*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    names = [str(f.getPath()) for f in found or ()]
    return sorted((int(m[1]), int(m[2]), n) for n in names if (m := re.search(rf"/day=(-?\d+)/{second}=(-?\d+)$", n)))


def _within(day: int, start_day: int | None, end_day: int | None) -> bool:
    return start_day is None or start_day <= day <= (end_day if end_day is not None else start_day)


def _notes(spark: SparkSession, path: str) -> list[tuple[int, int, int]]:
    """(day, upto, when it was made) of all folds: a row a day for each compaction."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(folds_path(path))
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return []
    return [tuple(r) for r in spark.read.schema(NOTE).parquet(folds_path(path)).collect()]


def _newest(notes: Sequence[tuple[int, int, int]]) -> dict[int, int]:
    out: dict[int, int] = {}
    for day, upto, _ in notes:
        out[day] = max(upto, out.get(day, upto))
    return out


def _of(numbers: Mapping[int, int]) -> Column:
    """The number of the row's day, null for other days: a literal map, so that conditions on it prune partitions."""
    if not numbers:
        return F.lit(None).cast("bigint")
    return F.try_element_at(F.create_map(*[F.lit(x).cast("bigint") for pair in numbers.items() for x in pair]), F.col("day"))


def _stored(spark: SparkSession, path: str, second: str, start_day: int | None, end_day: int | None) -> DataFrame | None:
    if not _partitions(spark, path, second):
        return None
    out = spark.read.parquet(path)
    kinds = {"day": T.LongType(), BATCH: T.LongType(), UPTO: T.LongType()}
    out = out.select(*[F.col(c).cast(kinds[c]).alias(c) if c in kinds else c for c in out.columns])
    if start_day is not None:
        out = out.filter(F.col("day").between(start_day, end_day if end_day is not None else start_day))
    return out


def read(spark: SparkSession, path: str, start_day: int | None = None, end_day: int | None = None,
         newest: Mapping[int, int] | None = None, last: Mapping[int, int] | None = None) -> DataFrame:
    """State rows that count: the newest fold of each day and the batches after it. ``newest`` and ``last`` (for
    compaction) give the folds to go by and the last batch of each day to take; other days are then left out."""
    newest = _newest(_notes(spark, path)) if newest is None else newest
    newest = {d: u for d, u in newest.items() if _within(d, start_day, end_day)}
    batches = _stored(spark, path, BATCH, start_day, end_day)
    folds = _stored(spark, folded_path(path), UPTO, start_day, end_day) if newest else None
    if batches is not None and newest:
        batches = batches.filter(_of(newest).isNull() | (F.col(BATCH) > _of(newest)))
    if batches is not None and last is not None:
        batches = batches.filter(F.col(BATCH) <= _of(last))
    if folds is not None:
        folds = folds.filter(F.col(UPTO) == _of(newest)).withColumnRenamed(UPTO, BATCH)
        if last is not None:
            folds = folds.filter(_of(last).isNotNull())
    parts = [p for p in (folds, batches) if p is not None]
    if not parts:
        raise ValueError(f"no states below {path}")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)


def merged(spark: SparkSession, path: str, rules: Sequence[R.Rule], start_day: int | None = None, end_day: int | None = None) -> DataFrame:
    """Merged wide states of the unkeyed rules."""
    return R.merge_states(read(spark, path, start_day, end_day), [r for r in rules if not R.is_keyed(r)])


def merged_keyed(spark: SparkSession, path: str, start_day: int | None = None, end_day: int | None = None) -> DataFrame:
    """Merged long states of the keyed rules, for :func:`lookout.operators.rules.keyed_rows`."""
    return R.merge_keyed(read(spark, keyed_path(path), start_day, end_day))


def values(spark: SparkSession, path: str, rules: Sequence[R.Rule], start_day: int | None = None, end_day: int | None = None) -> DataFrame:
    """All rules of the table at ``path`` as the long metric table (metric, entity_id, time_bucket, value, label)."""
    plain = [r for r in rules if not R.is_keyed(r)]
    out = None
    if plain:
        wide = R.values(merged(spark, path, plain, start_day, end_day), plain)
        out = R.to_rows(wide, plain).withColumn("label", F.lit(None).cast("string"))
    if len(plain) < len(rules):
        rows = R.keyed_rows(merged_keyed(spark, path, start_day, end_day), rules)
        out = rows if out is None else out.unionByName(rows.select(*out.columns))
    return out


def _fold(spark: SparkSession, path: str, fold: Callable[[DataFrame], DataFrame], start_day: int | None, end_day: int | None) -> None:
    newest, due = _newest(_notes(spark, path)), {}
    for day, batch, _ in _partitions(spark, path, BATCH):
        if _within(day, start_day, end_day) and batch > newest.get(day, -1):
            due[day] = max(batch, due.get(day, batch))
    if not due:
        return
    rows = with_day(fold(read(spark, path, newest=newest, last=due))).withColumn(UPTO, _of(due))
    _write(rows, folded_path(path), "day", UPTO)
    made = int(time.time() * 1000)
    (spark.createDataFrame([(day, upto, made) for day, upto in due.items()], NOTE).coalesce(1)
     .write.mode("append").parquet(folds_path(path)))


def compact(spark: SparkSession, path: str, rules: Sequence[R.Rule], start_day: int | None = None, end_day: int | None = None) -> None:
    """Fold the batches of the days that have any the newest fold lacks, up to the last that is there now; one that is
    written meanwhile is left for the next fold. Numbers of batches must rise, as those of a stream do; a repeated batch that a
    fold holds already is passed over by readers. Nothing is deleted."""
    plain = [r for r in rules if not R.is_keyed(r)]
    if plain:
        _fold(spark, path, lambda df: R.merge_states(df, plain), start_day, end_day)
    if len(plain) < len(rules):
        _fold(spark, keyed_path(path), R.merge_keyed, start_day, end_day)


def vacuum(spark: SparkSession, path: str, keep_ms: int = 3_600_000, now_ms: int | None = None) -> int:
    """Delete the batches that a fold holds and the folds that it replaced, ``keep_ms`` after it was made: readers that
    started before have had that long. Returns the folders deleted."""
    now, gone = int(time.time() * 1000) if now_ms is None else now_ms, 0
    for table in (path, keyed_path(path)):
        notes = _notes(spark, table)
        settled = _newest([n for n in notes if n[2] <= now - keep_ms])
        old = [f for day, batch, f in _partitions(spark, table, BATCH) if batch <= settled.get(day, -1)]
        old += [f for day, upto, f in _partitions(spark, folded_path(table), UPTO) if upto < settled.get(day, -1)]
        for folder in old:
            delete(spark, folder)
        gone += len(old)
    return gone


def expire(spark: SparkSession, path: str, today: int, ttl_days: int) -> list[int]:
    """Delete the days older than the retention from the table, its keyed table and the folds of both; returns them."""
    limit = int((datetime.strptime(str(today), "%Y%m%d") - timedelta(days=ttl_days)).strftime("%Y%m%d"))
    old = set()
    for table in (path, keyed_path(path)):
        for folder, second in ((table, BATCH), (folded_path(table), UPTO)):
            days = {day for day, _, _ in _partitions(spark, folder, second) if day < limit}
            for day in days:
                delete(spark, f"{folder.rstrip('/')}/day={day}")
            old |= days
    return sorted(old)


def expire_all(spark: SparkSession, paths: Mapping[str, tuple[str, str | None]], today: int, overrides: Mapping[str, int] | None = None) -> dict[str, list[int]]:
    """:func:`expire` for tables by path, each with its category and granularity as in :mod:`lookout.sinks.writers`."""
    from .writers import ttl_of

    return {path: expire(spark, path, today, ttl_of(*kind, overrides)) for path, kind in paths.items()}


def write_metrics(rows: DataFrame, path: str) -> None:
    """The metric table that :func:`lookout.sources.tables.read_metrics` and ``scan_metric`` prune: long rows
    (metric, entity_id, time_bucket, value ...) by metric and day. Days that are written again are replaced."""
    _write(with_day(rows), path, "metric", "day")
