"""A cache of metric states in the state store: states of many batches are merged there and written once per flush.

Appending every batch's partial states makes as many files a day as there are batches. Here a group's states (one row
per entity and bucket with all metrics of a source, or per metric, group and key) stay in the state store of the
stream; the first rows of a group set a timer, and when it fires the merged states leave as one row and the group's
state is cleared. Late rows simply open their group again and leave as one more row, which the state table merges.

Time is the arrival of rows, not their event time, so no row is ever too late. The default arrival is the time of the
batch, which Spark keeps in its log, so a repeated batch sees the same time.
"""

from __future__ import annotations

from contextlib import contextmanager
from typing import Any, Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators import aggregates as A
from ..operators import rules as R
from ..sinks import state_table

ARRIVED = "_arrived"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FOLD = {"sum": lambda a, b: a + b, "max": max, "min": min}


class StateCache(StatefulProcessor):
    """Merged states of one group until their timer fires."""

    def __init__(self, keys: Sequence[str], folds: Mapping[str, str], kinds: T.StructType, flush_ms: int):
        self.keys, self.folds, self.kinds, self.flush = list(keys), dict(folds), kinds, flush_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", self.kinds)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        held = self.held.get()  # each call of the store is a round trip
        fresh = held is None
        held = [None] * len(self.folds) if fresh else list(held)
        first = None
        for row in rows:
            arrived = row[ARRIVED]
            first = arrived if first is None else min(first, arrived)
            for i, (name, how) in enumerate(self.folds.items()):
                value = row[name]
                if value is not None:
                    held[i] = value if held[i] is None else FOLD[how](held[i], value)
        self.held.update(tuple(held))
        if fresh:
            self.handle.registerTimer(int(first.timestamp() * 1000) + self.flush)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        held = self.held.get()
        if held is not None:
            self.held.clear()
            yield Row(*self.keys, *self.folds)(*key, *held)

    def close(self) -> None:
        pass


def _combined(keys: Sequence[str], folds: Mapping[str, str]):
    """Rows of one Arrow batch with equal keys and arrival become one, before anything is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            out = rows.group_by([*keys, ARRIVED], use_threads=False).aggregate(list(folds.items()))
            names = [f"{c}_{how}" for c, how in folds.items()]
            yield from (out.select([*keys, *names, ARRIVED]).rename_columns([*keys, *folds, ARRIVED])
                        .cast(rows.schema).combine_chunks().to_batches())
    return run


def _milliseconds(interval: str) -> int:
    from ..functions.timebucket import parse_range_ms

    number, unit = interval.split()
    return parse_range_ms(number + {"second": "s", "minute": "m", "hour": "h", "day": "d"}[unit.rstrip("s")])


def flushed(rows: DataFrame, keys: Sequence[str], folds: Mapping[str, str], arrival: Column | None = None, flush: str = "1 minute") -> DataFrame:
    """Stream of merged states, one row per group and flush. ``rows``: keys and state columns, one row per input row.

    A group leaves ``flush`` after its first rows arrived. The state store holds the groups of that time only, and is
    empty once all timers have fired. Where all states are numbers, rows are merged within each batch of a task before
    the shuffle, so a hot group sends one row per batch.
    """
    keys, folds = list(keys), dict(folds)
    slim = rows.select(*keys, *folds, (F.current_timestamp() if arrival is None else arrival.cast("timestamp")).alias(ARRIVED))
    if all(isinstance(slim.schema[c].dataType, T.NumericType) for c in folds):
        slim = slim.mapInArrow(_combined(keys, folds), slim.schema)
    kinds = T.StructType([T.StructField(c, slim.schema[c].dataType) for c in folds])
    out = T.StructType([*(T.StructField(c, slim.schema[c].dataType) for c in keys), *kinds.fields])
    return slim.withWatermark(ARRIVED, "0 seconds").groupBy(*keys).transformWithState(
        StateCache(keys, folds, kinds, _milliseconds(flush)), outputStructType=out, outputMode="append", timeMode="EventTime")


def cached_states(source: DataFrame, rules: Sequence[R.Rule], arrival: Column | None = None, flush: str = "1 minute") -> DataFrame:
    """Flushed wide states of the unkeyed rules."""
    rules = [r for r in rules if not R.is_keyed(r)]
    with_arrival = source.withColumn(ARRIVED, F.current_timestamp() if arrival is None else arrival)
    rows, folds = R.row_states(with_arrival, rules, [ARRIVED])
    del folds[ARRIVED]
    return flushed(rows, A.GROUP, folds, F.col(ARRIVED), flush)


def cached_keyed(source: DataFrame, rules: Sequence[R.Rule], arrival: Column | None = None, flush: str = "1 minute") -> DataFrame:
    """Flushed long states of the keyed rules; rows count as arrived with their batch unless ``arrival`` says otherwise."""
    rules = [r for r in rules if R.is_keyed(r)]
    with_arrival = source.withColumn(ARRIVED, F.current_timestamp() if arrival is None else arrival)
    rows, columns = R.keyed_row_states(with_arrival, rules, [ARRIVED])
    return flushed(rows, R.KEYED, {c: c.rsplit("_", 1)[1] for c in columns}, F.col(ARRIVED), flush)


def append_flush(path: str, roll: Callable[[DataFrame, int], DataFrame], hour_path: str | None = None, day_path: str | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that appends flushed states and their roll-ups; a batch without a flush writes nothing."""
    targets = [(p, levels) for p, levels in ((path, 0), (hour_path, 1), (day_path, 2)) if p]

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if batch.isEmpty():
                return
            for target, levels in targets:
                state_table.append(roll(batch, levels) if levels else batch, target, batch_id)
        finally:
            batch.unpersist()
    return run


@contextmanager
def _rocksdb(spark: SparkSession):
    """Value states and timers need the RocksDB state store; a query keeps the store that it was started with."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def stream_cached(source: DataFrame, path: str, rules: Sequence[R.Rule], checkpoint: str, hour_path: str | None = None, day_path: str | None = None,
                  arrival: Column | None = None, flush: str = "1 minute", trigger: Mapping | None = None) -> list:
    """Start the cached streams of the plain and of the keyed rules into the state table at ``path`` and its roll-ups."""
    plain, keyed = [r for r in rules if not R.is_keyed(r)], [r for r in rules if R.is_keyed(r)]
    parts = []
    if plain:
        parts.append((cached_states(source, plain, arrival, flush), "plain", lambda df, n: R.rollup(df, plain, n), lambda p: p))
    if keyed:
        parts.append((cached_keyed(source, keyed, arrival, flush), "keyed", lambda df, n: R.rollup_keyed(df, keyed, n), state_table.keyed_path))
    out = []
    with _rocksdb(source.sparkSession):
        for rows, name, roll, where in parts:
            targets = [where(p) if p else None for p in (path, hour_path, day_path)]
            out.append(rows.writeStream.foreachBatch(append_flush(targets[0], roll, *targets[1:])).outputMode("append")
                       .option("checkpointLocation", f"{checkpoint}/{name}").trigger(**(trigger or {"processingTime": "25 seconds"})).start())
    return out
