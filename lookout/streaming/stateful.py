"""Keyed state across micro-batches, in event time: alarm machines and counters.

Rows wait until the watermark has passed them and are then taken in the order of their time, so the results depend on
neither arrival order nor batch borders. Rows that arrive behind the watermark are left out. Timers clear the state of
an entity or series that has gone quiet.
"""

from __future__ import annotations

from typing import Any, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

from ..functions import labels as L
from ..operators.alarms import AlarmRule, run_machine

MINUTE_MS = 60_000


class AlarmMachine(StatefulProcessor):
    """State machine of one entity. A minute without a tick means that the window ran empty: nothing needs keeping."""

    def __init__(self, silence: int, recovery: int):
        self.silence, self.recovery = silence, recovery

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("machine", StructType([
            StructField("state", StringType()), StructField("silence", LongType()), StructField("recovery", LongType()), StructField("last", LongType())]))
        self.waiting = handle.getMapState("waiting", StructType([StructField("tick", LongType())]), StructType([StructField("match", BooleanType())]))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        last = self.state.get()[3] if self.state.exists() else None
        for frame in rows:
            for tick, match in zip(frame["tick"].tolist(), frame["match"].tolist()):
                if last is None or tick > last:
                    self.waiting.updateValue((tick,), (bool(match),))
                    self.handle.registerTimer(tick * MINUTE_MS)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        tick = expiredTimerInfo.getExpiryTimeInMs() // MINUTE_MS
        if self.waiting.containsKey((tick,)):
            match = self.waiting.getValue((tick,))[0]
            self.waiting.removeKey((tick,))
            start = self.state.get() if self.state.exists() else None
            states, end = run_machine(pd.DataFrame({"tick": [tick], "match": [match]}), self.silence, self.recovery, tuple(start) if start else None)
            self.state.update(end)
            # the minute after: without a tick by then, the entity starts afresh
            self.handle.registerTimer((tick + 1) * MINUTE_MS)
            yield pd.DataFrame({"entity_id": [key[0]], "tick": [tick], "match": [match], "state": states})
        elif self.state.exists() and self.state.get()[3] < tick:
            self.state.clear()

    def close(self) -> None:
        pass


def alarm_states(ticks: DataFrame, rule: AlarmRule, delay: str = "1 minute") -> DataFrame:
    """Streaming form of :func:`lookout.operators.alarms.states`; a tick answers once the watermark has passed it."""
    minute = F.col("minute").cast("timestamp")
    slim = (ticks.select("entity_id", "match", minute.alias("minute"), F.expr("unix_seconds(cast(minute as timestamp)) div 60").alias("tick"))
            .withWatermark("minute", delay))
    out = slim.groupBy("entity_id").transformWithStateInPandas(
        AlarmMachine(rule.silence, rule.recovery), outputStructType="entity_id string, tick bigint, match boolean, state string",
        outputMode="append", timeMode="EventTime")
    return out.select("entity_id", F.timestamp_seconds(F.col("tick") * 60).alias("minute"), "match", "state")


class Counter(StatefulProcessor):
    """Samples of one series: those still waiting for the watermark, and those inside the look-back window, sorted."""

    def __init__(self, window_ms: int | None, idle_ms: int):
        self.window, self.idle = window_ms, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        point = StructType([StructField("ts", LongType()), StructField("value", DoubleType())])
        self.kept = handle.getListState("kept", point)
        self.waiting = handle.getListState("waiting", point)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        points = [(t, v) for frame in rows for t, v in zip(frame["ts"].tolist(), frame["value"].tolist())]
        if points:
            self.waiting.appendList(points)
            for ts in {t for t, _ in points}:
                self.handle.registerTimer(ts)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        waiting = [tuple(x) for x in self.waiting.get()] if self.waiting.exists() else []
        kept = [tuple(x) for x in self.kept.get()] if self.kept.exists() else []
        mark = timerValues.getCurrentWatermarkInMs()
        # one call takes all that the watermark has passed; the timers of the rest of them find nothing
        due = sorted(x for x in waiting if x[0] <= max(now, mark))
        if not due:
            if not waiting and (not kept or kept[-1][0] + self.idle <= now):
                self.kept.clear()
                self.waiting.clear()
            return
        rest = [x for x in waiting if x[0] > due[-1][0]]
        low, first = [], 0
        for ts, value in due:
            if self.window is None:
                low.append(kept[-1] if kept else (ts, value))
                kept = [(ts, value)]
                continue
            kept.append((ts, value))
            edge, gone = ts - self.window, None
            while kept[first][0] < edge:
                gone = kept[first]
                first += 1
            low.append(gone if gone is not None and edge - gone[0] <= kept[first][0] - edge else kept[first])
        kept = kept[first:]
        self.kept.put(kept)
        if rest:
            self.waiting.put(rest)
        else:
            self.waiting.clear()
        self.handle.registerTimer(kept[-1][0] + self.idle)
        yield pd.DataFrame({"name": key[0], "_lk": key[1], "ts": [t for t, _ in due], "value": [v for _, v in due],
                            "low_ts": [t for t, _ in low], "low_value": [v for _, v in low]})

    def close(self) -> None:
        pass


def look_back(samples: DataFrame, window_ms: int | None, delay: str = "1 minute", idle_ms: int = 86_400_000) -> DataFrame:
    """Streaming look-back per (name, labels); without a window the previous sample.

    A series without samples for ``idle_ms`` (at least two windows) is forgotten and starts afresh.
    """
    slim = (samples.select("name", L.key_of(F.col("labels")).alias("_lk"), "ts", "value", F.timestamp_millis("ts").alias("_time"))
            .withWatermark("_time", delay))
    out = slim.groupBy("name", "_lk").transformWithStateInPandas(
        Counter(window_ms, max(idle_ms, 2 * (window_ms or 0))),
        outputStructType="name string, _lk string, ts bigint, value double, low_ts bigint, low_value double",
        outputMode="append", timeMode="EventTime")
    return out.withColumn("labels", L.from_key(F.col("_lk"))).drop("_lk")


def rates(samples: DataFrame, window_ms: int | None, delay: str = "1 minute", idle_ms: int = 86_400_000) -> DataFrame:
    from ..operators.counters import _per_second

    return look_back(samples, window_ms, delay, idle_ms).withColumn("value", _per_second()).drop("low_ts", "low_value")
