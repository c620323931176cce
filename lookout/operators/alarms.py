"""Alarm rules: sliding windows of minutes, conditions over them and the firing state machine."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text

NORMAL, FIRING, SILENCED, OBSERVING, RECOVERED = "NORMAL", "FIRING", "SILENCED_FIRING", "OBSERVING_RECOVERY", "RECOVERED"


@dataclass(frozen=True)
class AlarmRule:
    """``aggregates`` are named aggregate columns over the window's minutes; ``condition`` is a boolean over them.

    Example: ``aggregates={"hits": F.sum((F.col("resp_time") > 1000).cast("int"))}, condition=F.col("hits") >= 1``.
    """

    name: str
    aggregates: Callable[[], Mapping[str, Column]]
    condition: Callable[[], Column]
    period: int
    silence: int = 5
    recovery: int = 0
    message: str = ""
    scope: str = "Service"
    tags: tuple[str, ...] = ()
    expression: str = ""
    hooks: tuple[str, ...] = ()
    layers: tuple[str, ...] = ()
    include: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()
    include_regex: str | None = None
    exclude_regex: str | None = None


def select_entities(df: DataFrame, rule: AlarmRule, name: str = "name") -> DataFrame:
    """Include and exclude lists and full-match regular expressions, all of which must allow the name."""
    c = F.col(name)
    if rule.include:
        df = df.filter(c.isin(list(rule.include)))
    if rule.exclude:
        df = df.filter(~c.isin(list(rule.exclude)))
    if rule.include_regex:
        df = df.filter(c.rlike(text.whole(rule.include_regex)))
    if rule.exclude_regex:
        df = df.filter(~c.rlike(text.whole(rule.exclude_regex)))
    return df


def windows(minutes: DataFrame, rule: AlarmRule, entity: Sequence[str] = ("entity_id",), labels: Sequence[str] = ()) -> DataFrame:
    """One row per entity and minute whose window holds any data, with ``match``.

    ``minutes`` has one row per entity (and label) and ``minute`` timestamp. A minute counts towards the ``period``
    windows that contain it, which is a sliding time window: a plain hash aggregation in batch and in streams.
    With labels a tick matches when any label does.
    """
    sliding = F.window("minute", f"{rule.period} minutes", "1 minute")
    aggs = [c.alias(n) for n, c in rule.aggregates().items()]
    out = (minutes.groupBy(*entity, *labels, sliding.alias("_w")).agg(*aggs)
           .withColumn("minute", F.col("_w.end") - F.expr("INTERVAL 1 MINUTE")).drop("_w")
           .withColumn("match", F.coalesce(rule.condition(), F.lit(False))))
    if labels:
        return out.groupBy(*entity, "minute").agg(F.max("match").alias("match"))
    return out


def step(state: str, silence: int, recovery: int, match: bool, silence_period: int, recovery_period: int) -> tuple[str, int, int]:
    """One tick of the state machine."""
    silence -= 1
    if not match:
        recovery -= 1
    nxt = state
    if match:
        if state == NORMAL:
            nxt = FIRING
        elif state == FIRING:
            nxt = SILENCED if silence >= 0 else None
        else:
            nxt = FIRING if silence < 0 else SILENCED
    elif state in (FIRING, SILENCED):
        nxt = RECOVERED if recovery < 0 and silence < 0 else OBSERVING
    elif state == OBSERVING:
        nxt = RECOVERED if recovery < 0 and silence < 0 else None
    elif state == RECOVERED:
        nxt = NORMAL
    else:
        nxt = None
    if nxt is None:
        # stays where it is, without the effects of entering the state
        return state, silence, recovery
    if nxt == FIRING:
        silence, recovery = silence_period, recovery_period
    elif nxt == OBSERVING:
        recovery = recovery_period - 1
    elif nxt in (RECOVERED, NORMAL):
        recovery = recovery_period
    return nxt, silence, recovery


def run_machine(ticks: pd.DataFrame, rule_silence: int, rule_recovery: int, start=None) -> tuple[list[str], tuple]:
    """States of consecutive minutes. A missing minute means that the window ran empty: the entity starts afresh."""
    state, silence, recovery, last = start or (NORMAL, -1, rule_recovery, None)
    out = []
    for minute, match in zip(ticks["tick"].tolist(), ticks["match"].tolist()):
        if last is not None and minute != last + 1:
            state, silence, recovery = NORMAL, -1, rule_recovery
        state, silence, recovery = step(state, silence, recovery, bool(match), rule_silence, rule_recovery)
        out.append(state)
        last = minute
    return out, (state, silence, recovery, last)


class Machine:
    """The state machine as a table over numbers: ``after[match][number]``.

    A number stands for a state with its two counters. These only matter until they fall below zero, so they stop at -1
    and there are 5 * (silence + 2) * (recovery + 2) numbers. A run of minutes is then a map of numbers, and the map of
    two runs is one map after the other, which is what lets runs of one entity be taken apart.
    """

    names = (NORMAL, FIRING, SILENCED, OBSERVING, RECOVERED)

    def __init__(self, silence: int, recovery: int):
        self.silence, self.recovery = silence, recovery
        self.size = len(self.names) * (silence + 2) * (recovery + 2)
        self.start = self.number(NORMAL, -1, recovery)
        self.after = np.empty((2, self.size), dtype=np.int32)
        for n in range(self.size):
            for match in (0, 1):
                self.after[match, n] = self.number(*step(*self.state(n), bool(match), silence, recovery))

    def number(self, state: str, silence: int, recovery: int) -> int:
        return (self.names.index(state) * (self.silence + 2) + max(silence, -1) + 1) * (self.recovery + 2) + max(recovery, -1) + 1

    def state(self, number: int) -> tuple[str, int, int]:
        rest, recovery = divmod(number, self.recovery + 2)
        name, silence = divmod(rest, self.silence + 2)
        return self.names[name], silence - 1, recovery - 1

    def over(self, ticks: Sequence[int], matches: Sequence[bool]) -> np.ndarray:
        """Where each number gets to by these minutes. A missing minute sets all back to the start."""
        at, last = np.arange(self.size), None
        for tick, match in zip(ticks, matches):
            if last is not None and tick != last + 1:
                at = np.full(self.size, self.start)
            at = self.after[int(match)][at]
            last = tick
        return at

    def run(self, number: int, ticks: Sequence[int], matches: Sequence[bool]) -> list[str]:
        out, last = [], None
        for tick, match in zip(ticks, matches):
            if last is not None and tick != last + 1:
                number = self.start
            number = int(self.after[int(match), number])
            out.append(self.state(number)[0])
            last = tick
        return out


def states(ticks: DataFrame, rule: AlarmRule, entity: Sequence[str] = ("entity_id",), chunk: int = 1440) -> DataFrame:
    """State after every tick, one row per entity and minute. An entity's minutes are dealt out in chunks.

    Each chunk first becomes a map of machine states (:class:`Machine`). Following an entity's maps, one row a chunk,
    gives the state in which each chunk starts; then the chunks run alone. Tasks are as even as chunks are, however
    many minutes one entity has.
    """
    machine, keys = Machine(rule.silence, rule.recovery), list(entity)
    tick = F.expr("unix_seconds(cast(minute as timestamp)) div 60")
    # both passes use one exchange
    slim = (ticks.select(*keys, "minute", "match", tick.alias("tick")).withColumn("chunk", F.call_function("div", F.col("tick"), F.lit(chunk).cast("bigint")))
            .repartition(*keys, "chunk"))
    kinds = {f.name: f.dataType.simpleString() for f in slim.schema}
    head = ", ".join(f"`{c}` {kinds[c]}" for c in (*keys, "chunk"))

    def mapped(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("tick")
        ends = machine.over(pdf["tick"].tolist(), pdf["match"].tolist())
        return pdf[[*keys, "chunk"]].head(1).assign(first=pdf["tick"].iloc[0], last=pdf["tick"].iloc[-1], ends=[ends.tolist()])

    def followed(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("chunk")
        number, before, out = machine.start, None, []
        for first, last, ends in zip(pdf["first"].tolist(), pdf["last"].tolist(), pdf["ends"]):
            if first - 1 != before:
                number = machine.start
            out.append(number)
            number, before = int(ends[number]), last
        return pdf[[*keys, "chunk"]].assign(start=out)

    def ran(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("tick")
        pdf["state"] = machine.run(int(pdf["start"].iloc[0]), pdf["tick"].tolist(), pdf["match"].tolist())
        return pdf[[*keys, "minute", "match", "state"]]

    maps = slim.groupBy(*keys, "chunk").applyInPandas(mapped, f"{head}, first bigint, last bigint, ends array<int>")
    starts = maps.groupBy(*keys).applyInPandas(followed, f"{head}, start int")
    same = [slim[c].eqNullSafe(starts[c]) for c in (*keys, "chunk")]
    placed = slim.join(starts, same).select(*[slim[c] for c in slim.columns], "start")
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in (*keys, "minute", "match")) + ", state string"
    return placed.groupBy(*keys, "chunk").applyInPandas(ran, schema)


def messages(state_rows: DataFrame, rule: AlarmRule, id0: str = "entity_id", name: str = "name", entity: Sequence[str] = ("entity_id",)) -> DataFrame:
    """Rows for firing and recovery ticks. A firing that is not silenced fires again every minute.

    A recovery belongs to the last firing of its entity: both carry that firing's ``firing_id`` and ``start_minute``.
    Only firing and recovery rows are put in order for that.
    """
    out = state_rows.filter(F.col("state").isin(FIRING, RECOVERED))
    body = text.template(rule.message, id=F.col(id0), name=F.col(name) if name in state_rows.columns else F.col(id0))
    texts = lambda values: F.array(*[F.lit(v) for v in values]).cast("array<string>")
    so_far = Window.partitionBy(*entity).orderBy("minute").rowsBetween(Window.unboundedPreceding, 0)
    start = F.last(F.when(F.col("state") == FIRING, F.col("minute")), ignorenulls=True).over(so_far)
    seconds = F.unix_seconds(F.col("start_minute").cast("timestamp")).cast("string")
    return (out.withColumn("rule", F.lit(rule.name)).withColumn("scope", F.lit(rule.scope)).withColumn("message", body)
            .withColumn("period", F.lit(rule.period)).withColumn("recovered", F.col("state") == RECOVERED)
            .withColumn("tags", texts(rule.tags)).withColumn("expression", F.lit(rule.expression)).withColumn("hooks", texts(rule.hooks))
            .withColumn("layers", texts(rule.layers)).withColumn("start_minute", start)
            .withColumn("firing_id", F.concat_ws("@", F.lit(rule.name), *[F.col(c).cast("string") for c in entity], seconds)))


def with_snapshot(found: DataFrame, minutes: DataFrame, rule: AlarmRule, values: Sequence[str], entity: Sequence[str] = ("entity_id",)) -> DataFrame:
    """Adds ``snapshot``: the window's minutes and ``values`` at the firing, in order; a recovery shows those of its firing.

    Only the minutes of windows that fired are joined, by equality: a message asks for the ``period`` minutes it saw.
    """
    keys = list(entity)
    back = F.sequence(F.lit(0), F.lit(rule.period - 1))
    fired = found.select(*keys, "start_minute").distinct()
    asked = fired.select(*keys, "start_minute", F.explode(back).alias("_back")).select(
        *keys, "start_minute", (F.col("start_minute") - F.make_dt_interval(mins=F.col("_back"))).alias("minute"))
    seen = asked.join(minutes.select(*keys, "minute", *values), [*keys, "minute"]).groupBy(*keys, "start_minute").agg(
        F.sort_array(F.collect_list(F.struct("minute", *values))).alias("snapshot"))
    return found.join(seen, [*keys, "start_minute"], "left")


def evaluate(minutes: DataFrame, rule: AlarmRule, entity: Sequence[str] = ("entity_id",), labels: Sequence[str] = (),
             name: str | None = None, values: Sequence[str] = ()) -> DataFrame:
    """Messages of a rule over minutes of metric values; with ``values`` also what the firing window held of them."""
    rows = select_entities(minutes, rule, name) if name else minutes
    found = messages(states(windows(rows, rule, entity, labels), rule, entity), rule, entity[0], entity=entity)
    return with_snapshot(found, rows, rule, [*labels, *values], entity) if values else found


def split_late(minutes: DataFrame, rule: AlarmRule, arrival: str = "arrival", block: int = 1440) -> tuple[DataFrame, DataFrame]:
    """Values that reach the alarm's window, and apart from them those that come too late for it.

    The window ends with the newest minute that has arrived so far, so a value is too late when it is ``period``
    minutes or more behind that. ``arrival`` is a whole number that orders the arrivals, equal numbers come together; rows
    without one are left out. The running maximum is taken over one row per arrival, in blocks; of the blocks
    themselves there is one row each. :func:`lookout.streaming.metrics.late_batch` is the form for streams.
    """
    rows = minutes.withColumn("_tick", F.expr("unix_seconds(cast(minute as timestamp)) div 60"))
    seen = rows.groupBy(F.col(arrival).alias("_a")).agg(F.max("_tick").alias("_most"))
    seen = seen.withColumn("_block", F.call_function("div", F.col("_a").cast("bigint"), F.lit(block).cast("bigint")))
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = seen.groupBy("_block").agg(F.max("_most").alias("_top")).select("_block", F.max("_top").over(earlier).alias("_before"))
    inside = Window.partitionBy("_block").orderBy("_a").rowsBetween(Window.unboundedPreceding, 0)
    newest = seen.join(before, "_block").select("_a", F.greatest(F.max("_most").over(inside), "_before").alias("_newest"))
    marked = rows.join(newest, F.col(arrival) == F.col("_a")).withColumn("_late", F.col("_tick") <= F.col("_newest") - rule.period)
    return tuple(marked.filter(c).select(*minutes.columns) for c in (~F.col("_late"), F.col("_late")))
