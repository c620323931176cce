"""Events, alarm records and browser errors: conditions and attachment."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _conjunction(condition: Mapping) -> Column:
    out = F.lit(True)
    for name, want in condition.items():
        if want is None or want == "":
            continue
        if name == "after":
            out = out & (F.col("timestamp") > want)
        elif name == "before":
            out = out & (F.col("timestamp") < want)
        else:
            out = out & (F.col(name) == want)
    return out


def filter_events(events: DataFrame, conditions: Sequence[Mapping]) -> DataFrame:
    """Events that satisfy any of the conditions. A condition names columns (uuid, service, instance, endpoint, name,
    type, layer) and exclusive bounds ``after`` and ``before`` on the timestamp."""
    any_of = F.lit(False)
    for c in conditions:
        any_of = any_of | _conjunction(c)
    return events.filter(F.coalesce(any_of, F.lit(False))) if conditions else events


def filter_alarms(alarms: DataFrame, scope: str | None = None, keyword: str | None = None, layer: str | None = None,
                  rules: Sequence[str] = (), entities: Sequence[Mapping[str, str]] = (), tags: Sequence[str] = (),
                  bounds: tuple[int, int] | None = None) -> DataFrame:
    """Alarm records, newest first is left to the page. ``entities`` are id0/id1 constraints: any of them, each in full."""
    if bounds:
        alarms = alarms.filter(F.col("time_bucket").between(*bounds))
    if scope:
        alarms = alarms.filter(F.col("scope") == scope)
    if keyword:
        alarms = alarms.filter(F.col("message").contains(keyword))
    if layer:
        alarms = alarms.filter(F.col("layer") == layer)
    if rules:
        alarms = alarms.filter(F.col("rule").isin(list(rules)))
    if entities:
        any_of = F.lit(False)
        for e in entities:
            part = F.lit(True)
            for k in ("id0", "id1"):
                if e.get(k) is not None:
                    part = part & (F.col(k) == e[k])
            any_of = any_of | part
        alarms = alarms.filter(any_of)
    for t in tags:
        alarms = alarms.filter(F.array_contains("tags", t))
    return alarms


def entity_constraints(entity_id: str, relation_to: str | None = None) -> list[dict[str, str]]:
    """One entity matches either end of a relation; a relation matches both ends exactly."""
    return [{"id0": entity_id, "id1": relation_to}] if relation_to else [{"id0": entity_id}, {"id1": entity_id}]


def attach_events(page: DataFrame, events: DataFrame, after: int | None = None, before: int | None = None) -> DataFrame:
    """Events whose source is either end of an alarm, inside the query's exclusive bounds.

    One row per (alarm, event); alarms without events are kept. ``page`` is a limited page of alarms (alarm_id, id0,
    id1, ...) and ``events`` carry the ``entity_id`` of their source. Nest the rows afterwards if needed.
    """
    bounds = _conjunction({"after": after, "before": before})
    e = events.filter(bounds).select("entity_id", "uuid", F.col("timestamp").alias("event_time"), F.col("name").alias("event_name"))
    ends = page.select("alarm_id", F.explode(F.array_distinct(F.array("id0", "id1"))).alias("entity_id")).filter(F.coalesce("entity_id", F.lit("")) != "")
    hits = ends.join(e, "entity_id").select("alarm_id", "uuid", "event_time", "event_name")
    return page.join(hits, "alarm_id", "left")


def filter_browser_errors(errors: DataFrame, service: str | None = None, version: str | None = None, page: str | None = None,
                          category: str | None = None, bounds: tuple[int, int] | None = None) -> DataFrame:
    if bounds:
        errors = errors.filter(F.col("time_bucket").between(*bounds))
    for column, want in (("service", service), ("version", version), ("page", page), ("category", category)):
        if want:
            errors = errors.filter(F.col(column) == want)
    return errors
