"""Inventories of services, instances, endpoints and processes, and the queries over them."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids, text


def services(rows: DataFrame) -> DataFrame:
    """Distinct (name, layer) with group, short name and first bucket."""
    out = rows.groupBy("name", "layer").agg(F.min("time_bucket").alias("time_bucket"))
    return out.select("name", "layer", text.group_of(F.col("name")).alias("group"), text.short_name(F.col("name")).alias("short_name"),
                      ids.service_id(F.col("name")).alias("service_id"), "time_bucket")


def merged_properties(rows: DataFrame, key: Sequence[str], order: str = "last_ping") -> DataFrame:
    """Property maps merged key by key; the value with the latest ping wins."""
    flat = rows.select(*key, order, F.explode("properties").alias("_k", "_v"))
    newest = flat.groupBy(*key, "_k").agg(F.max_by("_v", F.struct(order, "_v")).alias("_v"))
    return newest.groupBy(*key).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("_k", "_v")))).alias("properties"))


def instances(pings: DataFrame) -> DataFrame:
    """Instance inventory from pings (service, name, time_bucket, last_ping, properties)."""
    key = ["service", "name"]
    base = pings.groupBy(*key).agg(F.max("last_ping").alias("last_ping"), F.min("time_bucket").alias("time_bucket"))
    if "properties" not in pings.columns:
        return base
    return base.join(merged_properties(pings, key), key, "left")


def endpoints(rows: DataFrame) -> DataFrame:
    return rows.select("service", "name").distinct()


def processes(pings: DataFrame) -> DataFrame:
    """Process inventory: latest ping, last non-blank agent, labels and detect type, merged properties, first bucket."""
    key = ["process_id", "service", "instance", "name"]
    last = lambda c: F.max_by(F.col(c), F.when(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) != "", F.struct("last_ping", c)))
    base = pings.groupBy(*key).agg(F.max("last_ping").alias("last_ping"), F.min("time_bucket").alias("time_bucket"),
                                   last("agent_id").alias("agent_id"), last("labels").alias("labels"),
                                   last("detect_type").alias("detect_type"), F.max("profiling_support").alias("profiling_support"))
    return base.join(merged_properties(pings, key), key, "left") if "properties" in pings.columns else base


def tag_dictionary(rows: DataFrame, tag_type: str, tags: str = "tags") -> DataFrame:
    """Distinct (type, key, value) per minute from ``key=value`` tag arrays."""
    t = rows.select(F.col("time_bucket"), F.explode(tags).alias("t"))
    return t.select(F.lit(tag_type).alias("tag_type"), F.substring_index("t", "=", 1).alias("tag_key"),
                    F.expr("substring(t, instr(t, '=') + 1)").alias("tag_value"), "time_bucket").distinct()


# ---- queries ----

def list_layers(svc: DataFrame) -> DataFrame:
    return svc.select("layer").distinct()


def list_services(svc: DataFrame, layer: str | None = None, group: str | None = None, limit: int | None = None) -> DataFrame:
    if layer:
        svc = svc.filter(F.col("layer") == layer)
    if group:
        svc = svc.filter(F.col("group") == group)
    return svc.orderBy("name", "layer").limit(limit) if limit else svc


def live_instances(inst: DataFrame, service: str, start: int | None = None, end: int | None = None, limit: int | None = None) -> DataFrame:
    """Instances that pinged after the start and existed before the end."""
    out = inst.filter(F.col("service") == service)
    if start is not None:
        out = out.filter(F.col("last_ping") >= start)
    if end is not None:
        out = out.filter(F.col("time_bucket") <= end)
    return out.orderBy("name").limit(limit) if limit else out


def find_endpoints(ep: DataFrame, service: str, keyword: str = "", limit: int = 10) -> DataFrame:
    out = ep.filter(F.col("service") == service)
    if keyword:
        out = out.filter(F.col("name").contains(keyword))
    return out.orderBy("name").limit(limit)


def list_processes(proc: DataFrame, service: str | None = None, instance: str | None = None, agent: str | None = None,
                   supported: bool | None = None, start: int = 0, end: int = 0, include_virtual: bool = False) -> DataFrame:
    for column, want in (("service", service), ("instance", instance), ("agent_id", agent)):
        if want:
            proc = proc.filter(F.col(column) == want)
    if supported is not None:
        proc = proc.filter(F.col("profiling_support") == int(supported))
    if start:
        proc = proc.filter(F.col("last_ping") >= start)
    if end:
        proc = proc.filter(F.col("time_bucket") <= end)
    return proc if include_virtual else proc.filter(F.col("detect_type") != "VIRTUAL")


def process_count(proc: DataFrame, **conditions) -> DataFrame:
    return list_processes(proc, **conditions).agg(F.count(F.lit(1)).alias("total"))


def tag_keys(tags: DataFrame, tag_type: str, start: int, end: int, limit: int = 100) -> DataFrame:
    return (tags.filter((F.col("tag_type") == tag_type) & F.col("time_bucket").between(start, end))
            .select("tag_key").distinct().orderBy("tag_key").limit(limit))


def tag_values(tags: DataFrame, tag_type: str, key: str, start: int, end: int, limit: int = 100) -> DataFrame:
    return (tags.filter((F.col("tag_type") == tag_type) & (F.col("tag_key") == key) & F.col("time_bucket").between(start, end))
            .select("tag_value").distinct().orderBy("tag_value").limit(limit))
