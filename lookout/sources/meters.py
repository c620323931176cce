"""Scraped and pushed measurements to samples (name, labels, ts in ms, value)."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.text import whole

LONG_MIN = -(2 ** 63)


def escape_name(name: Column) -> Column:
    """Dots and slashes become underscores."""
    return F.regexp_replace(name, "[./]", "_")


def prometheus(metrics: DataFrame) -> DataFrame:
    """Families to samples. Histograms and summaries also give ``_count`` and ``_sum``.

    Input: name, kind (counter, gauge, histogram, summary), labels, ts, value, count, sum, buckets map double to bigint,
    quantiles map double to double.
    """
    name, k = escape_name(F.col("name")), F.col("kind")
    item = lambda n, labels, v: F.struct(n.alias("name"), labels.alias("labels"), v.cast("double").alias("value"))
    totals = F.array(item(F.concat(name, F.lit("_count")), F.col("labels"), F.col("count")),
                     item(F.concat(name, F.lit("_sum")), F.col("labels"), F.col("sum")))
    none = F.slice(totals, F.lit(1), F.lit(0))
    spread = lambda column, key: F.coalesce(F.transform(F.map_entries(column), lambda e: item(
        name, L.put(F.col("labels"), key, e["key"].cast("string")), e["value"])), none)
    items = (F.when(k.isin("counter", "gauge"), F.array(item(name, F.col("labels"), F.col("value"))))
             .when(k == "histogram", F.concat(totals, spread("buckets", "le")))
             .when(k == "summary", F.concat(totals, spread("quantiles", "quantile"))))
    return metrics.select("ts", F.inline(items)).select("name", "labels", "ts", "value")


def agent_meters(meters: DataFrame) -> DataFrame:
    """Agent meters, single values and histograms; rows lacking service, instance or time are dropped.

    Input: service, instance, ts, name, labels, value, buckets array of (bucket, negative_infinity, count). Bucket
    bounds are milliseconds already; the bucket open to minus infinity has the smallest long as bound.
    """
    ok = (F.coalesce("service", F.lit("")) != "") & (F.coalesce("instance", F.lit("")) != "") & (F.coalesce("ts", F.lit(0)) > 0)
    labels = F.map_zip_with(F.col("labels"), F.create_map(F.lit("service"), F.col("service"), F.lit("instance"), F.col("instance")),
                            lambda _, a, b: F.coalesce(b, a))
    rows = meters.filter(ok).withColumn("_labels", labels)
    single = F.array(F.struct(F.col("_labels").alias("labels"), F.col("value").cast("double").alias("value")))
    bound = lambda b: F.when(b["negative_infinity"], str(LONG_MIN)).otherwise(b["bucket"].cast("string"))
    spread = F.transform("buckets", lambda b: F.struct(L.put(F.col("_labels"), "le", bound(b)).alias("labels"), b["count"].cast("double").alias("value")))
    return rows.select("name", "ts", F.inline(F.when(F.col("buckets").isNull(), single).otherwise(spread))).select("name", "labels", "ts", "value")


def telegraf(points: DataFrame) -> DataFrame:
    """Points (name, tags, fields map of texts, timestamp in s): every numeric field is a sample ``name_field``."""
    rows = points.select("name", "tags", "timestamp", F.explode("fields").alias("_k", "_v"))
    value = F.col("_v").try_cast("double")
    return (rows.filter(value.isNotNull())
            .select(F.concat_ws("_", "name", "_k").alias("name"), F.col("tags").alias("labels"), (F.col("timestamp") * 1000).alias("ts"), value.alias("value")))


def zabbix(items: DataFrame, config_labels: Mapping[str, str] | None = None, host_pattern: str | None = None) -> DataFrame:
    """Agent items (host, key, value, clock, state). ``key[p1,p2]`` gives the labels 1 and 2; quoted parameters may
    hold commas. Items in error and values that are no numbers are left out."""
    rows = items.filter((F.col("state") == 0) & F.col("value").try_cast("double").isNotNull())
    if host_pattern:
        rows = rows.filter(F.col("host").rlike(whole(host_pattern)))
    has = F.col("key").contains("[") & F.col("key").endswith("]")
    inner = F.regexp_extract("key", r"^[^\[]*\[(.*)\]$", 1)
    pieces = F.transform(F.regexp_extract_all(inner, F.lit(r'("[^"]*"|[^,]*)(,|$)'), F.lit(1)), lambda p: F.regexp_replace(p, r'^"(.*)"$', "$1"))
    # the pattern also matches the empty end unless the text itself ends in a comma
    params = F.when(inner.endswith(",") | (inner == ""), pieces).otherwise(F.slice(pieces, F.lit(1), F.size(pieces) - 1))
    numbered = F.map_from_entries(F.transform(params, lambda p, i: F.struct((i + 1).cast("string").alias("key"), p.alias("value"))))
    extra = F.create_map(*[F.lit(x) for kv in (config_labels or {}).items() for x in kv], F.lit("host"), F.col("host"))
    labels = F.map_zip_with(F.when(has, numbered).otherwise(L.empty()), extra, lambda _, a, b: F.coalesce(b, a))
    name = F.replace(F.when(has, F.regexp_extract("key", r"^([^\[]*)\[", 1)).otherwise(F.col("key")), F.lit("."), F.lit("_"))
    return rows.select(name.alias("name"), labels.alias("labels"), (F.col("clock") * 1000).alias("ts"), F.col("value").try_cast("double").alias("value"))
