"""Zipkin spans to searchable span rows and inventories."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.timebucket import bucket_of
from ..operators.topk import first_per_group

SPAN_JSON = ("array<struct<traceId:string,parentId:string,id:string,kind:string,name:string,timestamp:bigint,duration:bigint,"
             "debug:boolean,shared:boolean,localEndpoint:struct<serviceName:string,ipv4:string,ipv6:string,port:int>,"
             "remoteEndpoint:struct<serviceName:string,ipv4:string,ipv6:string,port:int>,"
             "annotations:array<struct<timestamp:bigint,value:string>>,tags:map<string,string>>>")
# Longest searchable annotation and tag, longest name.
QUERY_LENGTH, TAG_LENGTH = 256, 256
UNKNOWN = "Unknown"


def from_json(payloads: DataFrame, body: str = "value") -> DataFrame:
    """Span arrays as sent by reporters to one row per span."""
    s = payloads.select(F.explode(F.from_json(F.col(body).cast("string"), SPAN_JSON)).alias("s"))
    return s.select(F.col("s.traceId").alias("trace_id"), F.col("s.parentId").alias("parent_id"), F.col("s.id").alias("span_id"),
                    F.col("s.kind").alias("kind"), F.col("s.name").alias("name"), F.col("s.timestamp").alias("timestamp_us"),
                    F.col("s.duration").alias("duration_us"), F.coalesce("s.debug", F.lit(False)).alias("debug"),
                    F.coalesce("s.shared", F.lit(False)).alias("shared"), F.col("s.localEndpoint.serviceName").alias("local_service"),
                    F.col("s.remoteEndpoint.serviceName").alias("remote_service"), F.col("s.annotations").alias("annotations"),
                    F.col("s.tags").alias("tags"))


def span_rows(spans: DataFrame) -> DataFrame:
    """Adds names cut to length, millisecond time, second bucket and the searchable ``query`` array.

    ``query`` holds annotations, tag keys and ``key=value`` texts that are not too long.
    """
    local = F.when(F.coalesce("local_service", F.lit("")) == "", UNKNOWN).otherwise(F.col("local_service"))
    annotations = F.filter(F.transform(F.coalesce("annotations", F.expr("cast(array() as array<struct<timestamp:bigint,value:string>>)")),
                                       lambda a: a["value"]), lambda v: F.length(v) <= QUERY_LENGTH)
    entries = F.sort_array(F.map_entries(F.coalesce("tags", F.expr("map_from_entries(cast(array() as array<struct<key:string,value:string>>))"))))
    fitting = F.filter(entries, lambda e: (F.length(e["value"]) <= TAG_LENGTH)
                       & (F.length(F.concat(e["key"], F.lit("="), e["value"])) <= TAG_LENGTH))
    pairs = F.flatten(F.transform(fitting, lambda e: F.array(e["key"], F.concat(e["key"], F.lit("="), e["value"]))))
    ts = F.timestamp_micros("timestamp_us")
    return (spans.withColumn("local_service", text.service_name(local))
            .withColumn("remote_service", text.service_name(F.col("remote_service")))
            .withColumn("name", text.endpoint_name(F.col("name")))
            .withColumn("duration_us", F.coalesce("duration_us", F.lit(0)))
            .withColumn("timestamp_ms", F.call_function("div", F.col("timestamp_us"), F.lit(1000).cast("bigint")))
            .withColumn("time_bucket", bucket_of(ts, "second")).withColumn("query", F.concat(annotations, pairs)))


def inventories(rows: DataFrame, searchable: Sequence[str] = ("http.method",)) -> dict[str, DataFrame]:
    """Distinct services, span names, remote services and searchable tags."""
    minute = F.call_function("div", F.col("time_bucket"), F.lit(100).cast("bigint")).alias("time_bucket")
    tags = rows.select(F.explode(F.map_filter("tags", lambda k, v: k.isin(list(searchable)) & (F.length(v) <= TAG_LENGTH))).alias("tag_key", "tag_value"), minute)
    return {
        "services": rows.select(F.col("local_service").alias("service")).distinct(),
        "span_names": rows.select(F.col("local_service").alias("service"), F.col("name").alias("span_name")).distinct(),
        "remote_services": rows.filter(F.coalesce("remote_service", F.lit("")) != "")
                               .select(F.col("local_service").alias("service"), "remote_service").distinct(),
        "tags": tags.select(F.lit("ZIPKIN").alias("tag_type"), "tag_key", "tag_value", "time_bucket").distinct(),
    }


def sample(spans: DataFrame, rate: int = 10000, max_per_second: int | None = None) -> DataFrame:
    """Keep whole traces by their id; debug spans always. ``max_per_second`` caps the rest per second of event time,
    ranked within each map side first, so a busy second is never sorted in one task."""
    debug = F.coalesce("debug", F.lit(False))
    out = spans
    if max_per_second is not None:
        counted = out.filter(~debug).withColumn("_second", F.call_function("div", F.col("timestamp_us"), F.lit(1_000_000).cast("bigint")))
        kept = first_per_group(counted, ["_second"], [F.col("timestamp_us").asc(), F.col("span_id").asc()], max_per_second).drop("_second")
        out = out.filter(debug).unionByName(kept)
    if rate < 10000:
        out = out.filter(debug | (trace_number(F.col("trace_id")) <= int((2 ** 63 - 1) * (rate / 10000))))
    return out


def trace_number(trace_id: Column) -> Column:
    """Absolute value of the low 64 bits of a hexadecimal trace id read as a signed number."""
    low = F.lpad(F.substring(trace_id, -16, 16), 16, "0")
    high, rest = F.conv(F.substring(low, 1, 8), 16, 10).cast("bigint"), F.conv(F.substring(low, 9, 8), 16, 10).cast("bigint")
    signed = F.when(high >= 2 ** 31, high - 2 ** 32).otherwise(high)
    # the most negative number has no counterpart and reads as the largest one
    lowest = (signed == -(2 ** 31)) & (rest == 0)
    value = signed * F.lit(2 ** 32) + rest
    return F.when(lowest, F.lit(2 ** 63 - 1)).otherwise(F.abs(value))


# ---- queries ----

def search(rows: DataFrame, service: str | None = None, remote: str | None = None, span_name: str | None = None,
           min_us: int | None = None, max_us: int | None = None, annotation_query: Sequence[str] = (), start_ms: int | None = None,
           end_ms: int | None = None, limit: int = 10) -> DataFrame:
    """Newest traces with a span that satisfies every condition. Columns: trace_id, timestamp_us."""
    for column, want in (("local_service", service), ("remote_service", remote), ("name", span_name)):
        if want:
            rows = rows.filter(F.col(column) == want)
    if min_us is not None:
        rows = rows.filter(F.col("duration_us") >= min_us)
    if max_us is not None:
        rows = rows.filter(F.col("duration_us") <= max_us)
    if start_ms is not None:
        rows = rows.filter(F.col("timestamp_ms") >= start_ms)
    if end_ms is not None:
        rows = rows.filter(F.col("timestamp_ms") <= end_ms)
    for q in annotation_query:
        rows = rows.filter(F.array_contains("query", q))
    return (rows.groupBy("trace_id").agg(F.min("timestamp_us").alias("timestamp_us"))
            .orderBy(F.col("timestamp_us").desc(), "trace_id").limit(limit))


def spans_of(rows: DataFrame, traces: DataFrame) -> DataFrame:
    return rows.join(traces.select("trace_id"), "trace_id", "left_semi")


def names(inventory: DataFrame, column: str, limit: int, **where: str) -> DataFrame:
    """Names of an inventory, at most ``limit``."""
    for k, v in where.items():
        inventory = inventory.filter(F.col(k) == v)
    return inventory.select(column).distinct().orderBy(column).limit(limit)
