"""Trace analysis: segments and spans to traffic rows, virtual services, segment rows and span trees.

A segment row is (trace_id, segment_id, service, instance, spans); a span row carries the segment's columns and
span_id, parent_span_id, start_time, end_time (ms), operation, peer, span_type, span_layer, component_id, is_error,
skip_analysis, tags (array of key/value) and refs (array of parent references).
"""

from __future__ import annotations

from functools import reduce
from typing import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ids, text
from ..functions.timebucket import bucket_of_millis
from ..plans.runtime import delete, lookup, lookup_join, stored

TAGS_TYPE = "array<struct<key:string,value:string>>"
REFS_TYPE = ("array<struct<ref_type:string,trace_id:string,parent_segment_id:string,parent_span_id:int,"
             "parent_service:string,parent_instance:string,parent_endpoint:string,network_address:string>>")
SPAN_FIELDS = ("span_id", "parent_span_id", "start_time", "end_time", "operation", "peer", "span_type", "span_layer",
               "component_id", "is_error", "skip_analysis", "tags", "refs")
#: what :func:`segment_rows` is made of; all fields up to the operation, so that spans keep their order
SEARCH_FIELDS = ("span_id", "parent_span_id", "start_time", "end_time", "operation", "span_type", "is_error", "tags")
SEARCHABLE = ("http.method", "http.status_code", "rpc.status_code", "db.type", "db.instance", "mq.queue", "mq.topic", "mq.broker")
# Fixed values of the data model.
USER = "User"
INT_MAX = 2 ** 31 - 1
TAG_STATUS = ("status_code", "http.status_code")
TAG_RPC_STATUS = "rpc.status_code"
TAG_DB_TYPE, TAG_DB_STATEMENT = "db.type", "db.statement"
TAG_CACHE_TYPE, TAG_CACHE_OP, TAG_CACHE_CMD, TAG_CACHE_KEY = "cache.type", "cache.op", "cache.cmd", "cache.key"
TAG_MQ_QUEUE, TAG_MQ_TOPIC, TAG_TRANSMISSION = "mq.queue", "mq.topic", "transmission.latency"
TAG_LOGIC_ENDPOINT = "x-le"
DB_THRESHOLDS = {"default": 200, "mongodb": 100}
CACHE_READ_THRESHOLDS = {"default": 20, "redis": 10}
CACHE_WRITE_THRESHOLDS = {"default": 20, "redis": 10}


def tag(tags: Column, *keys: str) -> Column:
    """Value of the last tag with one of these keys."""
    hits = F.filter(tags, lambda t: t["key"].isin(list(keys)))
    return F.when(F.size(hits) > 0, F.element_at(hits, -1)["value"])


def _blank(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit(""))) == ""


def explode_spans(segments: DataFrame) -> DataFrame:
    head = [c for c in segments.columns if c != "spans"]
    return segments.select(*head, F.explode("spans").alias("_s")).select(*head, "_s.*")


def gather_segments(spans: DataFrame) -> DataFrame:
    """Span rows back to segments. A segment is written by one thread of one process, which bounds it."""
    head = [c for c in spans.columns if c not in SPAN_FIELDS]
    body = F.struct(*[c for c in SPAN_FIELDS if c in spans.columns])
    return spans.groupBy(*head).agg(F.sort_array(F.collect_list(body)).alias("spans"))


# ---- segment rows and sampling ----

def segment_error(spans: Column, mode: str = "any") -> Column:
    """Error state of a segment from its first span, its entry spans or any span."""
    if mode == "first":
        return F.exists(spans, lambda s: (s["span_id"] == 0) & s["is_error"])
    if mode == "entry":
        return F.exists(spans, lambda s: (s["span_type"] == "Entry") & s["is_error"])
    return F.exists(spans, lambda s: s["is_error"])


def searched(spans: DataFrame, tags: bool = True, searchable: Sequence[str] = SEARCHABLE, max_tag: int = 256) -> DataFrame:
    """Span rows with what :func:`segment_rows` reads, to be gathered for it: Spark prunes no field of a span once it is
    collected. Of the tags only searchable ones travel; where a search reads none, they are left out (``tags``)."""
    fields = [c for c in SEARCH_FIELDS if tags or c != "tags"]
    slim = spans.select(*[c for c in spans.columns if c not in SPAN_FIELDS or c in fields])
    fits = lambda t: t["key"].isin(list(searchable)) & (F.length(t["value"]) <= max_tag)
    return slim.withColumn("tags", F.filter("tags", fits)) if tags else slim


def segment_rows(segments: DataFrame, searchable: Sequence[str] = SEARCHABLE, error_mode: str = "any", max_tag: int = 256,
                 whole: bool = False) -> DataFrame:
    """One searchable row per segment; nothing is shuffled. Segments gathered without tags have no column ``tags``.

    ``whole``: the row also holds the segment itself, its service, instance and spans, as they were gathered."""
    spans = F.col("spans")
    start = F.array_min(F.transform(spans, lambda s: s["start_time"]))
    end = F.array_max(F.transform(spans, lambda s: s["end_time"]))
    entries = F.filter(spans, lambda s: s["span_type"] == "Entry")
    first = F.filter(spans, lambda s: s["span_id"] == 0)
    # the last entry span names the endpoint, else the first span of the segment
    op = F.when(F.size(entries) > 0, F.element_at(entries, -1)["operation"]).otherwise(F.get(first, F.lit(0))["operation"])
    service = text.service_name(F.col("service"))
    sid = ids.service_id(service)
    tagged = []
    if "tags" in segments.schema["spans"].dataType.elementType.names:
        fitting = F.filter(F.flatten(F.transform(spans, lambda s: s["tags"])), lambda t: F.length(t["value"]) <= max_tag)
        tagged = [text.searchable_tags(fitting, searchable, max_tag).alias("tags")]
    return segments.select(
        "trace_id", "segment_id", sid.alias("service_id"),
        ids.instance_id(sid, text.instance_name(F.col("instance"))).alias("instance_id"),
        ids.endpoint_id(sid, text.endpoint_name(op)).alias("endpoint_id"), text.endpoint_name(op).alias("endpoint"),
        start.alias("start_time"), F.least(end - start, F.lit(INT_MAX)).cast("int").alias("latency"),
        segment_error(spans, error_mode).alias("is_error"),
        bucket_of_millis(start, "second").alias("time_bucket"), *tagged, *(["service", "instance", "spans"] if whole else []))


def segment_rows_of(spans: DataFrame, searchable: Sequence[str] = SEARCHABLE, error_mode: str = "any", max_tag: int = 256) -> DataFrame:
    """:func:`segment_rows` from span rows: one aggregation of plain values, in which no span is collected.

    Task by task a segment shrinks to its bounds, its error, the operation that names it and its distinct searchable
    tags, which come in order here.
    """
    head = ["trace_id", "segment_id", "service", "instance"]
    entry = F.col("span_type") == "Entry"
    failed = {"any": F.col("is_error"), "first": (F.col("span_id") == 0) & F.col("is_error"), "entry": entry & F.col("is_error")}[error_mode]
    fitting = F.filter("tags", lambda t: F.length(t["value"]) <= max_tag)
    whole = spans.select(*head, "span_id", "start_time", "end_time", "operation", entry.alias("_entry"), failed.alias("_failed"),
                         text.searchable_tags(fitting, searchable, max_tag).alias("_tags")).groupBy(*head).agg(
        F.min("start_time").alias("start_time"), F.max("end_time").alias("_end"), F.bool_or("_failed").alias("_failed"),
        F.bool_or("_entry").alias("_entered"), F.max_by("operation", F.when(F.col("_entry"), F.col("span_id"))).alias("_by_entry"),
        F.max(F.when(F.col("span_id") == 0, F.col("operation"))).alias("_by_first"), F.collect_set("_tags").alias("_tags"))
    service = text.service_name(F.col("service"))
    sid = ids.service_id(service)
    op = F.when(F.col("_entered"), F.col("_by_entry")).otherwise(F.col("_by_first"))
    return whole.select(
        "trace_id", "segment_id", sid.alias("service_id"),
        ids.instance_id(sid, text.instance_name(F.col("instance"))).alias("instance_id"),
        ids.endpoint_id(sid, text.endpoint_name(op)).alias("endpoint_id"), text.endpoint_name(op).alias("endpoint"),
        "start_time", F.least(F.col("_end") - F.col("start_time"), F.lit(INT_MAX)).cast("int").alias("latency"),
        F.coalesce("_failed", F.lit(False)).alias("is_error"), bucket_of_millis(F.col("start_time"), "second").alias("time_bucket"),
        F.sort_array(F.array_distinct(F.flatten("_tags"))).alias("tags"))


def java_hash(s: Column) -> Column:
    """The 32-bit polynomial text hash with base 31, as signed long. Exact for characters of the basic plane."""
    codes = F.transform(F.filter(F.split(s, ""), lambda ch: ch != ""), lambda ch: F.ascii(ch).cast("bigint"))
    h = F.aggregate(codes, F.lit(0).cast("bigint"), lambda acc, x: (acc * 31 + x).bitwiseAND(0xFFFFFFFF))
    return F.when(h >= 2 ** 31, h - 2 ** 32).otherwise(h)


def sample_bucket(trace_id: Column) -> Column:
    """0..9999 per trace, the same for all its segments. The most negative hash maps below zero and is always kept."""
    h = java_hash(trace_id)
    return F.when(h == -(2 ** 31), -(F.lit(2 ** 31) % 10000)).otherwise(F.abs(h) % 10000)


def sample_segments(rows: DataFrame, rate: int = 10000, slow_ms: int = -1, policies: DataFrame | None = None,
                    force_errors: bool = True) -> DataFrame:
    """Keep segments by trace hash, slowness or error. ``policies`` (service, rate, duration) override per service;
    a missing part of a policy falls back to the global one."""
    bucket = sample_bucket(F.col("trace_id"))
    if policies is not None:
        right = policies.groupBy("service").agg(F.max("rate").alias("_rate"), F.max("duration").alias("_dur"))
        rows = lookup_join(rows, right, ["service"])
        r, d = F.coalesce("_rate", F.lit(rate)), F.coalesce("_dur", F.lit(slow_ms))
    else:
        r, d = F.lit(rate), F.lit(slow_ms)
    keep = (bucket < r) | ((d > -1) & (F.col("latency") >= d))
    if force_errors:
        keep = keep | F.col("is_error")
    return rows.filter(keep).drop("_rate", "_dur")


# ---- traffic rows ----

def _layer(span_layer: Column) -> Column:
    return F.when(span_layer == "FAAS", "FAAS").otherwise("GENERAL")


def _is_gateway(address: Column, gateways: Sequence[str]) -> Column:
    return F.coalesce(address.isin(list(gateways)), F.lit(False)) if gateways else F.lit(False)


def _remote_layer(span_layer: Column, peer: Column, gateways) -> Column:
    return (F.when(span_layer == "Database", "VIRTUAL_DATABASE").when(span_layer == "RPCFramework", "GENERAL")
            .when((span_layer == "Http") & _is_gateway(peer, gateways), "VIRTUAL_GATEWAY").when(span_layer == "Http", "GENERAL")
            .when(span_layer == "MQ", "VIRTUAL_MQ").when(span_layer == "Cache", "VIRTUAL_CACHE")
            .when(span_layer == "FAAS", "FAAS").when(span_layer == "GenAI", "VIRTUAL_GENAI").otherwise("UNDEFINED"))


def public_attrs() -> list[Column]:
    """Latency, state, response codes and request type of a span."""
    tags = F.col("tags")
    layer = F.col("span_layer")
    kind = (F.when(layer == "Http", "HTTP").when(layer == "Database", "DATABASE").when(layer == "MQ", "MQ")
            .when(layer == "GenAI", "GenAI").otherwise("RPC"))
    # a code that is no number is ignored, so the last numeric one counts
    codes = F.filter(F.transform(F.filter(tags, lambda t: t["key"].isin(list(TAG_STATUS))), lambda t: t["value"].try_cast("int")),
                     lambda v: v.isNotNull())
    return [bucket_of_millis(F.col("start_time")).alias("time_bucket"),
            (F.col("end_time") - F.col("start_time")).cast("int").alias("latency"),
            (~F.col("is_error")).alias("status"),
            F.when(F.size(codes) > 0, F.element_at(codes, -1)).otherwise(0).alias("http_status"),
            tag(tags, TAG_RPC_STATUS).alias("rpc_status"), kind.alias("type"), "component_id", "tags"]


def _caller(gateways) -> dict[str, Column]:
    """Source side of a call as told by a parent reference."""
    ref, mq = F.col("_ref"), F.col("span_layer") == "MQ"
    virtual = mq | _is_gateway(ref["network_address"], gateways)
    return {
        "source_service": F.when(virtual, ref["network_address"]).otherwise(ref["parent_service"]),
        "source_instance": F.when(virtual, ref["network_address"]).otherwise(ref["parent_instance"]),
        "source_endpoint": F.when(F.coalesce(ref["parent_endpoint"], F.lit("")) == "", USER).otherwise(ref["parent_endpoint"]),
        "source_endpoint_owner": ref["parent_service"],
        "source_layer": F.when(mq, "VIRTUAL_MQ").when(virtual, "VIRTUAL_GATEWAY").otherwise("GENERAL"),
    }


def _callee() -> list[Column]:
    return [F.col("service").alias("dest_service"), F.col("instance").alias("dest_instance"),
            F.col("operation").alias("dest_endpoint"), _layer(F.col("span_layer")).alias("dest_layer")]


def entry_calls(spans: DataFrame, gateways: Sequence[str] = ()) -> DataFrame:
    """Server-side calls from entry spans: one row per parent reference, one row when there is none.

    Without reference the caller is the message peer for queue spans and the user otherwise.
    """
    entry = spans.filter((F.col("span_type") == "Entry") & ~F.col("skip_analysis"))
    rows = entry.withColumn("_ref", F.explode_outer("refs"))
    none = F.col("_ref").isNull()
    queue = none & (F.col("span_layer") == "MQ") & ~_blank(F.col("peer"))
    by_ref = _caller(gateways)
    alone = {"source_service": USER, "source_instance": USER, "source_endpoint": USER, "source_endpoint_owner": None,
             "source_layer": "UNDEFINED"}
    queued = {"source_service": F.col("peer"), "source_instance": F.col("peer"), "source_endpoint": F.lit(None).cast("string"),
              "source_endpoint_owner": F.lit(None).cast("string"), "source_layer": F.lit("VIRTUAL_MQ")}
    source = [F.when(queue, queued[k]).when(none, F.lit(alone[k]).cast("string")).otherwise(by_ref[k]).alias(k) for k in by_ref]
    return rows.select("trace_id", "segment_id", "span_id", *source, *_callee(), F.lit("SERVER").alias("detect_point"), *public_attrs())


def build_alias(spans: DataFrame, gateways: Sequence[str] = ()) -> DataFrame:
    """Network address -> (service, instance), the newest one per address."""
    rows = (spans.filter((F.col("span_type") == "Entry") & ~F.col("skip_analysis") & (F.col("span_layer") != "MQ"))
            .select("service", "instance", "start_time", F.explode("refs").alias("_ref"))
            .filter(F.col("_ref.ref_type") == "CrossProcess"))
    address = text.service_name(F.col("_ref.network_address"))
    rows = rows.filter(~_is_gateway(address, gateways))
    return (rows.select(address.alias("address"), "service", "instance", bucket_of_millis(F.col("start_time")).alias("time_bucket"))
            .groupBy("address")
            .agg(F.max(F.struct("time_bucket", "service", "instance")).alias("_m"))
            .select("address", F.col("_m.service").alias("alias_service"), F.col("_m.instance").alias("alias_instance"),
                    F.col("_m.time_bucket").alias("time_bucket")))


def exit_calls(spans: DataFrame, aliases: DataFrame | None = None, gateways: Sequence[str] = (),
               unnamed_instance_components: Sequence[int] = ()) -> DataFrame:
    """Client-side calls from exit spans. A peer address with an alias becomes the real service behind it."""
    rows = spans.filter((F.col("span_type") == "Exit") & ~F.col("skip_analysis") & (F.coalesce("peer", F.lit("")) != ""))
    if aliases is not None:
        right = aliases.select(F.col("address").alias("peer"), "alias_service", "alias_instance")
        rows = lookup_join(rows, right, ["peer"])
    else:
        rows = rows.withColumn("alias_service", F.lit(None).cast("string")).withColumn("alias_instance", F.lit(None).cast("string"))
    known = F.col("alias_service").isNotNull()
    hidden = F.col("component_id").isin(list(unnamed_instance_components)) if unnamed_instance_components else F.lit(False)
    return rows.select(
        "trace_id", "segment_id", "span_id",
        F.col("service").alias("source_service"), F.col("instance").alias("source_instance"),
        F.lit(None).cast("string").alias("source_endpoint"), F.lit(None).cast("string").alias("source_endpoint_owner"),
        _layer(F.col("span_layer")).alias("source_layer"),
        F.coalesce("alias_service", "peer").alias("dest_service"),
        F.when(known & hidden, F.lit(None)).when(known, F.col("alias_instance")).otherwise(F.col("peer")).alias("dest_instance"),
        F.lit(None).cast("string").alias("dest_endpoint"),
        F.when(known, "GENERAL").otherwise(_remote_layer(F.col("span_layer"), F.col("peer"), gateways)).alias("dest_layer"),
        F.lit("CLIENT").alias("detect_point"), *public_attrs())


def cross_thread_calls(spans: DataFrame, gateways: Sequence[str] = ()) -> DataFrame:
    """Endpoint dependencies of exit and local spans that carry references."""
    rows = (spans.filter(F.col("span_type").isin("Exit", "Local") & ~F.col("skip_analysis"))
            .withColumn("_ref", F.explode("refs")))
    return rows.select("trace_id", "segment_id", "span_id", *[c.alias(k) for k, c in _caller(gateways).items()], *_callee(),
                       F.lit("SERVER").alias("detect_point"), *public_attrs())


def logic_endpoints(spans: DataFrame) -> DataFrame:
    """Endpoint rows named by logic-endpoint tags of entry and local spans."""
    rows = (spans.filter(F.col("span_type").isin("Entry", "Local") & ~F.col("skip_analysis"))
            .withColumn("_t", F.explode(F.filter("tags", lambda t: t["key"] == TAG_LOGIC_ENDPOINT))))
    le = text.logic_endpoint(F.col("_t.value"), F.col("span_type") == "Local", F.col("operation"),
                             F.col("end_time") - F.col("start_time"), F.col("is_error"))
    return (rows.withColumn("_le", le).filter(F.col("_le").isNotNull())
            .select("trace_id", "service", "instance", F.col("_le.name").alias("endpoint"), F.col("_le.latency").alias("latency"),
                    F.col("_le.status").alias("status"), F.lit("LOGIC").alias("type"), F.lit("GENERAL").alias("layer"),
                    bucket_of_millis(F.col("start_time")).alias("time_bucket")))


# ---- projections of calls onto source frames: one call fans out to many metrics ----

def to_services(calls: DataFrame) -> DataFrame:
    return calls.select(F.col("dest_service").alias("name"), F.col("dest_layer").alias("layer"),
                        ids.service_id(F.col("dest_service")).alias("entity_id"), "time_bucket", "latency", "status",
                        "http_status", "rpc_status", "type", F.map_from_entries(_unique_tags()).alias("tag"))


def _unique_tags() -> Column:
    """Tags with unique keys, the last one of a key."""
    t = F.col("tags")
    keys = F.array_distinct(F.transform(t, lambda x: x["key"]))
    return F.transform(keys, lambda k: F.struct(k.alias("key"), F.element_at(F.filter(t, lambda x: x["key"] == k), -1)["value"].alias("value")))


def to_instances(calls: DataFrame) -> DataFrame:
    sid = ids.service_id(F.col("dest_service"))
    return calls.select(F.col("dest_service").alias("service"), F.col("dest_instance").alias("name"), F.col("dest_layer").alias("layer"),
                        ids.instance_id(sid, F.col("dest_instance")).alias("entity_id"), "time_bucket", "latency", "status", "http_status", "type")


def to_endpoints(calls: DataFrame) -> DataFrame:
    """Functions have no endpoints of their own."""
    sid = ids.service_id(F.col("dest_service"))
    return (calls.filter((F.col("dest_layer") != "FAAS") & F.col("dest_endpoint").isNotNull())
            .select(F.col("dest_service").alias("service"), F.col("dest_endpoint").alias("name"), F.col("dest_layer").alias("layer"),
                    ids.endpoint_id(sid, F.col("dest_endpoint")).alias("entity_id"), "time_bucket", "latency", "status", "http_status", "type",
                    F.map_from_entries(_unique_tags()).alias("tag")))


def _normal(layer: Column) -> Column:
    """Services inferred from addresses are not normal ones."""
    return ~(layer.startswith("VIRTUAL_") | (layer == "UNDEFINED"))


def to_service_relations(calls: DataFrame) -> DataFrame:
    s = ids.service_id(F.col("source_service"), _normal(F.col("source_layer")))
    d = ids.service_id(F.col("dest_service"), _normal(F.col("dest_layer")))
    return calls.select(s.alias("source_id"), d.alias("dest_id"), ids.relation_id(s, d).alias("entity_id"), "detect_point",
                        "component_id", "time_bucket", "latency", "status", "http_status", "type")


def to_instance_relations(calls: DataFrame) -> DataFrame:
    s = ids.instance_id(ids.service_id(F.col("source_service"), _normal(F.col("source_layer"))), F.col("source_instance"))
    d = ids.instance_id(ids.service_id(F.col("dest_service"), _normal(F.col("dest_layer"))), F.col("dest_instance"))
    return (calls.filter(F.col("source_instance").isNotNull() & F.col("dest_instance").isNotNull())
            .select(s.alias("source_id"), d.alias("dest_id"), ids.relation_id(s, d).alias("entity_id"), "detect_point",
                    "component_id", "time_bucket", "latency", "status"))


def to_endpoint_relations(calls: DataFrame) -> DataFrame:
    owner = F.coalesce("source_endpoint_owner", "source_service")
    owner_normal = F.when(F.col("source_endpoint_owner").isNotNull(), True).otherwise(_normal(F.col("source_layer")))
    s = ids.service_id(owner, owner_normal)
    d = ids.service_id(F.col("dest_service"), _normal(F.col("dest_layer")))
    return (calls.filter(F.col("source_endpoint").isNotNull() & F.col("dest_endpoint").isNotNull() & (F.col("dest_layer") != "FAAS"))
            .select(ids.endpoint_id(s, F.col("source_endpoint")).alias("source_id"),
                    ids.endpoint_id(d, F.col("dest_endpoint")).alias("dest_id"),
                    ids.endpoint_relation_id(s, F.col("source_endpoint"), d, F.col("dest_endpoint")).alias("entity_id"),
                    "detect_point", "component_id", "time_bucket", F.col("latency").alias("rpc_latency"), "status"))


# ---- virtual services ----

def _latency() -> Column:
    return (F.col("end_time") - F.col("start_time")).cast("int")


def _record_id() -> Column:
    return F.concat(F.col("segment_id"), F.lit("-"), F.col("span_id").cast("string"))


def _threshold(df: DataFrame, kind: Column, table: Mapping[str, int] | DataFrame) -> DataFrame:
    """Slow threshold by lower-cased type. Types without one use ``default``; without a default nothing is slow."""
    default = table.get("default", INT_MAX) if isinstance(table, Mapping) else INT_MAX
    named = {k: v for k, v in table.items() if k != "default"} if isinstance(table, Mapping) else table
    return lookup(df, F.lower(kind), named, "_threshold", default)


def virtual_database(spans: DataFrame, thresholds: Mapping[str, int] | DataFrame = DB_THRESHOLDS,
                     max_statement: int = text.STATEMENT_MAX) -> dict[str, DataFrame]:
    """Access rows and slow statements of database exit spans."""
    rows = spans.filter((F.col("span_layer") == "Database") & (F.col("span_type") == "Exit") & ~_blank(F.col("peer")))
    access = rows.select(text.service_name(F.col("peer")).alias("name"), F.lit("VIRTUAL_DATABASE").alias("layer"),
                         ids.service_id(text.service_name(F.col("peer")), False).alias("entity_id"), "component_id",
                         bucket_of_millis(F.col("start_time")).alias("time_bucket"), _latency().alias("latency"),
                         (~F.col("is_error")).alias("status"))
    db_type, statement = tag(F.col("tags"), TAG_DB_TYPE), text.cut(tag(F.col("tags"), TAG_DB_STATEMENT), max_statement)
    typed = _threshold(rows.filter(db_type.isNotNull()), db_type, thresholds)
    slow = (typed.filter((_latency() > F.col("_threshold")) & ~_blank(statement))
            .select(_record_id().alias("id"), "trace_id", "service", text.service_name(F.col("peer")).alias("database"),
                    ids.service_id(text.service_name(F.col("peer")), False).alias("entity_id"),
                    ids.service_id(F.col("service")).alias("service_entity_id"), statement.alias("statement"),
                    _latency().alias("latency"), bucket_of_millis(F.col("start_time"), "second").alias("time_bucket"),
                    F.col("start_time").alias("timestamp")))
    return {"access": access, "slow": slow}


def virtual_cache(spans: DataFrame, read_thresholds: Mapping[str, int] | DataFrame = CACHE_READ_THRESHOLDS,
                  write_thresholds: Mapping[str, int] | DataFrame = CACHE_WRITE_THRESHOLDS) -> dict[str, DataFrame]:
    tags = F.col("tags")
    kind, op = tag(tags, TAG_CACHE_TYPE), tag(tags, TAG_CACHE_OP)
    rows = spans.filter((F.col("span_layer") == "Cache") & F.col("span_type").isin("Exit", "Local") & ~_blank(kind))
    peer = F.when(_blank(F.col("peer")), F.concat(kind, F.lit("-local"))).otherwise(F.col("peer"))
    name = text.service_name(peer)
    operation = F.when(op == "write", "Write").when(op == "read", "Read").otherwise("Others")
    base = (rows.withColumn("name", name).withColumn("operation_kind", operation).withColumn("latency", _latency()))
    access = base.select("name", F.lit("VIRTUAL_CACHE").alias("layer"), ids.service_id(F.col("name"), False).alias("entity_id"),
                         "component_id", bucket_of_millis(F.col("start_time")).alias("time_bucket"), "latency",
                         (~F.col("is_error")).alias("status"), F.col("operation_kind").alias("operation"))
    both = _threshold(base, kind, read_thresholds).withColumnRenamed("_threshold", "_read")
    both = _threshold(both, kind, write_thresholds)
    slow = (both.filter(((F.col("operation_kind") == "Write") & (F.col("latency") > F.col("_threshold")))
                        | ((F.col("operation_kind") == "Read") & (F.col("latency") > F.col("_read"))))
            .select(_record_id().alias("id"), "trace_id", "name", ids.service_id(F.col("name"), False).alias("entity_id"),
                    tag(tags, TAG_CACHE_CMD).alias("command"), tag(tags, TAG_CACHE_KEY).alias("key"),
                    F.col("operation_kind").alias("operation"), "latency", (~F.col("is_error")).alias("status"),
                    bucket_of_millis(F.col("start_time"), "second").alias("time_bucket"), F.col("start_time").alias("timestamp")))
    return {"access": access, "slow": slow}


def virtual_queue(spans: DataFrame) -> dict[str, DataFrame]:
    """Produce and consume rows of queue spans, by service and by ``topic/queue`` endpoint."""
    rows = spans.filter((F.col("span_layer") == "MQ") & F.col("span_type").isin("Entry", "Exit"))
    first = F.get(F.col("refs"), F.lit(0))["network_address"]
    consume = F.col("span_type") == "Entry"
    peer = F.when(consume & ~_blank(first), first).otherwise(F.col("peer"))
    tags = F.col("tags")
    topic, queue, sent = tag(tags, TAG_MQ_TOPIC), tag(tags, TAG_MQ_QUEUE), tag(tags, TAG_TRANSMISSION)
    parts = F.filter(F.array(topic, queue), lambda x: F.trim(F.coalesce(x, F.lit(""))) != "")
    base = (rows.filter(~_blank(peer)).withColumn("name", text.service_name(peer))
            .withColumn("endpoint", text.endpoint_name(F.array_join(parts, "/"))))
    out = [F.lit("VIRTUAL_MQ").alias("layer"), "component_id", bucket_of_millis(F.col("start_time")).alias("time_bucket"),
           F.coalesce(sent.try_cast("bigint"), F.lit(0)).alias("transmission_latency"), (~F.col("is_error")).alias("status"),
           F.when(consume, "Consume").otherwise("Produce").alias("operation")]
    sid = ids.service_id(F.col("name"), False)
    return {"service": base.select("name", sid.alias("entity_id"), *out),
            "endpoint": base.filter(F.col("endpoint") != "").select(
                "name", "endpoint", ids.endpoint_id(sid, F.col("endpoint")).alias("entity_id"), *out)}


# ---- span trees ----

def _span_key(segment: Column, span: Column) -> Column:
    return F.concat(segment, F.lit("S"), span.cast("string"))


def with_keys(spans: DataFrame) -> DataFrame:
    """Adds ``span_key`` and ``parent_key``; the last reference replaces the parent inside the segment."""
    last = F.when(F.size("refs") > 0, F.element_at("refs", -1))
    own = _span_key(F.col("segment_id"), F.col("parent_span_id"))
    return (spans.withColumn("span_key", _span_key(F.col("segment_id"), F.col("span_id")))
            .withColumn("parent_key", F.coalesce(_span_key(last["parent_segment_id"], last["parent_span_id"]), own)))


def roots(keyed: DataFrame) -> DataFrame:
    """Spans whose parent is not in the trace. Broken traces have several."""
    present = keyed.select("trace_id", F.col("span_key").alias("parent_key"))
    return keyed.join(present, ["trace_id", "parent_key"], "left_anti")


TREE = ("trace_id", "segment_id", "span_id", "span_key", "parent_key", "start_time")


def order_tree(keyed: DataFrame, chosen: DataFrame | None = None, together: int = 10_000) -> DataFrame:
    """Adds ``position`` (from 1 in its trace: roots by start time, children depth first by start time) and ``depth``;
    of all traces, or of those whose ids the page ``chosen`` has.

    The walk around each tree is a list: a span is entered, then its children in order, then it is left. Doubling the
    distance to the element that each one points at, and adding up what lies between, ranks a list of n elements in
    log2(n) rounds, whatever the depth. Traces of up to ``together`` spans are brought together by one shuffle and a task
    ranks all of its lists at once; the elements of larger ones are spread over the cluster, and a round is a join
    (:func:`_ranked`). Spans caught in a reference cycle hang under no root and are left out. Of spans that share a key one
    gives its place to all.
    """
    if chosen is not None:  # the page is found and its spans are read once, not for each use below
        keyed, _ = stored(full_spans(keyed, chosen))
    slim = keyed.select(*TREE)
    large, _ = stored(slim.groupBy("trace_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > together).select("trace_id"))
    split = not large.isEmpty()
    small = lookup_join(slim, large, ["trace_id"], "left_anti") if split else slim
    kinds = {f.name: f.dataType.simpleString() for f in slim.schema}
    out = small.repartition("trace_id").sortWithinPartitions("trace_id").mapInArrow(
        _walked, ", ".join(f"{c} {kinds[c]}" for c in TREE) + ", position bigint, depth int")
    if split:
        big = lookup_join(slim, large, ["trace_id"], "left_semi")
        out = out.unionByName(big.join(_ranked(big), ["trace_id", "span_key"]).select(*TREE, "position", "depth"))
    if set(keyed.columns) == set(TREE):
        return out.select(*keyed.columns, "position", "depth")
    places = out.select("trace_id", "span_key", "position", "depth").dropDuplicates(["trace_id", "span_key"])
    return keyed.join(places, ["trace_id", "span_key"])


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole traces, which arrive sorted, with their places; some traces are held at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows = pa.Table.from_batches(held).combine_chunks()
        trace = rows.column("trace_id").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        whole = int(np.flatnonzero(trace != trace[-1])[-1]) + 1 if (trace != trace[-1]).any() else 0
        if whole:
            yield from _places(rows.slice(0, whole)).to_batches()
        held = rows.slice(whole).combine_chunks().to_batches()
    if held:
        yield from _places(pa.Table.from_batches(held)).to_batches()


def _numbers(*columns: pa.ChunkedArray) -> list[np.ndarray]:
    """Texts of some columns as numbers, equal ones alike."""
    joined = pa.chunked_array([c for column in columns for c in column.chunks]).combine_chunks()
    numbers = joined.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return np.split(numbers, np.cumsum([len(c) for c in columns])[:-1])


def _order(column: pa.ChunkedArray) -> np.ndarray:
    """Texts as numbers in the order of the texts; null comes last."""
    return pc.rank(column.combine_chunks(), sort_keys="ascending", null_placement="at_end", tiebreaker="dense").to_numpy().astype(np.int64)


def _places(rows: pa.Table) -> pa.Table:
    (trace,), (segment,) = _numbers(rows.column("trace_id")), _numbers(rows.column("segment_id"))
    own, parent = _numbers(rows.column("span_key"), rows.column("parent_key"))
    start, span = rows.column("start_time").to_numpy(), rows.column("span_id").to_numpy()
    size = int(max(own.max(), parent.max())) + 1
    # one node for each key of a trace: its earliest span
    key = trace * size + own
    nodes, first = np.unique(key, return_index=True)
    if len(nodes) < len(key):
        order = np.lexsort((_order(rows.column("parent_key")), start, key))
        first = order[np.unique(key[order], return_index=True)[1]]
    n = len(nodes)
    up = np.searchsorted(nodes, trace[first] * size + parent[first])
    up = np.where((up < n) & (nodes[np.minimum(up, n - 1)] == trace[first] * size + parent[first]), up, -1)
    below = np.where(up >= 0, up, n + trace[first])
    if (segment != trace).any():  # traces of several segments
        segment = _order(rows.column("segment_id"))
    order = np.lexsort((span[first], segment[first], start[first], below))
    follows = below[order][1:] == below[order][:-1]
    after, child = np.full(n, -1), np.full(n, -1)
    after[order[:-1][follows]] = order[1:][follows]
    heads = order[np.concatenate(([True], ~follows))]
    heads = heads[up[heads] >= 0]
    child[up[heads]] = heads
    # element 2i enters node i, element 2i + 1 leaves it; a last element stands at the end
    then = np.empty(2 * n + 1, dtype=np.int64)
    then[0:-1:2] = np.where(child >= 0, 2 * child, 2 * np.arange(n) + 1)
    then[1::2] = np.where(after >= 0, 2 * after, np.where(up >= 0, 2 * up + 1, 2 * n))
    then[-1] = 2 * n
    spans, levels = np.zeros(2 * n + 1, dtype=np.int64), np.zeros(2 * n + 1, dtype=np.int64)
    spans[0:-1:2], levels[0:-1:2], levels[1::2] = 1, 1, -1
    for _ in range(int(2 * n).bit_length() + 1):
        spans, levels, then = spans + spans[then], levels + levels[then], then[then]
    placed = then[0:-1:2] == 2 * n
    most = np.zeros(int(trace.max()) + 1, dtype=np.int64)
    np.maximum.at(most, trace[first][placed], spans[0:-1:2][placed])
    position, depth = most[trace[first]] - spans[0:-1:2] + 1, 1 - levels[0:-1:2]
    node = np.searchsorted(nodes, key)
    out = rows.append_column("position", pa.array(position[node])).append_column("depth", pa.array(depth[node].astype(np.int32)))
    return out.filter(pa.array(placed[node]))


def _ranked(keyed: DataFrame) -> DataFrame:
    """``trace_id, span_key, position, depth`` of large traces, in rounds of one join on the element's number.

    An element is four numbers, in a round as in the last; a span without children is one element. Rounds end when all
    elements have seen the end of their list. The children of one span are put in order by one sort.
    """
    spark = keyed.sparkSession
    nodes, node_path = stored(keyed.groupBy("trace_id", "span_key").agg(F.min_by(F.struct("parent_key", "start_time", "segment_id", "span_id"), F.struct("start_time", "parent_key")).alias("s"))
                              .select("trace_id", "span_key", "s.*").withColumn("id", F.monotonically_increasing_id()))
    parents = nodes.select("trace_id", F.col("span_key").alias("parent_key"), F.col("id").alias("up"))
    order = Window.partitionBy("trace_id", "up").orderBy("start_time", "segment_id", "span_id")
    linked, linked_path = stored(nodes.join(parents, ["trace_id", "parent_key"], "left").select(
        "id", "up", F.lead("id").over(order).alias("after"), F.row_number().over(order).alias("nth")))
    first = linked.filter((F.col("nth") == 1) & F.col("up").isNotNull()).select(F.col("up").alias("id"), F.col("id").alias("child"))
    following = F.coalesce(F.col("after") * 2, F.col("up") * 2 + 1)
    element = lambda at, then, spans, levels: F.struct(at.alias("at"), then.alias("then"), F.lit(spans).cast("bigint").alias("spans"), F.lit(levels).cast("bigint").alias("levels"))
    walk = F.when(F.col("child").isNull(), F.array(element(F.col("id") * 2, following, 1, 0))).otherwise(
        F.array(element(F.col("id") * 2, F.col("child") * 2, 1, 1), element(F.col("id") * 2 + 1, following, 0, -1)))
    state, path = stored(linked.join(first, "id", "left").select(F.inline(walk)))
    delete(spark, linked_path)
    waiting = state.filter(F.col("then").isNotNull()).count()
    while waiting:
        ahead = state.select(F.col("at").alias("then"), F.col("then").alias("_then"), F.col("spans").alias("_spans"), F.col("levels").alias("_levels"))
        further, further_path = stored(state.join(ahead, "then", "left").select(
            "at", F.col("_then").alias("then"), *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in ("spans", "levels")]))
        delete(spark, path)
        state, path = further, further_path
        left = state.filter(F.col("then").isNotNull()).count()
        if left == waiting:
            break
        waiting = left
    entered = state.filter(F.col("then").isNull() & (F.col("at") % 2 == 0)).select(
        F.expr("at div 2").alias("id"), "spans", (1 - F.col("levels")).cast("int").alias("depth"))
    placed = nodes.join(entered, "id").select("trace_id", "span_key", "spans", "depth")
    whole = placed.groupBy("trace_id").agg(F.max("spans").alias("_whole"))
    return placed.join(whole, "trace_id").select("trace_id", "span_key", (F.col("_whole") - F.col("spans") + 1).alias("position"), "depth")


def attach_events(keyed: DataFrame, events: DataFrame) -> DataFrame:
    """Kernel events on the span of the same trace, segment and span id, one row per event.

    Request/inbound and response/outbound events were seen by the server and move to the entry span below, if any.
    ``events``: trace_id, segment_id, span_id (text), start_seconds, start_nanos, event, data_type, data_direction.
    """
    e = events.filter(F.col("span_id").rlike(r"^\d+$")).withColumn("span_key", _span_key(F.col("segment_id"), F.col("span_id")))
    own = keyed.select("trace_id", "span_key")
    entry = (keyed.filter(F.col("span_type") == "Entry").groupBy("trace_id", F.col("parent_key").alias("span_key"))
             .agg(F.min_by("span_key", F.struct("start_time", "span_key")).alias("_entry")))
    hit = e.select("trace_id", "span_key", "start_seconds", "start_nanos", "event", "data_type", "data_direction").join(own, ["trace_id", "span_key"])
    server = (((F.col("data_type") == "request") & (F.col("data_direction") == "inbound"))
              | ((F.col("data_type") == "response") & (F.col("data_direction") == "outbound")))
    return (hit.join(entry, ["trace_id", "span_key"], "left")
            .withColumn("span_key", F.when(server, F.coalesce("_entry", "span_key")).otherwise(F.col("span_key"))).drop("_entry"))


# ---- search ----

def filter_traces(rows: DataFrame, service_id: str | None = None, instance_id: str | None = None, endpoint_id: str | None = None,
                  trace_id: str | None = None, min_ms: int | None = None, max_ms: int | None = None,
                  tags: Sequence[str] = (), state: str = "ALL", bounds: tuple[int, int] | None = None) -> DataFrame:
    """Segment rows by any combination of conditions. Each tag is one ``key=value`` that must be present."""
    conditions = []
    if bounds:
        conditions.append(F.col("time_bucket").between(*bounds))
    for column, want in (("service_id", service_id), ("instance_id", instance_id), ("endpoint_id", endpoint_id), ("trace_id", trace_id)):
        if want is not None:
            conditions.append(F.col(column) == want)
    if min_ms is not None:
        conditions.append(F.col("latency") >= min_ms)
    if max_ms is not None:
        conditions.append(F.col("latency") <= max_ms)
    conditions += [F.array_contains("tags", t) for t in tags]
    if state != "ALL":
        conditions.append(F.col("is_error") == F.lit(state == "ERROR"))
    for c in conditions:
        rows = rows.filter(c)
    return rows


def by_tag_table(rows: DataFrame, tag_rows: DataFrame, tags: Sequence[str], key: str = "segment_id") -> DataFrame:
    """The same tag condition against a side table (key, tag), which is read once: keys that have all the tags."""
    wanted = list(dict.fromkeys(tags))
    if not wanted:
        return rows
    bit = reduce(lambda found, i: F.when(F.col("tag") == wanted[i], F.lit(1 << i).cast("bigint")).otherwise(found), range(len(wanted)), F.lit(0).cast("bigint"))
    hits = tag_rows.filter(F.col("tag").isin(wanted)).groupBy(key).agg(F.bit_or(bit).alias("_tags"))
    return rows.join(hits.filter(F.col("_tags") == (1 << len(wanted)) - 1).select(key), key, "left_semi")


def with_tags(rows: DataFrame, column: str, tags: Sequence[str], key: str | None = None) -> DataFrame:
    """Rows whose own array ``column`` has all the tags; with ``key``, the keys whose rows have them between them.

    Keys take one pass and one aggregation: a row is marked with one bit for each tag, a key with those of its rows.
    """
    wanted = list(dict.fromkeys(tags))
    has = [F.array_contains(column, t) for t in wanted]
    if key is None:
        return reduce(DataFrame.filter, has, rows)
    bits = reduce(Column.bitwiseOR, [F.when(c, F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for i, c in enumerate(has)])
    marked = rows.select(key, bits.alias("_tags")).filter(F.col("_tags") != 0).groupBy(key).agg(F.bit_or("_tags").alias("_tags"))
    return marked.filter(F.col("_tags") == (1 << len(wanted)) - 1).select(key)


def sorted_traces(rows: DataFrame, by: str = "start_time") -> DataFrame:
    return rows.orderBy(F.col({"start_time": "start_time", "duration": "latency"}[by]).desc(), "segment_id")


def full_spans(spans: DataFrame, chosen: DataFrame) -> DataFrame:
    """All spans of the traces in ``chosen``."""
    return spans.join(chosen.select("trace_id").distinct(), "trace_id", "left_semi")


def to_otlp(spans: DataFrame) -> DataFrame:
    """One OTLP-shaped row per span; nest with :func:`nest_otlp` only after a page of traces has been chosen.

    Spans marked ``is_root`` and spans without a parent id have none, unless a reference of the same trace names one.
    Peer, component and layer become attributes.
    """
    has = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) != ""
    attr = lambda key, value: F.struct(F.lit(key).alias("key"), F.struct(value.alias("stringValue")).alias("value"))
    component = F.col("component") if "component" in spans.columns else F.col("component_id").cast("string")
    own = F.transform("tags", lambda t: F.struct(t["key"].alias("key"), F.struct(t["value"].alias("stringValue")).alias("value")))
    extra = F.filter(F.array(F.when(has("peer"), attr("peer.address", F.col("peer"))), F.when(component.isNotNull(), attr("component", component)),
                             F.when(has("span_layer"), attr("layer", F.col("span_layer")))), lambda x: x.isNotNull())
    kind = (F.when(F.col("span_type") == "Entry", "SPAN_KIND_SERVER").when(F.col("span_type") == "Exit", "SPAN_KIND_CLIENT")
            .otherwise("SPAN_KIND_INTERNAL"))
    root = F.col("is_root") if "is_root" in spans.columns else F.lit(False)
    linked = F.get(F.filter("refs", lambda r: r["trace_id"] == F.col("trace_id")), F.lit(0))
    parent = (F.when((F.col("parent_span_id") >= 0) & ~root, F.col("parent_key"))
              .when(linked.isNotNull(), _span_key(linked["parent_segment_id"], linked["parent_span_id"])))
    return with_keys(spans).select(
        F.col("trace_id").alias("traceId"), F.col("span_key").alias("spanId"), parent.alias("parentSpanId"),
        F.when(has("operation"), F.col("operation")).when(has("span_type"), F.col("span_type")).otherwise("unknown").alias("name"),
        kind.alias("kind"), (F.col("start_time") * 1000000).alias("startTimeUnixNano"),
        (F.col("end_time") * 1000000).alias("endTimeUnixNano"), F.concat(own, extra).alias("attributes"),
        F.struct(F.when(F.col("is_error"), "STATUS_CODE_ERROR").otherwise("STATUS_CODE_OK").alias("code"),
                 F.when(F.col("is_error"), "Error occurred").alias("message")).alias("status"),
        F.when(has("service"), F.col("service")).otherwise("unknown").alias("serviceName"), F.col("instance").alias("instanceName"))


def nest_otlp(otlp: DataFrame) -> DataFrame:
    """One row per trace and service of an already limited page."""
    fields = [c for c in otlp.columns if c not in ("serviceName", "instanceName")]
    return (otlp.groupBy("traceId", "serviceName").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("spans")))
