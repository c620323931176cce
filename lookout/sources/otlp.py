"""OTLP traces, metrics and logs, and the older metric form sent by cloud vendors.

Inputs are decoded rows: attribute lists are ``map<string,string>``, ids are hexadecimal text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from .meters import escape_name

# Tag keys.
SERVICE_NAMES = ("service.name", "faas.name", "k8s.deployment.name", "process.executable.name")
IP = r"^(\d{1,3}\.){3}\d{1,3}$|^[0-9a-fA-F:]*:[0-9a-fA-F:]*$"
KINDS = {"SPAN_KIND_CLIENT": "CLIENT", "SPAN_KIND_SERVER": "SERVER", "SPAN_KIND_PRODUCER": "PRODUCER", "SPAN_KIND_CONSUMER": "CONSUMER"}
NO_RECORDED_VALUE = 1


def _get(m: Column, key: str) -> Column:
    """Value of a key, null when absent or empty."""
    v = F.try_element_at(m, F.lit(key))
    return F.when(v != "", v)


def _merge(*maps: Column) -> Column:
    """Later maps win."""
    out = maps[0]
    for m in maps[1:]:
        out = F.map_zip_with(out, m, lambda _, a, b: F.coalesce(b, a))
    return out


def _dots(m: Column) -> Column:
    """Dots in keys become underscores; of two keys that fall together the first in key order counts."""
    rename = lambda k: F.replace(k, F.lit("."), F.lit("_"))
    keys = F.array_distinct(F.transform(F.map_keys(m), rename))
    entries = F.transform(F.sort_array(F.map_entries(m)), lambda e: F.struct(rename(e["key"]).alias("key"), e["value"].alias("value")))
    first = F.transform(keys, lambda k: F.struct(k.alias("key"), F.get(F.filter(entries, lambda e: e["key"] == k), F.lit(0))["value"].alias("value")))
    return F.when(F.size(keys) == F.size(m), F.transform_keys(m, lambda k, _: rename(k))).otherwise(F.map_from_entries(first))


def _or_empty(c: Column) -> Column:
    return F.coalesce(c, L.empty())


# ---- traces ----

def traces(spans: DataFrame) -> DataFrame:
    """Span rows in the form of :mod:`lookout.sources.zipkin`.

    Input: resource (map), scope_name, scope_version, trace_id, span_id, parent_span_id, trace_state, name, kind,
    start_nanos, end_nanos, attributes (map), status_code, status_message, events array of (time_nanos, name,
    attributes, dropped), links array of (trace_id, span_id, trace_state, attributes, dropped).
    """
    resource = _or_empty(F.col("resource"))
    picked = [_get(resource, k) for k in SERVICE_NAMES]
    service = F.coalesce(*picked, F.lit(""))
    # a fallback name moves out of the tags, which then tell where it came from
    moved = resource
    for i in reversed(range(1, len(SERVICE_NAMES))):
        chosen = picked[i].isNotNull()
        for earlier in picked[:i]:
            chosen = chosen & earlier.isNull()
        moved = F.when(chosen, L.put(L.without(resource, [SERVICE_NAMES[i]]), "otlp.service.name.source", F.lit(SERVICE_NAMES[i]))).otherwise(moved)
    scope = F.map_filter(F.create_map(F.lit("otel.library.name"), F.col("scope_name"), F.lit("otel.library.version"), F.col("scope_version")),
                         lambda _, v: F.coalesce(v, F.lit("")) != "")
    own = F.map_filter(F.create_map(F.lit("w3c.tracestate"), F.coalesce("trace_state", F.lit("")),
                                    F.lit("span.kind"), F.when(F.col("kind") == "SPAN_KIND_INTERNAL", "internal")),
                       lambda _, v: v.isNotNull())
    tags = _merge(moved, scope, _or_empty(F.col("attributes")), own)
    rows = spans.withColumn("_tags", tags).withColumn("_service", service)

    t = F.col("_tags")
    peer, peer_name, peer_ip = _get(t, "peer.service"), _get(t, "net.peer.name"), _get(t, "net.peer.ip")
    is_ip = lambda c: c.rlike(IP)
    remote = F.coalesce(peer, F.when(~is_ip(peer_name), peer_name), F.when(~is_ip(peer_ip), peer_ip), F.lit(""))
    local = F.when(F.col("_service") != "", F.col("_service")).otherwise(
        F.coalesce(F.when(~is_ip(_get(t, "net.host.ip")), _get(t, "net.host.ip")), F.lit("")))
    used = ["net.host.ip", "net.host.port", "net.peer.ip", "net.peer.port"]
    kept = F.map_filter(t, lambda k, v: ~((k.isin(used) | (k == "peer.service") | ((k == "net.peer.name") & peer.isNull())) & (v != "")))
    code = F.coalesce("status_code", F.lit("STATUS_CODE_UNSET"))
    state = F.map_filter(F.create_map(
        F.lit("error"), F.when(code == "STATUS_CODE_ERROR", "true"),
        F.lit("otel.status_code"), F.when(code != "STATUS_CODE_UNSET", code),
        F.lit("otel.status_description"), F.when((code != "STATUS_CODE_UNSET") & (F.coalesce("status_message", F.lit("")) != ""), F.col("status_message"))),
        lambda _, v: v.isNotNull())
    links = F.map_from_entries(F.transform(F.coalesce("links", F.expr("cast(array() as array<struct<trace_id:string,span_id:string,trace_state:string,attributes:map<string,string>,dropped:int>>)")),
                                           lambda l, i: F.struct(F.concat(F.lit("otlp.link."), i.cast("string")).alias("key"),
                                                                 F.concat_ws("|", l["trace_id"], l["span_id"], l["trace_state"], F.to_json(l["attributes"]), l["dropped"].cast("string")).alias("value"))))
    us = lambda c: F.call_function("div", c.cast("bigint"), F.lit(1000).cast("bigint"))
    note = lambda e: F.struct(us(e["time_nanos"]).alias("timestamp"),
                              F.when((F.size(e["attributes"]) <= 0) & (F.coalesce(e["dropped"], F.lit(0)) == 0), e["name"])
                              .otherwise(F.concat_ws("|", e["name"], F.to_json(e["attributes"]), F.coalesce(e["dropped"], F.lit(0)).cast("string"))).alias("value"))
    kind = F.lit(None).cast("string")
    for k, v in KINDS.items():
        kind = F.when(F.col("kind") == k, v).otherwise(kind)
    valid = (F.coalesce("trace_id", F.lit("")) != "") & (F.coalesce("span_id", F.lit("")) != "")
    return rows.filter(valid).select(
        "trace_id", F.when(F.coalesce("parent_span_id", F.lit("")) != "", F.col("parent_span_id")).alias("parent_id"), "span_id",
        kind.alias("kind"), "name", us(F.col("start_nanos")).alias("timestamp_us"), (us(F.col("end_nanos")) - us(F.col("start_nanos"))).alias("duration_us"),
        F.lit(False).alias("debug"), F.lit(False).alias("shared"), F.when(local != "", local).alias("local_service"),
        F.when(remote != "", remote).alias("remote_service"),
        F.transform(F.coalesce("events", F.expr("cast(array() as array<struct<time_nanos:bigint,name:string,attributes:map<string,string>,dropped:int>>)")), note).alias("annotations"),
        _merge(L.without(kept, ["error"]), state, links).alias("tags"))


# ---- metrics ----

def _node_labels(resource: Column, base: Column) -> Column:
    """Resource attributes as labels (``base``), plus the labels that rules know a host and a job by."""
    host = F.coalesce(_get(base, "node_identifier_host_name"), F.try_element_at(resource, F.lit("net.host.name")), F.try_element_at(resource, F.lit("host.name")))
    job = F.coalesce(_get(base, "job_name"), F.try_element_at(resource, F.lit("service.name")))
    extra = F.map_filter(F.create_map(F.lit("node_identifier_host_name"), host, F.lit("job_name"), job), lambda _, v: v.isNotNull())
    return F.map_zip_with(base, extra, lambda _, a, b: F.coalesce(a, b))


def metrics(points: DataFrame) -> DataFrame:
    """Metric points to samples (name, labels, ts, value).

    Input: resource, name, kind (gauge, sum, histogram, exponential_histogram, summary), temporality, flags, attributes,
    time_nanos, value, count, sum, bucket_counts, explicit_bounds, scale, positive_offset, positive_counts,
    negative_offset, negative_counts, quantiles array of (quantile, value). Point labels override resource labels;
    points without a recorded value and sums of unknown temporality are left out.
    """
    ok = F.coalesce("flags", F.lit(0)).bitwiseAND(NO_RECORDED_VALUE) == 0
    ok = ok & ~((F.col("kind") == "sum") & (F.coalesce("temporality", F.lit("UNSPECIFIED")) == "UNSPECIFIED"))
    # one step per column, so that no expression is evaluated twice
    base = (points.filter(ok).withColumn("_res", _dots(_or_empty(F.col("resource"))))
            .withColumn("_node", _node_labels(_or_empty(F.col("resource")), F.col("_res")))
            .withColumn("_own", _dots(_or_empty(F.col("attributes")))).withColumn("labels", _merge(F.col("_node"), F.col("_own")))
            .withColumn("ts", F.call_function("div", F.col("time_nanos"), F.lit(1_000_000).cast("bigint")))
            .withColumn("name", escape_name(F.col("name"))))
    name = F.col("name")
    k = F.col("kind")
    one = lambda suffix, value: F.struct((F.concat(name, F.lit(suffix)) if suffix else name).alias("name"), F.col("labels").alias("labels"), value.cast("double").alias("value"))
    labelled = lambda key, bound, value: F.struct(name.alias("name"), L.put(F.col("labels"), key, bound).alias("labels"), value.cast("double").alias("value"))

    explicit = F.transform(F.col("bucket_counts"), lambda c, i: F.struct(F.coalesce(F.get("explicit_bounds", i), F.lit(float("inf"))).alias("b"), c.alias("c")))
    base_pow = F.pow(F.lit(2.0), F.pow(F.lit(2.0), -F.col("scale").cast("double")))
    negative = F.transform(F.coalesce("negative_counts", F.expr("cast(array() as array<bigint>)")),
                           lambda c, i: F.struct((-F.pow(base_pow, F.col("negative_offset") + i)).alias("b"), c.alias("c")))
    n_pos = F.size("positive_counts")
    positive = F.transform("positive_counts", lambda c, i: F.struct(
        F.when(i == n_pos - 1, F.lit(float("inf"))).otherwise(F.pow(base_pow, F.col("positive_offset") + i + 1)).alias("b"), c.alias("c")))
    exponential = F.concat(negative, positive)
    base = base.withColumn("_b", F.when(k == "histogram", explicit).when(k == "exponential_histogram", exponential))
    # only the last bound may be open
    finite = F.slice("_b", F.lit(1), F.size("_b") - 1)
    out_of_range = (k == "exponential_histogram") & ((base_pow == float("inf")) | F.exists(
        finite, lambda x: (x["b"] == float("inf")) | (x["b"] == float("-inf"))))
    buckets = F.when(~out_of_range, F.col("_b"))
    totals = F.array(one("_count", F.col("count")), one("_sum", F.col("sum")))
    none = F.slice(totals, F.lit(1), F.lit(0))
    items = (F.when(k.isin("gauge", "sum"), F.array(one("", F.col("value"))))
             .when(k.isin("histogram", "exponential_histogram"), F.concat(totals, F.coalesce(F.transform(buckets, lambda x: labelled("le", bound_text(x["b"]), x["c"])), none)))
             .when(k == "summary", F.concat(totals, F.coalesce(F.transform("quantiles", lambda q: labelled("quantile", bound_text(q["quantile"]), q["value"])), none))))
    return base.select("ts", F.inline(items)).select("name", "labels", "ts", "value")


def bound_text(c: Column) -> Column:
    """Text of a double bound; an unbounded one is spelled ``Infinity``."""
    return c.cast("double").cast("string")


def old_metrics(points: DataFrame) -> DataFrame:
    """Points of the older form (labels instead of attributes, integer and double kinds apart) in the form of
    :func:`metrics`. Exemplars, minima and maxima do not exist there."""
    kind = F.regexp_replace(F.lower("kind"), "^(int|double)_", "")
    value = F.coalesce(F.col("double_value"), F.col("int_value").cast("double"))
    return (points.withColumn("kind", kind).withColumn("value", value).withColumn("attributes", F.col("labels"))
            .withColumn("flags", F.lit(0)).drop("labels", "double_value", "int_value"))


# ---- logs ----

def logs(records: DataFrame) -> DataFrame:
    """Log rows. Records of a resource without a service name are discarded."""
    r = _or_empty(F.col("resource"))
    return (records.filter(_get(r, "service.name").isNotNull())
            .select(_get(r, "service.name").alias("service"),
                    F.coalesce(_get(r, "service.instance.id"), F.try_element_at(r, F.lit("service.instance")), F.lit("")).alias("instance"),
                    F.lit(None).cast("string").alias("endpoint"), F.coalesce(F.try_element_at(r, F.lit("service.layer")), F.lit("")).alias("layer"),
                    F.call_function("div", F.col("time_nanos"), F.lit(1_000_000).cast("bigint")).alias("ts"),
                    F.lit(None).cast("string").alias("trace_id"), F.lit(None).cast("string").alias("segment_id"),
                    F.lit(None).cast("int").alias("span_id"), F.lit("TEXT").alias("body_type"), "body", _or_empty(F.col("attributes")).alias("tags")))
