"""Queries on the source adapters. The driver's rows are dressed as the input of each adapter by Spark itself."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import labels as L
from ..operators import aggregates as A
from ..operators import genai
from ..operators import rules as R
from ..sources import clients, flows, mesh, meters, otlp, records, runtimes, tables
from . import catalog
from . import frames as fr
from .q_rules import THRESHOLDS, percentile_sql
from .registry import query
from .runtime import lookup

V = f"WITH {fr.SVC}"
MIN = "minute AS time_bucket"


def _s(spark, sf):
    return fr.service_rows(spark, sf)


def _text(c):
    return F.col(c).cast("string")


# ---- Kafka ----

@query("src_kafka", f"{V} SELECT event_id, 'logs_json' AS kind, name FROM svc WHERE k % 3 = 0 UNION ALL SELECT event_id, 'meters', name FROM svc WHERE k % 3 = 1")
def src_kafka(spark, sf):
    """Records of three topics, routed by topic and parsed by kind; texts that are no JSON are left out."""
    s = _s(spark, sf)
    topic = F.when(F.col("k") % 3 == 0, "prod-logs-json").when(F.col("k") % 3 == 1, "prod-meters").otherwise("prod-unknown")
    raw = s.select(topic.alias("topic"), F.to_json(F.struct("event_id", "name")).cast("binary").alias("value"))
    routed = tables.route_kafka(raw, "prod")
    part = lambda k: tables.parse_kind(routed, k, "event_id bigint, name string").withColumn("kind", F.lit(k))
    return part("logs_json").unionByName(part("meters")).select("event_id", "kind", "name")


# ---- OTLP ----

@query("src_otlp_traces", f"""{V} SELECT CAST(event_id AS VARCHAR) AS span_id, CASE WHEN k % 4 = 0 THEN 'faas-' || instance ELSE name END AS local_service,
CASE WHEN k % 3 = 0 THEN endpoint WHEN k % 3 = 1 THEN 'host-' || instance ELSE '' END AS remote_service, CASE WHEN status THEN 'SERVER' END AS kind, latency * 1000 AS duration_us,
CASE WHEN status THEN '' ELSE 'true' END AS error, CASE WHEN k % 4 = 0 THEN 'faas.name' ELSE '' END AS source, CASE WHEN status THEN '' ELSE 'internal' END AS span_kind, 'start|{{"a":"1"}}|0' AS note, 'x' AS attribute FROM svc""".replace("{{", "{").replace("}}", "}"))
def src_otlp_traces(spark, sf):
    s = _s(spark, sf)
    d = F.col("k") % 3
    resource = F.when(F.col("k") % 4 == 0, F.create_map(F.lit("faas.name"), F.concat(F.lit("faas-"), "instance"), F.lit("attr"), F.lit("r"))).otherwise(
        F.create_map(F.lit("service.name"), F.col("name"), F.lit("attr"), F.lit("r")))
    attributes = F.map_concat(F.create_map(F.lit("attr"), F.lit("x")), F.when(d == 0, F.create_map(F.lit("peer.service"), F.col("endpoint")))
                              .when(d == 1, F.create_map(F.lit("net.peer.name"), F.concat(F.lit("host-"), "instance"))).otherwise(F.create_map(F.lit("net.peer.ip"), F.lit("10.0.0.1"))))
    spans = s.select(
        resource.alias("resource"), F.lit("lib").alias("scope_name"), F.lit("").alias("scope_version"), F.lit("aa").alias("trace_id"), _text("event_id").alias("span_id"),
        F.lit("").alias("parent_span_id"), F.lit("").alias("trace_state"), F.col("endpoint").alias("name"), F.when(F.col("status"), "SPAN_KIND_SERVER").otherwise("SPAN_KIND_INTERNAL").alias("kind"),
        (F.col("ms") * 1_000_000).alias("start_nanos"), ((F.col("ms") + F.col("latency")) * 1_000_000).alias("end_nanos"), attributes.alias("attributes"),
        F.when(F.col("status"), "STATUS_CODE_UNSET").otherwise("STATUS_CODE_ERROR").alias("status_code"), F.lit("").alias("status_message"),
        F.array(F.struct((F.col("ms") * 1_000_000).alias("time_nanos"), F.lit("start").alias("name"), F.create_map(F.lit("a"), F.lit("1")).alias("attributes"), F.lit(0).alias("dropped"))).alias("events"),
        F.lit(None).cast("array<struct<trace_id:string,span_id:string,trace_state:string,attributes:map<string,string>,dropped:int>>").alias("links"))
    out = otlp.traces(spans)
    tag = lambda k: F.coalesce(F.try_element_at("tags", F.lit(k)), F.lit(""))
    return out.select("span_id", "local_service", F.coalesce("remote_service", F.lit("")).alias("remote_service"), "kind", "duration_us", tag("error").alias("error"),
                      tag("otlp.service.name.source").alias("source"), tag("span.kind").alias("span_kind"), F.col("annotations")[0]["value"].alias("note"), tag("attr").alias("attribute"))


def _points(spark, sf):
    """Gauge, histogram, exponential histogram and summary points, by k."""
    s = _s(spark, sf)
    kind = F.element_at(F.array(*[F.lit(x) for x in ("gauge", "histogram", "exponential_histogram", "summary")]), (F.col("k") % 4 + 1).cast("int"))
    n = F.col("latency")
    return s.select(
        "event_id", F.create_map(F.lit("service.name"), F.col("name"), F.lit("host.name"), F.col("instance")).alias("resource"),
        F.concat(F.lit("m."), _text("event_id")).alias("name"), kind.alias("kind"), F.lit("CUMULATIVE").alias("temporality"), F.lit(0).alias("flags"),
        F.create_map(F.lit("svc.kind"), F.col("endpoint")).alias("attributes"), (F.col("ms") * 1_000_000).alias("time_nanos"), n.cast("double").alias("value"),
        n.alias("count"), (n * 2).cast("double").alias("sum"), F.array(n, n + 1, n + 2).alias("bucket_counts"), F.array(F.lit(0.5), F.lit(1.5)).alias("explicit_bounds"),
        F.lit(0).alias("scale"), F.lit(1).alias("positive_offset"), F.array(n, n + 1).alias("positive_counts"), F.lit(2).alias("negative_offset"), F.array(n + 5).alias("negative_counts"),
        F.array(F.struct(F.lit(0.5).alias("quantile"), (n + 7).cast("double").alias("value"))).alias("quantiles"))


def _point_sql(prefix):
    lab = "'host_name=' || instance || ',job_name=' || name || '{le},node_identifier_host_name=' || instance || '{q},service_name=' || name || ',svc_kind=' || endpoint"
    rows = [("'m_' || event_id", "", "", "latency", "k % 4 = 0")]
    rows += [("'m_' || event_id || '_count'", "", "", "latency", "k % 4 > 0"), ("'m_' || event_id || '_sum'", "", "", "latency * 2", "k % 4 > 0")]
    rows += [("'m_' || event_id", f",le={b}", "", v, "k % 4 = 1") for b, v in (("0.5", "latency"), ("1.5", "latency + 1"), ("Infinity", "latency + 2"))]
    # base 2 at scale 0: -2^2, then 2^2 and the open bucket
    rows += [("'m_' || event_id", f",le={b}", "", v, "k % 4 = 2") for b, v in (("-4.0", "latency + 5"), ("4.0", "latency"), ("Infinity", "latency + 1"))]
    rows += [("'m_' || event_id", "", ",quantile=0.5", "latency + 7", "k % 4 = 3")]
    return f"{V} " + " UNION ALL ".join(
        f"SELECT {n} AS name, '{{' || {lab.replace('{le}', le).replace('{q}', q)} || '}}' AS labels, ms AS ts, CAST({v} AS DOUBLE) AS value FROM svc WHERE {c}" for n, le, q, v, c in rows)


@query("src_otlp_metrics", _point_sql("m"))
def src_otlp_metrics(spark, sf):
    return otlp.metrics(_points(spark, sf)).withColumn("labels", L.encode(F.col("labels")))


@query("src_firehose", f"{V} SELECT 'f_' || event_id AS name, '{{job_name=' || name || ',kind=' || endpoint || ',service_name=' || name || '}}' AS labels, ms AS ts, CAST(CASE WHEN k % 2 = 0 THEN latency ELSE k END AS DOUBLE) AS value FROM svc")
def src_firehose(spark, sf):
    """Integer and double points of the older form."""
    p = _points(spark, sf).join(_s(spark, sf).select("event_id", "name", "endpoint", "k", "latency").withColumnRenamed("name", "svc"), "event_id")
    old = p.select(F.create_map(F.lit("service.name"), F.col("svc")).alias("resource"), F.concat(F.lit("f/"), _text("event_id")).alias("name"),
                   F.when(F.col("k") % 2 == 0, "int_gauge").otherwise("double_gauge").alias("kind"), "temporality", F.create_map(F.lit("kind"), F.col("endpoint")).alias("labels"),
                   "time_nanos", F.when(F.col("k") % 2 == 0, F.col("latency")).alias("int_value"), F.when(F.col("k") % 2 == 1, F.col("k").cast("double")).alias("double_value"),
                   "count", "sum", "bucket_counts", "explicit_bounds", "scale", "positive_offset", "positive_counts", "negative_offset", "negative_counts", "quantiles")
    return otlp.metrics(otlp.old_metrics(old)).withColumn("labels", L.encode(F.col("labels")))


@query("src_otlp_logs", f"{V} SELECT event_id, name AS service, CASE WHEN k % 2 = 0 THEN instance ELSE '' END AS instance, ms AS ts, endpoint AS body FROM svc WHERE status")
def src_otlp_logs(spark, sf):
    """Logs of resources without a service name are discarded."""
    s = _s(spark, sf)
    resource = F.map_filter(F.create_map(F.lit("service.name"), F.when(F.col("status"), F.col("name")), F.lit("service.instance.id"), F.when(F.col("k") % 2 == 0, F.col("instance"))), lambda _, v: v.isNotNull())
    rows = s.select(resource.alias("resource"), (F.col("ms") * 1_000_000).alias("time_nanos"), F.col("endpoint").alias("body"), F.create_map(F.lit("id"), _text("event_id")).alias("attributes"))
    return otlp.logs(rows).select(F.col("tags")["id"].cast("bigint").alias("event_id"), "service", "instance", "ts", "body")


# ---- scraped and pushed meters ----

@query("src_prom", f"""{V} SELECT 'a_b_' || endpoint AS name, '{{svc=' || name || '}}' AS labels, ms AS ts, CAST(latency AS DOUBLE) AS value FROM svc WHERE k % 3 = 0
UNION ALL SELECT 'a_b_' || endpoint || '_count', '{{svc=' || name || '}}', ms, CAST(k AS DOUBLE) FROM svc WHERE k % 3 > 0
UNION ALL SELECT 'a_b_' || endpoint || '_sum', '{{svc=' || name || '}}', ms, CAST(latency AS DOUBLE) FROM svc WHERE k % 3 > 0
UNION ALL SELECT 'a_b_' || endpoint, '{{le=' || b || ',svc=' || name || '}}', ms, CAST(k + x AS DOUBLE) FROM svc, (VALUES ('0.5', 0), ('2.0', 1)) t(b, x) WHERE k % 3 = 1
UNION ALL SELECT 'a_b_' || endpoint, '{{quantile=0.9,svc=' || name || '}}', ms, CAST(latency AS DOUBLE) FROM svc WHERE k % 3 = 2""")
def src_prom(spark, sf):
    s = _s(spark, sf)
    kind = F.element_at(F.array(F.lit("gauge"), F.lit("histogram"), F.lit("summary")), (F.col("k") % 3 + 1).cast("int"))
    rows = s.select(F.concat(F.lit("a.b/"), "endpoint").alias("name"), kind.alias("kind"), F.create_map(F.lit("svc"), F.col("name")).alias("labels"), F.col("ms").alias("ts"),
                    F.col("latency").cast("double").alias("value"), F.col("k").alias("count"), F.col("latency").cast("double").alias("sum"),
                    F.create_map(F.lit(0.5), F.col("k"), F.lit(2.0), F.col("k") + 1).alias("buckets"), F.create_map(F.lit(0.9), F.col("latency").cast("double")).alias("quantiles"))
    return meters.prometheus(rows).withColumn("labels", L.encode(F.col("labels")))


@query("src_meter", f"""{V} SELECT endpoint AS name, '{{instance=' || instance || ',service=' || name || '}}' AS labels, ms AS ts, CAST(latency AS DOUBLE) AS value FROM svc WHERE k % 2 = 0 AND name <> 'svc_0'
UNION ALL SELECT endpoint, '{{instance=' || instance || ',le=' || b || ',service=' || name || '}}', ms, CAST(k + x AS DOUBLE) FROM svc, (VALUES ('-9223372036854775808', 0), ('100.0', 1)) t(b, x) WHERE k % 2 = 1 AND name <> 'svc_0'""")
def src_meter(spark, sf):
    s = _s(spark, sf)
    bucket = lambda b, inf, c: F.struct(F.lit(b).alias("bucket"), F.lit(inf).alias("negative_infinity"), c.alias("count"))
    rows = s.select(F.when(F.col("name") != "svc_0", F.col("name")).alias("service"), "instance", F.col("ms").alias("ts"), F.col("endpoint").alias("name"), L.empty().alias("labels"),
                    F.col("latency").cast("double").alias("value"), F.when(F.col("k") % 2 == 1, F.array(bucket(0.0, True, F.col("k")), bucket(100.0, False, F.col("k") + 1))).alias("buckets"))
    return meters.agent_meters(rows).withColumn("labels", L.encode(F.col("labels")))


@query("src_telegraf", f"{V} SELECT endpoint || '_' || f AS name, '{{host=' || instance || '}}' AS labels, ms // 1000 * 1000 AS ts, CAST(CASE f WHEN 'k' THEN k ELSE latency END AS DOUBLE) AS value FROM svc, (VALUES ('k'), ('lat')) t(f)")
def src_telegraf(spark, sf):
    """The field ``who`` is no number."""
    s = _s(spark, sf)
    rows = s.select(F.col("endpoint").alias("name"), F.create_map(F.lit("host"), F.col("instance")).alias("tags"), F.expr("ms div 1000").alias("timestamp"),
                    F.create_map(F.lit("k"), _text("k"), F.lit("lat"), _text("latency"), F.lit("who"), F.col("name")).alias("fields"))
    return meters.telegraf(rows).withColumn("labels", L.encode(F.col("labels")))


@query("src_zabbix", f"""{V} SELECT 'vfs_fs_size' AS name, '{{1=' || endpoint || ',2=a,b,dc=x,host=' || instance || '}}' AS labels, ms // 1000 * 1000 AS ts, CAST(latency AS DOUBLE) AS value FROM svc WHERE status AND k % 2 = 0
UNION ALL SELECT 'system_load', '{{dc=x,host=' || instance || '}}', ms // 1000 * 1000, CAST(latency AS DOUBLE) FROM svc WHERE status AND k % 2 = 1""")
def src_zabbix(spark, sf):
    """Items in error are left out; a quoted parameter may hold a comma."""
    s = _s(spark, sf)
    key = F.when(F.col("k") % 2 == 0, F.concat(F.lit("vfs.fs.size["), "endpoint", F.lit(',"a,b"]'))).otherwise("system.load")
    rows = s.select(F.col("instance").alias("host"), key.alias("key"), _text("latency").alias("value"), F.expr("ms div 1000").alias("clock"), F.when(F.col("status"), 0).otherwise(1).alias("state"))
    return meters.zabbix(rows, {"dc": "x"}, "i_.*").withColumn("labels", L.encode(F.col("labels")))


# ---- runtimes ----

def _jvm(spark, sf):
    s = _s(spark, sf)
    n = F.col("latency")
    mem = lambda heap, f: F.struct(F.lit(heap).alias("is_heap"), (n * f).alias("init"), (n * f * 2).alias("max"), (n * f).alias("used"), n.alias("committed"))
    pool = lambda t, f: F.struct(F.lit(t).alias("pool_type"), n.alias("init"), n.alias("max"), (n + f).alias("used"), n.alias("committed"))
    gc = lambda p, f: F.struct(F.lit(p).alias("phase"), (F.col("k") * f).alias("time"), F.lit(1).cast("bigint").alias("count"))
    thread = F.struct(*[(F.col("k") + i).alias(c) for i, c in enumerate(("live_count", "daemon_count", "peak_count", "runnable", "blocked", "waiting", "timed_waiting"))])
    clazz = F.struct(*[(F.col("k") * 10 + i).alias(c) for i, c in enumerate(("loaded_class_count", "total_unloaded_class_count", "total_loaded_class_count"))])
    return s.select(F.col("name").alias("service"), "instance", F.col("ms").alias("time"), (F.col("k") / 20.0).alias("cpu"), F.array(mem(True, 1), mem(False, 3)).alias("memory"),
                    F.array(pool("NEWGEN_USAGE", 1), pool("OLDGEN_USAGE", 2)).alias("memory_pool"), F.array(gc("NEW", 1), gc("OLD", 2)).alias("gc"), thread.alias("thread"), clazz.alias("clazz"))


_IID = "base64(encode(name)) || '.1_' || base64(encode(instance)) AS entity_id"


def _metric_rows(expressions, extra=""):
    return " UNION ALL ".join(f"SELECT '{m}' AS metric, {_IID}, {MIN}, CAST({e} AS DOUBLE) AS value FROM svc {extra} GROUP BY name, instance, minute" for m, e in expressions)


_JVM = [("instance_jvm_cpu", "sum(greatest(k / 20.0::DOUBLE, 1.0)) / count(*)"), ("instance_jvm_memory_heap", "sum(latency) // count(*)"), ("instance_jvm_memory_noheap", "sum(latency * 3) // count(*)"),
        ("instance_jvm_memory_heap_max", "sum(latency * 2) // count(*)"), ("instance_jvm_memory_noheap_max", "sum(latency * 6) // count(*)"),
        ("instance_jvm_memory_pool_newgen", "sum(latency + 1) // count(*)"), ("instance_jvm_memory_pool_oldgen", "sum(latency + 2) // count(*)"),
        ("instance_jvm_young_gc_time", "sum(k)"), ("instance_jvm_old_gc_time", "sum(k * 2)"), ("instance_jvm_young_gc_count", "count(*)"), ("instance_jvm_old_gc_count", "count(*)"),
        ("instance_jvm_class_loaded_class_count", "sum(k * 10) // count(*)"), ("instance_jvm_class_total_unloaded_class_count", "sum(k * 10 + 1) // count(*)"), ("instance_jvm_class_total_loaded_class_count", "sum(k * 10 + 2) // count(*)")]
_JVM += [(f"instance_jvm_thread_{n}", f"sum(k + {i}) // count(*)") for i, n in enumerate(("live_count", "daemon_count", "peak_count", "runnable_state_thread_count", "blocked_state_thread_count", "waiting_state_thread_count", "timed_waiting_state_thread_count"))]


def _all_rules(frames):
    out = None
    for source, df in frames.items():
        part = R.run(df, catalog.by_source(source)).drop("label")
        out = part if out is None else out.unionByName(part)
    return out


@query("src_jvm", f"{V} {_metric_rows(_JVM)}")
def src_jvm(spark, sf):
    """Snapshots through the adapter and all shipped rules of its six frames."""
    return _all_rules(runtimes.jvm(_jvm(spark, sf)))


_CLR = [("instance_clr_cpu", "CAST(sum(k) AS DOUBLE) / count(*)"), ("instance_clr_gen0_collect_count", "sum(k)"), ("instance_clr_gen1_collect_count", "sum(k + 1)"), ("instance_clr_gen2_collect_count", "sum(k + 2)"),
        ("instance_clr_heap_memory", "sum(latency) // count(*)")] + [(f"instance_clr_{n}", f"greatest(max(k * {i + 1}), 0)") for i, n in enumerate(
            ("available_completion_port_threads", "available_worker_threads", "max_completion_port_threads", "max_worker_threads"))]


@query("src_clr", f"{V} {_metric_rows(_CLR)}")
def src_clr(spark, sf):
    s = _s(spark, sf)
    gc = F.struct(F.col("k").alias("gen0_collect_count"), (F.col("k") + 1).alias("gen1_collect_count"), (F.col("k") + 2).alias("gen2_collect_count"), F.col("latency").alias("heap_memory"))
    names = ("available_completion_port_threads", "available_worker_threads", "max_completion_port_threads", "max_worker_threads")
    thread = F.struct(*[(F.col("k") * (i + 1)).alias(n) for i, n in enumerate(names)])
    rows = s.select(F.col("name").alias("service"), "instance", F.col("ms").alias("time"), F.col("k").cast("double").alias("cpu"), gc.alias("gc"), thread.alias("thread"))
    return _all_rules(runtimes.clr(rows))


# ---- mesh ----

def _mesh_rows(spark, sf):
    s = _s(spark, sf)
    return s.select(
        F.when(F.col("k") % 5 != 0, F.concat(F.lit("src_"), (F.col("user_id") % 7).cast("string"))).alias("source_service"), F.when(F.col("k") % 5 > 1, F.col("instance")).alias("source_instance"),
        F.col("name").alias("dest_service"), F.when(F.col("k") % 7 != 0, F.col("instance")).alias("dest_instance"), F.when(F.col("k") % 6 != 0, F.col("endpoint")).alias("endpoint"),
        F.col("ms").alias("start_time"), F.col("latency").cast("int").alias("latency"), F.col("http_status").alias("response_code"), "status", F.when(F.col("k") % 2 == 0, "HTTP").otherwise("gRPC").alias("protocol"),
        F.when(F.col("k") % 3 == 0, "client").otherwise("server").alias("detect_point"), F.lit("NONE").alias("tls_mode"), F.lit(None).cast("string").alias("internal_error_code"),
        (F.col("k") * 10).alias("internal_request_latency_nanos"), (F.col("k") * 20).alias("internal_response_latency_nanos"),
        F.create_map(F.lit("v"), _text("k")).alias("dest_properties"), F.col("latency").alias("received_bytes"), F.col("k").alias("sent_bytes"))


def _mesh_count(frame, cond):
    return f"SELECT '{frame}' AS frame, CAST(count(*) FILTER ({cond}) AS BIGINT) AS n, CAST(sum(latency) FILTER ({cond}) AS BIGINT) AS total FROM svc"


_MESH_COUNTS = " UNION ALL ".join(_mesh_count(*x) for x in (
    ("service", "k % 3 <> 0"), ("service_instance", "k % 3 <> 0 AND k % 7 <> 0"), ("endpoint", "k % 3 <> 0 AND k % 6 <> 0"),
    ("service_relation", "k % 5 <> 0"), ("service_instance_relation", "k % 5 > 1")))


@query("src_mesh", f"{V} {_MESH_COUNTS}")
def src_mesh(spark, sf):
    """Rows and latency of each frame: servers count for services, relations need a named source."""
    frames = mesh.mesh(_mesh_rows(spark, sf))
    out = None
    for name in ("service", "service_instance", "endpoint", "service_relation", "service_instance_relation"):
        part = frames[name].agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("latency").cast("bigint")).alias("total")).select(F.lit(name).alias("frame"), "n", "total")
        out = part if out is None else out.unionByName(part)
    return out


@query("src_mesh_tcp", f"{V} SELECT 'service_throughput_received' AS metric, base64(encode(name)) || '.1' AS entity_id, {MIN}, CAST(sum(latency) // count(*) AS DOUBLE) AS value FROM svc WHERE k % 3 <> 0 GROUP BY name, minute UNION ALL SELECT 'service_throughput_sent', base64(encode(name)) || '.1', {MIN}, CAST(sum(k) // count(*) AS DOUBLE) FROM svc WHERE k % 3 <> 0 GROUP BY name, minute")
def src_mesh_tcp(spark, sf):
    return _all_rules({"tcp_service": mesh.mesh(_mesh_rows(spark, sf), tcp=True)["service"]})


@query("src_envoy_als", f"""{V} SELECT event_id, 'server' AS side, CAST(greatest(1, latency) AS INTEGER) AS latency, http_status AS response_code, http_status < 500 AS status, 'GET:/' || endpoint AS endpoint,
CASE WHEN k % 3 = 0 THEN 'NONE' WHEN k % 3 = 1 THEN 'TLS' ELSE 'mTLS' END AS tls_mode, CASE WHEN k % 4 = 0 THEN 'local_reset' WHEN k % 4 = 1 THEN 'no_route_found' ELSE '' END AS code FROM svc
UNION ALL SELECT event_id, 'client', CAST(greatest(1, latency - 10) AS INTEGER), http_status, http_status < 400, 'GET:/' || endpoint, CASE WHEN k % 3 = 0 THEN 'NONE' WHEN k % 3 = 1 THEN 'TLS' ELSE 'mTLS' END, CASE WHEN k % 4 = 0 THEN 'local_reset' WHEN k % 4 = 1 THEN 'no_route_found' ELSE '' END FROM svc""")
def src_envoy_als(spark, sf):
    s = _s(spark, sf)
    d = F.col("k") % 3
    flags = F.when(F.col("k") % 4 == 0, F.array(F.lit("rate_limited"), F.lit("local_reset"))).when(F.col("k") % 4 == 1, F.array(F.lit("no_route_found")))
    rows = s.select(
        F.lit("a").alias("source_service"), F.lit("ai").alias("source_instance"), F.col("name").alias("dest_service"), F.col("instance").alias("dest_instance"), F.col("ms").alias("start_time"),
        F.col("latency").alias("to_last_downstream_tx"), F.lit(10).alias("to_first_upstream_tx"), F.col("latency").alias("to_last_upstream_rx"), F.when(F.col("http_status") != 200, F.col("http_status")).alias("response_code"),
        F.lit("GET").alias("method"), F.concat(F.lit("/"), "endpoint").alias("path"), F.lit("https").alias("scheme"), F.when(d > 0, "subject").otherwise("").alias("local_subject"), F.lit("").alias("local_san"),
        F.lit("").alias("peer_subject"), F.when(d == 2, "san").otherwise("").alias("peer_san"), flags.alias("response_flags"), F.lit(0).alias("internal_request_latency_nanos"), F.lit(0).alias("internal_response_latency_nanos"),
        F.create_map(F.lit("id"), _text("event_id")).alias("dest_properties"))
    side = lambda x: mesh.proxy_logs(rows, x).select(F.col("dest_properties")["id"].cast("bigint").alias("event_id"), F.lit(x).alias("side"), "latency", "response_code", "status", "endpoint", "tls_mode", F.col("internal_error_code").alias("code"))
    return side("server").unionByName(side("client"))


def _kernel(spark, sf):
    s = _s(spark, sf)
    n, k = F.col("latency"), F.col("k")
    end = lambda svc, inst: F.struct(svc.alias("service"), inst.alias("instance"))
    write = F.struct(n.alias("duration"), F.struct((n + 1).alias("duration"), k.alias("transmit_package_count"), (k % 3).alias("retransmit_package_count"), (n * 2).alias("total_package_size")).alias("l4"),
                     F.struct(n.alias("duration"), n.alias("local_duration"), n.alias("output_duration"), k.alias("resolve_mac_count"), k.alias("resolve_mac_duration"), k.alias("net_filter_count"), k.alias("net_filter_duration")).alias("l3"),
                     F.struct(n.alias("duration"), k.alias("enter_queue_buffer_count"), n.alias("ready_send_duration"), n.alias("network_device_send_duration")).alias("l2"))
    read = F.struct(n.alias("duration"), F.struct(n.alias("duration")).alias("l4"), F.struct(n.alias("duration"), n.alias("rcv_duration"), n.alias("local_duration"), k.alias("net_filter_count"), k.alias("net_filter_duration")).alias("l3"),
                    F.struct(k.alias("package_count"), (n * 3).alias("total_package_size"), n.alias("package_to_queue_duration"), n.alias("rcv_package_from_queue_duration")).alias("l2"))
    empty = lambda x: F.when(F.lit(False), x)
    op = lambda kind: F.struct(F.lit(kind).alias("type"), F.col("ms").alias("start_time"),
                               (F.struct(n.alias("duration"), F.col("status").alias("success")) if kind == "connect" else empty(F.struct(n.alias("duration"), F.col("status").alias("success")))).alias("connect"),
                               (F.struct((n + 2).alias("duration")) if kind == "accept" else empty(F.struct((n + 2).alias("duration")))).alias("accept"),
                               (F.struct((n + 3).alias("duration"), F.col("status").alias("success")) if kind == "close" else empty(F.struct((n + 3).alias("duration"), F.col("status").alias("success")))).alias("close"),
                               (read if kind == "read" else empty(read)).alias("read"), (write if kind == "write" else empty(write)).alias("write"))
    http = F.struct(F.col("ms").alias("start_time"), (n * 1_000_000).alias("end_nanos"), F.lit(0).cast("bigint").alias("start_nanos"), F.concat(F.lit("/"), "endpoint").alias("path"), F.lit("GET").alias("method"),
                    F.col("http_status").alias("status_code"), k.alias("size_of_request_header"), k.alias("size_of_request_body"), k.alias("size_of_response_header"), k.alias("size_of_response_body"))
    return s.select(F.when(k % 2 == 0, "client").otherwise("server").alias("role"), end(F.col("name"), F.col("instance")).alias("local"), end(F.col("endpoint"), F.lit("r")).alias("remote"),
                    F.lit(49).alias("component_id"), F.lit("TLS").alias("tls_mode"), F.array(*[op(kind) for kind in ("connect", "accept", "close", "write", "read")]).alias("kernel"), F.array(http).alias("http"))


def _k8s(metric, expr, cond="TRUE"):
    return f"SELECT 'kubernetes_service_{metric}' AS metric, base64(encode(name)) || '.1' AS entity_id, {MIN}, CAST({expr} AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS label FROM svc WHERE {cond} GROUP BY name, minute"


_WEB = "k % 2 = 1"
_AVG = "sum({}) // count(*)".format
_K8S = [_k8s("connect_cpm", "count(*)"), _k8s("connect_time", _AVG("latency")), _k8s("connect_success_cpm", "count(*)", "status")]
_K8S += [_k8s(f"{o}_cpm", "count(*)") for o in ("accept", "close", "write", "read")]
_K8S += [_k8s(f"{o}_time", _AVG(v)) for o, v in (("accept", "latency + 2"), ("close", "latency + 3"), ("write", "latency"), ("read", "latency"))]
_K8S += [_k8s(m, f"sum({v})") for m, v in (
    ("write_package_cpm", "k"), ("write_retrains_package_cpm", "k % 3"), ("write_package_size", "latency * 2"), ("write_netfilter_cpm", "k"), ("write_netfilter_duration", "k"),
    ("read_package_cpm", "k"), ("read_package_size", "latency * 3"), ("read_netfilter_cpm", "k"), ("read_netfilter_duration", "k"), ("resolve_mac_cpm", "k"), ("resolve_mac_duration", "k"))]
_K8S += [_k8s(m, _AVG(v)) for m, v in (
    ("write_l4_time", "latency + 1"), *[(f"write_{x}_time", "latency") for x in ("l3", "l3_local", "l3_output", "l2")], *[(f"read_{x}_time", "latency") for x in ("l4", "l3", "l3_rcv", "l3_local")],
    ("write_l2_enter_avg_queue_count", "k"), ("write_l2_ready_avg_send_duration", "latency"), ("write_l2_net_device_avg_send_duration", "latency"),
    ("read_package_to_queue_time", "latency"), ("read_rcv_package_from_queue_time", "latency"))]
_K8S += [_k8s("http_call_cpm", "count(*)", _WEB), _k8s("http_call_time", _AVG("latency"), _WEB), _k8s("http_call_successful_rate", "count(*) FILTER (http_status < 500) * 10000 // count(*)", _WEB)]
_K8S += [_k8s(f"http_avg_{x}_size", _AVG("k"), _WEB) for x in ("req_header", "req_body", "resp_header", "resp_body")]
_K8S += [_k8s(f"http_status_{n}xx_cpm", "count(*)", f"{_WEB} AND http_status // 100 = {n}") for n in range(1, 6)]
_THR = "(CASE WHEN user_id % 10 < 5 THEN (user_id % 10 + 1) * 100 ELSE 500 END)"
_K8S += [_k8s("apdex", f"(count(*) FILTER (http_status < 500 AND latency <= {_THR}) * 10000 + (count(*) FILTER (http_status < 500 AND latency > {_THR} AND latency <= 4 * {_THR}) * 10000) // 2) // count(*)", _WEB),
         "SELECT 'kubernetes_service_percentile', entity_id, time_bucket, CAST(value AS DOUBLE), CAST(p AS VARCHAR) FROM pct"]


@query("src_ebpf_access", f"""{V}, served AS (SELECT base64(encode(name)) || '.1' AS entity_id, {MIN}, latency FROM svc WHERE {_WEB}),
pct AS (WITH {percentile_sql('served', 'entity_id, time_bucket', 'latency // 10', A.RANKS, 10)}) """ + " UNION ALL ".join(_K8S))
def src_ebpf_access(spark, sf):
    """Kernel and protocol logs through the adapter and all shipped rules of a service."""
    rows = lookup(mesh.kernel_logs(_kernel(spark, sf))["k8s_service"], F.col("name"), THRESHOLDS, "apdex_threshold", 500)
    return R.run(rows, catalog.by_source("k8s_service")).select("metric", "entity_id", "time_bucket", "value", "label")


@query("src_ebpf_tcp", f"""{V} SELECT CASE WHEN k % 2 = 0 THEN name ELSE endpoint END AS source_service, CASE WHEN k % 2 = 0 THEN endpoint ELSE name END AS dest_service, CAST(sum(latency * 2) AS BIGINT) AS sent, CAST(sum(latency * 3) AS BIGINT) AS received FROM svc GROUP BY 1, 2""")
def src_ebpf_tcp(spark, sf):
    """TCP bytes between the ends of kernel connections, from client to server."""
    t = mesh.kernel_tcp(_kernel(spark, sf))
    return t.groupBy("source_service", "dest_service").agg(F.sum("sent_bytes").alias("sent"), F.sum("received_bytes").alias("received"))


def _flows(spark, sf):
    s = _s(spark, sf)
    end = lambda i, svc, ns: F.struct(i.alias("id"), svc.alias("service"), F.lit("pod").alias("instance"), F.lit("pod").alias("pod"), ns.alias("namespace"))
    http = F.when(F.col("k") % 4 == 1, F.struct(F.col("http_status").alias("code"), F.concat(F.lit("http://h/"), "endpoint", F.lit("?q=1")).alias("url"), F.lit("GET").alias("method"), F.lit("HTTP/1.1").alias("protocol")))
    dns = F.when(F.col("k") % 4 == 2, F.struct((F.col("k") % 3).cast("int").alias("rcode"), F.lit("Code").alias("rcode_string"), F.lit("q").alias("query"), F.lit("A").alias("qtype")))
    kafka = F.when(F.col("k") % 4 == 3, F.struct(F.when(F.col("status"), 0).otherwise(5).alias("error_code"), F.lit("LEADER").alias("error_code_string"), F.lit("t1").alias("topic"), F.lit("fetch").alias("api_key")))
    return s.select(
        end(F.when(F.col("user_id") % 2 == 0, 7).otherwise(0), F.col("name"), F.lit("a")).alias("source"), end(F.when(F.col("user_id") % 2 == 0, 0).otherwise(9), F.col("endpoint"), F.lit("b")).alias("destination"),
        (F.col("user_id") % 3 == 0).alias("is_reply"), F.when(F.col("type") == "MQ", "DROPPED").when(F.col("type") == "HTTP", "FORWARDED").otherwise(F.when(F.col("k") % 10 < 9, "FORWARDED").otherwise("AUDIT")).alias("verdict"),
        F.when(F.col("user_id") % 5 < 3, "INGRESS").otherwise("EGRESS").alias("direction"), F.when(F.col("k") % 4 == 0, "L3_L4").otherwise("L7").alias("type"), F.expr("ms div 1000").alias("time"),
        F.concat(F.lit("reason_"), (F.col("k") % 2).cast("string")).alias("drop_reason"), F.lit("RESPONSE").alias("l7_type"), F.col("latency").alias("latency_ns"), http.alias("http"), dns.alias("dns"), kafka.alias("kafka"))


# the side that saw a flow: sources of even users have an id, destinations of odd ones; replies are judged and turned by their destination
_FLOW = f"""fl AS (SELECT *, CASE WHEN user_id % 3 = 0 THEN CASE WHEN user_id % 2 = 0 THEN 'SERVER' ELSE 'CLIENT' END ELSE CASE WHEN user_id % 2 = 0 THEN 'CLIENT' ELSE 'SERVER' END END AS seen,
  CASE WHEN user_id % 3 = 0 THEN endpoint ELSE name END AS s, CASE WHEN user_id % 3 = 0 THEN name ELSE endpoint END AS d, (user_id % 5 < 3) <> (user_id % 3 = 0) AS ingress, type = 'MQ' AS dropped
  FROM svc WHERE NOT (type = 'RPC' AND k % 10 = 9)), fo AS (SELECT *, CASE seen WHEN 'CLIENT' THEN s ELSE d END AS own FROM fl)"""


def _cil(metric, expr, cond):
    return f"SELECT 'cilium_service_{metric}' AS metric, base64(encode(own)) || '.1' AS entity_id, {MIN}, CAST({expr} AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS label FROM fo WHERE {cond} GROUP BY own, minute"


_FORWARDED = "NOT dropped AND seen = 'SERVER' AND "
_HTTP, _DNS, _KAFKA = _FORWARDED + "k % 4 = 1", _FORWARDED + "k % 4 = 2", _FORWARDED + "k % 4 = 3"
_FLOW_OK = "CASE k % 4 WHEN 1 THEN http_status < 500 WHEN 2 THEN k % 3 = 0 WHEN 3 THEN status ELSE TRUE END"


def _cil_labels(metric, label, cond):
    return f"SELECT 'cilium_service_{metric}', base64(encode(own)) || '.1', {MIN}, CAST(count(*) AS DOUBLE), {label} FROM fo WHERE {cond} GROUP BY ALL"


@query("src_cilium", f"{V}, {_FLOW} " + " UNION ALL ".join([
    *[_cil(f"l4_{side}_pkg_{'drop_' if drop else ''}cpm", "count(*)", f"{'' if drop else 'NOT '}dropped AND k % 4 = 0 AND {'' if side == 'read' else 'NOT '}ingress") for side in ("read", "write") for drop in (False, True)],
    _cil("protocol_cpm", "count(*)", _FORWARDED + "k % 4 > 0"), _cil("protocol_call_duration", "sum(latency)", _FORWARDED + "k % 4 > 0"),
    _cil("protocol_call_success_count", "count(*)", f"{_FORWARDED} k % 4 > 0 AND {_FLOW_OK}"),
    *[_cil(f"protocol_{p}_call_cpm", "count(*)", c) for p, c in (("http", _HTTP), ("dns", _DNS), ("kafka", _KAFKA))],
    *[_cil(f"protocol_{p}_call_duration", "sum(latency)", c) for p, c in (("http", _HTTP), ("dns", _DNS), ("kafka", _KAFKA))],
    *[_cil(f"protocol_{p}_call_success_count", "count(*)", f"{c} AND {_FLOW_OK}") for p, c in (("http", _HTTP), ("dns", _DNS), ("kafka", _KAFKA))],
    *[_cil(f"protocol_http_status_{h}xx_cpm", "count(*)", f"{_HTTP} AND http_status // 100 = {h}") for h in range(1, 6)],
    _cil_labels("protocol_dns_error_count", "'Code'", f"{_DNS} AND NOT {_FLOW_OK}"), _cil_labels("protocol_kafka_call_error_count", "'LEADER'", f"{_KAFKA} AND NOT {_FLOW_OK}"),
    _cil_labels("l4_drop_reason_count", "'reason_' || (k % 2)", "dropped AND k % 4 = 0")]))
def src_cilium(spark, sf):
    """Flows through the adapter and all shipped rules of a service."""
    rows = flows.flows(_flows(spark, sf))["flow_service"]
    return R.run(rows, catalog.by_source("flow_service")).select("metric", "entity_id", "time_bucket", "value", "label")


# ---- clients ----

@query("src_browser", f"""{V}, b AS (SELECT base64(encode(name)) || '.1' AS entity_id, minute, status, k FROM svc)
SELECT 'browser_app_pv' AS metric, entity_id, {MIN}, CAST(count(*) AS DOUBLE) AS value FROM b WHERE status GROUP BY entity_id, minute
UNION ALL SELECT 'browser_app_error_sum', entity_id, {MIN}, CAST(count(*) AS DOUBLE) FROM b WHERE NOT status GROUP BY entity_id, minute
UNION ALL SELECT 'browser_app_error_rate', entity_id, {MIN}, CAST(CASE WHEN count(*) FILTER (status) = 0 THEN 0 ELSE count(*) FILTER (NOT status AND k % 2 = 0) * 10000 // count(*) FILTER (status) END AS DOUBLE) FROM b GROUP BY entity_id, minute""")
def src_browser(spark, sf):
    """Page loads and errors through the adapter and the shipped rules of the app."""
    s = _s(spark, sf)
    base = [F.col("name").alias("service"), F.lit("v1").alias("version"), F.concat(F.lit("/"), "endpoint").alias("page"), F.col("ms").alias("ts")]
    perf = s.filter("status").select(*base)
    errors = s.filter("not status").select(*base, F.lit("js").alias("category"), (F.col("k") % 2 == 0).alias("first_reported"))
    return _all_rules({"browser_app_traffic": clients.browser_traffic(perf, errors)["browser_app_traffic"]})


def _resources(metric, expr, label):
    return f"SELECT 'browser_app_resource_{metric}' AS metric, entity_id, {MIN}, CAST({expr} AS DOUBLE) AS value, {label} AS label FROM r GROUP BY entity_id, minute, {label}"


_UP = "CASE WHEN sum({0}) // count(*) = 0 AND sum({0}) > 0 THEN 1 ELSE sum({0}) // count(*) END".format


@query("src_browser_perf", f"""{V}, r AS (SELECT base64(encode(name)) || '.1' AS entity_id, minute, endpoint, latency, k, 'h' || (k % 3 + 1) AS protocol, CASE WHEN k % 2 = 0 THEN 'css' ELSE 'img' END AS kind FROM svc) """ + " UNION ALL ".join([
    _resources("duration_avg", _UP("latency"), "endpoint"), _resources("size_avg", _UP("k"), "endpoint"), _resources("protocol_count", "count(*)", "protocol"), _resources("type_count", "count(*)", "kind")]))
def src_browser_perf(spark, sf):
    s = _s(spark, sf)
    rows = s.select(F.col("name").alias("service"), F.col("ms").alias("ts"), F.col("endpoint").alias("name"), F.col("latency").alias("duration"), F.col("k").alias("size"),
                    F.concat(F.lit("h"), (F.col("k") % 3 + 1).cast("string")).alias("protocol"), F.when(F.col("k") % 2 == 0, "css").otherwise("img").alias("type"))
    frame = clients.browser_app_perf(rows, ["name", "duration", "size", "protocol", "type"])
    return R.run(frame, catalog.by_source("browser_resource_perf")).select("metric", "entity_id", "time_bucket", "value", "label")


def _mobile(spark, sf):
    s = _s(spark, sf)
    resource = F.create_map(F.lit("os.name"), F.when(F.col("k") % 5 == 0, "Android").otherwise("iOS"), F.lit("service.name"), F.col("name"), F.lit("service.version"), F.lit("1.0"))
    old = F.create_map(F.lit("http.method"), F.lit("GET"), F.lit("net.peer.name"), F.col("endpoint"), F.lit("http.status_code"), _text("http_status"))
    new = F.create_map(F.lit("http.request.method"), F.lit("GET"), F.lit("server.address"), F.col("endpoint"), F.lit("http.response.status_code"), F.lit(""))
    return s.select("event_id", resource.alias("resource"), F.lit("NSURLSession").alias("scope_name"), F.lit("SPAN_KIND_CLIENT").alias("kind"), F.lit("n").alias("name"),
                    F.when(F.col("k") % 2 == 0, old).otherwise(new).alias("attributes"), (F.col("ms") * 1_000_000).alias("start_nanos"), ((F.col("ms") + F.col("latency")) * 1_000_000).alias("end_nanos"), "latency", "k")


@query("src_ios", f"""{V} SELECT name, CAST(count(*) AS BIGINT) AS n, CAST(sum(latency) AS BIGINT) AS total, CAST(count(*) FILTER (k % 2 = 0 AND http_status < 400) AS BIGINT) AS ok FROM svc WHERE k % 5 <> 0 GROUP BY 1""")
def src_ios(spark, sf):
    """Both attribute conventions; a missing response code is a failure."""
    rows = clients.mobile_http(_mobile(spark, sf))["service"]
    return rows.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("latency").cast("bigint")).alias("total"), F.count_if("status").alias("ok"))


@query("ext_span", f"""{V} SELECT 'metrickit_hang_time' AS name, NULL AS le, CAST(count(*) AS BIGINT) AS n, CAST(sum(latency) AS DOUBLE) AS total FROM svc WHERE k % 5 <> 0
UNION ALL SELECT 'metrickit_hang_time_histogram', CAST(b AS VARCHAR), CAST(count(*) AS BIGINT), CAST(count(*) FILTER (latency <= b AND latency > lo) AS DOUBLE) FROM svc, (VALUES (250, -1), (400, 250), (600, 400), (1000, 600), (1500, 1000), (2000, 1500), (3000, 2000), (5000, 3000), (10000, 5000), (30000, 10000)) t(b, lo) WHERE k % 5 <> 0 GROUP BY b""")
def ext_span(spark, sf):
    """A span listener that turns payload spans into samples."""
    m = _mobile(spark, sf).withColumn("scope_name", F.lit("MetricKit")).withColumn("name", F.lit("MXMetricPayload"))
    m = m.withColumn("attributes", F.create_map(F.lit(clients.HANG), (F.col("latency") / 1000.0).cast("string")))
    out = clients.mobile_diagnostics(m)
    return out.groupBy("name", F.try_element_at("labels", F.lit("le")).alias("le")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.round("value")).alias("total"))


# ---- model usage ----

PROVIDERS = [("gpt", "openai"), ("claude", "anthropic")]
PRICES = [("gpt-4o", 2.5, 10.0), ("gpt-4o-mini", 0.15, 0.6), ("claude-4-sonnet", 3.0, 15.0)]


def _matched(spark, sf):
    providers = spark.createDataFrame(PROVIDERS, "prefix string, provider string")
    prices = spark.createDataFrame(PRICES, "prefix string, input_price double, output_price double")
    return genai.match_models(fr.usage(spark, sf), providers, prices)


_PRICE = """pr AS (SELECT *, CASE WHEN starts_with(model, 'gpt') THEN 'openai' WHEN starts_with(model, 'claude') THEN 'anthropic' ELSE 'unknown' END AS provider,
  CASE WHEN starts_with(model, 'gpt-4o-mini') THEN 0.15::DOUBLE WHEN starts_with(model, 'gpt-4o') THEN 2.5::DOUBLE WHEN starts_with(model, 'claude-4-sonnet') THEN 3.0::DOUBLE END AS ip,
  CASE WHEN starts_with(model, 'gpt-4o-mini') THEN 0.6::DOUBLE WHEN starts_with(model, 'gpt-4o') THEN 10.0::DOUBLE WHEN starts_with(model, 'claude-4-sonnet') THEN 15.0::DOUBLE END AS op FROM usage),
co AS (SELECT *, CAST(floor(coalesce(input_tokens * ip, 0) + coalesce(output_tokens * op, 0) + 0.5) AS BIGINT) AS cost FROM pr)"""
U = f"WITH {fr.USAGE}, {_PRICE}"


@query("join_price", f"{U} SELECT conv_id, turn, provider, ip AS input_price, op AS output_price FROM pr")
def join_price(spark, sf):
    return _matched(spark, sf).select("conv_id", "turn", "provider", "input_price", "output_price")


@query("src_genai", f"{U} SELECT provider, model, time_bucket, CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens, CAST(sum(cost) AS BIGINT) AS cost FROM co GROUP BY ALL")
def src_genai(spark, sf):
    rows = genai.access_rows(_matched(spark, sf))["model"]
    return rows.groupBy(F.col("service").alias("provider"), F.col("name").alias("model"), "time_bucket").agg(
        F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"), F.sum("total_estimated_cost").alias("cost"))


_GA = "base64(encode(provider)) || '.0' AS entity_id, time_bucket"


def _provider(metric, expr):
    return f"SELECT 'gen_ai_provider_{metric}' AS metric, {_GA}, CAST({expr} AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS label FROM co GROUP BY provider, time_bucket HAVING {expr} IS NOT NULL"


_MINUTES = "CASE length(CAST(time_bucket AS VARCHAR)) WHEN 12 THEN 1 WHEN 10 THEN 60 ELSE 1440 END"


@query("tr_virtual_genai", f"""{U}, pct AS (WITH {percentile_sql('co', 'provider, time_bucket', 'latency // 10', A.RANKS, 10)}) """ + " UNION ALL ".join([
    _provider("total_estimated_cost", "sum(cost)"), _provider("avg_estimated_cost", "sum(cost) // count(*)"), _provider("sla", "count(*) FILTER (status) * 10000 // count(*)"),
    _provider("resp_time", "sum(latency) // count(*)"), _provider("cpm", f"count(*) // ({_MINUTES})"),
    *[_provider(f"{d}_tokens_sum", f"sum({d}_tokens)") for d in ("input", "output")], *[_provider(f"{d}_tokens_avg", f"sum({d}_tokens) // count(*)") for d in ("input", "output")],
    f"SELECT 'gen_ai_provider_latency_percentile', {_GA}, CAST(value AS DOUBLE), CAST(p AS VARCHAR) FROM pct"]))
def tr_virtual_genai(spark, sf):
    """Provider rows under all shipped rules."""
    return R.run(genai.access_rows(_matched(spark, sf))["provider"], catalog.by_source("genai_provider")).select("metric", "entity_id", "time_bucket", "value", "label")


@query("src_genai_spans", f"{V} SELECT 'gpt-4o' AS model, CASE WHEN status THEN name END AS named_provider, CASE WHEN k % 2 = 0 THEN k ELSE 0 END AS input_tokens, latency AS output_tokens, status, {MIN} FROM svc")
def src_genai_spans(spark, sf):
    """Usage read from span tags; a count that is no number reads as 0."""
    s = _s(spark, sf)
    tags = F.map_filter(F.create_map(
        F.lit(records.MODEL), F.lit("gpt-4o"), F.lit(records.PROVIDER), F.when(F.col("status") & (F.col("k") % 3 == 0), F.col("name")), F.lit(records.SYSTEM), F.when(F.col("status"), F.col("name")),
        F.lit(records.INPUT), F.when(F.col("k") % 2 == 0, _text("k")).otherwise("many"), F.lit(records.OUTPUT), _text("latency"), F.lit("error"), F.when(~F.col("status"), "true")), lambda _, v: v.isNotNull())
    rows = s.select(tags.alias("tags"), (F.col("ms") * 1000).alias("timestamp_us"), (F.col("latency") * 1000).alias("duration_us"))
    return records.genai_usage(rows).select("model", "named_provider", "input_tokens", "output_tokens", "status", "time_bucket")
