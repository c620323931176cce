"""Service mesh: access logs, proxy logs and kernel access logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids, text
from ..functions.timebucket import bucket_of_millis

# Component ids of the protocols, TLS modes, response flags in the order they are tested.
COMPONENTS = {"HTTP": 49, "gRPC": 23, "RPC": 50, "TCP": 110}
NON_TLS, TLS, M_TLS = "NONE", "TLS", "mTLS"
RESPONSE_FLAGS = (
    "failed_local_healthcheck", "no_healthy_upstream", "upstream_request_timeout", "local_reset", "upstream_connection_failure",
    "upstream_connection_termination", "upstream_overflow", "no_route_found", "delay_injected", "fault_injected", "rate_limited",
    "unauthorized_details", "rate_limit_service_error", "downstream_connection_termination", "upstream_retry_limit_exceeded",
    "stream_idle_timeout", "invalid_envoy_request_headers", "downstream_protocol_error")


def _filled(c) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")) != ""


def _side_car() -> Column:
    return F.struct(F.coalesce("internal_error_code", F.lit("")).alias("internal_error_code"),
                    F.col("internal_request_latency_nanos"), F.col("internal_response_latency_nanos")).alias("side_car")


def _prepared(rows: DataFrame, tcp: bool) -> DataFrame:
    out = rows
    for c, cut in (("source_service", text.service_name), ("source_instance", text.instance_name),
                   ("dest_service", text.service_name), ("dest_instance", text.instance_name)):
        out = out.withColumn(c, cut(F.col(c)))
    if not tcp:
        out = out.withColumn("endpoint", text.endpoint_name(F.col("endpoint")))
    return out.withColumn("time_bucket", bucket_of_millis(F.col("start_time"))).withColumn("detect_point", F.upper("detect_point"))


def mesh(rows: DataFrame, tcp: bool = False) -> dict[str, DataFrame]:
    """Access rows to service, instance, endpoint and relation frames; all are projections of one read.

    Input: source_service, source_instance, dest_service, dest_instance, endpoint, start_time, latency, response_code,
    status, protocol, detect_point, tls_mode, internal_error_code and latencies, dest_properties; for TCP received_bytes
    and sent_bytes instead of endpoint, latency, response_code and status. Only the server side counts for services,
    instances and endpoints; relations need a named source.
    """
    r = _prepared(rows, tcp)
    if tcp:
        measure, component = ["received_bytes", "sent_bytes"], F.lit(COMPONENTS["TCP"])
    else:
        kind = F.when(F.col("protocol").isin("gRPC", "HTTP"), F.col("protocol")).otherwise("RPC")
        measure = ["latency", "status", F.col("response_code").alias("http_status"), kind.alias("type")]
        component = F.when(F.col("protocol") == "gRPC", COMPONENTS["gRPC"]).when(F.col("protocol") == "HTTP", COMPONENTS["HTTP"]).otherwise(COMPONENTS["RPC"])
    common = ["time_bucket", *measure, "tls_mode", _side_car(), F.lit("MESH").alias("layer")]
    served = r.filter(F.col("detect_point") == "SERVER")
    sid, did = ids.service_id(F.col("source_service")), ids.service_id(F.col("dest_service"))
    related = r.filter(_filled("source_service"))
    relation = lambda s, d: [s.alias("source_id"), d.alias("dest_id"), ids.relation_id(s, d).alias("entity_id"), "detect_point", component.alias("component_id")]
    si, di = ids.instance_id(sid, F.col("source_instance")), ids.instance_id(did, F.col("dest_instance"))
    out = {
        "service": served.select(F.col("dest_service").alias("name"), did.alias("entity_id"), *common),
        "service_instance": served.filter(_filled("dest_instance")).select(F.col("dest_service").alias("service"), F.col("dest_instance").alias("name"), di.alias("entity_id"), *common),
        "instance_traffic": served.filter(_filled("dest_instance")).select(
            F.col("dest_service").alias("service"), F.col("dest_instance").alias("name"), "time_bucket", F.col("time_bucket").alias("last_ping"),
            F.col("dest_properties").alias("properties")),
        "service_relation": related.select(*relation(sid, did), *common),
        "service_instance_relation": related.filter(_filled("source_instance")).select(*relation(si, di), *common),
    }
    if not tcp:
        out["endpoint"] = served.filter(_filled("endpoint")).select(
            F.col("dest_service").alias("service"), F.col("endpoint").alias("name"), ids.endpoint_id(did, F.col("endpoint")).alias("entity_id"), *common)
    return out


# ---- proxy logs ----

def tls_mode(local_subject: Column, local_san: Column, peer_subject: Column, peer_san: Column) -> Column:
    local, peer = _filled(local_subject) | _filled(local_san), _filled(peer_subject) | _filled(peer_san)
    return F.when(~local, NON_TLS).when(~peer, TLS).otherwise(M_TLS)


def error_code(flags: Column) -> Column:
    """First response flag that is set, in their fixed order. ``flags`` is an array of flag names."""
    hits = F.filter(F.array(*[F.lit(f) for f in RESPONSE_FLAGS]), lambda f: F.array_contains(F.coalesce(flags, F.expr("cast(array() as array<string>)")), f))
    return F.coalesce(F.get(hits, F.lit(0)), F.lit(""))


def proxy_logs(entries: DataFrame, side: str = "server") -> DataFrame:
    """Proxy log entries to mesh rows, seen from below (server) or towards the upstream (client).

    Times are milliseconds: start_time, to_last_downstream_tx, to_first_upstream_tx, to_last_upstream_rx. Calls take at
    least 1 ms. A missing response code reads as 200; a server fails from 500 on, a client from 400.
    """
    code = F.when(F.coalesce("response_code", F.lit(0)) > 0, F.col("response_code")).otherwise(200)
    endpoint = F.when(F.col("path").isNull(), "/").otherwise(F.concat_ws(":", "method", "path"))
    protocol = F.when(F.coalesce("scheme", F.lit("http")).startswith("http"), "HTTP").otherwise("gRPC")
    if side == "server":
        start, end, status = F.col("start_time"), F.col("start_time") + F.col("to_last_downstream_tx"), code < 500
    else:
        start, end = F.col("start_time") + F.col("to_first_upstream_tx"), F.col("start_time") + F.col("to_last_upstream_rx")
        status = code < 400
    return entries.select(
        "source_service", "source_instance", "dest_service", "dest_instance", endpoint.alias("endpoint"), start.alias("start_time"), end.alias("end_time"),
        F.greatest(F.lit(1), end - start).cast("int").alias("latency"), code.cast("int").alias("response_code"), status.alias("status"), protocol.alias("protocol"),
        F.lit(side).alias("detect_point"),
        tls_mode(F.col("local_subject"), F.col("local_san"), F.col("peer_subject"), F.col("peer_san")).alias("tls_mode"),
        error_code(F.col("response_flags")).alias("internal_error_code"), "internal_request_latency_nanos", "internal_response_latency_nanos",
        "dest_properties")


# ---- kernel access logs ----

KERNEL_KINDS = ("connect", "accept", "close", "read", "write")


def kernel_logs(connections: DataFrame) -> dict[str, DataFrame]:
    """Connections with kernel operations and protocol logs to service, instance, relation and endpoint frames.

    Input, one row per connection batch: role (client or server, as seen by the local end), local and remote struct
    (service, instance, layer), component_id, tls_mode, and two arrays: ``kernel`` of (type, start_time, duration and the operation's
    struct connect, accept, close, read or write) and ``http`` of (start_time, end_nanos, start_nanos, path, method,
    status_code, sizes). Kernel rows carry their type; protocol rows are of type ``protocol``.
    """
    kernel = connections.select("role", "local", "remote", "component_id", "tls_mode", F.explode("kernel").alias("_k")).select(
        "role", "local", "remote", "component_id", "tls_mode", "_k.type", bucket_of_millis(F.col("_k.start_time")).alias("time_bucket"),
        *[F.when(F.col("_k.type") == k, F.col(f"_k.{k}")).alias(k) for k in KERNEL_KINDS])
    http = connections.select("role", "local", "remote", "component_id", "tls_mode", F.explode("http").alias("_h"))
    latency = F.call_function("div", F.col("_h.end_nanos") - F.col("_h.start_nanos"), F.lit(1_000_000).cast("bigint"))
    body = F.struct(latency.alias("latency"), F.col("_h.path").alias("url"), F.col("_h.method").alias("method"), F.col("_h.status_code").alias("status_code"),
                    F.col("_h.size_of_request_header"), F.col("_h.size_of_request_body"), F.col("_h.size_of_response_header"), F.col("_h.size_of_response_body"))
    ok = F.col("_h.status_code") < 500
    proto = http.select("role", "local", "remote", "component_id", "tls_mode", F.lit("protocol").alias("type"),
                        bucket_of_millis(F.col("_h.start_time")).alias("time_bucket"),
                        F.struct(F.lit("http").alias("type"), ok.alias("success"), body.alias("http")).alias("protocol"))
    rows = kernel.unionByName(proto, allowMissingColumns=True).withColumn("detect_point", F.upper("role"))
    client = F.col("role") == "client"
    src = lambda f: F.when(client, F.col(f"local.{f}")).otherwise(F.col(f"remote.{f}"))
    dst = lambda f: F.when(client, F.col(f"remote.{f}")).otherwise(F.col(f"local.{f}"))
    payload = ["type", "time_bucket", "detect_point", *KERNEL_KINDS, "protocol"]
    own = ids.service_id(F.col("local.service"))
    s, d = ids.service_id(src("service")), ids.service_id(dst("service"))
    si, di = ids.instance_id(s, src("instance")), ids.instance_id(d, dst("instance"))
    endpoint = F.concat_ws(":", F.col("protocol.http.method"), F.col("protocol.http.url"))
    served = rows.filter((F.col("type") == "protocol") & (F.col("detect_point") == "SERVER"))
    return {
        "k8s_service": rows.filter(_filled("local.service")).select(F.col("local.service").alias("name"), own.alias("entity_id"), *payload),
        "k8s_service_instance": rows.filter(_filled("local.instance")).select(
            F.col("local.service").alias("service"), F.col("local.instance").alias("name"), ids.instance_id(own, F.col("local.instance")).alias("entity_id"), *payload),
        "k8s_service_relation": rows.filter(_filled(src("service")) & _filled(dst("service"))).select(
            s.alias("source_id"), d.alias("dest_id"), ids.relation_id(s, d).alias("entity_id"), "component_id", *payload),
        "k8s_service_instance_relation": rows.filter(_filled(src("instance")) & _filled(dst("instance"))).select(
            si.alias("source_id"), di.alias("dest_id"), ids.relation_id(si, di).alias("entity_id"), "component_id", *payload),
        "k8s_endpoint": served.select(F.col("local.service").alias("service"), endpoint.alias("name"), ids.endpoint_id(own, endpoint).alias("entity_id"),
                                      F.lit("http").alias("type"), "time_bucket", F.col("protocol.success").alias("success"),
                                      F.col("protocol.http.latency").alias("duration"), F.col("protocol.http").alias("http")),
    }


def kernel_tcp(connections: DataFrame) -> DataFrame:
    """TCP mesh rows from the kernel reads and writes of connections: bytes written were sent, bytes read received."""
    rows = connections.select("role", "local", "remote", "tls_mode", F.explode("kernel").alias("_k")).filter(F.col("_k.type").isin("read", "write"))
    client = F.col("role") == "client"
    pick = lambda f, source: F.when(client == F.lit(source), F.col(f"local.{f}")).otherwise(F.col(f"remote.{f}"))
    write = F.col("_k.type") == "write"
    return rows.select(
        pick("service", True).alias("source_service"), pick("instance", True).alias("source_instance"), pick("service", False).alias("dest_service"),
        pick("instance", False).alias("dest_instance"), F.col("_k.start_time").alias("start_time"), F.col("role").alias("detect_point"), "tls_mode",
        F.when(write, 0).otherwise(F.col("_k.read.l2.total_package_size")).cast("bigint").alias("received_bytes"),
        F.when(write, F.col("_k.write.l4.total_package_size")).otherwise(0).cast("bigint").alias("sent_bytes"),
        F.lit("").alias("internal_error_code"), F.lit(0).cast("bigint").alias("internal_request_latency_nanos"),
        F.lit(0).cast("bigint").alias("internal_response_latency_nanos"), F.lit(None).cast("map<string,string>").alias("dest_properties"))
