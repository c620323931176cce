"""Network flows to service, instance, endpoint and relation rows.

A flow row has source and destination structs (id, service, instance, pod, namespace), is_reply, verdict, direction
(INGRESS or EGRESS), type (L3_L4 or L7), time (s), drop_reason, and for L7 the record kind with its struct: l7_type,
latency_ns, http (code, url, method, protocol), dns (rcode, rcode_string, query, qtype), kafka (error_code,
error_code_string, topic, api_key).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids
from ..functions.timebucket import bucket_of_millis

# Component ids by protocol, and names of DNS return codes.
COMPONENTS = {"tcp": 110, "http": 49, "dns": 159, "kafka": 27}
LAYER = "CILIUM_SERVICE"


def _known(end: str) -> Column:
    """An end without id must at least name its pod and namespace."""
    named = (F.coalesce(F.col(f"{end}.pod"), F.lit("")) != "") & (F.coalesce(F.col(f"{end}.namespace"), F.lit("")) != "")
    return F.col(end).isNotNull() & ((F.coalesce(F.col(f"{end}.id"), F.lit(0)) != 0) | named)


def detect_point() -> Column:
    """The side that saw the flow: replies are judged by their destination."""
    seen = F.when(F.col("is_reply"), F.col("destination.id")).otherwise(F.col("source.id"))
    return F.when(F.coalesce(seen, F.lit(0)) != 0, "CLIENT").otherwise("SERVER")


def accepted(flows: DataFrame, excluded_namespaces: Sequence[str] = (), client_as_server: bool = False) -> DataFrame:
    """Forwarded or dropped L3/L4 and L7 flows in a known direction between known ends."""
    keep = (_known("source") & _known("destination") & F.col("verdict").isin("FORWARDED", "DROPPED")
            & F.col("direction").isin("INGRESS", "EGRESS") & F.col("type").isin("L3_L4", "L7"))
    if excluded_namespaces:
        out = lambda end: F.coalesce(F.col(f"{end}.namespace").isin(list(excluded_namespaces)), F.lit(False))
        keep = keep & ~(out("source") & out("destination"))
    rows = flows.filter(keep).withColumn("detect_point", detect_point())
    return rows.filter(F.col("detect_point") != "SERVER") if client_as_server else rows


def turned(rows: DataFrame, client_as_server: bool = False) -> DataFrame:
    """Replies read from client to server: ends swapped, direction reversed."""
    other = F.when(F.col("direction") == "INGRESS", "EGRESS").otherwise("INGRESS")
    flip = F.col("is_reply")
    way = F.when(flip, other).otherwise(F.col("direction"))
    if client_as_server:
        way = F.when(way == "INGRESS", "EGRESS").otherwise("INGRESS")
        rows = rows.withColumn("detect_point", F.lit("SERVER"))
    return rows.select("*", F.when(flip, F.col("destination")).otherwise(F.col("source")).alias("_s"),
                       F.when(flip, F.col("source")).otherwise(F.col("destination")).alias("_d"), way.alias("_way"))


def flows(rows: DataFrame, excluded_namespaces: Sequence[str] = (), client_as_server: bool = False) -> dict[str, DataFrame]:
    """All frames of the accepted flows. HTTP requests (code 0) and unanswered DNS and Kafka records are left out."""
    r = turned(accepted(rows, excluded_namespaces, client_as_server), client_as_server)
    l7 = F.col("type") == "L7"
    answered = F.col("l7_type") == "RESPONSE"
    kind = (F.when(~l7, "tcp").when(F.col("http").isNotNull() & (F.col("http.code") != 0), "http")
            .when(F.col("dns").isNotNull() & answered, "dns").when(F.col("kafka").isNotNull() & answered, "kafka"))
    path = F.regexp_extract("http.url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    endpoint = (F.when(F.col("_kind") == "http", F.concat_ws(":", F.col("http.method"), path))
                .when(F.col("_kind") == "dns", F.concat(F.lit("DNS/"), F.coalesce("dns.qtype", F.lit("UNKNOWN"))))
                .when(F.col("_kind") == "kafka", F.concat_ws("/", F.lit("Kafka"), "kafka.topic", "kafka.api_key")))
    ok = (F.when(F.col("_kind") == "http", F.col("http.code") < 500).when(F.col("_kind") == "dns", F.col("dns.rcode") == 0)
          .when(F.col("_kind") == "kafka", F.col("kafka.error_code") == 0))
    component = F.lit(0)
    for k, c in COMPONENTS.items():
        component = F.when(F.col("_kind") == k, c).otherwise(component)
    base = (r.withColumn("_kind", kind).filter(F.col("_kind").isNotNull())
            .filter((F.col("_kind") != "http") | F.col("http.url").rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"))
            .withColumn("_endpoint", endpoint).withColumn("_ok", ok).withColumn("_component", component)
            .withColumn("_own", F.when(F.col("detect_point") == "CLIENT", F.col("_s")).otherwise(F.col("_d"))))
    code = lambda c: F.coalesce(c, F.lit("UNKNOWN"))
    payload = [F.lower("verdict").alias("verdict"), F.col("_kind").alias("type"), F.lower("_way").alias("direction"),
               bucket_of_millis(F.col("time") * 1000).alias("time_bucket"), F.timestamp_seconds("time").alias("ts"), "detect_point",
               F.when(F.col("verdict") == "DROPPED", F.col("drop_reason")).alias("drop_reason"), F.col("_ok").alias("success"),
               F.when(F.col("_kind") != "tcp", F.col("latency_ns")).alias("duration"), "http",
               F.struct(code(F.col("dns.rcode_string")).alias("rcode_string")).alias("dns"),
               F.struct(code(F.col("kafka.error_code_string")).alias("error_code_string")).alias("kafka"), F.lit(LAYER).alias("layer")]
    own = ids.service_id(F.col("_own.service"))
    s, d = ids.service_id(F.col("_s.service")), ids.service_id(F.col("_d.service"))
    si, di = ids.instance_id(s, F.col("_s.instance")), ids.instance_id(d, F.col("_d.instance"))
    named = base.filter(F.col("_kind") != "tcp")
    return {
        "flow_service": base.select(F.col("_own.service").alias("name"), own.alias("entity_id"), *payload),
        "flow_service_instance": base.select(F.col("_own.service").alias("service"), F.col("_own.instance").alias("name"),
                                             ids.instance_id(own, F.col("_own.instance")).alias("entity_id"), *payload),
        "flow_service_relation": base.select(s.alias("source_id"), d.alias("dest_id"), ids.relation_id(s, d).alias("entity_id"),
                                             F.col("_component").alias("component_id"), *payload),
        "flow_service_instance_relation": base.select(si.alias("source_id"), di.alias("dest_id"), ids.relation_id(si, di).alias("entity_id"),
                                                      F.col("_component").alias("component_id"), *payload),
        "flow_endpoint": named.filter(F.col("detect_point") != "CLIENT").select(
            F.col("_own.service").alias("service"), F.col("_endpoint").alias("name"), ids.endpoint_id(own, F.col("_endpoint")).alias("entity_id"), *payload),
        "flow_endpoint_relation": named.select(
            ids.endpoint_relation_id(s, F.col("_endpoint"), d, F.col("_endpoint")).alias("entity_id"),
            ids.endpoint_id(s, F.col("_endpoint")).alias("source_id"), ids.endpoint_id(d, F.col("_endpoint")).alias("dest_id"), *payload),
    }
