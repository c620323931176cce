"""The shipped metric rules, as data.

Names, attributes and filters are fixed values. Families that repeat over scopes, sides or protocols are generated
from one template each. Entities: every source frame carries ``entity_id`` and ``time_bucket`` already.
"""

from __future__ import annotations

from typing import Iterable

from ..operators.rules import Rule

P2 = {"precision": 10}
CLIENT, SERVER = ("eq", "detect_point", "CLIENT"), ("eq", "detect_point", "SERVER")
OK = ("is_true", "status")


def _r(name, source, fn, attr=None, *where, cast=None, **args) -> Rule:
    return Rule(name, source, fn, attr, tuple(where), args, cast)


def _percent(name, source, *where, cond=OK) -> Rule:
    return _r(name, source, "percent", None, *where, cond=cond)


def _traffic(prefix: str, source: str, *where, latency="latency", resp="resp_time", percentile=True) -> list[Rule]:
    out = [_r(f"{prefix}_{resp}", source, "long_avg", latency, *where), _percent(f"{prefix}_sla", source, *where),
           _r(f"{prefix}_cpm", source, "cpm", None, *where)]
    return out + ([_r(f"{prefix}_percentile", source, "percentile2", latency, *where, **P2)] if percentile else [])


def _transmission(name: str, source: str) -> Rule:
    return _r(name, source, "long_avg", "tag[transmission.latency]", ("eq", "type", "MQ"),
              ("ne", "tag[transmission.latency]", None), cast="long")


def _core() -> Iterable[Rule]:
    yield from _traffic("service", "service")
    yield _r("service_apdex", "service", "apdex", "latency", threshold="apdex_threshold", status="status")
    yield _r("service_mq_consume_count", "service", "count", None, ("eq", "type", "MQ"))
    yield _transmission("service_mq_consume_latency", "service")
    for scope in ("service", "service_instance"):
        source = f"{scope}_relation"
        for side, cond in (("client", CLIENT), ("server", SERVER)):
            yield _r(f"{source}_{side}_cpm", source, "cpm", None, cond)
            yield _percent(f"{source}_{side}_call_sla", source, cond)
            yield _r(f"{source}_{side}_resp_time", source, "long_avg", "latency", cond)
            yield _r(f"{source}_{side}_percentile", source, "percentile2", "latency", cond, **P2)
    yield from _traffic("service_instance", "service_instance", percentile=False)
    yield from _traffic("endpoint", "endpoint")
    yield _transmission("endpoint_mq_consume_latency", "endpoint")
    yield from _traffic("endpoint_relation", "endpoint_relation", SERVER, latency="rpc_latency")
    yield from _traffic("database_access", "database_access")
    yield from _traffic("cache_read", "cache_access", ("eq", "operation", "Read"))
    yield from _traffic("cache_write", "cache_access", ("eq", "operation", "Write"))
    yield from _traffic("cache_access", "cache_access")
    for scope in ("service", "endpoint"):
        source = "mq_access" if scope == "service" else "mq_endpoint_access"
        consume, produce = ("eq", "operation", "Consume"), ("eq", "operation", "Produce")
        yield from _traffic(f"mq_{scope}_consume", source, consume, latency="transmission_latency", resp="latency")
        yield _r(f"mq_{scope}_produce_cpm", source, "cpm", None, produce)
        yield _percent(f"mq_{scope}_produce_sla", source, produce)


# Memory pools of the process metrics.
POOLS = {"code_cache": "CODE_CACHE_USAGE", "newgen": "NEWGEN_USAGE", "oldgen": "OLDGEN_USAGE", "survivor": "SURVIVOR_USAGE",
         "permgen": "PERMGEN_USAGE", "metaspace": "METASPACE_USAGE", "zheap": "ZHEAP_USAGE",
         "compressed_class_space": "COMPRESSED_CLASS_SPACE_USAGE", "codeheap_non_nmethods": "CODEHEAP_NON_NMETHODS_USAGE",
         "codeheap_profiled_nmethods": "CODEHEAP_PROFILED_NMETHODS_USAGE",
         "codeheap_non_profiled_nmethods": "CODEHEAP_NON_PROFILED_NMETHODS_USAGE"}


def _runtimes() -> Iterable[Rule]:
    jvm = "instance_jvm"
    yield _r(f"{jvm}_cpu", "jvm_cpu", "double_avg", "use_percent")
    for name, attr, heap in (("memory_heap", "used", True), ("memory_noheap", "used", False),
                             ("memory_heap_max", "max", True), ("memory_noheap_max", "max", False)):
        yield _r(f"{jvm}_{name}", "jvm_memory", "long_avg", attr, ("is_true" if heap else "is_not_true", "is_heap"))
    for name, pool in POOLS.items():
        yield _r(f"{jvm}_memory_pool_{name}", "jvm_memory_pool", "long_avg", "used", ("eq", "pool_type", pool))
    for name, phase in (("young", "NEW"), ("old", "OLD"), ("normal", "NORMAL")):
        yield _r(f"{jvm}_{name}_gc_time", "jvm_gc", "sum", "time", ("eq", "phase", phase))
        yield _r(f"{jvm}_{name}_gc_count", "jvm_gc", "sum", "count", ("eq", "phase", phase))
    for name, attr in (("live_count", "live_count"), ("daemon_count", "daemon_count"), ("peak_count", "peak_count"),
                       ("runnable_state_thread_count", "runnable"), ("blocked_state_thread_count", "blocked"),
                       ("waiting_state_thread_count", "waiting"), ("timed_waiting_state_thread_count", "timed_waiting")):
        yield _r(f"{jvm}_thread_{name}", "jvm_thread", "long_avg", attr)
    for name in ("loaded_class_count", "total_unloaded_class_count", "total_loaded_class_count"):
        yield _r(f"{jvm}_class_{name}", "jvm_class", "long_avg", name)
    clr = "instance_clr"
    yield _r(f"{clr}_cpu", "clr_cpu", "double_avg", "use_percent")
    for gen in ("gen0", "gen1", "gen2"):
        yield _r(f"{clr}_{gen}_collect_count", "clr_gc", "sum", f"{gen}_collect_count")
    yield _r(f"{clr}_heap_memory", "clr_gc", "long_avg", "heap_memory")
    for name in ("available_completion_port_threads", "available_worker_threads", "max_completion_port_threads", "max_worker_threads"):
        yield _r(f"{clr}_{name}", "clr_thread", "max", name)


def _browser() -> Iterable[Rule]:
    normal, first, abnormal = (("eq", "traffic", "NORMAL"), ("eq", "traffic", "FIRST_ERROR"), ("ne", "traffic", "NORMAL"))
    for prefix, source in (("browser_app", "browser_app_traffic"), ("browser_app_single_version", "browser_version_traffic"),
                           ("browser_app_page", "browser_page_traffic")):
        yield _r(f"{prefix}_pv", source, "sum", "count", normal)
        yield _r(f"{prefix}_error_rate", source, "rate", None, num=first, den=normal)
        yield _r(f"{prefix}_error_sum", source, "sum", "count", abnormal)
    page = "browser_page_traffic"
    for name, cond in (("ajax", ("eq", "error_category", "AJAX")), ("resource", ("eq", "error_category", "RESOURCE")),
                       ("js", ("in", "error_category", ["JS", "VUE", "PROMISE"])), ("unknown", ("eq", "error_category", "UNKNOWN"))):
        yield _r(f"browser_app_page_{name}_error_sum", page, "sum", "count", abnormal, cond)
    perf = "browser_page_perf"
    for name in ("redirect", "dns", "ttfb", "tcp", "trans", "dom_analysis", "fpt", "dom_ready", "load_page", "res", "ssl", "ttl",
                 "first_pack", "fmp"):
        yield _r(f"browser_app_page_{name}_avg", perf, "long_avg", f"{name}_time")
    for name in ("fpt", "ttl", "dom_ready", "load_page", "first_pack", "fmp"):
        yield _r(f"browser_app_page_{name}_percentile", perf, "percentile2", f"{name}_time", **P2)
    res = "browser_resource_perf"
    yield _r("browser_app_resource_duration_avg", res, "label_avg", "duration", label="name", ts="ts")
    yield _r("browser_app_resource_size_avg", res, "label_avg", "size", label="name", ts="ts")
    yield _r("browser_app_resource_protocol_count", res, "label_count", None, label="protocol", ts="ts")
    yield _r("browser_app_resource_type_count", res, "label_count", None, label="type", ts="ts")
    vitals = "browser_web_vitals"
    for name, attr in (("fmp", "fmp_time"), ("cls", "cls"), ("lcp", "lcp_time")):
        yield _r(f"browser_app_web_vitals_{name}_avg", vitals, "long_avg", attr, ("ge", attr, 0))
    yield _r("browser_app_web_interaction_inp_percentile", "browser_web_interaction", "percentile2", "inp_time", ("ge", "inp_time", 0), **P2)


def _genai() -> Iterable[Rule]:
    tokens = ("input_tokens", "output_tokens")
    for prefix, source, latency, percentile, calls in (
            ("gen_ai_provider", "genai_provider", "resp_time", "latency_percentile", "cpm"),
            ("gen_ai_model", "genai_model", "latency_avg", "latency_percentile", "call_cpm")):
        yield _r(f"{prefix}_{latency}", source, "long_avg", "latency")
        yield _percent(f"{prefix}_sla", source)
        yield _r(f"{prefix}_{calls}", source, "cpm")
        yield _r(f"{prefix}_{percentile}", source, "percentile2", "latency", **P2)
        for t in tokens:
            yield _r(f"{prefix}_{t}_sum", source, "sum", t)
            yield _r(f"{prefix}_{t}_avg", source, "long_avg", t)
        yield _r(f"{prefix}_total_estimated_cost", source, "sum", "total_estimated_cost")
        yield _r(f"{prefix}_avg_estimated_cost", source, "long_avg", "total_estimated_cost")
    ttft = ("gt", "time_to_first_token", 0)
    yield _r("gen_ai_model_ttft_avg", "genai_model", "long_avg", "time_to_first_token", ttft)
    yield _r("gen_ai_model_ttft_percentile", "genai_model", "percentile2", "time_to_first_token", ttft, **P2)


def _mesh() -> Iterable[Rule]:
    attr = {"req": "side_car.internal_request_latency_nanos", "resp": "side_car.internal_response_latency_nanos"}
    for kind in ("req", "resp"):
        for scope in ("service", "service_instance", "endpoint"):
            yield _r(f"{scope}_sidecar_internal_{kind}_latency_nanos", f"mesh_{scope}", "long_avg", attr[kind])
        for prefix, source in (("service", "mesh_service_relation"), ("instance", "mesh_service_instance_relation")):
            for side, cond in (("client", CLIENT), ("server", SERVER)):
                yield _r(f"{prefix}_{side}_sidecar_internal_{kind}_latency_nanos", source, "long_avg", attr[kind], cond)
    for way in ("received", "sent"):
        for scope in ("service", "service_instance"):
            yield _r(f"{scope}_throughput_{way}", f"tcp_{scope}", "long_avg", f"{way}_bytes")
            for side, cond in (("client", CLIENT), ("server", SERVER)):
                yield _r(f"{scope}_relation_{side}_{way}", f"tcp_{scope}_relation", "long_avg", f"{way}_bytes", cond)


def _status_cpm(prefix: str, source: str, code: str, *where) -> Iterable[Rule]:
    for n in range(1, 6):
        yield _r(f"{prefix}_status_{n}xx_cpm", source, "cpm", None, *where, ("ge", code, n * 100), ("lt", code, (n + 1) * 100))


def _http_sizes(prefix: str, source: str, base: str, *where, fn="long_avg") -> Iterable[Rule]:
    for name, attr in (("req_header", "size_of_request_header"), ("req_body", "size_of_request_body"),
                       ("resp_header", "size_of_response_header"), ("resp_body", "size_of_response_body")):
        yield _r(f"{prefix}_avg_{name}_size", source, fn, f"{base}.{attr}", *where)


def _kernel() -> Iterable[Rule]:
    of = lambda kind: ("eq", "type", kind)
    http = (of("protocol"), ("eq", "protocol.type", "http"))
    # counters that are summed and durations that are averaged, by operation
    totals = {"write": (("package_cpm", "l4.transmit_package_count"), ("retrains_package_cpm", "l4.retransmit_package_count"),
                        ("package_size", "l4.total_package_size")),
              "read": (("package_cpm", "l2.package_count"), ("package_size", "l2.total_package_size"))}
    layers = {"write": (("l4_time", "l4.duration"), ("l3_time", "l3.duration"), ("l3_local_time", "l3.local_duration"),
                        ("l3_output_time", "l3.output_duration"), ("l2_time", "l2.duration")),
              "read": (("l4_time", "l4.duration"), ("l3_time", "l3.duration"), ("l3_rcv_time", "l3.rcv_duration"),
                       ("l3_local_time", "l3.local_duration"))}
    filters = {"write": (("netfilter_cpm", "l3.net_filter_count"), ("netfilter_duration", "l3.net_filter_duration")),
               "read": (("netfilter_cpm", "l3.net_filter_count"), ("netfilter_duration", "l3.net_filter_duration"))}
    mac = (("resolve_mac_cpm", "l3.resolve_mac_count"), ("resolve_mac_duration", "l3.resolve_mac_duration"))
    queue = {"service": ("l2_enter_avg_queue_count", "l2_ready_avg_send_duration", "l2_net_device_avg_send_duration"),
             "service_instance": ("l2_avg_enter_queue_count", "l2_ready_send_time", "l2_net_device_send_time")}
    queue_attr = ("l2.enter_queue_buffer_count", "l2.ready_send_duration", "l2.network_device_send_duration")

    for scope in ("service", "service_instance"):
        p, s = f"kubernetes_{scope}", f"k8s_{scope}"
        yield _r(f"{p}_connect_cpm", s, "cpm", None, of("connect"))
        yield _r(f"{p}_connect_time", s, "long_avg", "connect.duration", of("connect"))
        yield _r(f"{p}_connect_success_cpm", s, "cpm", None, of("connect"), ("is_true", "connect.success"))
        for op in ("accept", "close", "write", "read"):
            yield _r(f"{p}_{op}_cpm", s, "cpm", None, of(op))
            yield _r(f"{p}_{op}_time", s, "long_avg", f"{op}.duration", of(op))
        for op in ("write", "read"):
            for name, attr in totals[op] + filters[op]:
                yield _r(f"{p}_{op}_{name}", s, "sum", f"{op}.{attr}", of(op))
            for name, attr in layers[op]:
                yield _r(f"{p}_{op}_{name}", s, "long_avg", f"{op}.{attr}", of(op))
        for name, attr in zip(queue[scope], queue_attr):
            yield _r(f"{p}_write_{name}", s, "long_avg", f"write.{attr}", of("write"))
        # both read the time to the queue
        for name in ("package_to_queue_time", "rcv_package_from_queue_time"):
            yield _r(f"{p}_read_{name}", s, "long_avg", "read.l2.package_to_queue_duration", of("read"))
        for name, attr in mac:
            yield _r(f"{p}_{name}", s, "sum", f"write.{attr}", of("write"))
        where = (SERVER, *http)
        yield _r(f"{p}_http_call_cpm", s, "cpm", None, *where)
        yield _r(f"{p}_http_call_time", s, "long_avg", "protocol.http.latency", *where)
        yield _percent(f"{p}_http_call_successful_rate", s, *where, cond=("is_true", "protocol.success"))
        yield from _http_sizes(f"{p}_http", s, "protocol.http", *where)
        yield _r(f"{p}_apdex", s, "apdex", "protocol.http.latency", *where, threshold="apdex_threshold", status="protocol.success")
        yield _r(f"{p}_percentile", s, "percentile2", "protocol.http.latency", *where, **P2)
        yield from _status_cpm(f"{p}_http", s, "protocol.http.status_code", *where)

        p, s = f"kubernetes_{scope}_relation", f"k8s_{scope}_relation"
        for op in ("connect", "accept", "close"):
            yield _r(f"{p}_{op}_cpm", s, "cpm", None, of(op))
            yield _r(f"{p}_{op}_duration", s, "sum", f"{op}.duration", of(op))
        yield _r(f"{p}_connect_success_cpm", s, "cpm", None, of("connect"), ("is_true", "connect.success"))
        for side, cond in (("server", SERVER), ("client", CLIENT)):
            q = f"{p}_{side}"
            for op in ("write", "read"):
                yield _r(f"{q}_{op}_cpm", s, "cpm", None, cond, of(op))
                yield _r(f"{q}_{op}_package_duration", s, "sum", f"{op}.duration", cond, of(op))
                for name, attr in totals[op] + filters[op]:
                    yield _r(f"{q}_{op}_{name}", s, "sum", f"{op}.{attr}", cond, of(op))
                for name, attr in layers[op]:
                    yield _r(f"{q}_{op}_{name}", s, "long_avg", f"{op}.{attr}", cond, of(op))
            for name, attr in mac:
                yield _r(f"{q}_write_{name}", s, "sum", f"write.{attr}", cond, of("write"))
            for name, attr in (("l2_ready_send_time", "l2.ready_send_duration"), ("l2_net_dev_send_time", "l2.network_device_send_duration")):
                yield _r(f"{q}_write_{name}", s, "long_avg", f"write.{attr}", cond, of("write"))
            for name, attr in (("l2_package_to_queue_time", "l2.package_to_queue_duration"),
                               ("l2_rcv_package_from_queue_time", "l2.rcv_package_from_queue_duration")):
                yield _r(f"{q}_read_{name}", s, "long_avg", f"read.{attr}", cond, of("read"))
            where = (cond, *http)
            yield _r(f"{q}_http_call_cpm", s, "cpm", None, *where)
            yield _r(f"{q}_http_call_time", s, "long_avg", "protocol.http.latency", *where)
            # between instances the client side sums the sizes
            summed = scope == "service_instance" and side == "client"
            yield from _http_sizes(f"{q}_http", s, "protocol.http", *where, fn="sum" if summed else "long_avg")
            if scope == "service":
                yield _r(f"{q}_http_success_cpm", s, "cpm", None, *where, ("is_true", "protocol.success"))
                if side == "client":
                    yield _r(f"{q}_http_call_duration", s, "sum", "protocol.http.latency", *where)
            yield _r(f"{q}_apdex", s, "apdex", "protocol.http.latency", *where, threshold="apdex_threshold", status="protocol.success")
            yield _r(f"{q}_percentile", s, "percentile2", "protocol.http.latency", *where, **P2)
            yield from _status_cpm(f"{q}_http", s, "protocol.http.status_code", *where)

    p, s, web = "kubernetes_service_endpoint", "k8s_endpoint", of("http")
    for q, where, latency in ((f"{p}_call", (), "duration"), (f"{p}_http_call", (web,), "http.latency")):
        yield _r(f"{q}_cpm", s, "cpm", None, *where)
        yield _percent(f"{q}_successful_rate", s, *where, cond=("is_true", "success"))
        yield _r(f"{q}_time", s, "long_avg", latency, *where)
    yield from _http_sizes(f"{p}_http", s, "http", web)
    yield from _status_cpm(f"{p}_http", s, "http.status_code", web)


def _flows() -> Iterable[Rule]:
    kind = lambda k: ("eq", "type", k)
    forwarded, dropped = ("eq", "verdict", "forwarded"), ("eq", "verdict", "dropped")
    ingress, egress = ("eq", "direction", "ingress"), ("eq", "direction", "egress")
    ok, failed = ("is_true", "success"), ("is_not_true", "success")

    def packets(prefix, source, *side):
        for name, verdict, way in (("read_pkg", forwarded, ingress), ("write_pkg", forwarded, egress),
                                   ("read_pkg_drop", dropped, ingress), ("write_pkg_drop", dropped, egress)):
            yield _r(f"{prefix}_l4_{name}_cpm", source, "cpm", None, verdict, kind("tcp"), *side, way)
        yield _r(f"{prefix}_l4_drop_reason_count", source, "label_count", None, dropped, kind("tcp"), *side, label="drop_reason", ts="ts")

    def protocols(prefix, source, *side, status=True):
        for name, cond, error in (("protocol", ("ne", "type", "tcp"), None), ("protocol_http", kind("http"), None),
                                  ("protocol_dns", kind("dns"), ("dns_error_count", "dns.rcode_string")),
                                  ("protocol_kafka", kind("kafka"), ("kafka_call_error_count", "kafka.error_code_string"))):
            call = "cpm" if name == "protocol" else "call_cpm"
            yield _r(f"{prefix}_{name}_{call}", source, "cpm", None, forwarded, cond, *side)
            yield _r(f"{prefix}_{name}_call_duration", source, "sum", "duration", forwarded, cond, *side)
            yield _r(f"{prefix}_{name}_call_success_count", source, "cpm", None, forwarded, cond, *side, ok)
            if error:
                yield _r(f"{prefix}_protocol_{error[0]}", source, "label_count", None, forwarded, cond, *side, failed, label=error[1], ts="ts")
        if status:
            yield from _status_cpm(f"{prefix}_protocol_http", source, "http.code", forwarded, kind("http"), *side)

    for scope in ("service", "service_instance"):
        yield from packets(f"cilium_{scope}", f"flow_{scope}")
        yield from protocols(f"cilium_{scope}", f"flow_{scope}", SERVER)
        p, s = f"cilium_{scope}_relation", f"flow_{scope}_relation"
        for side, cond in (("client", CLIENT), ("server", SERVER)):
            yield from packets(f"{p}_{side}", s, cond)
            yield from protocols(f"{p}_{side}", s, cond, status=False)
        yield from _status_cpm(f"{p}_protocol_http", s, "http.code", forwarded, kind("http"), SERVER)
    yield from protocols("cilium_endpoint", "flow_endpoint")


def rules() -> list[Rule]:
    out: list[Rule] = []
    for part in (_core, _runtimes, _browser, _genai, _mesh, _kernel, _flows):
        out.extend(part())
    return out


def by_source(source: str, disabled=()) -> list[Rule]:
    return [r for r in rules() if r.source == source and r.name not in set(disabled)]


KEYED = {"percentile", "percentile2", "histogram", "label_count", "label_avg"}


def value_kind(rule: Rule) -> str:
    return "HISTOGRAM" if rule.fn == "histogram" else "LABELED_VALUE" if rule.fn in KEYED else "COMMON_VALUE"


def frame(spark):
    """The catalog as a table: metric, source, function, type, downsample."""
    return spark.createDataFrame([(r.name, r.source, r.fn, value_kind(r), r.downsample) for r in rules()],
                                 "metric string, source string, fn string, type string, downsample boolean")
