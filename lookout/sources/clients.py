"""Browser and mobile clients."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids, text
from ..functions import labels as L
from ..functions.timebucket import bucket_of_millis

INT_MAX = 2 ** 31 - 1


def _ids() -> dict[str, Column]:
    sid = ids.service_id(F.col("service"))
    return {"app": sid, "version": ids.instance_id(sid, F.col("version")), "page": ids.endpoint_id(sid, F.col("page"))}


def _named(rows: DataFrame) -> DataFrame:
    return (rows.withColumn("service", text.service_name(F.col("service"))).withColumn("version", text.instance_name(F.col("version")))
            .withColumn("page", text.endpoint_name(F.col("page"))))


def browser_traffic(perf: DataFrame, errors: DataFrame) -> dict[str, DataFrame]:
    """Page loads count as NORMAL traffic, errors as FIRST_ERROR or ERROR, for the app, its version and the page.

    ``perf``: service, version, page, ts. ``errors``: also category, first_reported.
    """
    normal = _named(perf).select("service", "version", "page", "ts", F.lit("NORMAL").alias("traffic"), F.lit(None).cast("string").alias("error_category"))
    bad = _named(errors).select("service", "version", "page", "ts", F.when(F.col("first_reported"), "FIRST_ERROR").otherwise("ERROR").alias("traffic"),
                                F.upper("category").alias("error_category"))
    rows = normal.unionByName(bad)
    e = _ids()
    common = [bucket_of_millis(F.col("ts")).alias("time_bucket"), F.lit(1).cast("bigint").alias("count"), "traffic", "error_category"]
    frame = lambda key: rows.select("service", "version", "page", e[key].alias("entity_id"), *common)
    return {"browser_app_traffic": frame("app"), "browser_version_traffic": frame("version"), "browser_page_traffic": frame("page")}


def browser_page_perf(perf: DataFrame, times: Sequence[str]) -> DataFrame:
    """Page performance rows; ``times`` are the measured columns."""
    return _named(perf).select("service", "version", "page", _ids()["page"].alias("entity_id"), bucket_of_millis(F.col("ts")).alias("time_bucket"), *times)


def browser_app_perf(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Resource, web-vital and interaction rows of an app."""
    return rows.withColumn("service", text.service_name(F.col("service"))).select(
        "service", _ids_app().alias("entity_id"), bucket_of_millis(F.col("ts")).alias("time_bucket"), F.timestamp_millis("ts").alias("ts"), *columns)


def _ids_app() -> Column:
    return ids.service_id(F.col("service"))


def browser_errors(errors: DataFrame) -> DataFrame:
    """Searchable error records."""
    e = _ids()
    return _named(errors).select("unique_id", "service", "version", "page", e["app"].alias("service_id"), e["version"].alias("version_id"),
                                 e["page"].alias("page_id"), F.upper("category").alias("category"), "message",
                                 bucket_of_millis(F.col("ts"), "second").alias("time_bucket"), F.col("ts").alias("timestamp"))


# ---- mobile ----

MOBILE_OS = ("iOS", "iPadOS")
# Histogram bounds in ms, and payload attributes with the sample they become and their factor.
LAUNCH_BOUNDS = (400, 600, 800, 1000, 1500, 2000, 3000, 5000, 10000, 30000)
HANG_BOUNDS = (250, 400, 600, 1000, 1500, 2000, 3000, 5000, 10000, 30000)
HANG = "metrickit.app_responsiveness.hang_time_average"
LAUNCH = "metrickit.app_launch.time_to_first_draw_average"
PAYLOAD = {
    "metrickit_hang_time": (HANG, 1000.0),
    "metrickit_cpu_time": ("metrickit.cpu.cpu_time", 1.0),
    "metrickit_gpu_time": ("metrickit.gpu.time", 1.0),
    "metrickit_peak_memory": ("metrickit.memory.peak_memory_usage", 1.0),
    "metrickit_disk_write": ("metrickit.diskio.logical_write_count", 1.0),
    "metrickit_wifi_download": ("metrickit.network_transfer.wifi_download", 1.0),
    "metrickit_wifi_upload": ("metrickit.network_transfer.wifi_upload", 1.0),
    "metrickit_cellular_download": ("metrickit.network_transfer.cellular_download", 1.0),
    "metrickit_cellular_upload": ("metrickit.network_transfer.cellular_upload", 1.0),
    "metrickit_foreground_abnormal_exit_count": ("metrickit.app_exit.foreground.abnormal_exit_count", 1.0),
    "metrickit_background_abnormal_exit_count": ("metrickit.app_exit.background.abnormal_exit_count", 1.0),
    "metrickit_background_oom_kill_count": ("metrickit.app_exit.background.memory_pressure_exit_count", 1.0),
    "metrickit_scroll_hitch_ratio": ("metrickit.animation.scroll_hitch_time_ratio", 1.0),
}


def _attr(column: str, *keys: str) -> Column:
    """First of the keys that has a value."""
    found = [F.try_element_at(F.col(column), F.lit(k)) for k in keys]
    return F.coalesce(*[F.when(f != "", f) for f in found])


def mobile_http(spans: DataFrame) -> dict[str, DataFrame]:
    """HTTP client spans of mobile apps to service, instance and endpoint rows; the endpoint is the called domain.

    Input: resource, scope_name, kind, attributes, start_nanos, end_nanos. No response code counts as a failure.
    """
    method, domain = _attr("attributes", "http.request.method", "http.method"), _attr("attributes", "server.address", "net.peer.name")
    rows = spans.filter(_attr("resource", "os.name").isin(*MOBILE_OS) & (F.col("scope_name") == "NSURLSession") & (F.col("kind") == "SPAN_KIND_CLIENT")
                        & method.isNotNull() & domain.isNotNull() & _attr("resource", "service.name").isNotNull())
    ms = lambda c: F.call_function("div", F.col(c), F.lit(1_000_000).cast("bigint"))
    end = ms("end_nanos")
    start = F.when(F.col("start_nanos") > 0, ms("start_nanos")).otherwise(end)
    code = F.coalesce(_attr("attributes", "http.response.status_code", "http.status_code").try_cast("int"), F.lit(0))
    base = rows.select(text.service_name(_attr("resource", "service.name")).alias("service"),
                       text.instance_name(F.coalesce(_attr("resource", "service.version"), F.lit(""))).alias("instance"),
                       text.endpoint_name(domain).alias("endpoint"), bucket_of_millis(end).alias("time_bucket"),
                       F.greatest(F.lit(0), F.least(end - start, F.lit(INT_MAX))).cast("int").alias("latency"), code.alias("http_status"),
                       ((code > 0) & (code < 400)).alias("status"), F.lit("HTTP").alias("type"), F.lit("IOS").alias("layer"))
    sid = ids.service_id(F.col("service"))
    measure = ["time_bucket", "latency", "status", "http_status", "type", "layer"]
    return {
        "service": base.select(F.col("service").alias("name"), sid.alias("entity_id"), *measure),
        "service_instance": base.filter(F.col("instance") != "").select("service", F.col("instance").alias("name"), ids.instance_id(sid, F.col("instance")).alias("entity_id"), *measure),
        "endpoint": base.select("service", F.col("endpoint").alias("name"), ids.endpoint_id(sid, F.col("endpoint")).alias("entity_id"), *measure),
    }


def mobile_diagnostics(spans: DataFrame) -> DataFrame:
    """Daily payload spans to samples. Histogram samples hold the count of their own bucket, bounds in ms; values above
    the last bound fall into it."""
    rows = spans.filter(_attr("resource", "os.name").isin(*MOBILE_OS) & (F.col("scope_name") == "MetricKit") & (F.col("name") == "MXMetricPayload")
                        & _attr("resource", "service.name").isNotNull())
    labels = F.create_map(
        F.lit("service_name"), text.service_name(_attr("resource", "service.name")),
        F.lit("service_instance_id"), F.coalesce(text.instance_name(_attr("resource", "service.version")), F.lit("unknown")),
        F.lit("device_model"), F.coalesce(_attr("attributes", "metrickit.metadata.device_type"), _attr("resource", "device.model.identifier"), F.lit("unknown")),
        F.lit("os_version"), F.coalesce(_attr("attributes", "metrickit.metadata.os_version"), _attr("resource", "os.version"), F.lit("unknown")))
    base = rows.select("attributes", labels.alias("labels"), F.call_function("div", F.col("end_nanos"), F.lit(1_000_000).cast("bigint")).alias("ts"))
    value = lambda key, factor: _attr("attributes", key).try_cast("double") * factor
    plain = [F.struct(F.lit(n).alias("name"), F.col("labels").alias("labels"), value(k, f).alias("value")) for n, (k, f) in PAYLOAD.items()]

    def spread(name, key, bounds):
        v = value(key, 1000.0)
        out, lower = [], None
        for i, b in enumerate(bounds):
            inside = (v <= b) if i < len(bounds) - 1 else F.lit(True)
            hit = inside if lower is None else inside & (v > lower)
            out.append(F.struct(F.lit(name).alias("name"), L.put(F.col("labels"), "le", F.lit(str(b))).alias("labels"),
                                F.when(v.isNotNull(), F.when(hit, 1.0).otherwise(0.0)).alias("value")))
            lower = b
        return out

    items = F.array(*plain, *spread("metrickit_app_launch_time_histogram", LAUNCH, LAUNCH_BOUNDS), *spread("metrickit_hang_time_histogram", HANG, HANG_BOUNDS))
    return base.select("ts", F.inline(items)).filter(F.col("value").isNotNull()).select("name", "labels", "ts", "value")
