"""Queries on inventories, events, alarms, browser errors, sinks and the flagship."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import ids
from ..functions import labels as L
from ..functions.timebucket import bucket_of, bucket_of_millis
from ..operators import aggregates as A
from ..operators import metadata as M
from ..operators import records, topk
from ..operators import rules as R
from ..operators import traces as T
from ..sinks import writers
from ..sources import records as src
from . import frames as fr
from .q_rules import SERVICE_RULES, THRESHOLDS, _WIDE, percentile_sql
from .registry import query

V = f"WITH {fr.SVC}"
G = "entity_id, time_bucket"

# ---- the flagship ----


@query("flagship", f"""{V}, wide AS (SELECT {G}, {_WIDE.format(minutes=60)} FROM svc GROUP BY {G}), p AS (WITH {percentile_sql('svc', G, 'latency // 10', A.RANKS, 10)}),
pp AS (SELECT {G}, max(value) FILTER (p = '50') AS p50, max(value) FILTER (p = '99') AS p99 FROM p GROUP BY {G}),
t AS (SELECT entity_id, row_number() OVER (ORDER BY sum(service_resp_time)::DOUBLE / count(*) DESC, entity_id) AS rn FROM wide GROUP BY 1)
SELECT wide.entity_id, wide.time_bucket, service_resp_time, service_sla, service_cpm, service_mq_count, service_max, p50, p99 FROM wide JOIN pp ON wide.entity_id = pp.entity_id AND wide.time_bucket = pp.time_bucket JOIN t ON t.entity_id = wide.entity_id WHERE rn <= 3""")
def flagship(spark, sf):
    """Hourly metrics and percentiles of the three services with the highest average response time."""
    rows = fr.service_rows(spark, sf)
    wide = R.values(R.states(rows, SERVICE_RULES), SERVICE_RULES)
    pct = A.rank_scan(A.fold(rows, "percentile2", F.col("latency"), {"precision": 10}), A.GROUP, A.RANKS)
    best = topk.top_n(wide.withColumnRenamed("service_resp_time", "value"), 3).select("entity_id")
    return (wide.join(best, "entity_id").join(pct.select(*A.GROUP, (F.col("r0") * 10).alias("p50"), (F.col("r4") * 10).alias("p99")), list(A.GROUP)))


# ---- inventories ----

def _pings(spark, sf):
    s = fr.service_rows(spark, sf)
    return s.select(F.col("name").alias("service"), F.col("instance").alias("name"), F.col("minute").alias("time_bucket"), F.col("ms").alias("last_ping"),
                    F.create_map(F.lit("last_k"), F.col("k").cast("string"), F.col("endpoint"), F.col("event_id").cast("string")).alias("properties"), "event_id", "endpoint")


_PING = "pi AS (SELECT name AS service, instance AS name, minute AS time_bucket, ms AS last_ping, k, endpoint, event_id FROM svc)"


@query("src_metadata_ping", f"""{V}, {_PING}, b AS (SELECT service, name, max(last_ping) AS last_ping, min(time_bucket) AS time_bucket, arg_max(k, last_ping) AS last_k FROM pi GROUP BY 1, 2) SELECT service, name, last_ping, time_bucket, CAST(last_k AS VARCHAR) AS last_k FROM b""")
def src_metadata_ping(spark, sf):
    """Latest ping, first bucket and properties merged key by key."""
    return M.instances(_pings(spark, sf)).select("service", "name", "last_ping", "time_bucket", F.col("properties")["last_k"].alias("last_k"))


@query("agg_traffic", f"""{V} SELECT 'service' AS kind, name AS a, type AS b, min(minute) AS time_bucket FROM svc GROUP BY name, type UNION ALL SELECT DISTINCT 'endpoint', name, endpoint, 0 FROM svc""")
def agg_traffic(spark, sf):
    s = fr.service_rows(spark, sf)
    svc = M.services(s.select("name", F.col("type").alias("layer"), F.col("minute").alias("time_bucket")))
    ep = M.endpoints(s.select(F.col("name").alias("service"), F.col("endpoint").alias("name")))
    return (svc.select(F.lit("service").alias("kind"), F.col("name").alias("a"), F.col("layer").alias("b"), "time_bucket")
            .unionByName(ep.select(F.lit("endpoint").alias("kind"), F.col("service").alias("a"), F.col("name").alias("b"), F.lit(0).cast("bigint").alias("time_bucket"))))


def _processes(spark, sf):
    s = fr.service_rows(spark, sf)
    return s.select(F.concat_ws("/", "name", "instance", "endpoint").alias("process_id"), F.col("name").alias("service"), "instance", F.col("endpoint").alias("name"),
                    F.col("minute").alias("time_bucket"), F.col("ms").alias("last_ping"), F.when(F.col("k") % 2 == 0, F.concat(F.lit("agent_"), (F.col("k") % 5).cast("string"))).otherwise("").alias("agent_id"),
                    F.lit("").alias("labels"), F.when(F.col("endpoint") == "click", "VIRTUAL").otherwise("REPORTED").alias("detect_type"), (F.col("status")).cast("int").alias("profiling_support"))


_PROC = """pr AS (SELECT name || '/' || instance || '/' || endpoint AS process_id, name AS service, instance, endpoint AS name, max(ms) AS last_ping, min(minute) AS time_bucket,
  arg_max('agent_' || (k % 5), ms) FILTER (k % 2 = 0) AS agent_id, CASE WHEN endpoint = 'click' THEN 'VIRTUAL' ELSE 'REPORTED' END AS detect_type, max(CAST(status AS INTEGER)) AS profiling_support FROM svc GROUP BY ALL)"""


@query("agg_traffic_process", f"{V}, {_PROC} SELECT process_id, last_ping, time_bucket, agent_id, detect_type, profiling_support FROM pr")
def agg_traffic_process(spark, sf):
    """Latest ping, last agent that was named, first bucket."""
    return M.processes(_processes(spark, sf)).select("process_id", "last_ping", "time_bucket", "agent_id", "detect_type", "profiling_support")


@query("agg_process_count", f"{V}, {_PROC} SELECT CAST(count(*) AS BIGINT) AS total FROM pr WHERE service = 'svc_2' AND profiling_support = 1 AND last_ping >= 1704500000000 AND detect_type <> 'VIRTUAL'")
def agg_process_count(spark, sf):
    return M.process_count(M.processes(_processes(spark, sf)), service="svc_2", supported=True, start=1704500000000)


@query("q_processes", f"{V}, {_PROC} SELECT process_id, agent_id FROM pr WHERE instance = 'i_4'")
def q_processes(spark, sf):
    return M.list_processes(M.processes(_processes(spark, sf)), instance="i_4", include_virtual=True).select("process_id", "agent_id")


@query("q_services", f"{V} SELECT DISTINCT name, type AS layer, name AS short_name FROM svc WHERE type = 'HTTP' ORDER BY name LIMIT 6")
def q_services(spark, sf):
    s = fr.service_rows(spark, sf)
    svc = M.services(s.select("name", F.col("type").alias("layer"), F.col("minute").alias("time_bucket")))
    return M.list_services(svc, "HTTP", limit=6).select("name", "layer", "short_name")


@query("q_instances", f"{V}, {_PING}, i AS (SELECT service, name, max(last_ping) AS last_ping, min(time_bucket) AS time_bucket FROM pi GROUP BY 1, 2) SELECT * FROM i WHERE service = 'svc_5' AND last_ping >= 1706400000000 AND time_bucket <= 202401301200")
def q_instances(spark, sf):
    inst = M.instances(_pings(spark, sf).drop("properties"))
    return M.live_instances(inst, "svc_5", 1706400000000, 202401301200)


@query("q_endpoints", f"{V} SELECT DISTINCT name AS service, endpoint AS name FROM svc WHERE name = 'svc_1' AND contains(endpoint, 'i') ORDER BY 2 LIMIT 3")
def q_endpoints(spark, sf):
    s = fr.service_rows(spark, sf)
    return M.find_endpoints(M.endpoints(s.select(F.col("name").alias("service"), F.col("endpoint").alias("name"))), "svc_1", "i", 3)


def _tags(spark, sf):
    s = fr.service_rows(spark, sf)
    rows = s.select(F.col("minute").alias("time_bucket"), F.array(F.concat(F.lit("kind="), "endpoint"), F.concat(F.lit("expr=a="), "type")).alias("tags"))
    return M.tag_dictionary(rows, "TRACE")


@query("agg_tag_dict", f"{V} SELECT DISTINCT 'TRACE' AS tag_type, 'kind' AS tag_key, endpoint AS tag_value, minute AS time_bucket FROM svc UNION SELECT DISTINCT 'TRACE', 'expr', 'a=' || type, minute FROM svc")
def agg_tag_dict(spark, sf):
    return _tags(spark, sf)


@query("q_tags", f"{V} SELECT DISTINCT 'kind' AS tag_key, endpoint AS tag_value FROM svc WHERE minute BETWEEN 202401050000 AND 202401202359 ORDER BY 2 LIMIT 4")
def q_tags(spark, sf):
    return M.tag_values(_tags(spark, sf), "TRACE", "kind", 202401050000, 202401202359, 4).select(F.lit("kind").alias("tag_key"), "tag_value")


@query("set_distinct", f"{V} SELECT DISTINCT 'kind' AS tag_key FROM svc UNION SELECT 'expr'")
def set_distinct(spark, sf):
    return M.tag_keys(_tags(spark, sf), "TRACE", 202401010000, 202401312359)


# ---- events, alarms, browser ----

def _events(spark, sf):
    s = fr.service_rows(spark, sf)
    rows = s.select(F.concat(F.lit("u"), F.col("event_id").cast("string")).alias("uuid"), F.col("name").alias("service"), "instance", F.lit("").alias("endpoint"), F.col("endpoint").alias("name"),
                    F.when(F.col("status"), "Normal").otherwise("Error").alias("type"), F.lit("").alias("message"), F.create_map(F.lit("k"), F.col("k").cast("string")).alias("parameters"),
                    F.when(F.col("k") % 2 == 0, F.col("ms")).otherwise(0).alias("start_time"), (F.col("ms") + 500).alias("end_time"), F.lit("GENERAL").alias("layer"))
    return src.events(rows)


_EVENT = "ev AS (SELECT 'u' || event_id AS uuid, name AS service, instance, endpoint AS name, CASE WHEN status THEN 'Normal' ELSE 'Error' END AS type, '{\"k\":\"' || k || '\"}' AS parameters, CASE WHEN k % 2 = 0 THEN ms ELSE ms + 500 END AS timestamp FROM svc)"


@query("src_events", f"{V}, {_EVENT} SELECT uuid, service, parameters, timestamp, CAST(strftime(make_timestamp(timestamp * 1000), '%Y%m%d%H%M%S') AS BIGINT) AS time_bucket FROM ev")
def src_events(spark, sf):
    return _events(spark, sf).select("uuid", "service", "parameters", "timestamp", "time_bucket")


_CONDITIONS = [{"service": "svc_1", "type": "Error", "after": 1704400000000}, {"name": "signup", "before": 1704300000000, "instance": "i_7"}, {"uuid": "u42"}]


@query("event_filter", f"{V}, {_EVENT} SELECT uuid FROM ev WHERE (service = 'svc_1' AND type = 'Error' AND timestamp > 1704400000000) OR (name = 'signup' AND timestamp < 1704300000000 AND instance = 'i_7') OR uuid = 'u42'")
def event_filter(spark, sf):
    return records.filter_events(_events(spark, sf), _CONDITIONS).select("uuid")


@query("q_events", f"{V}, {_EVENT} SELECT uuid, timestamp FROM ev WHERE type = 'Error' ORDER BY timestamp DESC, uuid LIMIT 10 OFFSET 10")
def q_events(spark, sf):
    ev = records.filter_events(_events(spark, sf), [{"type": "Error"}])
    return topk.page(ev, [F.col("timestamp").desc(), F.col("uuid").asc()], 10, 2).select("uuid", "timestamp")


def _alarms(spark, sf):
    """Every slow order is an alarm of its customer service towards a priority."""
    o = fr.table(spark, sf, "orders")
    start = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    return o.select(F.col("o_orderkey").alias("alarm_id"), F.concat(F.lit("svc_"), (F.col("o_custkey") % 10).cast("string")).alias("id0"), F.col("o_orderpriority").alias("id1"),
                    F.when(F.col("o_orderstatus") == "F", "Endpoint").otherwise("Service").alias("scope"), F.concat(F.lit("rule_"), "o_orderstatus").alias("rule"),
                    F.concat_ws(" ", F.lit("order"), "o_orderkey", "o_orderpriority").alias("message"), F.lit("GENERAL").alias("layer"),
                    F.array(F.concat(F.lit("level="), "o_orderstatus")).alias("tags"), start.alias("start_time"), F.lit(5).alias("period"), bucket_of(F.col("o_orderdate"), "second").alias("time_bucket"))


_ALARM = "al AS (SELECT o_orderkey AS alarm_id, 'svc_' || (o_custkey % 10) AS id0, o_orderpriority AS id1, CASE WHEN o_orderstatus = 'F' THEN 'Endpoint' ELSE 'Service' END AS scope, 'rule_' || o_orderstatus AS rule, 'order ' || o_orderkey || ' ' || o_orderpriority AS message, o_orderstatus AS st, (epoch_us(o_orderdate) // 1000) AS start_time FROM orders)"


@query("alarm_filter", f"WITH {_ALARM} SELECT alarm_id FROM al WHERE scope = 'Service' AND contains(message, '7 1-UR') AND rule IN ('rule_O', 'rule_P') AND ((id0 = 'svc_1' AND id1 = '1-URGENT') OR id0 = 'svc_4' OR id1 = 'svc_4') AND st = 'O'")
def alarm_filter(spark, sf):
    entities = records.entity_constraints("svc_1", "1-URGENT") + records.entity_constraints("svc_4")
    return records.filter_alarms(_alarms(spark, sf), "Service", "7 1-UR", "GENERAL", ["rule_O", "rule_P"], entities, ["level=O"]).select("alarm_id")


@query("join_tags_alarm", f"WITH {_ALARM} SELECT alarm_id FROM al WHERE st = 'P'")
def join_tags_alarm(spark, sf):
    from ..operators import traces as T

    a = _alarms(spark, sf)
    return T.by_tag_table(a, a.select("alarm_id", F.explode("tags").alias("tag")), ["level=P"], "alarm_id").select("alarm_id")


@query("q_alarms", f"""{V}, {_EVENT}, al AS (SELECT event_id AS alarm_id, name AS id0, CASE WHEN k % 2 = 0 THEN instance ELSE '' END AS id1, ms AS start_time FROM svc WHERE NOT status), pg AS (SELECT * FROM al ORDER BY start_time DESC, alarm_id LIMIT 40),
e AS (SELECT service AS id, uuid FROM ev WHERE name = 'signup' AND timestamp > 1706500000000 UNION ALL SELECT instance, uuid FROM ev WHERE name = 'click' AND timestamp > 1706500000000)
SELECT pg.alarm_id, pg.id0, e.uuid FROM pg LEFT JOIN e ON e.id = pg.id0 OR (pg.id1 <> '' AND e.id = pg.id1)""")
def q_alarms(spark, sf):
    """Newest alarms with the events of either end inside the query's range."""
    s = fr.service_rows(spark, sf).filter(~F.col("status"))
    al = s.select(F.col("event_id").alias("alarm_id"), F.col("name").alias("id0"), F.when(F.col("k") % 2 == 0, F.col("instance")).otherwise("").alias("id1"), F.col("ms").alias("start_time"))
    page = topk.page(al, [F.col("start_time").desc(), F.col("alarm_id").asc()], 40)
    ev = _events(spark, sf)
    of_service = ev.filter("name = 'signup'").withColumn("entity_id", F.col("service"))
    of_instance = ev.filter("name = 'click'").withColumn("entity_id", F.col("instance"))
    return records.attach_events(page, of_service.unionByName(of_instance), after=1706500000000).select("alarm_id", "id0", "uuid")


def _browser(spark, sf):
    s = fr.service_rows(spark, sf).filter(~F.col("status"))
    from ..sources.clients import browser_errors

    rows = s.select(F.col("event_id").cast("string").alias("unique_id"), F.col("name").alias("service"), F.concat(F.lit("v"), (F.col("k") % 3).cast("string")).alias("version"),
                    F.concat(F.lit("/"), "instance").alias("page"), F.when(F.col("k") % 2 == 0, "js").otherwise("ajax").alias("category"), F.lit("m").alias("message"), F.col("ms").alias("ts"))
    return browser_errors(rows)


@query("browser_log_filter", f"{V} SELECT CAST(event_id AS VARCHAR) AS unique_id FROM svc WHERE NOT status AND k % 3 = 1 AND k % 2 = 0 AND minute BETWEEN 202401030000 AND 202401251200")
def browser_log_filter(spark, sf):
    out = records.filter_browser_errors(_browser(spark, sf), version="v1", category="JS", bounds=(20240103000000, 20240125120059))
    return out.select("unique_id")


@query("q_browser_errors", f"{V} SELECT CAST(event_id AS VARCHAR) AS unique_id, ms AS timestamp FROM svc WHERE NOT status AND name = 'svc_6' ORDER BY ms DESC, 1 LIMIT 12")
def q_browser_errors(spark, sf):
    out = records.filter_browser_errors(_browser(spark, sf), service="svc_6")
    return topk.page(out, [F.col("timestamp").desc(), F.col("unique_id").asc()], 12).select("unique_id", "timestamp")


# ---- sinks: the frames that the writers store ----

@query("sink_upsert", f"{V} SELECT {G}, {_WIDE.format(minutes=60)} FROM svc GROUP BY {G}")
def sink_upsert(spark, sf):
    """Three deliveries appended to the state table, folded and cleared on the way, and merged when read."""
    from ..sinks import state_table
    from .runtime import checkpoint_dir
    from uuid import uuid4

    path = f"{checkpoint_dir(spark)}/state-{uuid4().hex}"
    rows = fr.service_rows(spark, sf)
    for batch in range(3):
        state_table.append(R.states(rows.filter(F.col("event_id") % 3 == batch), SERVICE_RULES), path, batch)
        # a repeated delivery replaces itself, also one that a fold holds
        state_table.append(R.states(rows.filter(F.col("event_id") % 3 == batch), SERVICE_RULES), path, batch)
        if batch == 1:
            state_table.compact(spark, path, SERVICE_RULES)
            state_table.vacuum(spark, path, keep_ms=0)
            state_table.append(R.states(rows.filter(F.col("event_id") % 3 == batch), SERVICE_RULES), path, batch)
    return R.values(state_table.merged(spark, path, SERVICE_RULES), SERVICE_RULES)


@query("st_late", f"{V} SELECT {G}, CAST(count(*) AS BIGINT) AS n FROM svc GROUP BY {G}")
def st_late(spark, sf):
    """Rows delivered a day late join their old bucket."""
    rows = fr.service_rows(spark, sf)
    rule = [R.Rule("n", "service", "count")]
    late = F.col("ts") < F.lit("2024-01-29").cast("timestamp_ntz")
    parts = R.states(rows.filter(~late), rule).unionByName(R.states(rows.filter(late), rule))
    return R.values(R.merge_states(parts, rule), rule)


@query("st_state_cache", f"{V} SELECT {G}, CAST(sum(latency) // count(*) AS BIGINT) AS value FROM svc GROUP BY {G}")
def st_state_cache(spark, sf):
    """The events as a stream whose states are merged in the state store and written when they are flushed."""
    from uuid import uuid4

    from ..sinks import state_table
    from ..streaming import cache
    from .runtime import checkpoint_dir

    base = f"{checkpoint_dir(spark).rstrip('/')}/cache-{uuid4().hex}"
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    rows = fr.service_rows(spark, sf, spark.readStream.schema(schema).parquet(f"{sf}/event[s].parquet"))  # streams read a single file as a pattern
    rule = [R.Rule("value", "service", "long_avg", "latency")]
    # events arrive when they happen; without a delay the last of them is flushed as well
    for query in cache.stream_cached(rows, f"{base}/t", rule, f"{base}/checkpoint", arrival=F.col("ts"), flush="0 seconds", trigger={"availableNow": True}):
        query.awaitTermination()
    return R.values(state_table.merged(spark, f"{base}/t", rule), rule)


@query("st_tumbling", "SELECT CAST(strftime(date_trunc('minute', ts), '%Y%m%d%H%M') AS BIGINT) AS time_bucket, event_type AS entity_id, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY ALL")
def st_tumbling(spark, sf):
    from ..streaming.metrics import windowed

    rows = fr.service_rows(spark, sf).withColumn("entity_id", F.col("endpoint"))
    return windowed(rows, {"n": F.count(F.lit(1))}).select("time_bucket", "entity_id", "n")


@query("sink_record", f"{V} SELECT CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS day, CAST(count(*) AS BIGINT) AS n FROM svc GROUP BY 1")
def sink_record(spark, sf):
    """Records appended by day and read back."""
    from .runtime import checkpoint_dir
    from uuid import uuid4

    path = f"{checkpoint_dir(spark)}/records-{uuid4().hex}"
    rows = fr.service_rows(spark, sf).select("event_id", bucket_of(F.col("ts"), "second").alias("time_bucket"))
    writers.append_records(rows, path)
    return spark.read.parquet(path).groupBy(F.col("day").cast("bigint").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query("sink_manage", f"{V} SELECT instance, arg_max(event_id, event_id) AS version, arg_max(k, event_id) AS k FROM svc GROUP BY 1")
def sink_manage(spark, sf):
    rows = fr.service_rows(spark, sf).select("instance", F.col("event_id").alias("version"), "k")
    return writers.last_rows(rows.filter("version % 2 = 0"), rows.filter("version % 2 = 1"), ["instance"])


@query("sink_batch", f"{V} SELECT 'batchsize' AS option, '2000' AS value FROM (SELECT count(*) AS n FROM svc) WHERE n > 0 UNION ALL SELECT 'numPartitions', CAST(ceil(n / 2000.0) AS BIGINT)::VARCHAR FROM (SELECT count(*) AS n FROM svc)")
def sink_batch(spark, sf):
    """Writer options for a table: batches of 2000 statements, enough connections for the rows."""
    n = fr.service_rows(spark, sf).agg(F.count(F.lit(1)).alias("n"))
    options = writers.jdbc_options("jdbc:none", "service_rows")
    items = F.array(F.struct(F.lit("batchsize").alias("option"), F.lit(options["batchsize"]).alias("value")),
                    F.struct(F.lit("numPartitions").alias("option"), F.ceil(F.col("n") / writers.JDBC_BATCH).cast("string").alias("value")))
    return n.filter("n > 0").select(F.inline(items))


_SEARCHABLE = ", ".join(f"'{k}'" for k in T.SEARCHABLE)
_SENT = f"""one AS (SELECT trace_id, segment_id, {{'span_id': span_id, 'parent_span_id': parent_span_id, 'start_time': start_time, 'end_time': end_time, 'operation': operation, 'peer': peer,
  'span_type': span_type, 'span_layer': span_layer, 'component_id': component_id, 'is_error': is_error, 'skip_analysis': false,
  'tags': [{{'key': 'http.status_code', 'value': CASE WHEN is_error THEN '500' ELSE '200' END}}, {{'key': 'db.type', 'value': CASE WHEN part % 2 = 0 THEN 'MySQL' ELSE 'mongodb' END}},
    {{'key': 'db.statement', 'value': 'select ' || part}}, {{'key': 'cache.type', 'value': CASE WHEN part % 2 = 0 THEN 'Redis' ELSE 'memcached' END}},
    {{'key': 'cache.op', 'value': CASE WHEN part % 3 = 0 THEN 'read' ELSE 'write' END}}, {{'key': 'mq.topic', 'value': 'topic_' || (part % 4)}},
    {{'key': 'transmission.latency', 'value': CAST(part % 100 AS VARCHAR)}}],
  'refs': CASE WHEN span_type = 'Entry' AND span_id > 0 THEN [{{'ref_type': 'CrossProcess', 'trace_id': trace_id, 'parent_segment_id': trace_id || '.a', 'parent_span_id': parent_span_id,
    'parent_service': 'cust_' || (part % 20), 'parent_instance': 'i_' || (part % 30), 'parent_endpoint': '/order/' || (part % 5), 'network_address': peer}}] ELSE [] END}} AS s FROM spans),
whole AS (SELECT trace_id, segment_id, list(s ORDER BY s) AS spans, min(s.start_time) AS start_time, max(s.end_time) AS end_time, bool_or(s.is_error) AS is_error FROM one GROUP BY 1, 2),
named AS (SELECT *, substr(list_filter(spans, lambda x: x.span_type = 'Entry')[-1].operation, 1, 150) AS endpoint,
  list_transform(list_filter(flatten(list_transform(spans, lambda x: x.tags)), lambda t: t.key IN ({_SEARCHABLE}) AND length(t.value) <= 256), lambda t: t.key || '=' || t.value) AS pairs FROM whole),
sent AS (SELECT segment_id, is_error, {{'trace_id': trace_id, 'segment_id': segment_id, 'service_id': base64(encode('gateway')) || '.1',
  'instance_id': base64(encode('gateway')) || '.1_' || base64(encode('g-1')),
  'endpoint_id': base64(encode('gateway')) || '.1_' || base64(encode(CASE WHEN trim(coalesce(endpoint, '')) = '' THEN '_blank' ELSE endpoint END)), 'endpoint': endpoint,
  'start_time': start_time, 'latency': CAST(least(end_time - start_time, 2147483647) AS INTEGER), 'is_error': is_error,
  'time_bucket': CAST(strftime(make_timestamp(start_time * 1000), '%Y%m%d%H%M%S') AS BIGINT), 'tags': list_filter(pairs, lambda p, i: length(p) <= 256 AND list_position(pairs, p) = i),
  'service': 'gateway', 'instance': 'g-1', 'spans': spans}} AS message FROM named)"""


@query("sink_kafka_trace", f"WITH {fr.SPANS}, {_SENT} SELECT segment_id AS key, CAST(to_json(message) AS VARCHAR) AS value FROM sent WHERE is_error")
def sink_kafka_trace(spark, sf):
    """Messages of the segments with an error: each holds its segment row and all its spans."""
    from .q_traces import _one_process

    segments = T.gather_segments(_one_process(fr.stored_spans(spark, sf)))
    return writers.kafka_traces(T.segment_rows(segments, whole=True), errors_only=True)


@query("sink_kafka_log", f"WITH {fr.LOGS} SELECT trace_id AS key, service, instance, endpoint, body AS text FROM logs")
def sink_kafka_log(spark, sf):
    from ..operators import logs as LG

    out = writers.kafka_logs(LG.sink(LG.prepare(fr.logs(spark, sf)))["records"])
    j = lambda p: F.get_json_object("value", p)
    return out.select("key", j("$.service").alias("service"), j("$.serviceInstance").alias("instance"), j("$.endpoint").alias("endpoint"), j("$.body.text").alias("text"))


@query("sink_metric_export", f"""{V}, t AS (SELECT {G}, event_id % 2 AS half, count(*) AS n, sum(latency) AS s FROM svc GROUP BY ALL)
SELECT 'n' AS metric, {G}, CAST(n AS DOUBLE) AS value, 'INCREMENT' AS kind FROM t WHERE half = 1 UNION ALL SELECT 's', {G}, CAST(sum(s) AS DOUBLE), 'TOTAL' FROM t GROUP BY {G}""")
def sink_metric_export(spark, sf):
    """Increments of one metric and merged totals of another."""
    rules = [R.Rule("n", "service", "count"), R.Rule("s", "service", "sum", "latency")]
    rows = fr.service_rows(spark, sf)
    old, new = (R.states(rows.filter(F.col("event_id") % 2 == h), rules) for h in (0, 1))
    table = lambda states: R.to_rows(R.values(states, rules), rules)
    return writers.metric_export(table(new), table(R.merge_states(old.unionByName(new), rules)), {"n": "INCREMENT", "s": "TOTAL"})


@query("sink_ttl", f"{V} SELECT DISTINCT CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS day FROM svc WHERE ts < TIMESTAMP '2024-01-24'")
def sink_ttl(spark, sf):
    """Days that retention takes from a state table with batches, keyed states and folds."""
    from uuid import uuid4

    from ..sinks import state_table
    from .runtime import checkpoint_dir

    path = f"{checkpoint_dir(spark).rstrip('/')}/ttl-{uuid4().hex}"
    rules = [R.Rule("n", "service", "count"), R.Rule("types", "service", "label_count", None, (), {"label": "type", "ts": "ts"})]
    rows = fr.service_rows(spark, sf)
    state_table.append(R.states(rows, rules[:1]), path, 0)
    state_table.append(R.keyed_states(rows, rules[1:]), state_table.keyed_path(path), 0)
    state_table.compact(spark, path, rules)
    state_table.append(R.states(rows, rules[:1]), path, 1)
    state_table.expire_all(spark, {path: ("metrics", "hour")}, 20240131)
    kept = state_table.read(spark, path).select("day").unionByName(state_table.read(spark, state_table.keyed_path(path)).select("day")).distinct()
    return rows.select(F.expr("time_bucket div 100").alias("day")).distinct().join(kept, "day", "left_anti")


@query("q_ttl", f"{V} SELECT 'records' AS category, 3 AS days, CAST(count(DISTINCT strftime(ts, '%Y%m%d')) AS BIGINT) AS kept FROM svc WHERE ts >= TIMESTAMP '2024-01-28' UNION ALL SELECT 'metrics', 7, CAST(count(DISTINCT strftime(ts, '%Y%m%d')) AS BIGINT) FROM svc WHERE ts >= TIMESTAMP '2024-01-24'")
def q_ttl(spark, sf):
    """Retention of each category and how many of the stored days it keeps."""
    days = fr.service_rows(spark, sf).select(F.expr("time_bucket div 100").alias("day")).distinct()
    out = None
    for category, ttl in writers.retention().items():
        old = writers.expired_days(days, 20240131, ttl).withColumnRenamed("day", "_d")
        part = (days.join(old, days.day == F.col("_d"), "left_anti").agg(F.count(F.lit(1)).alias("kept"))
                .select(F.lit(category).alias("category"), F.lit(ttl).alias("days"), "kept"))
        out = part if out is None else out.unionByName(part)
    return out
