"""Queries on traces, virtual services, topologies, profiles and hierarchies."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import ids, text
from ..operators import hierarchy as H
from ..operators import profiles, topk, topology, traceql
from ..operators import traces as T
from ..sources import zipkin
from . import frames as fr
from .registry import query

W = f"WITH {fr.SPANS}"
B64 = "base64(encode({}))"
SID = B64 + " || '.1'"
_MIN = "CAST(strftime(make_timestamp(start_time * 1000), '%Y%m%d%H%M') AS BIGINT) AS time_bucket"
_SEC = "CAST(strftime(make_timestamp(start_time * 1000), '%Y%m%d%H%M%S') AS BIGINT) AS time_bucket"


def sid(c):
    return SID.format(c)


# ---- segments ----

@query("src_spans", f"{W} SELECT trace_id, segment_id, span_id, service, start_time, end_time, operation, is_error FROM spans")
def src_spans(spark, sf):
    """Spans gathered into segments per process and spread out again."""
    out = ["trace_id", "segment_id", "span_id", "service", "start_time", "end_time", "operation", "is_error"]
    return T.explode_spans(T.gather_segments(fr.spans(spark, sf).select(*out, "instance"))).select(*out)


def _one_process(s):
    """Spans of one process, which bounds segments: one per trace."""
    return s.withColumn("service", F.lit("gateway")).withColumn("instance", F.lit("g-1"))


def _segments(spark, sf, tags: bool = True):
    """One segment per trace; its process is that of the first span."""
    return T.gather_segments(T.searched(_one_process(fr.spans(spark, sf)), tags))


_SEG = f"""seg AS (SELECT trace_id, segment_id, min(start_time) AS start_time, CAST(least(max(end_time) - min(start_time), 2147483647) AS INTEGER) AS latency, bool_or(is_error) AS is_error,
  coalesce(arg_max(operation, span_id) FILTER (span_type = 'Entry'), arg_min(operation, span_id)) AS endpoint FROM spans GROUP BY ALL)"""


@query("tr_segment", f"""{W}, {_SEG} SELECT trace_id, segment_id, start_time, latency, is_error, endpoint, {SID.format("'gateway'")} || '_' || base64(encode(endpoint)) AS endpoint_id, {_SEC} FROM seg""")
def tr_segment(spark, sf):
    """Segment rows straight from spans: no span is gathered."""
    s = fr.spans(spark, sf).withColumn("service", F.lit("gateway")).withColumn("instance", F.lit("g-1"))
    return T.segment_rows_of(s).select("trace_id", "segment_id", "start_time", "latency", "is_error", "endpoint", "endpoint_id", "time_bucket")


@query("fn_tags_search", f"""{W} SELECT DISTINCT segment_id, tag FROM (SELECT segment_id, unnest(['http.status_code=' || CASE WHEN is_error THEN '500' ELSE '200' END, 'db.type=' || CASE WHEN part % 2 = 0 THEN 'MySQL' ELSE 'mongodb' END, 'mq.topic=topic_' || (part % 4)]) AS tag FROM spans)""")
def fn_tags_search(spark, sf):
    """Searchable tags of segments; statements and cache tags are not searchable."""
    return T.segment_rows(_segments(spark, sf)).select("segment_id", F.explode("tags").alias("tag"))


@query("tr_seg_status", f"{W} SELECT segment_id, coalesce(bool_or(is_error) FILTER (span_id = 0), false) AS first, coalesce(bool_or(is_error) FILTER (span_type = 'Entry'), false) AS entry, bool_or(is_error) AS any FROM spans GROUP BY 1")
def tr_seg_status(spark, sf):
    s = _segments(spark, sf, tags=False)
    return s.select("segment_id", *[F.coalesce(T.segment_error(F.col("spans"), m), F.lit(False)).alias(m) for m in ("first", "entry", "any")])


_HASH = "list_reduce(list_prepend(0::BIGINT, list_transform(string_split(trace_id, ''), lambda c: unicode(c)::BIGINT)), lambda a, c: (a * 31 + c) & 4294967295)"
_BUCKET = "(abs(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) % 10000)"


@query("tr_sampling", f"{W}, {_SEG}, hs AS (SELECT *, {_HASH} AS h FROM seg) SELECT segment_id, CAST({_BUCKET} AS BIGINT) AS bucket FROM hs WHERE {_BUCKET} < 3000 OR latency >= 6900 OR is_error")
def tr_sampling(spark, sf):
    rows = T.segment_rows(_segments(spark, sf, tags=False))
    return T.sample_segments(rows, 3000, 6900).select("segment_id", T.sample_bucket(F.col("trace_id")).alias("bucket"))


@query("join_sampling_policy", f"""{W}, s AS (SELECT trace_id, span_id, service, CAST(end_time - start_time AS BIGINT) AS latency, is_error FROM spans), p AS (SELECT 'cust_' || n_nationkey AS service, n_nationkey * 400 AS rate, CASE WHEN n_nationkey % 2 = 0 THEN 40 END AS duration FROM nation),
j AS (SELECT s.*, coalesce(p.rate, 1000) AS r, coalesce(p.duration, 48) AS d, {_HASH} AS h FROM s LEFT JOIN p USING (service))
SELECT trace_id, span_id FROM j WHERE {_BUCKET} < r OR latency >= d""")
def join_sampling_policy(spark, sf):
    policies = fr.table(spark, sf, "nation").select(
        F.concat(F.lit("cust_"), F.col("n_nationkey").cast("string")).alias("service"), (F.col("n_nationkey") * 400).alias("rate"),
        F.when(F.col("n_nationkey") % 2 == 0, 40).alias("duration"))
    rows = fr.spans(spark, sf).select("trace_id", "span_id", "service", (F.col("end_time") - F.col("start_time")).alias("latency"), "is_error")
    return T.sample_segments(rows, 1000, 48, policies, force_errors=False).select("trace_id", "span_id")


# ---- traffic ----

GATEWAYS = ("addr_3",)
_ENTRY = """ent AS (SELECT *, span_id > 0 AS has_ref, 'cust_' || (part % 20) AS pservice, 'i_' || (part % 30) AS pinstance, '/order/' || (part % 5) AS pendpoint,
  span_layer = 'MQ' OR peer = 'addr_3' AS virtual FROM spans WHERE span_type = 'Entry')"""


@query("tr_entry", f"""{W}, {_ENTRY} SELECT trace_id, span_id, CASE WHEN NOT has_ref THEN 'User' WHEN virtual THEN peer ELSE pservice END AS source_service,
CASE WHEN NOT has_ref THEN 'User' WHEN virtual THEN peer ELSE pinstance END AS source_instance, CASE WHEN NOT has_ref THEN 'User' ELSE pendpoint END AS source_endpoint,
CASE WHEN NOT has_ref THEN 'UNDEFINED' WHEN span_layer = 'MQ' THEN 'VIRTUAL_MQ' WHEN virtual THEN 'VIRTUAL_GATEWAY' ELSE 'GENERAL' END AS source_layer,
service AS dest_service, operation AS dest_endpoint, {_MIN}, CAST(end_time - start_time AS INTEGER) AS latency FROM ent""")
def tr_entry(spark, sf):
    return T.entry_calls(fr.spans(spark, sf), GATEWAYS).select("trace_id", "span_id", "source_service", "source_instance", "source_endpoint", "source_layer", "dest_service", "dest_endpoint", "time_bucket", "latency")


@query("tr_attrs", f"""{W} SELECT trace_id, span_id, CASE WHEN is_error THEN 500 ELSE 200 END AS http_status, NOT is_error AS status, CASE span_layer WHEN 'Http' THEN 'HTTP' WHEN 'Database' THEN 'DATABASE' WHEN 'MQ' THEN 'MQ' ELSE 'RPC' END AS type
FROM spans WHERE span_type IN ('Entry', 'Exit')""")
def tr_attrs(spark, sf):
    s = fr.spans(spark, sf)
    cols = ["trace_id", "span_id", "http_status", "status", "type"]
    return T.entry_calls(s).select(cols).unionByName(T.exit_calls(s).select(cols))


_ALIAS = f"""al AS (SELECT address, max((tb, service, instance)) AS m FROM (SELECT peer AS address, service, instance, CAST(strftime(make_timestamp(start_time * 1000), '%Y%m%d%H%M') AS BIGINT) AS tb
  FROM spans WHERE span_type = 'Entry' AND span_id > 0 AND span_layer <> 'MQ' AND peer <> 'addr_3') GROUP BY 1)"""


@query("build_alias", f"{W}, {_ALIAS} SELECT address, m[2] AS alias_service, m[3] AS alias_instance, m[1] AS time_bucket FROM al")
def build_alias(spark, sf):
    return T.build_alias(fr.spans(spark, sf), GATEWAYS)


_EXIT = f"""{W}, {_ALIAS} SELECT trace_id, span_id, service AS source_service, coalesce(m[2], peer) AS dest_service, coalesce(m[3], peer) AS dest_instance,
CASE WHEN m IS NOT NULL THEN 'GENERAL' ELSE CASE span_layer WHEN 'Database' THEN 'VIRTUAL_DATABASE' WHEN 'MQ' THEN 'VIRTUAL_MQ' WHEN 'Cache' THEN 'VIRTUAL_CACHE' WHEN 'Http' THEN CASE WHEN peer = 'addr_3' THEN 'VIRTUAL_GATEWAY' ELSE 'GENERAL' END ELSE 'GENERAL' END END AS dest_layer
FROM spans LEFT JOIN al ON peer = address AND {{cond}} WHERE span_type = 'Exit'"""


@query("tr_exit", _EXIT.replace("{cond}", "false"))
def tr_exit(spark, sf):
    return T.exit_calls(fr.spans(spark, sf), None, GATEWAYS).select("trace_id", "span_id", "source_service", "dest_service", "dest_instance", "dest_layer")


@query("join_alias", _EXIT.replace("{cond}", "true"))
def join_alias(spark, sf):
    s = fr.spans(spark, sf)
    return T.exit_calls(s, T.build_alias(s, GATEWAYS), GATEWAYS).select("trace_id", "span_id", "source_service", "dest_service", "dest_instance", "dest_layer")


@query("tr_logic_ep", f"""{W} SELECT trace_id, CASE WHEN part % 2 = 0 AND span_type = 'Local' THEN operation ELSE 'job-' || part END AS endpoint,
CAST(CASE WHEN part % 2 = 0 AND span_type = 'Local' THEN end_time - start_time ELSE span_id END AS INTEGER) AS latency, CASE WHEN part % 2 = 0 AND span_type = 'Local' THEN NOT is_error ELSE true END AS status
FROM spans WHERE span_type IN ('Local', 'Entry') AND (part % 2 = 1 OR span_type = 'Local')""")
def tr_logic_ep(spark, sf):
    """Local spans that mark themselves and spans that name an endpoint."""
    return T.logic_endpoints(_logic(spark, sf)).select("trace_id", "endpoint", "latency", "status")


def _logic(spark, sf):
    s = fr.spans(spark, sf)
    part = F.regexp_extract(F.filter("tags", lambda t: t["key"] == "db.statement")[0]["value"], r"(\d+)", 1)
    value = F.when(part.cast("bigint") % 2 == 0, F.lit('{"logic-span": true}')).otherwise(
        F.concat(F.lit('{"name": "job-'), part, F.lit('", "latency": '), F.col("span_id").cast("string"), F.lit(', "status": true}')))
    return s.withColumn("tags", F.array(F.struct(F.lit(T.TAG_LOGIC_ENDPOINT).alias("key"), value.alias("value"))))


@query("fn_json_tag", f"""{W} SELECT trace_id, span_id, CASE WHEN part % 2 = 0 THEN NULL ELSE 'job-' || part END AS name, CASE WHEN part % 2 = 0 THEN true END AS marked FROM spans""")
def fn_json_tag(spark, sf):
    found = text.json_fields(F.col("tags")[0]["value"], {"name": "string", "logic-span": "boolean"})
    return _logic(spark, sf).select("trace_id", "span_id", found["name"].alias("name"), found["logic-span"].alias("marked"))


@query("tr_cross_thread", f"""{W} SELECT trace_id, span_id, CASE WHEN span_layer = 'MQ' THEN peer ELSE 'cust_' || (part % 20) END AS source_service, '/order/' || (part % 5) AS source_endpoint, service AS dest_service, operation AS dest_endpoint
FROM spans WHERE span_type IN ('Exit', 'Local')""")
def tr_cross_thread(spark, sf):
    s = fr.spans(spark, sf)
    # the tables hold references of entry spans only: give the same reference to exit and local spans
    part = F.regexp_extract(F.filter("tags", lambda t: t["key"] == "db.statement")[0]["value"], r"(\d+)", 1).cast("bigint")
    ref = F.struct(F.lit("CrossThread").alias("ref_type"), F.col("trace_id"), F.col("segment_id").alias("parent_segment_id"), F.col("parent_span_id"),
                   F.concat(F.lit("cust_"), (part % 20).cast("string")).alias("parent_service"), F.concat(F.lit("i_"), (part % 30).cast("string")).alias("parent_instance"),
                   F.concat(F.lit("/order/"), (part % 5).cast("string")).alias("parent_endpoint"), F.col("peer").alias("network_address"))
    return T.cross_thread_calls(s.withColumn("refs", F.array(ref))).select("trace_id", "span_id", "source_service", "source_endpoint", "dest_service", "dest_endpoint")


# ---- virtual services ----

@query("tr_virtual_db", f"""{W} SELECT peer AS name, {B64.format('peer')} || '.0' AS entity_id, component_id, {_MIN}, CAST(end_time - start_time AS INTEGER) AS latency, NOT is_error AS status
FROM spans WHERE span_layer = 'Database' AND span_type = 'Exit'""")
def tr_virtual_db(spark, sf):
    return T.virtual_database(fr.spans(spark, sf))["access"].drop("layer")


DB_LIMITS = {"default": 20, "mongodb": 10}
_SLOWDB = f"""slow AS (SELECT segment_id || '-' || span_id AS id, trace_id, service, peer AS database, 'select ' || part AS statement, CAST(end_time - start_time AS INTEGER) AS latency, {_SEC}
FROM spans WHERE span_layer = 'Database' AND span_type = 'Exit' AND end_time - start_time > CASE WHEN part % 2 = 0 THEN 20 ELSE 10 END)"""


@query("join_db_threshold", f"{W}, {_SLOWDB} SELECT * FROM slow")
def join_db_threshold(spark, sf):
    return T.virtual_database(fr.spans(spark, sf), DB_LIMITS)["slow"].select("id", "trace_id", "service", "database", "statement", "latency", "time_bucket")


@query("topk_slow_db", f"{W}, {_SLOWDB} SELECT database, latency, id, statement FROM (SELECT *, row_number() OVER (PARTITION BY database ORDER BY latency DESC, id) AS rn FROM slow) WHERE rn <= 5")
def topk_slow_db(spark, sf):
    slow = T.virtual_database(fr.spans(spark, sf), DB_LIMITS)["slow"]
    return topk.first_per_group(slow, ["database"], [F.col("latency").desc(), F.col("id").asc()], 5).select("database", "latency", "id", "statement")


@query("topk_slow_service_db", f"{W}, {_SLOWDB} SELECT {sid('service')} AS entity_id, latency, id FROM (SELECT *, row_number() OVER (PARTITION BY service ORDER BY latency DESC, id) AS rn FROM slow) WHERE rn <= 3")
def topk_slow_service_db(spark, sf):
    slow = T.virtual_database(fr.spans(spark, sf), DB_LIMITS)["slow"].withColumn("entity_id", F.col("service_entity_id"))
    return topk.first_per_group(slow, ["entity_id"], [F.col("latency").desc(), F.col("id").asc()], 3).select("entity_id", "latency", "id")


_CACHE = """ca AS (SELECT *, CASE WHEN part % 3 = 0 THEN 'Read' ELSE 'Write' END AS op, CAST(end_time - start_time AS INTEGER) AS latency, CASE WHEN part % 2 = 0 THEN 'redis' ELSE 'memcached' END AS kind FROM spans WHERE span_layer = 'Cache' AND span_type IN ('Exit', 'Local'))"""


@query("tr_virtual_cache", f"{W}, {_CACHE} SELECT peer AS name, op AS operation, latency, {_MIN}, NOT is_error AS status FROM ca")
def tr_virtual_cache(spark, sf):
    return T.virtual_cache(fr.spans(spark, sf))["access"].select("name", "operation", "latency", "time_bucket", "status")


@query("topk_slow_cache", f"{W}, {_CACHE} SELECT segment_id || '-' || span_id AS id, op AS operation, latency FROM ca WHERE (op = 'Write' AND latency > CASE kind WHEN 'redis' THEN 30 ELSE 40 END) OR (op = 'Read' AND latency > CASE kind WHEN 'redis' THEN 10 ELSE 20 END)")
def topk_slow_cache(spark, sf):
    return T.virtual_cache(fr.spans(spark, sf), write_thresholds={"default": 40, "redis": 30})["slow"].select("id", "operation", "latency")


@query("tr_virtual_mq", f"""{W} SELECT peer AS name, 'topic_' || (part % 4) AS endpoint, CASE span_type WHEN 'Entry' THEN 'Consume' ELSE 'Produce' END AS operation, CAST(part % 100 AS BIGINT) AS transmission_latency, {_MIN}
FROM spans WHERE span_layer = 'MQ' AND span_type IN ('Entry', 'Exit')""")
def tr_virtual_mq(spark, sf):
    return T.virtual_queue(fr.spans(spark, sf))["endpoint"].select("name", "endpoint", "operation", "transmission_latency", "time_bucket")


# ---- searching ----

@query("trace_filter", f"{W}, {_SEG} SELECT segment_id, latency FROM seg WHERE latency BETWEEN 3000 AND 6000 AND is_error")
def trace_filter(spark, sf):
    rows = T.segment_rows(_segments(spark, sf, tags=False))
    return T.filter_traces(rows, min_ms=3000, max_ms=6000, state="ERROR", service_id=None).select("segment_id", "latency")


@query("join_tags_trace", f"""{W} SELECT segment_id FROM spans WHERE CASE WHEN is_error THEN '500' ELSE '200' END = '500' GROUP BY 1 INTERSECT SELECT segment_id FROM spans WHERE part % 4 = 1 GROUP BY 1""")
def join_tags_trace(spark, sf):
    rows = T.segment_rows(_segments(spark, sf))
    tag_rows = rows.select("segment_id", F.explode("tags").alias("tag"))
    return T.by_tag_table(rows, tag_rows, ["http.status_code=500", "mq.topic=topic_1"]).select("segment_id")


@query("q_trace_list", f"{W}, {_SEG} SELECT trace_id, segment_id, start_time, latency FROM seg WHERE is_error ORDER BY start_time DESC, segment_id LIMIT 20 OFFSET 20")
def q_trace_list(spark, sf):
    rows = T.filter_traces(T.segment_rows(_segments(spark, sf, tags=False)), state="ERROR")
    return topk.page(rows, [F.col("start_time").desc(), F.col("segment_id").asc()], 20, 2).select("trace_id", "segment_id", "start_time", "latency")


@query("sort_trace", f"{W}, {_SEG} SELECT segment_id, latency FROM seg ORDER BY latency DESC, segment_id LIMIT 30")
def sort_trace(spark, sf):
    return T.sorted_traces(T.segment_rows(_segments(spark, sf, tags=False)), "duration").select("segment_id", "latency").limit(30)


@query("q_trace_list_v2", f"""{W}, {_SEG}, pick AS (SELECT trace_id FROM seg ORDER BY start_time DESC, segment_id LIMIT 10)
SELECT trace_id, span_id, operation FROM spans WHERE trace_id IN (SELECT trace_id FROM pick)""")
def q_trace_list_v2(spark, sf):
    chosen = T.sorted_traces(T.segment_rows(_segments(spark, sf, tags=False))).limit(10)
    return T.full_spans(fr.spans(spark, sf), chosen).select("trace_id", "span_id", "operation")


@query("join_span_parent", f"{W} SELECT s.trace_id, s.span_id FROM spans s LEFT JOIN (SELECT DISTINCT trace_id, span_id FROM spans) p ON p.trace_id = s.trace_id AND p.span_id = s.parent_span_id WHERE p.span_id IS NULL")
def join_span_parent(spark, sf):
    return T.roots(T.with_keys(fr.spans(spark, sf))).select("trace_id", "span_id")


_TREE = f"""WITH RECURSIVE {fr.SPANS}, tree AS (
  SELECT trace_id, span_id, 1 AS depth, [(start_time, segment_id, span_id)] AS path FROM (SELECT s.* FROM spans s LEFT JOIN (SELECT DISTINCT trace_id, span_id FROM spans) p ON p.trace_id = s.trace_id AND p.span_id = s.parent_span_id WHERE p.span_id IS NULL) s
  UNION ALL SELECT s.trace_id, s.span_id, t.depth + 1, list_append(t.path, (s.start_time, s.segment_id, s.span_id)) FROM spans s JOIN tree t ON s.trace_id = t.trace_id AND s.parent_span_id = t.span_id)"""


@query("q_trace_detail", f"""{_TREE} SELECT trace_id, span_id, CAST(depth AS INTEGER) AS depth, row_number() OVER (PARTITION BY trace_id ORDER BY path) AS position FROM tree""")
def q_trace_detail(spark, sf):
    """Every trace of the tables as an ordered tree: ordering by (trace_id, position) lists it."""
    return T.order_tree(T.with_keys(fr.spans(spark, sf)).select(*T.TREE)).select("trace_id", "span_id", "depth", "position")


@query("q_trace_page", f"""{_TREE}, {_SEG}, pick AS (SELECT trace_id FROM seg ORDER BY latency DESC, segment_id LIMIT 10)
SELECT trace_id, span_id, CAST(depth AS INTEGER) AS depth, row_number() OVER (PARTITION BY trace_id ORDER BY path) AS position FROM tree WHERE trace_id IN (SELECT trace_id FROM pick)""")
def q_trace_page(spark, sf):
    """The trees of a page of the slowest traces: only the page's spans are walked."""
    page = T.sorted_traces(T.segment_rows(_segments(spark, sf, tags=False)), "duration").limit(10)
    return T.order_tree(T.with_keys(fr.spans(spark, sf)).select(*T.TREE), page).select("trace_id", "span_id", "depth", "position")


def _events(spark, sf):
    """Two kernel events per span."""
    s = fr.spans(spark, sf)
    kinds = F.array(F.struct(F.lit("request").alias("data_type"), F.lit("inbound").alias("data_direction")),
                    F.struct(F.lit("request").alias("data_type"), F.lit("outbound").alias("data_direction")))
    return s.select("trace_id", "segment_id", F.col("span_id").cast("string").alias("span_id"), F.expr("start_time div 1000").alias("start_seconds"),
                    (F.col("end_time") % 1000).alias("start_nanos"), F.explode(kinds).alias("k")).select("*", "k.*").withColumn("event", F.concat_ws("-", "span_id", "data_direction"))


_EV = "ev AS (SELECT trace_id, segment_id, span_id, start_time // 1000 AS start_seconds, end_time % 1000 AS start_nanos, dir AS data_direction, span_id || '-' || dir AS event FROM spans, (VALUES ('inbound'), ('outbound')) d(dir))"


@query("join_span_events", f"""{W}, {_EV}, en AS (SELECT trace_id, parent_span_id, arg_min(span_id, (start_time, segment_id || 'S' || span_id)) AS child FROM spans WHERE span_type = 'Entry' AND span_id > 0 GROUP BY ALL)
SELECT ev.trace_id, ev.segment_id || 'S' || CASE WHEN data_direction = 'inbound' THEN coalesce(child, ev.span_id) ELSE ev.span_id END AS span_key, event, start_seconds FROM ev LEFT JOIN en ON en.trace_id = ev.trace_id AND en.parent_span_id = ev.span_id""")
def join_span_events(spark, sf):
    """Inbound requests were seen by the server and move to the entry span below."""
    return T.attach_events(T.with_keys(fr.spans(spark, sf)), _events(spark, sf)).select("trace_id", "span_key", "event", "start_seconds")


@query("q_span_events", f"{W}, {_EV} SELECT trace_id, event, start_seconds, start_nanos FROM ev ORDER BY start_seconds, start_nanos, trace_id, event LIMIT 50")
def q_span_events(spark, sf):
    return _events(spark, sf).select("trace_id", "event", "start_seconds", "start_nanos").orderBy("start_seconds", "start_nanos", "trace_id", "event").limit(50)


@query("q_trace_otlp", f"""{W} SELECT trace_id AS "traceId", segment_id || 'S' || span_id AS "spanId", CASE WHEN parent_span_id >= 0 THEN segment_id || 'S' || parent_span_id END AS "parentSpanId", operation AS name, nullif(peer, '') AS peer, span_layer AS layer,
CASE span_type WHEN 'Entry' THEN 'SPAN_KIND_SERVER' WHEN 'Exit' THEN 'SPAN_KIND_CLIENT' ELSE 'SPAN_KIND_INTERNAL' END AS kind, start_time * 1000000 AS "startTimeUnixNano", CASE WHEN is_error THEN '500' ELSE '200' END AS status_attr,
CASE WHEN is_error THEN 'STATUS_CODE_ERROR' ELSE 'STATUS_CODE_OK' END AS code FROM spans""")
def q_trace_otlp(spark, sf):
    o = T.to_otlp(fr.spans(spark, sf))
    value = lambda key: F.get(F.filter("attributes", lambda a: a["key"] == key), F.lit(0))["value"]["stringValue"]
    return o.select("traceId", "spanId", "parentSpanId", "name", "kind", "startTimeUnixNano", F.col("attributes")[0]["value"]["stringValue"].alias("status_attr"), F.col("status.code").alias("code"),
                    value("peer.address").alias("peer"), value("layer").alias("layer"))


# ---- span selection language ----

@query("traceql_filter", f"{W} SELECT trace_id, span_id FROM spans WHERE service = 'supp_4' AND end_time - start_time > 20 AND is_error AND part % 2 = 0")
def traceql_filter(spark, sf):
    q = traceql
    return q.spanset(fr.spans(spark, sf), q.field("service", "=", "supp_4"), q.duration(">", "20ms"), q.status("=", "error"), q.attr("db.type", "=", "MySQL")).select("trace_id", "span_id")


@query("traceql_ops", f"{W} SELECT trace_id, span_id FROM spans WHERE part % 100 >= 50 AND regexp_full_match('topic_' || (part % 4), 'topic_[12]') AND part % 2 = 1 AND NOT (operation = '/part/5') AND end_time - start_time <> 30")
def traceql_ops(spark, sf):
    q = traceql
    return q.spanset(fr.spans(spark, sf), q.attr("transmission.latency", ">=", 50), q.attr("mq.topic", "=~", "topic_[12]"), q.attr("db.type", "!=", "MySQL"),
                     q.negate(q.field("operation", "=", "/part/5")), q.exists("cache.op"), q.duration("!=", "30ms")).select("trace_id", "span_id")


@query("set_spanset", f"""{W}, a AS (SELECT DISTINCT trace_id FROM spans WHERE service = 'supp_1'), b AS (SELECT DISTINCT trace_id FROM spans WHERE service = 'supp_2'), c AS (SELECT DISTINCT trace_id FROM spans WHERE service = 'supp_3' AND is_error)
(SELECT trace_id FROM a INTERSECT SELECT trace_id FROM b) UNION SELECT trace_id FROM c""")
def set_spanset(spark, sf):
    s, q = fr.spans(spark, sf), traceql
    of = lambda name: q.field("service", "=", name)
    return q.traces_where(s, {"one": of("supp_1"), "two": of("supp_2"), "failed": q.all_of(of("supp_3"), q.status("=", "error"))},
                          lambda one, two, failed: (one & two) | failed)


@query("q_traceql_search", f"""{W}, m AS (SELECT DISTINCT trace_id FROM spans WHERE service = 'supp_7' AND is_error)
SELECT trace_id, min(start_time) AS start_time, max(end_time) - min(start_time) AS duration_ms, CAST(count(*) AS BIGINT) AS span_count FROM spans WHERE trace_id IN (SELECT trace_id FROM m) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""")
def q_traceql_search(spark, sf):
    s, q = fr.spans(spark, sf), traceql
    return q.search(s, q.trace_ids(q.spanset(s, q.field("service", "=", "supp_7"), q.status("=", "error"))))


@query("q_traceql_tags", f"""{W} SELECT DISTINCT 'mq.topic' AS tag, 'topic_' || (part % 4) AS value FROM spans UNION SELECT unnest(['http.status_code', 'db.type', 'db.statement', 'cache.type', 'cache.op', 'mq.topic', 'transmission.latency']), NULL""")
def q_traceql_tags(spark, sf):
    s = fr.spans(spark, sf)
    values = traceql.tag_values(s, "mq.topic").select(F.lit("mq.topic").alias("tag"), "value")
    return values.unionByName(traceql.tag_names(s).withColumn("value", F.lit(None).cast("string")))


# ---- Zipkin ----

def _zipkin(spark, sf):
    s = fr.spans(spark, sf)
    return s.select(F.sha2("trace_id", 256).substr(1, 32).alias("trace_id"), F.lit(None).cast("string").alias("parent_id"), F.col("span_id").cast("string").alias("span_id"),
                    F.lit("SERVER").alias("kind"), F.col("operation").alias("name"), (F.col("start_time") * 1000).alias("timestamp_us"),
                    ((F.col("end_time") - F.col("start_time")) * 1000).alias("duration_us"), (F.col("span_id") == 5).alias("debug"), F.lit(False).alias("shared"),
                    F.when(F.col("span_id") == 7, "").otherwise(F.col("service")).alias("local_service"), F.when(F.col("peer") != "", F.col("peer")).alias("remote_service"),
                    F.array(F.struct((F.col("start_time") * 1000).alias("timestamp"), F.when(F.col("is_error"), "boom").otherwise("fine").alias("value"))).alias("annotations"),
                    F.create_map(F.lit("http.method"), F.when(F.col("span_id") % 2 == 0, "GET").otherwise("POST"),
                                 F.lit("long"), F.when(F.col("is_error"), F.repeat(F.lit("x"), 300)).otherwise("y")).alias("tags"))


_ZK = """zk AS (SELECT substr(sha256(trace_id), 1, 32) AS trace_id, span_id, operation AS name, start_time * 1000 AS timestamp_us, (end_time - start_time) * 1000 AS duration_us, span_id = 5 AS debug,
  CASE WHEN span_id = 7 THEN 'Unknown' ELSE service END AS local_service, nullif(peer, '') AS remote_service, CASE WHEN is_error THEN 'boom' ELSE 'fine' END AS note, CASE WHEN span_id % 2 = 0 THEN 'GET' ELSE 'POST' END AS method, is_error FROM spans)"""


@query("src_zipkin", f"""{W}, {_ZK} SELECT trace_id, CAST(span_id AS VARCHAR) AS span_id, local_service, timestamp_us // 1000 AS timestamp_ms, note || ',http.method,http.method=' || method || CASE WHEN is_error THEN '' ELSE ',long,long=y' END AS query FROM zk""")
def src_zipkin(spark, sf):
    """The same spans sent as JSON arrays and read back."""
    z = _zipkin(spark, sf)
    body = F.to_json(F.array(F.struct(
        F.col("trace_id").alias("traceId"), F.col("span_id").alias("id"), "kind", "name", F.col("timestamp_us").alias("timestamp"), F.col("duration_us").alias("duration"), "debug",
        F.struct(F.col("local_service").alias("serviceName")).alias("localEndpoint"), F.struct(F.col("remote_service").alias("serviceName")).alias("remoteEndpoint"), "annotations", "tags")))
    rows = zipkin.span_rows(zipkin.from_json(z.select(body.alias("value"))))
    return rows.select("trace_id", "span_id", "local_service", "timestamp_ms", F.array_join("query", ",").alias("query"))


@query("zipkin_filter", f"{W}, {_ZK} SELECT trace_id, min(timestamp_us) AS timestamp_us FROM zk WHERE local_service = 'supp_2' AND duration_us >= 10000 AND duration_us <= 40000 AND method = 'GET' AND note = 'fine' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def zipkin_filter(spark, sf):
    rows = zipkin.span_rows(_zipkin(spark, sf))
    return zipkin.search(rows, "supp_2", min_us=10000, max_us=40000, annotation_query=["http.method=GET", "fine"])


@query("join_tags_zipkin", f"{W}, {_ZK} SELECT trace_id, CAST(span_id AS VARCHAR) AS span_id FROM zk WHERE method = 'POST' AND NOT is_error")
def join_tags_zipkin(spark, sf):
    return T.with_tags(zipkin.span_rows(_zipkin(spark, sf)), "query", ["http.method=POST", "long=y"]).select("trace_id", "span_id")


@query("join_tags_zipkin_trace", f"{W}, {_ZK} SELECT trace_id FROM zk GROUP BY 1 HAVING bool_or(method = 'POST') AND bool_or(note = 'boom')")
def join_tags_zipkin_trace(spark, sf):
    """Traces whose spans have both tags among them, wherever each stands."""
    return T.with_tags(zipkin.span_rows(_zipkin(spark, sf)), "query", ["http.method=POST", "boom"], "trace_id")


@query("agg_zipkin_dict", f"""{W}, {_ZK} SELECT DISTINCT 'service' AS kind, local_service AS a, '' AS b FROM zk UNION SELECT DISTINCT 'span', local_service, name FROM zk UNION SELECT DISTINCT 'remote', local_service, remote_service FROM zk WHERE remote_service IS NOT NULL""")
def agg_zipkin_dict(spark, sf):
    inv = zipkin.inventories(zipkin.span_rows(_zipkin(spark, sf)))
    part = lambda kind, df, b: df.select(F.lit(kind).alias("kind"), F.col("service").alias("a"), b.alias("b"))
    return (part("service", inv["services"], F.lit("")).unionByName(part("span", inv["span_names"], F.col("span_name")))
            .unionByName(part("remote", inv["remote_services"], F.col("remote_service"))))


@query("q_zipkin", f"{W}, {_ZK}, t AS (SELECT trace_id FROM zk WHERE remote_service = 'addr_5' GROUP BY 1 ORDER BY min(timestamp_us) DESC, 1 LIMIT 5) SELECT trace_id, CAST(span_id AS VARCHAR) AS span_id, name FROM zk WHERE trace_id IN (SELECT trace_id FROM t)")
def q_zipkin(spark, sf):
    rows = zipkin.span_rows(_zipkin(spark, sf))
    return zipkin.spans_of(rows, zipkin.search(rows, remote="addr_5", limit=5)).select("trace_id", "span_id", "name")


@query("limit_names", f"{W}, {_ZK} SELECT DISTINCT name FROM zk WHERE local_service = 'supp_1' ORDER BY 1 LIMIT 7")
def limit_names(spark, sf):
    inv = zipkin.inventories(zipkin.span_rows(_zipkin(spark, sf)))
    return zipkin.names(inv["span_names"], "span_name", 7, service="supp_1").withColumnRenamed("span_name", "name")


_LOW = "('0x' || substr(trace_id, 17, 16))::UBIGINT"


@query("st_span_sample", f"""{W}, {_ZK}, n AS (SELECT *, {_LOW} AS u FROM zk), m AS (SELECT *, CASE WHEN u >= 9223372036854775808::UBIGINT THEN 18446744073709551615::UBIGINT - u + 1 ELSE u END AS mag FROM n),
r AS (SELECT *, row_number() OVER (PARTITION BY debug, timestamp_us // 1000000 ORDER BY timestamp_us, span_id::VARCHAR, trace_id) AS rn FROM m)
SELECT CAST(count(*) AS BIGINT) AS kept, CAST(count(*) FILTER (debug) AS BIGINT) AS debug FROM m WHERE debug OR mag <= 2305843009213693952::UBIGINT""")
def st_span_sample(spark, sf):
    kept = zipkin.sample(_zipkin(spark, sf), rate=2500)
    return kept.agg(F.count(F.lit(1)).alias("kept"), F.count_if("debug").alias("debug"))


# ---- topology ----

R = f"WITH {fr.REL}"
_EDGE = "e AS (SELECT DISTINCT lower(detect_point) AS side, source, target, component_id FROM rel)"


def _edges(spark, sf):
    rows = fr.relation_rows(spark, sf)
    s, d = ids.service_id(F.col("source")), ids.service_id(F.col("target"))
    calls = rows.select(s.alias("source_id"), d.alias("dest_id"), ids.relation_id(s, d).alias("entity_id"), "detect_point", "component_id", "time_bucket", "latency", "status")
    return calls


def _name(c):
    return ids.parse_service(F.col(c))["name"]


@query("agg_component_set", f"{R} SELECT source, target, detect_point, time_bucket, string_agg(component_id, ',' ORDER BY component_id) AS components FROM (SELECT DISTINCT source, target, detect_point, time_bucket, component_id FROM rel) GROUP BY ALL")
def agg_component_set(spark, sf):
    """Component sets of two partial frames, merged."""
    c = _edges(spark, sf)
    halves = topology.relation_rows(c.filter("component_id <= 3")).unionByName(topology.relation_rows(c.filter("component_id > 3")))
    return topology.merge_relation_rows(halves).select(_name("source_id").alias("source"), _name("dest_id").alias("target"), "detect_point", "time_bucket",
                                                       F.array_join(F.transform("components", lambda x: x.cast("string")), ",").alias("components"))


@query("agg_relations", f"{R} SELECT source, target, detect_point, time_bucket, CAST(sum(latency) // count(*) AS BIGINT) AS resp_time, CAST(count(*) FILTER (status) * 10000 // count(*) AS INTEGER) AS sla FROM rel GROUP BY source, target, detect_point, time_bucket")
def agg_relations(spark, sf):
    from ..operators import rules as RL
    from ..operators.rules import Rule

    rows = _edges(spark, sf).withColumn("entity_id", F.concat_ws("|", "entity_id", "detect_point"))
    rules = [Rule("resp_time", "service_relation", "long_avg", "latency"), Rule("sla", "service_relation", "percent", None, (), {"cond": ("is_true", "status")})]
    out = RL.values(RL.states(rows, rules), rules)
    rel = ids.parse_relation(F.substring_index("entity_id", "|", 1))
    name = lambda c: ids.parse_service(c)["name"]
    return out.select(name(rel["source"]).alias("source"), name(rel["dest"]).alias("target"), F.substring_index("entity_id", "|", -1).alias("detect_point"), "time_bucket", "resp_time", "sla")


@query("agg_rel_dedup", f"{R} SELECT DISTINCT lower(detect_point) AS side, source, target, component_id FROM rel WHERE time_bucket BETWEEN 19960101 AND 19971231")
def agg_rel_dedup(spark, sf):
    from ..functions.timebucket import Duration

    e = topology.edges_in_range(topology.relation_rows(_edges(spark, sf)), Duration("1996-01-01", "1997-12-31", "DAY"))
    return e.select("side", _name("source").alias("source"), _name("target").alias("target"), "component_id")


def _map_edges(spark, sf):
    return topology.edges_in_range(_edges(spark, sf))


_CALLS = """SELECT source, target, string_agg(DISTINCT side, ',' ORDER BY side) AS detect_points, string_agg(DISTINCT CASE WHEN side = 'client' THEN CAST(component_id AS VARCHAR) END, ',' ORDER BY CASE WHEN side = 'client' THEN CAST(component_id AS VARCHAR) END) AS source_components,
string_agg(DISTINCT CASE WHEN side = 'server' THEN CAST(component_id AS VARCHAR) END, ',' ORDER BY CASE WHEN side = 'server' THEN CAST(component_id AS VARCHAR) END) AS target_components"""


def _flat_calls(c):
    join = lambda n: F.when(F.size(n) > 0, F.array_join(n, ",")).alias(n)
    return c.select(_name("source").alias("source"), _name("target").alias("target"), join("detect_points"), join("source_components"), join("target_components"))


@query("join_client_server", f"{R}, {_EDGE} {_CALLS} FROM e GROUP BY 1, 2")
def join_client_server(spark, sf):
    return _flat_calls(topology.calls(_map_edges(spark, sf)))


@query("q_topo_service", f"{R}, {_EDGE}, n AS (SELECT * FROM e WHERE source IN ('cust_1', 'cust_2') OR target IN ('supp_3')) {_CALLS} FROM n GROUP BY 1, 2")
def q_topo_service(spark, sf):
    from base64 import b64encode

    sid_of = lambda name: b64encode(name.encode()).decode() + ".1"
    _, c = topology.service_map(_map_edges(spark, sf), [sid_of(x) for x in ("cust_1", "cust_2", "supp_3")])
    return _flat_calls(c)


_NODES = """SELECT id, max(type) AS type FROM (SELECT target AS id, CAST(max(component_id) FILTER (side = 'server') AS VARCHAR) AS type FROM e GROUP BY 1 UNION ALL SELECT source, NULL FROM e) GROUP BY 1"""


@query("q_topo_global", f"{R}, {_EDGE} {_NODES}")
def q_topo_global(spark, sf):
    """Nodes of the whole map; their priority is the component id here, so the highest one names the node."""
    nodes, _ = topology.service_map(_map_edges(spark, sf))
    return nodes.select(F.col("name").alias("id"), "type")


@query("q_topo_components", f"""{R}, {_EDGE}, c AS (SELECT n_nationkey AS component_id, n_name AS component, n_regionkey AS priority FROM nation), s AS (SELECT target AS id, component, priority, component_id FROM e JOIN c USING (component_id) WHERE side = 'server')
SELECT id, arg_max(component, priority * 1000 - component_id) AS type FROM s GROUP BY 1""")
def q_topo_components(spark, sf):
    """The component of highest priority that a server reports about itself."""
    n = fr.table(spark, sf, "nation")
    comp = n.select(F.col("n_nationkey").cast("int").alias("component_id"), F.col("n_name").alias("component"), F.lower("n_name").alias("server_name"), F.col("n_regionkey").alias("priority"))
    nodes = topology.service_nodes(_map_edges(spark, sf), comp)
    return nodes.filter("type is not null").select(F.col("name").alias("id"), "type")


@query("q_topo_instance", f"""{R}, i AS (SELECT DISTINCT lower(detect_point) AS side, source, target, component_id, 'c' || component_id AS si, 't' || (latency % 3) AS ti FROM rel WHERE (source = 'cust_1' AND target = 'supp_2'))
SELECT si, ti, string_agg(DISTINCT side, ',' ORDER BY side) AS sides FROM i GROUP BY 1, 2""")
def q_topo_instance(spark, sf):
    from base64 import b64encode

    rows = fr.relation_rows(spark, sf)
    inst = lambda svc, name: ids.instance_id(ids.service_id(F.col(svc)), name)
    e = rows.select(F.lower("detect_point").alias("side"), inst("source", F.concat(F.lit("c"), F.col("component_id").cast("string"))).alias("source"),
                    inst("target", F.concat(F.lit("t"), (F.col("latency") % 3).cast("string"))).alias("target"), "component_id").distinct()
    sid_of = lambda name: b64encode(name.encode()).decode() + ".1"
    c = topology.instance_map(e, sid_of("cust_1"), sid_of("supp_2"))
    name = lambda c_: ids.parse_part(F.col(c_))["name"]
    return c.select(name("source").alias("si"), name("target").alias("ti"), F.array_join("detect_points", ",").alias("sides"))


@query("q_topo_endpoint", f"{R} SELECT DISTINCT source, target FROM rel WHERE detect_point = 'SERVER' AND (source = 'cust_4' OR target = 'cust_4')")
def q_topo_endpoint(spark, sf):
    rows = fr.relation_rows(spark, sf)
    ep = lambda c: ids.endpoint_id(ids.service_id(F.lit("s")), F.col(c))
    e = rows.select(F.lower("detect_point").alias("side"), ep("source").alias("source"), ep("target").alias("target"), "component_id")
    from base64 import b64encode

    enc = lambda s: b64encode(s.encode()).decode()
    name = lambda c: ids.parse_part(F.col(c))["name"]
    return topology.endpoint_map(e, f"{enc('s')}.1_{enc('cust_4')}").select(name("source").alias("source"), name("target").alias("target"))


@query("q_topo_process", f"""{R}, p AS (SELECT DISTINCT 'cust_' || (c_custkey % 20) AS id, 'host_' || (c_custkey % 4) AS inst FROM customer), t AS (SELECT DISTINCT source, target FROM rel WHERE source IN (SELECT id FROM p WHERE inst = 'host_1'))
SELECT DISTINCT p.id AS process_id, inst AS instance_id, true AS is_real FROM p WHERE id IN (SELECT source FROM t)""")
def q_topo_process(spark, sf):
    c = fr.table(spark, sf, "customer").select(
        F.concat(F.lit("cust_"), (F.col("c_custkey") % 20).cast("string")).alias("process_id"), F.concat(F.lit("host_"), (F.col("c_custkey") % 4).cast("string")).alias("instance_id")).distinct()
    procs = c.withColumn("name", F.col("process_id")).withColumn("service_id", F.lit("s")).withColumn("virtual", F.lit(False))
    e = fr.relation_rows(spark, sf).select(F.lower("detect_point").alias("side"), "source", "target", "component_id").distinct()
    nodes, _ = topology.process_map(e, procs, "host_1")
    return nodes.select("process_id", "instance_id", "is_real").distinct()


# ---- profiles ----

S = f"WITH {fr.STACKS}"
_PATHS = "list_transform(range(1, len(stack) + 1), lambda i: stack[1:i])"


def _path(df, *cols):
    return df.select(F.array_join("path", ">").alias("path"), *cols)


@query("agg_flame_ebpf", f"""{S}, d AS (SELECT DISTINCT stack, weight, p_partkey // 100 AS upload FROM stacks) SELECT array_to_string(p, '>') AS path, CAST(sum(weight) AS BIGINT) AS weight FROM (SELECT unnest({_PATHS}) AS p, weight FROM d) GROUP BY 1""")
def agg_flame_ebpf(spark, sf):
    rows = fr.stacks(spark, sf).withColumn("upload_time", F.expr("p_partkey div 100")).withColumn("dump_count", F.col("weight"))
    return _path(profiles.flame_kernel(rows, aggregate="COUNT"), "weight")


@query("q_ebpf_profile", f"""{S}, d AS (SELECT DISTINCT segment_id, stack, weight * 3 AS weight, p_partkey // 100 AS upload FROM stacks WHERE dump_time BETWEEN 1000 AND 15000) SELECT segment_id, array_to_string(p, '>') AS path, CAST(sum(weight) AS BIGINT) AS weight FROM (SELECT segment_id, unnest({_PATHS}) AS p, weight FROM d) GROUP BY 1, 2""")
def q_ebpf_profile(spark, sf):
    rows = (fr.stacks(spark, sf).filter(F.col("dump_time").between(1000, 15000)).withColumn("upload_time", F.expr("p_partkey div 100"))
            .withColumn("duration", F.col("weight") * 3))
    out = profiles.flame_kernel(rows, ["segment_id"], "DURATION")
    return out.select("segment_id", F.array_join("path", ">").alias("path"), "weight")


@query("agg_flame_go", f"""{S}, n AS (SELECT segment_id, p, CAST(sum(weight) AS BIGINT) AS count FROM (SELECT segment_id, unnest({_PATHS}) AS p, weight FROM stacks) GROUP BY ALL),
l AS (SELECT segment_id, ['root'] || p AS p, count FROM n UNION ALL SELECT segment_id, ['root'], CAST(sum(count) AS BIGINT) FROM n WHERE len(p) = 1 GROUP BY 1),
k AS (SELECT segment_id, p[1:len(p) - 1] AS p, sum(count) AS below FROM l WHERE len(p) > 1 GROUP BY ALL)
SELECT l.segment_id, array_to_string(l.p, '>') AS path, count, count * 10 AS duration, CAST(greatest(count - coalesce(below, 0), 0) * 10 AS BIGINT) AS self_duration FROM l LEFT JOIN k ON k.segment_id = l.segment_id AND k.p = l.p""")
def agg_flame_go(spark, sf):
    out = profiles.flame_go(fr.stacks(spark, sf).withColumn("samples", F.col("weight")))
    return out.select("segment_id", F.array_join("path", ">").alias("path"), "count", "duration", "self_duration")


# snapshots: the parts of a segment follow each other with steps of 5, so every fifth sequence is its own and runs are
# told apart by p_size
def _snapshots(spark, sf):
    s = fr.stacks(spark, sf)
    return s.select("segment_id", F.expr("sequence div 5").alias("sequence"), F.col("dump_time").cast("bigint").alias("dump_time"), "stack")


_SNAP = "snap AS (SELECT segment_id, sequence // 5 AS sequence, dump_time, stack FROM stacks)"
_ISL = """SELECT {k}, CAST(sum(hi_t - lo_t) AS BIGINT) AS duration, CAST(sum(n) AS BIGINT) AS count FROM (SELECT {k}, g, max(dump_time) - 0 AS hi_t, min(dump_time) AS lo_t, count(*) AS n FROM (SELECT *, sequence - row_number() OVER (PARTITION BY {k} ORDER BY sequence) AS g FROM {t}) GROUP BY ALL) GROUP BY {k}"""


@query("win_islands", f"{S}, {_SNAP}, f AS (SELECT segment_id, stack[1] AS frame, sequence, dump_time FROM snap) {_ISL.format(k='segment_id, frame', t='f')}")
def win_islands(spark, sf):
    """Runs of one root frame; small chunks exercise the stitching at their borders."""
    rows = _snapshots(spark, sf).withColumn("frame", F.col("stack")[0])
    return profiles.island_duration(rows, ["segment_id", "frame"], chunk=16)


_FLAME = f"""x AS (SELECT segment_id, unnest({_PATHS}) AS p, sequence, dump_time FROM {{t}}), nodes AS ({_ISL.format(k='segment_id, p', t='x')}),
k AS (SELECT segment_id, p[1:len(p) - 1] AS p, sum(duration) AS below FROM nodes WHERE len(p) > 1 GROUP BY ALL)
SELECT nodes.segment_id, array_to_string(nodes.p, '>') AS path, count, duration, CAST(duration - coalesce(below, 0) AS BIGINT) AS self_duration FROM nodes LEFT JOIN k ON k.segment_id = nodes.segment_id AND k.p = nodes.p"""


@query("agg_flame_trace", f"{S}, {_SNAP}, {_FLAME.format(t='snap')}")
def agg_flame_trace(spark, sf):
    out = profiles.flame_from_snapshots(_snapshots(spark, sf), chunk=16)
    return out.select("segment_id", F.array_join("path", ">").alias("path"), "count", "duration", "self_duration")


_QUERIES = "q AS (SELECT 'seg_' || r_regionkey AS segment_id, r_regionkey * 1000 AS s, r_regionkey * 1000 + 9000 AS e FROM region)"
_PICK = f"""{_QUERIES}, inside AS (SELECT snap.segment_id, min(sequence) AS lo, least(max(sequence) + 1, min(sequence) + {{limit}}) AS hi FROM snap JOIN q ON q.segment_id = snap.segment_id AND dump_time BETWEEN s AND e GROUP BY 1),
picked AS (SELECT snap.* FROM snap JOIN inside ON inside.segment_id = snap.segment_id AND sequence >= lo AND sequence < hi)"""


def _profile_queries(spark, sf):
    r = fr.table(spark, sf, "region")
    return r.select(F.concat(F.lit("seg_"), F.col("r_regionkey").cast("string")).alias("segment_id"), (F.col("r_regionkey") * 1000).alias("start"), (F.col("r_regionkey") * 1000 + 9000).alias("end"))


@query("join_profile_segment", f"{S}, {_SNAP}, {_PICK.format(limit=100000)} SELECT segment_id, sequence, dump_time FROM picked")
def join_profile_segment(spark, sf):
    return profiles.select_snapshots(_snapshots(spark, sf), _profile_queries(spark, sf), 100000).select("segment_id", "sequence", "dump_time")


@query("q_profile", f"""{S}, {_SNAP}, {_PICK.format(limit=100)}, covered AS (SELECT CAST(sum(n) AS BIGINT) AS found FROM (SELECT max(sequence) + 1 - min(sequence) AS n FROM snap JOIN q ON q.segment_id = snap.segment_id AND dump_time BETWEEN s AND e GROUP BY snap.segment_id, s, e)),
flame AS (WITH {_FLAME.format(t='picked')}) SELECT *, NULL AS tip FROM flame UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, 'The tree covers 100 of ' || found || ' snapshots.' FROM covered WHERE found > 100""")
def q_profile(spark, sf):
    """Flame graphs of chosen segments; at most 100 snapshots of each are analysed, and a tip says how many there are."""
    trees, tip = profiles.analyse(_snapshots(spark, sf), _profile_queries(spark, sf), 100)
    trees = trees.select("segment_id", F.array_join("path", ">").alias("path"), "count", "duration", "self_duration")
    return trees.unionByName(tip.select("tip"), allowMissingColumns=True)


@query("agg_flame_merge", f"""{S}, n AS (SELECT segment_id, p, sum(weight) AS total FROM (SELECT segment_id, unnest({_PATHS}) AS p, weight FROM stacks) GROUP BY ALL), own AS (SELECT segment_id, stack AS p, sum(weight) AS self FROM stacks GROUP BY ALL)
SELECT array_to_string(n.p, '>') AS path, CAST(sum(total) AS BIGINT) AS total, CAST(sum(coalesce(self, 0)) AS BIGINT) AS self FROM n LEFT JOIN own ON own.segment_id = n.segment_id AND own.p = n.p GROUP BY 1""")
def agg_flame_merge(spark, sf):
    """Trees of five instances merged by path."""
    s = fr.stacks(spark, sf)
    total = profiles.flame_from_weights(s, ["segment_id"]).withColumnRenamed("weight", "total")
    own = s.groupBy("segment_id", F.col("stack").alias("path")).agg(F.sum("weight").alias("self"))
    trees = total.join(own, ["segment_id", "path"], "left").withColumn("self", F.coalesce("self", F.lit(0)))
    return _path(profiles.merge_trees(trees), "total", "self")


# ---- hierarchy ----

_LAYERS = ("GENERAL", "APISIX", "K8S_SERVICE", "MESH", "MESH_DP", "VIRTUAL_DATABASE", "MYSQL")


def _hier_services(spark, sf):
    """Every nation is a service in every layer; names differ by layer the way the rules expect."""
    n = fr.table(spark, sf, "nation").select("n_name")
    up = F.col("n_name")
    named = {"GENERAL": up, "APISIX": F.concat(up, F.lit(".ns1")), "K8S_SERVICE": F.concat(F.lit("k8s::"), up, F.lit(".ns1")), "MESH": up, "MESH_DP": up,
             "VIRTUAL_DATABASE": F.concat(up, F.lit(".ns1.svc.cluster.local:3306")), "MYSQL": F.concat(F.lit("db::"), up, F.lit(".ns1"))}
    return n.select(F.inline(F.array(*[F.struct(c.alias("name"), F.lit(l).alias("layer")) for l, c in named.items()])))


_HS = """n AS (SELECT n_name AS x FROM nation), rel4 AS (
  SELECT x AS upper, 'GENERAL' AS upper_layer, x || '.ns1' AS lower, 'APISIX' AS lower_layer FROM n
  UNION ALL SELECT x, 'GENERAL', 'k8s::' || x || '.ns1', 'K8S_SERVICE' FROM n
  UNION ALL SELECT x || '.ns1', 'APISIX', 'k8s::' || x || '.ns1', 'K8S_SERVICE' FROM n
  UNION ALL SELECT x, 'MESH', x, 'MESH_DP' FROM n
  UNION ALL SELECT x || '.ns1.svc.cluster.local:3306', 'VIRTUAL_DATABASE', 'db::' || x || '.ns1', 'MYSQL' FROM n
  UNION ALL SELECT 'db::' || x || '.ns1', 'MYSQL', 'k8s::' || x || '.ns1', 'K8S_SERVICE' FROM n)"""


@query("join_hierarchy", f"WITH {_HS} SELECT * FROM rel4")
def join_hierarchy(spark, sf):
    return H.match_services(_hier_services(spark, sf))


@query("st_hier_auto", f"WITH {_HS} SELECT upper_layer, lower_layer, CAST(count(*) AS BIGINT) AS n FROM rel4 GROUP BY 1, 2")
def st_hier_auto(spark, sf):
    """One run of the matching job: relations by layer pair."""
    return H.match_services(_hier_services(spark, sf)).groupBy("upper_layer", "lower_layer").agg(F.count(F.lit(1)).alias("n"))


@query("q_hier_service", f"WITH {_HS} SELECT * FROM rel4 WHERE NOT (upper_layer = 'GENERAL' AND lower_layer = 'K8S_SERVICE') AND contains(upper || '/' , 'NATION_7') AND upper_layer <> 'MESH' AND regexp_matches(upper, 'NATION_7($|\\.)')")
def q_hier_service(spark, sf):
    """Everything around one service, without relations that follow from longer ways."""
    return H.service_hierarchy(H.match_services(_hier_services(spark, sf)), "NATION_7", "GENERAL")


def _hier_instances(spark, sf):
    s = _hier_services(spark, sf)
    pod = F.concat(F.lit("pod-"), F.regexp_extract("name", r"(NATION_\d+)", 1))
    attrs = (F.when(F.col("layer") == "GENERAL", F.create_map(F.lit("hostname"), pod)).when(F.col("layer") == "APISIX", F.create_map(F.lit("Pod"), pod))
             .otherwise(F.create_map(F.lit("zone"), F.lit("a"))))
    name = (F.when(F.col("layer") == "K8S_SERVICE", pod).when(F.col("layer").isin("MESH", "MESH_DP"), F.lit("same")).otherwise(F.concat_ws("@", "layer", "name")))
    return s.select(F.col("name").alias("service"), "layer", name.alias("name"), attrs.alias("attributes"))


@query("join_instance_hier", """WITH n AS (SELECT n_name AS x FROM nation), r AS (
  SELECT x AS service, 'GENERAL' AS layer, 'GENERAL@' || x AS name, 'k8s::' || x || '.ns1' AS related_service, 'K8S_SERVICE' AS related_layer, 'lower' AS direction, 'pod-' || x AS related FROM n
  UNION ALL SELECT 'k8s::' || x || '.ns1', 'K8S_SERVICE', 'pod-' || x, x, 'GENERAL', 'upper', NULL FROM n WHERE false
  UNION ALL SELECT x || '.ns1', 'APISIX', 'APISIX@' || x || '.ns1', 'k8s::' || x || '.ns1', 'K8S_SERVICE', 'lower', 'pod-' || x FROM n
  UNION ALL SELECT x, 'MESH', 'same', x, 'MESH_DP', 'lower', 'same' FROM n UNION ALL SELECT x, 'MESH_DP', 'same', x, 'MESH', 'upper', 'same' FROM n) SELECT * FROM r""")
def join_instance_hier(spark, sf):
    return H.related_instances(_hier_instances(spark, sf), H.match_services(_hier_services(spark, sf)))


@query("q_hier_instance", """SELECT n_name AS service, 'GENERAL@' || n_name AS name, 'pod-' || n_name AS related FROM nation WHERE n_name = 'NATION_7'""")
def q_hier_instance(spark, sf):
    rel = H.match_services(_hier_services(spark, sf))
    out = H.related_instances(_hier_instances(spark, sf), rel).filter((F.col("service") == "NATION_7") & (F.col("layer") == "GENERAL"))
    return out.select("service", "name", "related")


@query("q_layer_levels", f"WITH {_HS}, l AS (SELECT DISTINCT upper_layer AS layer FROM rel4 UNION SELECT DISTINCT lower_layer FROM rel4) SELECT layer, CASE layer WHEN 'GENERAL' THEN 3 WHEN 'MESH' THEN 3 WHEN 'VIRTUAL_DATABASE' THEN 3 WHEN 'APISIX' THEN 2 WHEN 'MYSQL' THEN 2 WHEN 'MESH_DP' THEN 1 ELSE 0 END AS level FROM l")
def q_layer_levels(spark, sf):
    """Levels of the layers in use."""
    layers = _hier_services(spark, sf).select("layer").distinct()
    return H.layer_levels(spark).join(layers, "layer", "left_semi")
