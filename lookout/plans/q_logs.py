"""Queries on logs, names and text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions import text
from ..functions.timebucket import Duration
from ..operators import logs as G
from ..operators import naming, topk
from . import frames as fr
from .registry import query

W = f"WITH {fr.LOGS}"
V = f"WITH {fr.SVC}"

# ---- parsing ----

PATTERN = r"^(?<first>\S+)\s+(?<second>[a-z]+).*?(?<number>\d+)?"


@query("lal_text_regexp", f"""{W}, p AS (SELECT doc_id, regexp_extract(body, '\\d+', 0) AS number, regexp_extract(body, '([A-Za-z]+) (the) ([a-z]+)', 1) AS before, regexp_extract(body, '([A-Za-z]+) (the) ([a-z]+)', 3) AS after, regexp_matches(body, '([A-Za-z]+) (the) ([a-z]+)') AS hit FROM logs)
SELECT doc_id, CASE WHEN hit THEN before END AS before, CASE WHEN hit THEN after END AS after, NOT hit AS aborted FROM p""")
def lal_text_regexp(spark, sf):
    """Named groups of the first match anywhere in the whole text; logs without a match are aborted."""
    df = G.parse_regexp(G.prepare(fr.logs(spark, sf)), r"(?<before>[A-Za-z]+) (the) (?<after>[a-z]+)")
    return df.select("doc_id", G.field("before").alias("before"), G.field("after").alias("after"), "aborted")


@query("lal_json", f"{V} SELECT event_id, CAST(k AS VARCHAR) AS k, name AS service, CAST(ms AS VARCHAR) AS timestamp, false AS aborted FROM svc")
def lal_json(spark, sf):
    """JSON bodies; service and timestamp come from the metadata, because the body lacks them."""
    df = G.parse_json(G.prepare(fr.json_logs(spark, sf)))
    return df.select("event_id", G.field("k").alias("k"), G.field("service").alias("service"), G.field("timestamp").alias("timestamp"), "aborted")


@query("lal_json_abort", f"{W} SELECT doc_id, NOT (regexp_matches(body, '^\\s*\\{{') AND json_valid(body)) AS aborted, service FROM logs")
def lal_json_abort(spark, sf):
    """Texts that are no JSON objects: the parser aborts them when asked to."""
    df = G.parse_json(G.prepare(fr.logs(spark, sf)), abort_on_failure=True)
    return df.select("doc_id", "aborted", G.field("service").alias("service"))


@query("lal_yaml", f"""{V} SELECT event_id, endpoint AS kind, CAST(latency AS VARCHAR) AS cost, 'two words' AS note, name AS service, 'cost ' || latency || chr(10) || chr(10) || '# k ' || k || chr(10) AS lines,
'k is ' || k AS folded, '["a", "' || k || '", "c, d"]' AS list, CAST(latency AS VARCHAR) AS inner FROM svc""")
def lal_yaml(spark, sf):
    rows = fr.service_rows(spark, sf)
    k, cost = F.col("k").cast("string"), F.col("latency").cast("string")
    body = F.concat(F.lit("# made from the event\nkind: "), F.col("endpoint"), F.lit("\ncost: "), cost, F.lit("\nnote: \"two words\"\n  nested: 1\n"),
                    F.lit("lines: |\n  cost "), cost, F.lit("\n\n  # k "), k, F.lit("\nfolded: >-\n  k is\n  "), k, F.lit("\nlist: [a, "), k, F.lit(", 'c, d']\nmap: {k: "), k, F.lit(",\n  in: [x: "), cost, F.lit("]}\n"))
    logs = fr.json_logs(spark, sf).drop("body").join(rows.select("event_id", body.alias("body")), "event_id")
    df = G.parse_yaml(G.prepare(logs))
    return df.select("event_id", G.field("kind").alias("kind"), G.field("cost").alias("cost"), G.field("note").alias("note"), G.field("service").alias("service"),
                     G.field("lines").alias("lines"), G.field("folded").alias("folded"), G.field("list").alias("list"), G.path("map", "$.in[0].x").alias("inner"))


def _extracted(spark, sf):
    df = G.parse_json(G.prepare(fr.json_logs(spark, sf)))
    k = G.field("k").try_cast("bigint")
    df = G.extract(df, endpoint=F.concat(F.lit("/k/"), G.field("k")), layer=F.lit("MESH"), cost=(k * 2 + 1).cast("string"))
    return G.add_tags(df, bucket=(k % 3).cast("string"), none=F.lit(None).cast("string"))


@query("lal_extract", f"{V} SELECT event_id, '/k/' || k AS endpoint, 'MESH' AS layer, CAST(k * 2 + 1 AS VARCHAR) AS cost, '{{bucket=' || (k % 3) || ',kind=' || endpoint || '}}' AS tags FROM svc")
def lal_extract(spark, sf):
    return _extracted(spark, sf).select("event_id", "endpoint", "layer", "cost", L.encode(F.col("tags")).alias("tags"))


@query("lal_timestamp", f"{V} SELECT event_id, ms // 1000 * 1000 AS ts FROM svc")
def lal_timestamp(spark, sf):
    df = G.prepare(fr.json_logs(spark, sf)).withColumn("t", F.date_format(F.timestamp_millis("ts"), "yyyy-MM-dd HH:mm:ss"))
    return G.extract(df, ts=G.timestamp(F.col("t"), "yyyy-MM-dd HH:mm:ss")).select("event_id", "ts")


@query("lal_def", f"{V} SELECT event_id, k * k - k AS v FROM svc")
def lal_def(spark, sf):
    df = G.parse_json(G.prepare(fr.json_logs(spark, sf)))
    df = G.define(df, k=lambda v: G.field("k").try_cast("bigint"), square=lambda v: v.k * v.k, v=lambda v: v.square - v.k)
    return G.extract(df, out=G.defined("v").cast("string")).select("event_id", F.col("out").cast("bigint").alias("v"))


@query("lal_if", f"{V} SELECT event_id, CASE WHEN k > 80 AND endpoint <> 'error' THEN 'high' WHEN k > 80 OR k = 7 THEN 'odd' ELSE 'low' END AS level FROM svc")
def lal_if(spark, sf):
    df = G.parse_json(G.prepare(fr.json_logs(spark, sf)))
    k, kind = G.field("k").try_cast("bigint"), F.col("tags")["kind"]
    level = F.when((k > 80) & ~(kind == "error"), "high").when((k > 80) | (k == 7), "odd").otherwise("low")
    return G.extract(df, level=level).select("event_id", "level")


@query("lal_metrics", f"{V} SELECT 'log_k' AS name, '{{kind=' || endpoint || ',service=' || name || '}}' AS labels, ms AS ts, CAST(k AS DOUBLE) AS value FROM svc")
def lal_metrics(spark, sf):
    df = G.parse_json(G.prepare(fr.json_logs(spark, sf)))
    out = G.to_samples(df, "log_k", G.field("k"), {"service": F.col("service"), "kind": F.col("tags")["kind"], "absent": F.lit(None)})
    return out.withColumn("labels", L.encode(F.col("labels")))


@query("lal_metrics_meter", f"{V} SELECT 'svc' AS x, {'base64(encode(name))'} || '.1' AS entity_id, time_bucket, CAST(sum(CASE WHEN k <= 0 THEN 0 ELSE k END) AS BIGINT) AS value FROM svc GROUP BY ALL")
def lal_metrics_meter(spark, sf):
    """Samples taken from logs, bound to services and summed per hour."""
    from ..operators import samples as M

    df = G.parse_json(G.prepare(fr.json_logs(spark, sf)))
    s = G.to_samples(df, "log_k", G.field("k"), {"service": F.col("service"), "kind": F.col("tags")["kind"]})
    rows = M.to_meter_rows(M.bind_service(s, ["service"], "GENERAL"), "hour")
    return M.meter(rows, "SUM").select(F.lit("svc").alias("x"), "entity_id", "time_bucket", "value")


def _kept(spark, sf):
    df = G.parse_json(G.prepare(fr.json_logs(spark, sf)))
    k = G.field("k").try_cast("bigint")
    df = G.abort(df, k < 10)
    df = G.drop(df, k < 50)
    return G.enforce(df, F.col("tags")["kind"] == "error")


@query("lal_abort", f"{V} SELECT event_id, k < 10 AS aborted, k >= 50 OR endpoint = 'error' AS keep FROM svc")
def lal_abort(spark, sf):
    return _kept(spark, sf).select("event_id", "aborted", "keep")


_SINK = "l AS (SELECT *, CAST(strftime(ts, '%Y%m%d%H%M%S') AS BIGINT) AS tb FROM svc WHERE k >= 10 AND (k >= 50 OR endpoint = 'error'))"


@query("st_log_sink", f"{V}, {_SINK} SELECT 'record' AS kind, name AS a, instance AS b, tb AS time_bucket FROM l UNION ALL SELECT 'instance', name, instance, max(minute) FROM l GROUP BY ALL UNION ALL SELECT DISTINCT 'service', name, '', minute FROM l")
def st_log_sink(spark, sf):
    """Records and the inventory they imply, from one parsed frame."""
    out = G.sink(_kept(spark, sf))
    rec = out["records"].select(F.lit("record").alias("kind"), F.col("service").alias("a"), F.col("instance").alias("b"), "time_bucket")
    inst = out["instances"].select(F.lit("instance").alias("kind"), F.col("service").alias("a"), F.col("instance").alias("b"), F.col("last_ping").alias("time_bucket"))
    svc = out["services"].select(F.lit("service").alias("kind"), F.col("service").alias("a"), F.lit("").alias("b"), "time_bucket")
    return rec.unionByName(inst).unionByName(svc)


@query("st_auto_layer", f"{V} SELECT event_id FROM svc WHERE k % 2 = 0")
def st_auto_layer(spark, sf):
    """Rules in auto-layer mode drop rows that were given no layer."""
    df = G.parse_json(G.prepare(fr.json_logs(spark, sf)))
    df = G.extract(df, when=G.field("k").try_cast("bigint") % 2 == 0, layer=F.lit("MESH"))
    return G.sink(df, auto_layer=True)["records"].select(F.expr("cast(substring(trace_id, 2) as bigint)").alias("event_id"))


@query("lal_slow_sql", f"{V} SELECT 'e' || event_id AS id, 'q' || k AS statement, latency, base64(encode(name)) || '.0' AS entity_id, CAST(strftime(ts, '%Y%m%d%H%M%S') AS BIGINT) AS time_bucket FROM svc WHERE latency >= 1 AND k % 4 <> 0")
def lal_slow_sql(spark, sf):
    lat = fr.service_rows(spark, sf).select("event_id", "latency")
    df = G.parse_json(G.prepare(fr.json_logs(spark, sf).join(lat, "event_id")))
    k = G.field("k").try_cast("bigint")
    out = G.slow_statements(df, F.concat(F.lit("e"), F.col("event_id").cast("string")), F.when(k % 4 != 0, F.concat(F.lit("q"), G.field("k"))), F.col("latency"))
    return out.select("id", "statement", "latency", "entity_id", "time_bucket")


@query("topk_sampled_trace", f"{V} SELECT 'p' || (user_id % 5) || '-p' || (user_id % 7) AS entity_id, CASE k % 10 WHEN 0 THEN 'STATUS_5XX' WHEN 1 THEN 'STATUS_4XX' ELSE 'SLOW' END AS reason, '/' || endpoint AS uri, latency, 't' || event_id AS trace_id FROM svc WHERE k % 10 < 5 AND latency >= 0")
def topk_sampled_trace(spark, sf):
    """Rows without a reason are incomplete and dropped."""
    more = fr.service_rows(spark, sf).select("event_id", "latency", "user_id")
    df = G.parse_json(G.prepare(fr.json_logs(spark, sf).join(more, "event_id")))
    d = G.field("k").try_cast("bigint") % 10
    reason = F.when(d == 0, "STATUS_5XX").when(d == 1, "STATUS_4XX").when(d < 5, "SLOW")
    proc = lambda n: F.concat(F.lit("p"), (F.col("user_id") % n).cast("string"))
    out = G.sampled_traces(df, reason, F.concat(F.lit("/"), F.col("tags")["kind"]), F.col("latency"), proc(5), proc(7), F.lit("3"), F.lit("client"))
    return out.select("entity_id", "reason", "uri", "latency", "trace_id")


@query("st_rate_limit", f"{W}, r AS (SELECT doc_id, row_number() OVER (PARTITION BY endpoint, ts // 60000 ORDER BY ts, doc_id) AS rn FROM logs) SELECT doc_id FROM r WHERE rn <= 3")
def st_rate_limit(spark, sf):
    return G.rate_limit(fr.logs(spark, sf), F.col("endpoint"), 3, ("ts", "doc_id")).select("doc_id")


@query("st_possibility", f"{W} SELECT doc_id FROM logs WHERE ('0x' || substr(md5('0|' || doc_id), 1, 8))::UBIGINT % 100 < 30")
def st_possibility(spark, sf):
    return G.possibility(fr.logs(spark, sf), 30, ["doc_id"]).select("doc_id")


@query("ext_lal", f"{W} SELECT level, CAST(count(*) AS BIGINT) AS n FROM logs GROUP BY 1")
def ext_lal(spark, sf):
    G.register_builder("by_level", lambda df: df.groupBy(F.col("tags")["level"].alias("level")).agg(F.count(F.lit(1)).alias("n")))
    return G.BUILDERS["by_level"](fr.logs(spark, sf))


# ---- searching ----

def _records(spark, sf):
    return G.sink(G.prepare(fr.logs(spark, sf)), searchable=("level", "lang"))["records"].withColumn("doc_id", F.expr("(ts - 1704067200000) div 1000"))


@query("log_filter", f"{W} SELECT doc_id FROM logs WHERE service = 'src3' AND instance = 'i_1' AND level = 'INFO' AND lang = 'en'")
def log_filter(spark, sf):
    return G.search(_records(spark, sf), service="src3", instance="i_1", tags=["level=INFO", "lang=en"]).select("doc_id")


@query("log_keyword", f"{W} SELECT doc_id FROM logs WHERE contains(lower(body), 'the ') AND contains(lower(body), 'and') AND NOT contains(lower(body), 'er o')")
def log_keyword(spark, sf):
    return G.search(_records(spark, sf), include=["The ", "and"], exclude=["er o"]).select("doc_id")


@query("log_stream_sel", f"{W} SELECT doc_id FROM logs WHERE service = 'src5' AND lang = 'fr'")
def log_stream_sel(spark, sf):
    """Blank and star select everything; unknown names are tags."""
    return G.select_stream(_records(spark, sf), service="src5", service_instance="*", endpoint="", lang="fr").select("doc_id")


@query("join_tags_log", f"{W} SELECT doc_id FROM logs WHERE level = 'ERROR' AND lang = 'de'")
def join_tags_log(spark, sf):
    from ..operators import traces as T

    r = _records(spark, sf)
    tags = r.select("segment_id", F.explode("tags").alias("tag"))
    return T.by_tag_table(r, tags, ["level=ERROR", "lang=de"]).select("doc_id")


@query("q_logs", f"{W} SELECT doc_id, ts FROM logs WHERE lang = 'en' ORDER BY ts DESC LIMIT 15 OFFSET 15")
def q_logs(spark, sf):
    r = G.search(_records(spark, sf), tags=["lang=en"])
    return topk.page(r, [F.col("ts").desc()], 15, 2).select("doc_id", "ts")


@query("q_logql_range", f"{W}, p AS (SELECT * FROM logs WHERE contains(lower(body), 'the') ORDER BY ts DESC LIMIT 50) SELECT service, instance, endpoint, trace_id, CAST(count(*) AS INTEGER) AS lines, min(ts) AS first FROM p GROUP BY 1, 2, 3, 4")
def q_logql_range(spark, sf):
    page = topk.page(G.select_stream(_records(spark, sf), include=["the"]), [F.col("ts").desc()], 50)
    return G.streams(page).select("service", "instance", "endpoint", "trace_id", F.size("values").alias("lines"), F.col("values")[0]["ts"].alias("first"))


@query("q_logql_labels", f"{W} SELECT DISTINCT 'lang' AS label, lang AS value FROM logs UNION SELECT DISTINCT 'level', level FROM logs")
def q_logql_labels(spark, sf):
    from ..operators import metadata

    tags = metadata.tag_dictionary(_records(spark, sf).withColumn("time_bucket", F.expr("time_bucket div 100")), "LOG")
    out = None
    for label in ("lang", "level"):
        part = G.label_values(tags, label).select(F.lit(label).alias("label"), "value")
        out = part if out is None else out.unionByName(part)
    return out


# ---- names and texts ----

_PATH = "regexp_extract(url, '^(?:[a-z]+://[^/?#]*)?(/[^?#]*)', 1)"
_PAGES = f"pg AS (SELECT page_id, regexp_extract(url, 'example[.]([a-z]+)', 1) AS service, {_PATH} AS endpoint, page_id AS ts FROM pages)"
DOMAINS = ("com", "net", "org")
PATTERNS = [[(d, p) for d in DOMAINS] for p in ("/de/{var}", "/en/{var}", "/fr/{var}", "/en/{var}/detail")]


def _pages(spark, sf):
    p = fr.table(spark, sf, "pages")
    return p.select("page_id", F.regexp_extract("url", r"example\.([a-z]+)", 1).alias("service"), text.uri_path(F.col("url")).alias("endpoint"), F.col("page_id").alias("ts"))


@query("fn_uri_pattern", f"WITH {_PAGES}, t AS (SELECT *, string_split(regexp_replace(regexp_replace(endpoint, '^/', ''), '/$', ''), '/') AS parts FROM pg) SELECT page_id, len(parts) = 1 OR (len(parts) = 2 AND parts[1] IN ('de', 'en', 'fr')) AS matched, CASE WHEN len(parts) = 2 AND parts[1] IN ('de', 'en', 'fr') THEN '/' || parts[1] || '/{{var}}' ELSE endpoint END AS formatted FROM t".replace("{{var}}", "{var}"))
def fn_uri_pattern(spark, sf):
    return naming.match_patterns(_pages(spark, sf), sum(PATTERNS, [])).select("page_id", "matched", "formatted")


RULES = [(d, *r) for d in DOMAINS for r in ((r"/[a-z]+/\d+\.html", "/page"), (r"/de/\d+", "/german"))] + [("other", r".*", "/none")]


@query("join_uri_rule", f"""WITH {_PAGES} SELECT page_id, CASE WHEN regexp_full_match(endpoint, '/[a-z]+/\\d+\\.html') THEN '/page' WHEN regexp_full_match(endpoint, '/de/\\d+') THEN '/german'
WHEN regexp_full_match(endpoint, '/(en|fr)/[^/]*/?') THEN regexp_extract(endpoint, '^(/[a-z]+/)', 1) || '{{var}}' ELSE endpoint END AS formatted FROM pg""".replace("{{var}}", "{var}"))
def join_uri_rule(spark, sf):
    """Custom rules before path patterns."""
    return naming.group_endpoints(_pages(spark, sf), custom_rules=RULES, patterns=PATTERNS[1] + PATTERNS[2]).select("page_id", "formatted")


@query("st_uri_learn", f"WITH {_PAGES} SELECT formatted, CAST(count(*) AS BIGINT) AS n FROM (SELECT CASE WHEN regexp_full_match(endpoint, '/(en|fr)/[^/]*/?') THEN regexp_extract(endpoint, '^(/[a-z]+/)', 1) || '{{var}}' ELSE endpoint END AS formatted FROM pg) GROUP BY 1".replace("{{var}}", "{var}"))
def st_uri_learn(spark, sf):
    """Patterns that a learner delivered, applied to all names."""
    return naming.match_patterns(_pages(spark, sf), PATTERNS[1] + PATTERNS[2]).groupBy("formatted").agg(F.count(F.lit(1)).alias("n"))


@query("win_first_n_uri", f"WITH {_PAGES}, s AS (SELECT service, endpoint, min(ts) AS first FROM pg WHERE NOT regexp_full_match(endpoint, '/de/[^/]*/?') GROUP BY ALL), k AS (SELECT service, endpoint FROM (SELECT *, row_number() OVER (PARTITION BY service ORDER BY first, endpoint) AS rn FROM s) WHERE rn <= 20) SELECT page_id, CASE WHEN regexp_full_match(pg.endpoint, '/de/[^/]*/?') THEN '/de/{{var}}' WHEN k.endpoint IS NULL THEN '_abandoned' ELSE pg.endpoint END AS formatted FROM pg LEFT JOIN k ON k.endpoint = pg.endpoint AND k.service = pg.service".replace("{{var}}", "{var}"))
def win_first_n_uri(spark, sf):
    return naming.group_endpoints(_pages(spark, sf), patterns=PATTERNS[0], max_unformatted=20).select("page_id", "formatted")


@query("fn_name_format", f"{W} SELECT doc_id, substr(body, 1, 70) AS service, substr(body, 1, 150) AS endpoint FROM logs")
def fn_name_format(spark, sf):
    return fr.logs(spark, sf).select("doc_id", text.service_name(F.col("body")).alias("service"), text.endpoint_name(F.col("body")).alias("endpoint"))


@query("fn_cut", f"{W} SELECT doc_id, substr(body, 1, 2000) AS statement FROM logs")
def fn_cut(spark, sf):
    return fr.logs(spark, sf).select("doc_id", text.cut(F.col("body"), text.STATEMENT_MAX).alias("statement"))


@query("fn_alarm_format", f"{V} SELECT DISTINCT 'Service ' || name || ' (' || instance || ') is slow' AS message FROM svc")
def fn_alarm_format(spark, sf):
    return fr.service_rows(spark, sf).select(text.template("Service {name} ({id}) is slow", name=F.col("name"), id=F.col("instance")).alias("message")).distinct()


@query("fn_short_name", f"{V} SELECT DISTINCT endpoint || '::' || name || '::x' AS full_name, endpoint AS grp, name || '::x' AS short, '' AS no_grp, name AS plain FROM svc")
def fn_short_name(spark, sf):
    s = fr.service_rows(spark, sf).select(F.concat_ws("::", "endpoint", "name", F.lit("x")).alias("full_name"), "name").distinct()
    return s.select("full_name", text.group_of(F.col("full_name")).alias("grp"), text.short_name(F.col("full_name")).alias("short"),
                    text.group_of(F.col("name")).alias("no_grp"), text.short_name(F.col("name")).alias("plain"))


_B = "base64(encode({}))"


@query("fn_entity_ids", f"""{V} SELECT DISTINCT {_B.format('name')} || '.1' AS service, {_B.format('name')} || '.0_' || {_B.format('instance')} AS instance, sha256(endpoint || '_' || {_B.format('name')} || '.0_' || {_B.format('instance')}) AS process,
{_B.format('name')} || '.1-' || {_B.format('endpoint')} || '-' || {_B.format('name')} || '.1-' || {_B.format('instance')} AS relation, name AS back_service, instance AS back_instance, endpoint AS back_source, {_B.format("'_blank'")} || '.1' AS blank FROM svc""")
def fn_entity_ids(spark, sf):
    from ..functions import ids as I

    s = fr.service_rows(spark, sf).select("name", "instance", "endpoint").distinct()
    sid, vid = I.service_id(F.col("name")), I.service_id(F.col("name"), False)
    iid = I.instance_id(vid, F.col("instance"))
    rel = I.endpoint_relation_id(sid, F.col("endpoint"), sid, F.col("instance"))
    return s.select(sid.alias("service"), iid.alias("instance"), I.process_id(iid, F.col("endpoint")).alias("process"), rel.alias("relation"),
                    I.parse_service(sid)["name"].alias("back_service"), I.parse_part(iid)["name"].alias("back_instance"),
                    I.parse_endpoint_relation(rel)["source"].alias("back_source"), I.service_id(F.lit("  ")).alias("blank"))


@query("fn_json_props", f"""{V} SELECT event_id, '{{"k":"' || k || '","kind":"' || endpoint || '","old":"1"}}' AS props FROM svc""")
def fn_json_props(spark, sf):
    s = fr.service_rows(spark, sf)
    new = F.to_json(F.create_map(F.lit("k"), F.col("k").cast("string"), F.lit("kind"), F.col("endpoint")))
    return s.select("event_id", text.json_props_merge(F.lit('{"old":"1","k":"0"}'), new).alias("props"))


@query("fn_json_events", f"""{V} SELECT event_id, '{{"endpoint":"' || endpoint || '"}}' AS parameters FROM svc""")
def fn_json_events(spark, sf):
    return fr.service_rows(spark, sf).select("event_id", text.json_object(endpoint=F.col("endpoint")).alias("parameters"))
