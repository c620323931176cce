"""Queries on meter samples, counters, meter functions and alarms."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import closures as C
from ..functions import labels as L
from ..functions.arith import to_metric_long
from ..operators import aggregates as A
from ..operators import alarms, counters
from ..operators import samples as M
from . import frames as fr
from .q_rules import percentile_sql
from .registry import query

W = f"WITH {fr.SAMPLES}"
V = f"WITH {fr.SVC}"
G = "entity_id, time_bucket"
AT = ("scrape",)
_LBL = "'{inst=' || inst || ',svc=' || svc || '}' AS labels"
_COLS = f"name, {_LBL}, ts, value, seq"


def _out(df, *cols):
    return df.withColumn("labels", L.encode(F.col("labels"))).select(*(cols or ("name", "labels", "ts", "value", "seq")))


# ---- filters and labels ----

@query("mal_tag_equal", f"{W} SELECT {_COLS} FROM samples WHERE svc = 'svc_3' AND inst = 'i_3'")
def mal_tag_equal(spark, sf):
    return _out(M.tag_filter(fr.samples(spark, sf), "equal", svc="svc_3", inst="i_3"))


@query("mal_tag_not_equal", f"{W} SELECT {_COLS} FROM samples WHERE svc <> 'svc_3'")
def mal_tag_not_equal(spark, sf):
    """The label ``zone`` is missing everywhere and compares as empty text."""
    return _out(M.tag_filter(fr.samples(spark, sf), "not_equal", svc="svc_3", zone="x"))


@query("mal_tag_match", f"{W} SELECT {_COLS} FROM samples WHERE regexp_full_match(svc, 'svc_[1-3]')")
def mal_tag_match(spark, sf):
    return _out(M.tag_filter(fr.samples(spark, sf), "match", svc="svc_[1-3]", zone=""))


@query("mal_tag_not_match", f"{W} SELECT {_COLS} FROM samples WHERE NOT regexp_full_match(inst, 'i_1.')")
def mal_tag_not_match(spark, sf):
    return _out(M.tag_filter(fr.samples(spark, sf), "not_match", inst="i_1."))


@query("mal_value_cmp", f"{W} SELECT {_COLS} FROM samples WHERE value >= 500 AND value <> 700 AND value < 900")
def mal_value_cmp(spark, sf):
    s = fr.samples(spark, sf)
    return _out(M.value_filter(M.value_filter(M.value_filter(s, ">=", 500), "!=", 700), "<", 900))


@query("mal_filter", f"{W} SELECT {_COLS} FROM samples WHERE svc IN ('svc_1', 'svc_2') AND contains(inst, '2')")
def mal_filter(spark, sf):
    cond = lambda t: C.is_in(C.tag("svc"), ["svc_1", "svc_2"])(t) & C.contains(C.tag("inst"), "2")(t)
    return _out(M.where(fr.samples(spark, sf), cond))


@query("mal_tag", f"{W} SELECT name, '{{host=h-' || substr(inst, 3) || ',svc=' || CASE WHEN svc = 'svc_1' THEN 'one' ELSE svc END || '}}' AS labels, ts, value, seq FROM samples")
def mal_tag(spark, sf):
    rewrite = lambda t: C.removed("inst")(C.assign(host=C.joined("-", "h", C.split_at(C.tag("inst"), "_", 1)),
                                                  svc=C.ternary(C.matches(C.tag("svc"), "svc_1"), "one", C.tag("svc")))(t))
    return _out(M.tag(fr.samples(spark, sf), rewrite))


@query("mal_foreach", f"{W} SELECT name, '{{a_svc=' || svc || '!,b_svc=' || svc || '!!,inst=' || inst || ',svc=' || svc || '!!}}' AS labels, ts, value, seq FROM samples")
def mal_foreach(spark, sf):
    """Each element sees the labels that the one before has left."""
    def each(e, labels):
        marked = F.concat(L.get(labels, "svc"), F.lit("!"))
        return L.put(L.put(labels, "svc", marked), f"{e}_svc", marked)
    return _out(M.for_each(fr.samples(spark, sf), ["a", "b"], each))


@query("fn_closure", f"{W} SELECT seq, substr(svc, 5) AS num, regexp_full_match(svc, 'svc_[0-4]') AS low, CAST(instr(svc, '_') - 1 AS INTEGER) AS at, replace(inst, 'i_', 'x') AS renamed, svc AS fallback FROM samples")
def fn_closure(spark, sf):
    t = F.col("labels")
    return fr.samples(spark, sf).select(
        "seq", C.group(C.tag("svc"), r"svc_(\d)")(t).alias("num"), C.matches(C.tag("svc"), "svc_[0-4]")(t).alias("low"),
        C.index_of(C.tag("svc"), "_")(t).cast("int").alias("at"), C.replaced(C.tag("inst"), "i_", "x")(t).alias("renamed"),
        C.elvis(C.tag("missing"), C.tag("svc"))(t).alias("fallback"))


@query("mal_scope", f"""{W} SELECT seq, base64(encode(svc || '#' || inst)) || '.1' AS entity_id, svc || '#' || inst AS service, '{{}}' AS labels FROM samples
UNION ALL SELECT seq, base64(encode(svc)) || '.1_' || base64(encode(inst)), svc, '{{}}' FROM samples""")
def mal_scope(spark, sf):
    s = fr.samples(spark, sf)
    a = M.bind_service(s, ["svc", "zone", "inst"], "GENERAL", "#")
    b = M.bind_instance(s, ["svc"], ["inst"], "GENERAL")
    cols = ("seq", "entity_id", "service", "labels")
    return _out(a, *cols).unionByName(_out(b, *cols))


@query("mal_scope_relation", f"""{W} SELECT seq, base64(encode(svc)) || '.1-' || base64(encode(inst)) || '.1' AS entity_id, 'SERVER' AS detect_point, '{{}}' AS labels FROM samples
UNION ALL SELECT seq, base64(encode(svc)) || '.1_' || base64(encode(inst)), 'endpoint', '{{}}' FROM samples""")
def mal_scope_relation(spark, sf):
    s = fr.samples(spark, sf)
    rel = _out(M.bind_service_relation(s, "SERVER", ["svc"], ["inst"], "GENERAL"), "seq", "entity_id", "detect_point", "labels")
    ep = _out(M.bind_endpoint(s, ["svc"], ["inst"], "GENERAL").withColumn("detect_point", F.col("scope")), "seq", "entity_id", "detect_point", "labels")
    return rel.unionByName(ep)


@query("mal_decorate", f"{W} SELECT seq, upper(svc) AS attr0 FROM samples")
def mal_decorate(spark, sf):
    return M.decorate(M.bind_service(fr.samples(spark, sf), ["svc"], "GENERAL"), attr0=lambda df: F.upper("service")).select("seq", "attr0")


@query("mal_round_emit", f"{W} SELECT seq, CAST(CASE WHEN value / 300 - 0.1 <= 0 THEN 0 WHEN value / 300 - 0.1 < 1 THEN 1 ELSE floor(value / 300 - 0.1 + 0.5) END AS BIGINT) AS v FROM samples")
def mal_round_emit(spark, sf):
    return fr.samples(spark, sf).select("seq", to_metric_long(F.col("value") / 300.0 - F.lit(0.1)).alias("v"))


@query("join_k8s_retag", f"""{W}, pods AS (SELECT 'ns' AS ns, 'i_' || n_nationkey AS pod, 'pod_' || n_name AS service FROM nation)
SELECT seq, '{{inst=' || inst || ',ns=ns,service=' || coalesce(service, '') || ',svc=' || svc || '}}' AS labels FROM samples LEFT JOIN pods ON inst = pod""")
def join_k8s_retag(spark, sf):
    n = fr.table(spark, sf, "nation")
    pods = n.select(F.lit("ns").alias("namespace"), F.concat(F.lit("i_"), F.col("n_nationkey").cast("string")).alias("pod"), F.concat(F.lit("pod_"), "n_name").alias("service"))
    s = fr.samples(spark, sf).withColumn("labels", L.put(F.col("labels"), "ns", F.lit("ns")))
    return _out(M.retag_by_pod(s, "service", "inst", "ns", pods), "seq", "labels")


# ---- arithmetic ----

@query("mal_arith", f"""{W} SELECT seq, 1000 - (value * 2 + 5) / 4 AS a, CASE WHEN value = 0 THEN 'NaN'::DOUBLE ELSE 'Infinity'::DOUBLE END AS b, 0.0::DOUBLE AS c, -value AS d FROM samples""")
def mal_arith(spark, sf):
    s = fr.samples(spark, sf)
    a = M.scalar(M.scalar(M.scalar(M.scalar(s, "*", 2), "+", 5), "/", 4), "-", 1000, number_left=True)
    cols = [x.select("seq", F.col("value").alias(n)) for x, n in ((a, "a"), (M.scalar(s, "/", 0), "b"), (M.scalar(s, "safe_div", 0), "c"), (M.negative(s), "d"))]
    out = cols[0]
    for c in cols[1:]:
        out = out.join(c, "seq")
    return out


_PAIR = """c AS (SELECT * FROM samples WHERE name = 'click'), v AS (SELECT scrape, svc, inst, arg_min(value, seq) AS value FROM samples WHERE name = 'view' GROUP BY ALL),
matched AS (SELECT c.*, v.value AS other FROM c JOIN v ON c.scrape = v.scrape AND c.svc = v.svc AND c.inst = v.inst)"""


def _pair(spark, sf):
    s = fr.samples(spark, sf).drop("time_bucket")
    return M.family(s, "click"), M.family(s, "view")


@query("join_sample_binary", f"{W}, {_PAIR} SELECT seq, scrape, value * other AS value FROM matched")
def join_sample_binary(spark, sf):
    c, v = _pair(spark, sf)
    return M.binary(c, "*", v, AT).select("seq", "scrape", "value")


@query("join_sample_empty", f"""{W}, {_PAIR}, vs AS (SELECT DISTINCT scrape FROM samples WHERE name = 'view'), cs AS (SELECT DISTINCT scrape FROM c)
SELECT 'minus' AS op, name, seq, value - other AS value FROM matched
UNION ALL SELECT 'minus', name, seq, value FROM c WHERE scrape NOT IN (SELECT scrape FROM vs)
UNION ALL SELECT 'minus', name, seq, -value FROM samples WHERE name = 'view' AND scrape NOT IN (SELECT scrape FROM cs)
UNION ALL SELECT 'div', name, seq, CASE WHEN other = 0 THEN CASE WHEN value = 0 THEN 'NaN'::DOUBLE ELSE 'Infinity'::DOUBLE END ELSE value / other END FROM matched
UNION ALL SELECT 'div', name, seq, CASE WHEN value = 0 THEN 'NaN'::DOUBLE ELSE 'Infinity'::DOUBLE END FROM c WHERE scrape NOT IN (SELECT scrape FROM vs)
UNION ALL SELECT 'safe', name, seq, CASE WHEN other = 0 THEN 0 ELSE value / other END FROM matched""")
def join_sample_empty(spark, sf):
    c, v = _pair(spark, sf)
    part = lambda op, tag: M.binary(c, op, v, AT).select(F.lit(tag).alias("op"), "name", "seq", "value")
    return part("-", "minus").unionByName(part("/", "div")).unionByName(part("safe_div", "safe"))


# ---- aggregation ----

def _mal(name, fn, sql):
    @query(name, f"{W} SELECT name, scrape, '{{}}' AS labels, {sql} AS value FROM samples GROUP BY name, scrape UNION ALL SELECT name, scrape, '{{svc=' || svc || ',zone=}}', {sql} FROM samples GROUP BY name, scrape, svc")
    def run(spark, sf):
        s = fr.samples(spark, sf)
        both = M.aggregate(s, fn, at=AT).unionByName(M.aggregate(s, fn, ["svc", "zone"], AT))
        return _out(both, "name", "scrape", "labels", "value")


_mal("mal_sum", "sum", "sum(value)")
_mal("mal_max", "max", "max(value)")
_mal("mal_min", "min", "min(value)")
_mal("mal_avg", "avg", "sum(value) / count(*)")


@query("mal_count", f"""{W} SELECT 'rows' AS how, name, scrape, '{{}}' AS labels, CAST(count(*) AS DOUBLE) AS value FROM samples GROUP BY name, scrape
UNION ALL SELECT 'one', name, scrape, '{{}}', CAST(count(DISTINCT inst) AS DOUBLE) FROM samples GROUP BY name, scrape
UNION ALL SELECT 'two', name, scrape, '{{svc=' || svc || '}}', CAST(count(DISTINCT inst) AS DOUBLE) FROM samples GROUP BY name, scrape, svc""")
def mal_count(spark, sf):
    s = fr.samples(spark, sf)
    part = lambda how, df: _out(df, "name", "scrape", "labels", "value").select(F.lit(how).alias("how"), "*")
    return part("rows", M.count(s, at=AT)).unionByName(part("one", M.count(s, ["inst"], AT))).unionByName(part("two", M.count(s, ["svc", "inst"], AT)))


def _histogram(spark, sf):
    """Histogram samples: per service, event type and hour the number of calls per second-bounded bucket."""
    s = fr.service_rows(spark, sf)
    le = F.least(F.expr("latency div 200"), F.lit(5).cast("bigint")) * 200
    counts = s.groupBy("name", "endpoint", "time_bucket", (F.floor(F.col("ms") / 3_600_000) * 3_600_000).cast("bigint").alias("ts"), le.alias("le")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    return counts.select(F.lit("calls").alias("name"), "ts", "time_bucket", "value",
                         F.create_map(F.lit("svc"), F.col("name"), F.lit("type"), F.col("endpoint"), F.lit("le"), (F.col("le") / 1000.0).cast("string")).alias("labels"))


_HIST = "h AS (SELECT name AS svc, endpoint AS type, time_bucket, (ms // 3600000) * 3600000 AS ts, least(latency // 200, 5) * 200 AS le, CAST(count(*) AS BIGINT) AS n FROM svc GROUP BY ALL)"


@query("mal_histogram", f"{V}, {_HIST} SELECT ts, '{{le=' || le || ',svc=' || svc || ',type=' || type || '}}' AS labels, CAST(n AS DOUBLE) AS value FROM h")
def mal_histogram(spark, sf):
    return _out(M.histogram(_histogram(spark, sf), "le", "s"), "ts", "labels", "value")


def _buckets(spark, sf):
    bound = M.bind_service(M.histogram(_histogram(spark, sf)), ["svc"], "GENERAL")
    return M.to_bucket_rows(bound, "day").withColumn("entity_id", F.col("entity_id"))


_ENT = "base64(encode(svc)) || '.1' AS entity_id, time_bucket // 100 AS time_bucket, '{type=' || type || '}' AS label"


@query("mal_hist_pct", f"{V}, {_HIST}, d AS (SELECT {_ENT}, le, n FROM h), {percentile_sql('d', 'entity_id, time_bucket, label', 'le', (50, 90, 99), 1, n='sum(n)')}")
def mal_hist_pct(spark, sf):
    return M.meter(_buckets(spark, sf), "SUM", ranks=(50, 90, 99))


@query("mal_downsampling", f"""{V}, s AS (SELECT entity_id, time_bucket, latency, ms FROM svc)
SELECT 'SUM_PER_MIN' AS how, {G}, CAST(sum(latency) // 60 AS BIGINT) AS value FROM s GROUP BY {G} UNION ALL SELECT 'LATEST', {G}, CAST(max((ms, latency))[2] AS BIGINT) FROM s GROUP BY {G}""")
def mal_downsampling(spark, sf):
    rows = _meter_rows(spark, sf)
    return (M.meter(rows, "SUM_PER_MIN").select(F.lit("SUM_PER_MIN").alias("how"), "*")
            .unionByName(M.meter(rows, "LATEST").select(F.lit("LATEST").alias("how"), "*")))


@query("fn_labels_to_table", f"""{W}, b AS (SELECT 'svc' AS x, svc, ts, '{{name=' || name || '}}' AS label, seq, value FROM samples)
SELECT base64(encode(svc)) || '.1' AS entity_id, ts // 3600000 AS hour, label, CAST(arg_max(CASE WHEN value <= 0 THEN 0 WHEN value < 1 THEN 1 ELSE floor(value + 0.5) END, seq) AS BIGINT) AS value FROM b GROUP BY ALL""")
def fn_labels_to_table(spark, sf):
    s = fr.samples(spark, sf).drop("time_bucket").withColumn("labels", F.create_map(F.lit("svc"), F.col("labels")["svc"], F.lit("name"), F.col("name")))
    bound = M.bind_service(s.withColumn("hour", F.expr("ts div 3600000")), ["svc"], "GENERAL").withColumn("ts", F.col("hour") * 3600000)
    return M.labels_to_table(bound, ("hour",)).select("entity_id", "hour", "label", "value")


# ---- meter functions ----

def _meter_rows(spark, sf):
    s = fr.service_rows(spark, sf)
    return s.select("entity_id", "time_bucket", F.col("ms").alias("ts"), F.col("latency").alias("metric_value"), F.col("endpoint").alias("label"))


_FLOOR1 = "CAST(CASE WHEN sum({v}) // count(*) = 0 AND sum({v}) > 0 THEN 1 ELSE sum({v}) // count(*) END AS BIGINT)"


def _meter(name, fn, sql, labeled=False):
    keys = f"{G}, label" if labeled else G
    src = "(SELECT entity_id, time_bucket, ms, latency AS v, endpoint AS label FROM svc)"

    @query(name, f"{V} SELECT {keys}, {sql} AS value FROM {src} GROUP BY {keys}")
    def run(spark, sf):
        args = {"ts": F.col("ts"), "label": F.col("label")}
        return A.aggregate(_meter_rows(spark, sf), fn, F.col("metric_value"), args)


for _fn, _sql in (("avg", _FLOOR1.format(v="v")), ("sum", "CAST(sum(v) AS BIGINT)"), ("sum_per_min", "CAST(sum(v) // 60 AS BIGINT)"),
                  ("max", "greatest(max(v), 0)"), ("min", "min(v)"), ("latest", "CAST(max((ms, v))[2] AS BIGINT)")):
    _meter(f"mtr_{_fn}", f"meter_{_fn}", _sql)
    _meter(f"mtr_{_fn}_labeled", f"meter_{_fn}_labeled", "max(v)" if _fn == "max" else _sql, labeled=True)

_MH = f"{V}, {_HIST}, d AS (SELECT {_ENT}, le, n FROM h)"
_KEYS = "entity_id, time_bucket, label"


@query("mtr_sum_hist", f"{_MH} SELECT {_KEYS}, le, CAST(sum(n) AS BIGINT) AS value FROM d GROUP BY {_KEYS}, le")
def mtr_sum_hist(spark, sf):
    return M.meter(_buckets(spark, sf), "SUM", histogram=True)


@query("mtr_avg_hist", f"{_MH} SELECT {_KEYS}, le, {_FLOOR1.format(v='n')} AS value FROM d GROUP BY {_KEYS}, le")
def mtr_avg_hist(spark, sf):
    return M.meter(_buckets(spark, sf), "AVG", histogram=True)


@query("mtr_sum_hist_pct", f"{_MH}, {percentile_sql('d', _KEYS, 'le', (50, 75, 95), 1, n='sum(n)')}")
def mtr_sum_hist_pct(spark, sf):
    return M.meter(_buckets(spark, sf), "SUM", ranks=(50, 75, 95))


@query("mtr_avg_hist_pct", f"{_MH}, a AS (SELECT {_KEYS}, le, {_FLOOR1.format(v='n')} AS n FROM d GROUP BY {_KEYS}, le), {percentile_sql('a', _KEYS, 'le', (50, 75, 95), 1, n='sum(n)')}")
def mtr_avg_hist_pct(spark, sf):
    return M.meter(_buckets(spark, sf), "AVG", ranks=(50, 75, 95))


@query("mtr_hist_incompatible", f"""{_MH}, r AS (SELECT entity_id, time_bucket, h2.ts AS report, list(DISTINCT h2.le ORDER BY h2.le) AS les FROM (SELECT {_ENT}, ts, le FROM h) h2 GROUP BY entity_id, time_bucket, h2.ts)
SELECT entity_id, time_bucket FROM r GROUP BY ALL HAVING count(DISTINCT les) > 1""")
def mtr_hist_incompatible(spark, sf):
    """Groups whose reports disagree on their buckets, which must not be merged."""
    return A.incompatible_buckets(_buckets(spark, sf).withColumn("report", F.col("ts")))


@query("ext_meter_fn", f"{V} SELECT {G}, CAST(count(*) FILTER (latency > 500) AS BIGINT) AS value FROM svc GROUP BY {G}")
def ext_meter_fn(spark, sf):
    if "meter_over_500" not in A.REGISTRY:
        A.register(A.AggregateFn("meter_over_500", lambda v, a: {"n": ((v > 500).cast("bigint"), "sum")}, lambda s, m, a: s["n"]))
    return A.aggregate(_meter_rows(spark, sf), "meter_over_500", F.col("metric_value"))


@query("ext_mal", f"{W} SELECT seq, value + 1 AS value FROM samples WHERE name = 'click'")
def ext_mal(spark, sf):
    M.register_extension("demo", "plus", lambda df, n: M.scalar(df, "+", n))
    return M.call(M.family(fr.samples(spark, sf), "click"), "demo::plus", 1).select("seq", "value")


# ---- counters ----

WINDOW_MS = 6 * 3600 * 1000
_LOOK = f"""cw AS (SELECT name, svc, ts, value, seq, lag(ts) OVER (PARTITION BY name, svc ORDER BY ts) AS prev FROM samples),
j AS (SELECT a.name, a.svc, a.ts, a.value, a.seq, max((b.ts, b.value)) FILTER (b.ts < a.ts - {WINDOW_MS} AND b.ts >= a.prev - {WINDOW_MS}) AS old, min((b.ts, b.value)) FILTER (b.ts >= a.ts - {WINDOW_MS}) AS new
  FROM cw a JOIN cw b ON a.name = b.name AND a.svc = b.svc AND b.ts <= a.ts GROUP BY ALL),
low AS (SELECT *, CASE WHEN old IS NOT NULL AND ts - {WINDOW_MS} - old[1] <= new[1] - (ts - {WINDOW_MS}) THEN old ELSE new END AS l FROM j)"""


def _series(spark, sf):
    return fr.samples(spark, sf).withColumn("labels", F.create_map(F.lit("svc"), F.col("labels")["svc"])).select("name", "labels", "ts", "value", "seq")


@query("win_mal_increase", f"{W}, {_LOOK} SELECT seq, value - l[2] AS value FROM low")
def win_mal_increase(spark, sf):
    return counters.increase(_series(spark, sf), "PT6H").select("seq", "value")


@query("win_mal_rate", f"{W}, {_LOOK} SELECT seq, CASE WHEN (ts - l[1]) // 1000 < 1 THEN 0 ELSE (value - l[2]) / ((ts - l[1]) // 1000) END AS value FROM low")
def win_mal_rate(spark, sf):
    return counters.rate(_series(spark, sf), "PT6H").select("seq", "value")


@query("join_counter_lookback", f"{W}, {_LOOK} SELECT seq, l[1] AS low_ts, l[2] AS low_value FROM low")
def join_counter_lookback(spark, sf):
    return counters.look_back(_series(spark, sf), WINDOW_MS).select("seq", "low_ts", "low_value")


@query("win_mal_irate", f"""{W}, p AS (SELECT seq, ts, value, lag(ts) OVER w AS pt, lag(value) OVER w AS pv FROM samples WINDOW w AS (PARTITION BY name, svc ORDER BY ts))
SELECT seq, CASE WHEN pt IS NULL OR (ts - pt) // 1000 < 1 THEN 0 ELSE (value - pv) / ((ts - pt) // 1000) END AS value FROM p""")
def win_mal_irate(spark, sf):
    return counters.irate(_series(spark, sf)).select("seq", "value")


@query("st_counter", f"{W}, p AS (SELECT seq, ts, value, lag(ts, 1, ts) OVER w AS low_ts, lag(value, 1, value) OVER w AS low_value FROM samples WINDOW w AS (PARTITION BY name, svc ORDER BY ts)) SELECT seq, low_ts, low_value FROM p")
def st_counter(spark, sf):
    return counters.previous(_series(spark, sf)).select("seq", "low_ts", "low_value")


# ---- alarms ----

# Hours stand for minutes here, because the tables hold about one event per hour and service: hour h of the month
# becomes minute h, and the window of 6 hours one of 6 minutes.
RULE = alarms.AlarmRule(
    name="service_slow", aggregates=lambda: {"hits": F.sum((F.col("resp_time") > 600).cast("bigint")), "points": F.count("resp_time")},
    condition=lambda: F.col("hits") >= 2, period=6, silence=3, recovery=2, message="{name} of {id} is slow", scope="Service", tags=("level=WARN",))


def _minutes(spark, sf):
    s = fr.service_rows(spark, sf)
    hour = F.expr("(ms - 1704067200000) div 3600000")
    rows = s.groupBy("entity_id", hour.alias("h")).agg((F.sum("latency") / F.count(F.lit(1))).cast("bigint").alias("resp_time"))
    return rows.select("entity_id", F.timestamp_seconds(F.col("h") * 60).alias("minute"), "resp_time")


_MIN = "m AS (SELECT entity_id, (ms - 1704067200000) // 3600000 AS h, CAST(sum(latency) // count(*) AS BIGINT) AS resp_time FROM svc GROUP BY ALL)"
_TICK = f"{_MIN}, t AS (SELECT entity_id, h + d AS h, sum(CASE WHEN resp_time > 600 THEN 1 ELSE 0 END) >= 2 AS match FROM m, range(0, 6) r(d) GROUP BY ALL)"
# the machine, one tick after another, as a recursion over numbered ticks
_MACHINE = f"""{_TICK.replace('m AS', 'm AS', 1)}, n AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY h) AS i, lag(h) OVER (PARTITION BY entity_id ORDER BY h) AS ph FROM t),
s AS (
  SELECT entity_id, i, h, match, CASE WHEN match THEN 'FIRING' ELSE 'NORMAL' END AS state, CASE WHEN match THEN 3 ELSE -2 END AS sil, CASE WHEN match THEN 2 ELSE 1 END AS rec FROM n WHERE i = 1
  UNION ALL
  SELECT q.entity_id, q.i, q.h, q.match, q.nxt,
    CASE WHEN q.nxt = 'FIRING' AND q.entered THEN 3 ELSE q.sil END,
    CASE WHEN NOT q.entered THEN q.rec WHEN q.nxt = 'FIRING' THEN 2 WHEN q.nxt = 'OBSERVING_RECOVERY' THEN 1 WHEN q.nxt IN ('RECOVERED', 'NORMAL') THEN 2 ELSE q.rec END
  FROM (SELECT *, CASE
      WHEN match AND st = 'NORMAL' THEN 'FIRING' WHEN match AND st = 'FIRING' THEN CASE WHEN sil >= 0 THEN 'SILENCED_FIRING' ELSE 'FIRING' END
      WHEN match THEN CASE WHEN sil < 0 THEN 'FIRING' ELSE 'SILENCED_FIRING' END
      WHEN st IN ('FIRING', 'SILENCED_FIRING') THEN CASE WHEN rec < 0 AND sil < 0 THEN 'RECOVERED' ELSE 'OBSERVING_RECOVERY' END
      WHEN st = 'OBSERVING_RECOVERY' THEN CASE WHEN rec < 0 AND sil < 0 THEN 'RECOVERED' ELSE 'OBSERVING_RECOVERY' END
      ELSE 'NORMAL' END AS nxt,
      NOT ((match AND st = 'FIRING' AND sil < 0) OR (NOT match AND st = 'OBSERVING_RECOVERY' AND NOT (rec < 0 AND sil < 0)) OR (NOT match AND st = 'NORMAL')) AS entered
    FROM (SELECT n.entity_id, n.i, n.h, n.match, CASE WHEN n.h <> n.ph + 1 THEN 'NORMAL' ELSE s.state END AS st,
        CASE WHEN n.h <> n.ph + 1 THEN -1 ELSE s.sil END - 1 AS sil,
        CASE WHEN n.h <> n.ph + 1 THEN 2 ELSE s.rec END - CASE WHEN n.match THEN 0 ELSE 1 END AS rec
      FROM s JOIN n ON n.entity_id = s.entity_id AND n.i = s.i + 1)) q)"""
_REC_V = f"WITH RECURSIVE {fr.SVC}"


def _hour(c="minute"):
    return (F.unix_seconds(F.col(c).cast("timestamp")) / 60).cast("bigint").alias("h")


@query("win_alarm", f"{V}, {_TICK} SELECT entity_id, h, match FROM t")
def win_alarm(spark, sf):
    return alarms.windows(_minutes(spark, sf), RULE).select("entity_id", _hour(), "match")


@query("st_sliding", f"{V}, {_MIN} SELECT entity_id, h + d AS h, CAST(sum(resp_time) AS BIGINT) AS total FROM m, range(0, 6) r(d) GROUP BY ALL")
def st_sliding(spark, sf):
    from ..streaming.metrics import windowed

    out = windowed(_minutes(spark, sf), {"total": F.sum("resp_time")}, "minute", "6 minutes", "1 minute")
    return out.select("entity_id", _hour("end"), "total").withColumn("h", F.col("h") - 1)


@query("st_alarm_eval", f"""{V}, {_MIN}, l AS (SELECT entity_id, h, CASE WHEN resp_time % 2 = 0 THEN 'even' ELSE 'odd' END AS label, resp_time FROM m),
t AS (SELECT entity_id, label, h + d AS h, sum(CASE WHEN resp_time > 600 THEN 1 ELSE 0 END) >= 2 AS match FROM l, range(0, 6) r(d) GROUP BY ALL)
SELECT entity_id, h, bool_or(match) AS match FROM t GROUP BY 1, 2""")
def st_alarm_eval(spark, sf):
    """Labelled values: a tick matches when any label does."""
    rows = _minutes(spark, sf).withColumn("label", F.when(F.col("resp_time") % 2 == 0, "even").otherwise("odd"))
    return alarms.windows(rows, RULE, labels=("label",)).select("entity_id", _hour(), "match")


@query("st_alarm_state", f"{_REC_V}, {_MACHINE} SELECT entity_id, h, match, state FROM s")
def st_alarm_state(spark, sf):
    ticks = alarms.windows(_minutes(spark, sf), RULE)
    return alarms.states(ticks, RULE).select("entity_id", _hour(), "match", "state")


_FIRED = """x AS (SELECT *, max(h) FILTER (state = 'FIRING') OVER (PARTITION BY entity_id ORDER BY h) AS start FROM s WHERE state IN ('FIRING', 'RECOVERED')),
w AS (SELECT x.entity_id, x.start, string_agg(m.h || '=' || m.resp_time, ',' ORDER BY m.h) AS snapshot FROM (SELECT DISTINCT entity_id, start FROM x) x
  JOIN m ON m.entity_id = x.entity_id AND m.h BETWEEN x.start - 5 AND x.start GROUP BY ALL)"""


@query("st_alarm_message", f"""{_REC_V}, {_MACHINE}, {_FIRED}
SELECT x.entity_id, h, state, 'service_slow' AS rule, 'Service' AS scope, x.entity_id || ' of ' || x.entity_id || ' is slow' AS message, state = 'RECOVERED' AS recovered, 'level=WARN' AS tags, 6 AS period,
  'sum(resp_time > 600) >= 2' AS expression, 'webhook.default,slack.ops' AS hooks, 'GENERAL' AS layers, x.start, 'service_slow@' || x.entity_id || '@' || (x.start * 60) AS firing_id, snapshot
FROM x LEFT JOIN w ON w.entity_id = x.entity_id AND w.start = x.start WHERE x.entity_id <> 'svc_9'""")
def st_alarm_message(spark, sf):
    """Firing and recovery messages; a recovery names the firing it ends and shows the values that firing saw."""
    rule = alarms.AlarmRule(**{**RULE.__dict__, "exclude": ("svc_9",), "expression": "sum(resp_time > 600) >= 2", "hooks": ("webhook.default", "slack.ops"), "layers": ("GENERAL",)})
    out = alarms.evaluate(_minutes(spark, sf).withColumn("name", F.col("entity_id")), rule, name="name", values=("resp_time",))
    text = lambda c: F.array_join(c, ",").alias(c)
    seen = F.transform("snapshot", lambda x: F.concat_ws("=", (F.unix_seconds(x["minute"].cast("timestamp")) / 60).cast("bigint").cast("string"), x["resp_time"].cast("string")))
    return out.select("entity_id", _hour(), "state", "rule", "scope", "message", "recovered", text("tags"), "period", "expression", text("hooks"), text("layers"),
                      _hour("start_minute").alias("start"), "firing_id", F.array_join(seen, ",").alias("snapshot"))


@query("sink_alarm", f"{_REC_V}, {_MACHINE} SELECT CASE state WHEN 'FIRING' THEN 'firing' ELSE 'recovery' END AS kind, CAST(count(*) AS BIGINT) AS n FROM s WHERE state IN ('FIRING', 'RECOVERED') GROUP BY 1")
def sink_alarm(spark, sf):
    from ..sinks.writers import split_alarms

    parts = split_alarms(alarms.evaluate(_minutes(spark, sf), RULE))
    out = [df.groupBy(F.lit(k).alias("kind")).agg(F.count(F.lit(1)).alias("n")) for k, df in parts.items()]
    return out[0].unionByName(out[1])


@query("st_alarm_filter", f"{V} SELECT DISTINCT entity_id FROM svc WHERE entity_id IN ('svc_1', 'svc_2', 'svc_3', 'svc_4') AND entity_id <> 'svc_2' AND regexp_full_match(entity_id, 'svc_[1-8]') AND NOT regexp_full_match(entity_id, '.*4')")
def st_alarm_filter(spark, sf):
    rule = alarms.AlarmRule(**{**RULE.__dict__, "include": ("svc_1", "svc_2", "svc_3", "svc_4"), "exclude": ("svc_2",), "include_regex": "svc_[1-8]", "exclude_regex": ".*4"})
    return alarms.select_entities(fr.service_rows(spark, sf), rule).select("entity_id").distinct()


@query("st_alarm_scopes", f"""{V}, m AS (SELECT name AS e, 'Service' AS scope, (ms - 1704067200000) // 3600000 AS h, sum(latency) // count(*) AS v FROM svc GROUP BY ALL
  UNION ALL SELECT instance, 'ServiceInstance', (ms - 1704067200000) // 3600000, sum(latency) // count(*) FROM svc GROUP BY ALL
  UNION ALL SELECT endpoint, 'Endpoint', (ms - 1704067200000) // 3600000, sum(latency) // count(*) FROM svc GROUP BY ALL),
t AS (SELECT scope, e, h + d AS h, sum(CASE WHEN v > 600 THEN 1 ELSE 0 END) >= 2 AS match FROM m, range(0, 6) r(d) GROUP BY ALL)
SELECT scope, CAST(count(*) FILTER (match) AS BIGINT) AS matches FROM t GROUP BY 1""")
def st_alarm_scopes(spark, sf):
    """The same rule on services, instances and endpoints; the scope is part of the entity."""
    s = fr.service_rows(spark, sf)
    ends = F.array(*[F.struct(F.lit(sc).alias("scope"), F.col(c).alias("e")) for sc, c in (("Service", "name"), ("ServiceInstance", "instance"), ("Endpoint", "endpoint"))])
    rows = s.select(F.inline(ends), F.expr("(ms - 1704067200000) div 3600000").alias("h"), "latency").groupBy("scope", F.col("e").alias("entity_id"), "h").agg(
        F.expr("sum(latency) div count(*)").alias("resp_time"))
    minutes = rows.select("scope", "entity_id", F.timestamp_seconds(F.col("h") * 60).alias("minute"), "resp_time")
    t = alarms.windows(minutes, RULE, entity=("scope", "entity_id"))
    return t.groupBy("scope").agg(F.count_if("match").alias("matches"))


@query("st_late_alarm", f"""{V}, {_MIN}, a AS (SELECT entity_id, h, resp_time, CASE WHEN h % 50 = 0 THEN (h // 50 + 1) * 50 ELSE h END AS seen FROM m),
n AS (SELECT *, max(h) OVER (ORDER BY seen RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS newest FROM a)
SELECT entity_id, h, resp_time, h <= newest - 6 AS late FROM n""")
def st_late_alarm(spark, sf):
    """Every fiftieth hour arrives fifty hours after its turn: behind the window that then ends with the newest value, it does
    not reach the alarm and is kept apart."""
    m = _minutes(spark, sf)
    h = F.expr("unix_seconds(cast(minute as timestamp)) div 60")
    seen = F.when(h % 50 == 0, (F.call_function("div", h, F.lit(50).cast("bigint")) + 1) * 50).otherwise(h)
    fresh, late = alarms.split_late(m.withColumn("seen", seen), RULE, arrival="seen")
    both = fresh.withColumn("late", F.lit(False)).unionByName(late.withColumn("late", F.lit(True)))
    return both.select("entity_id", _hour(), "resp_time", "late")
