"""Queries on the rule functions, filters, roll-ups and top lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions.timebucket import Duration
from ..operators import aggregates as A
from ..operators import rules as R
from ..operators import topk
from ..operators.rules import Rule
from . import catalog
from . import frames as fr
from .registry import query

W = f"WITH {fr.SVC}"
G = "entity_id, time_bucket"


def _agg(name, fn, value=None, sql_value="", args=None, where=None, sql_where=""):
    """Register one rule function grouped by service and hour."""
    @query(name, f"{W} SELECT {G}, {sql_value} AS value FROM svc {sql_where} GROUP BY {G}")
    def run(spark, sf):
        rows = fr.service_rows(spark, sf)
        if where is not None:
            rows = rows.filter(where)
        return A.aggregate(rows, fn, F.col(value) if value else None, args() if args else {})


_agg("oal_count", "count", None, "CAST(count(*) AS BIGINT)")
_agg("oal_sum", "sum", "latency", "CAST(sum(latency) AS BIGINT)")
_agg("oal_long_avg", "long_avg", "latency", "CAST(sum(latency) // count(*) AS BIGINT)")
_agg("oal_double_avg", "double_avg", "latency", "CAST(sum(latency) AS DOUBLE) / count(*)")
_agg("oal_max", "max", "latency", "greatest(max(latency), 0)")
_agg("oal_max_double", "max_double", "latency", "greatest(CAST(max(latency) AS DOUBLE), 0.0::DOUBLE)")
_agg("oal_min", "min", "latency", "min(latency)")
_agg("oal_min_double", "min_double", "latency", "CAST(min(latency) AS DOUBLE)")
_agg("oal_cpm", "cpm", None, "CAST(count(*) // 60 AS BIGINT)")
_agg("oal_percent", "percent", None, "CAST(count(*) FILTER (status) * 10000 // count(*) AS INTEGER)", lambda: {"cond": F.col("status")})
_agg("oal_rate", "rate", None,
     "CAST(CASE WHEN count(*) FILTER (http_status = 404) = 0 THEN 0 ELSE count(*) FILTER (http_status = 500) * 10000 // count(*) FILTER (http_status = 404) END AS INTEGER)",
     lambda: {"num": F.col("http_status") == 500, "den": F.col("http_status") == 404})

THRESHOLDS = {f"svc_{i}": 100 * (i + 1) for i in range(5)}
_T = "CASE WHEN user_id % 10 < 5 THEN (user_id % 10 + 1) * 100 ELSE 500 END"


def _apdex_rows(spark, sf):
    from .runtime import lookup

    return lookup(fr.service_rows(spark, sf), F.col("name"), THRESHOLDS, "apdex_threshold", 500)


APDEX_SQL = f"""{W}, t AS (SELECT *, {_T} AS thr FROM svc)
SELECT {G}, CAST((count(*) FILTER (status AND latency <= thr) * 10000 + (count(*) FILTER (status AND latency > thr AND latency <= 4 * thr) * 10000) // 2) // count(*) AS INTEGER) AS value
FROM t GROUP BY {G}"""


@query("oal_apdex", APDEX_SQL)
def oal_apdex(spark, sf):
    return A.aggregate(_apdex_rows(spark, sf), "apdex", F.col("latency"), {"threshold": F.col("apdex_threshold"), "status": F.col("status")})


@query("join_apdex_threshold", f"{W} SELECT event_id, CAST({_T} AS INTEGER) AS apdex_threshold FROM svc")
def join_apdex_threshold(spark, sf):
    return _apdex_rows(spark, sf).select("event_id", "apdex_threshold")


def percentile_sql(source, group, key, ranks, scale, label="p", labels=None, n="count(*)", value_name="value"):
    """Smallest key whose running count reaches the rounded share of each rank."""
    pairs = ", ".join(f"({r}, '{l}')" for r, l in zip(ranks, labels or ranks))
    return f"""b AS (SELECT {group}, {key} AS key, CAST({n} AS BIGINT) AS n FROM {source} GROUP BY {group}, key),
c AS (SELECT *, CAST(sum(n) OVER (PARTITION BY {group} ORDER BY key ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum, CAST(sum(n) OVER (PARTITION BY {group}) AS BIGINT) AS tot FROM b)
SELECT {group}, lab AS {label}, CASE WHEN max(tot) <= 0 THEN 0 ELSE min(key) END * {scale} AS {value_name} FROM c, (VALUES {pairs}) r(rk, lab)
WHERE tot <= 0 OR cum >= floor(CAST(CAST(CAST(tot * rk AS FLOAT) / CAST(100 AS FLOAT) AS FLOAT) AS DOUBLE) + 0.5) GROUP BY {group}, lab"""


@query("oal_percentile2", f"{W}, {percentile_sql('svc', G, 'latency // 10', A.RANKS, 10)}")
def oal_percentile2(spark, sf):
    return A.aggregate(fr.service_rows(spark, sf), "percentile2", F.col("latency"), {"precision": 10})


@query("oal_percentile", f"{W}, {percentile_sql('svc', G, 'latency // 10', A.RANKS, 10, labels=range(5))}")
def oal_percentile(spark, sf):
    return A.aggregate(fr.service_rows(spark, sf), "percentile", F.col("latency"), {"precision": 10})


@query("win_percentile_scan", f"""{W}, b AS (SELECT entity_id, latency // 10 AS key, count(*) AS n FROM svc GROUP BY ALL)
SELECT entity_id, key, CAST(sum(n) OVER (PARTITION BY entity_id ORDER BY key ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum FROM b""")
def win_percentile_scan(spark, sf):
    from pyspark.sql import Window

    states = A.fold(fr.service_rows(spark, sf), "percentile2", F.col("latency"), {"precision": 10}, group=("entity_id",))
    w = Window.partitionBy("entity_id").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    return states.select("entity_id", "key", F.sum("n").over(w).alias("cum"))


@query("oal_histogram", f"""{W}, b AS (SELECT {G}, least(latency // 100, 20) * 100 AS bucket, count(*) AS n FROM svc GROUP BY ALL),
g AS (SELECT DISTINCT {G} FROM b)
SELECT g.entity_id, g.time_bucket, CAST(s.x AS BIGINT) AS bucket, CAST(coalesce(b.n, 0) AS BIGINT) AS value
FROM g CROSS JOIN range(0, 2001, 100) s(x) LEFT JOIN b ON b.entity_id = g.entity_id AND b.time_bucket = g.time_bucket AND b.bucket = s.x""")
def oal_histogram(spark, sf):
    return A.aggregate(fr.service_rows(spark, sf), "histogram", F.col("latency"), {"step": 100, "max_steps": 20})


_LABELS = f"""{W}, l AS (SELECT {G}, instance AS label, count(*) AS n, sum(latency) AS s, min(ts) AS first FROM svc GROUP BY {G}, instance),
r AS (SELECT *, row_number() OVER (PARTITION BY {G} ORDER BY first, label) AS rn FROM l)"""


@query("oal_label_count", f"{_LABELS} SELECT {G}, label, CAST(n AS BIGINT) AS value FROM r WHERE rn <= 2")
def oal_label_count(spark, sf):
    return A.aggregate(fr.service_rows(spark, sf), "label_count", None, {"label": F.col("instance"), "ts": F.col("ts"), "max_labels": 2})


@query("oal_label_avg", f"{_LABELS} SELECT {G}, label, CAST(CASE WHEN s // n = 0 AND s > 0 THEN 1 ELSE s // n END AS BIGINT) AS value FROM r WHERE rn <= 2")
def oal_label_avg(spark, sf):
    return A.aggregate(fr.service_rows(spark, sf), "label_avg", F.col("latency"), {"label": F.col("instance"), "ts": F.col("ts"), "max_labels": 2})


# ---- filters ----

def _filter(name, cond, sql_cond):
    @query(name, f"{W} SELECT event_id FROM svc WHERE {sql_cond}")
    def run(spark, sf):
        return fr.service_rows(spark, sf).withColumn("tags", F.array("instance", "endpoint")).filter(cond()).select("event_id")


_filter("flt_bool_eq", lambda: P.is_true("status"), "status")
_filter("flt_bool_ne", lambda: P.is_not_true("status"), "NOT status")
_filter("flt_num_eq", lambda: P.num_eq("http_status", 404), "http_status = 404")
_filter("flt_str_eq", lambda: P.str_eq("endpoint", '"click"'), "endpoint = 'click'")
_filter("flt_ne", lambda: P.ne("type", "MQ"), "type IS DISTINCT FROM 'MQ'")
_filter("flt_gt", lambda: P.gt("latency", 1000), "latency > 1000")
_filter("flt_ge", lambda: P.ge("latency", 1000), "latency >= 1000")
_filter("flt_lt", lambda: P.lt("latency", 100), "latency < 100")
_filter("flt_le", lambda: P.le("latency", 100), "latency <= 100")
_filter("flt_like", lambda: P.like("endpoint", "%ic%") | P.like("instance", "%9") | P.like("endpoint", "sig%") | P.like("endpoint", "view"),
        "contains(endpoint, 'ic') OR ends_with(instance, '9') OR starts_with(endpoint, 'sig')")
_filter("flt_in", lambda: P.is_in("endpoint", ["click", "view"]), "endpoint IN ('click', 'view')")
_filter("flt_contain", lambda: P.contains("tags", "i_7"), "instance = 'i_7'")
_filter("flt_not_contain", lambda: P.not_contains("tags", "click"), "endpoint <> 'click'")
_filter("flt_chain", lambda: P.all_of([P.gt("latency", 500), P.str_eq("type", "HTTP"), P.is_true("status")]), "latency > 500 AND type = 'HTTP' AND status")


@query("flt_disable", f"{W} SELECT 'service_cpm' AS metric, {G}, CAST(count(*) // 60 AS DOUBLE) AS value FROM svc GROUP BY {G}")
def flt_disable(spark, sf):
    rules = [Rule("service_cpm", "service", "cpm"), Rule("service_sum", "service", "sum", "latency")]
    return R.run(fr.service_rows(spark, sf), rules, disabled=["service_sum"]).drop("label")


@query("proj_source_attr", f"""{W} SELECT event_id, latency AS nested, endpoint AS mapped FROM svc""")
def proj_source_attr(spark, sf):
    rows = (fr.service_rows(spark, sf).withColumn("side_car", F.struct("latency"))
            .withColumn("tag", F.create_map(F.lit("transmission.latency"), F.col("endpoint"))))
    return rows.select("event_id", R.attribute("side_car.latency").alias("nested"), R.attribute("tag[transmission.latency]").alias("mapped"))


@query("proj_cast", """SELECT event_id, TRY_CAST(CASE WHEN event_id % 3 = 0 THEN event_type ELSE CAST(event_id AS VARCHAR) END AS BIGINT) AS as_long FROM events""")
def proj_cast(spark, sf):
    rows = fr.service_rows(spark, sf).withColumn("txt", F.when(F.col("event_id") % 3 == 0, F.col("endpoint")).otherwise(F.col("event_id").cast("string")))
    return rows.select("event_id", R.cast_attr(F.col("txt"), "long").alias("as_long"))


SERVICE_RULES = [
    Rule("service_resp_time", "service", "long_avg", "latency"),
    Rule("service_sla", "service", "percent", None, (), {"cond": ("is_true", "status")}),
    Rule("service_cpm", "service", "cpm"),
    Rule("service_mq_count", "service", "count", None, (("eq", "type", "MQ"),)),
    Rule("service_max", "service", "max", "latency", (("is_true", "status"),)),
]


@query("proj_decorate", f"""{W} SELECT attr0, entity_id, time_bucket, CAST(sum(latency) // count(*) AS BIGINT) AS service_resp_time
FROM (SELECT *, CASE WHEN user_id % 2 = 0 THEN 'GENERAL' ELSE 'MESH' END AS attr0 FROM svc) GROUP BY ALL""")
def proj_decorate(spark, sf):
    rules = SERVICE_RULES[:1]
    rows = fr.service_rows(spark, sf).withColumn("attr0", F.when(F.col("user_id") % 2 == 0, "GENERAL").otherwise("MESH"))
    return R.values(R.states(rows, rules, ["attr0"]), rules, ["attr0"])


_WIDE = """CAST(sum(latency) // count(*) AS BIGINT) AS service_resp_time, CAST(count(*) FILTER (status) * 10000 // count(*) AS INTEGER) AS service_sla,
CAST(count(*) // {minutes} AS BIGINT) AS service_cpm, CASE WHEN count(*) FILTER (type = 'MQ') > 0 THEN CAST(count(*) FILTER (type = 'MQ') AS BIGINT) END AS service_mq_count,
CASE WHEN count(*) FILTER (status) > 0 THEN greatest(max(latency) FILTER (status), 0) END AS service_max"""


@query("agg_partial_final", f"{W} SELECT {G}, {_WIDE.format(minutes=60)} FROM svc GROUP BY {G}")
def agg_partial_final(spark, sf):
    return R.values(R.states(fr.service_rows(spark, sf), SERVICE_RULES), SERVICE_RULES)


@query("agg_rollup", f"""{W}, m AS (SELECT *, minute // 10000 AS day FROM svc)
SELECT entity_id, day AS time_bucket, {_WIDE.format(minutes=1440)} FROM m GROUP BY entity_id, day""")
def agg_rollup(spark, sf):
    minutes = fr.service_rows(spark, sf).withColumn("time_bucket", F.col("minute"))
    hours = R.rollup(R.states(minutes, SERVICE_RULES), SERVICE_RULES, 1)
    return R.values(R.rollup(hours, SERVICE_RULES, 1), SERVICE_RULES)


@query("st_rollup", f"{W}, m AS (SELECT entity_id, time_bucket // 100 AS time_bucket, latency FROM svc), {percentile_sql('m', G, 'latency // 10', A.RANKS, 10)}")
def st_rollup(spark, sf):
    """Percentiles of a day from the merged bucket states of its hours."""
    hours = A.fold(fr.service_rows(spark, sf), "percentile2", F.col("latency"), {"precision": 10})
    return A.finalise(A.rollup(hours, "percentile2", 1), "percentile2", {"precision": 10})


@query("st_no_downsample", f"{W} SELECT entity_id, time_bucket // 100 AS time_bucket, CAST(count(*) // 1440 AS BIGINT) AS b FROM svc GROUP BY ALL")
def st_no_downsample(spark, sf):
    rules = [Rule("a", "service", "count", downsample=False), Rule("b", "service", "cpm")]
    kept = [r for r in rules if r.downsample]
    return R.values(R.rollup(R.states(fr.service_rows(spark, sf), rules), rules, 1), kept)


@query("join_upsert", f"{W} SELECT {G}, {_WIDE.format(minutes=60)} FROM svc GROUP BY {G}")
def join_upsert(spark, sf):
    """Stored states merged with the states of a second delivery."""
    rows = fr.service_rows(spark, sf)
    stored = R.states(rows.filter(F.col("event_id") % 3 != 0), SERVICE_RULES)
    fresh = R.states(rows.filter(F.col("event_id") % 3 == 0), SERVICE_RULES)
    return R.values(R.merge_states(stored.unionByName(fresh), SERVICE_RULES), SERVICE_RULES)


@query("agg_rule_catalog", f"""WITH {fr.SVC}, e AS (SELECT name || '/' || endpoint AS entity_id, time_bucket, latency, status, type, k FROM svc),
m AS (SELECT entity_id, time_bucket, sum(latency) // count(*) AS endpoint_resp_time, count(*) FILTER (status) * 10000 // count(*) AS endpoint_sla, count(*) // 60 AS endpoint_cpm,
  CASE WHEN count(*) FILTER (type = 'MQ') > 0 THEN sum(k) FILTER (type = 'MQ') // count(*) FILTER (type = 'MQ') END AS endpoint_mq_consume_latency FROM e GROUP BY ALL),
p AS ({percentile_sql('e', G, 'latency // 10', A.RANKS, 10).replace('b AS', 'WITH b AS', 1)})
SELECT metric, {G}, CAST(value AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS label FROM (UNPIVOT (SELECT entity_id, time_bucket, CAST(endpoint_resp_time AS DOUBLE) AS endpoint_resp_time, CAST(endpoint_sla AS DOUBLE) AS endpoint_sla, CAST(endpoint_cpm AS DOUBLE) AS endpoint_cpm, CAST(endpoint_mq_consume_latency AS DOUBLE) AS endpoint_mq_consume_latency FROM m) ON endpoint_resp_time, endpoint_sla, endpoint_cpm, endpoint_mq_consume_latency INTO NAME metric VALUE value)
UNION ALL SELECT 'endpoint_percentile', entity_id, time_bucket, CAST(value AS DOUBLE), p FROM p""")
def agg_rule_catalog(spark, sf):
    """All shipped endpoint rules over one read of the endpoint rows for the plain ones."""
    rows = (fr.service_rows(spark, sf).withColumn("entity_id", F.concat_ws("/", "name", "endpoint"))
            .withColumn("tag", F.create_map(F.lit("transmission.latency"), F.col("k").cast("string"))))
    return R.run(rows, catalog.by_source("endpoint")).select("metric", "entity_id", "time_bucket", "value", "label")


# ---- top lists ----

HOURLY = Rule("service_resp_time", "service", "long_avg", "latency")
_HOURLY = f"m AS (SELECT entity_id, time_bucket, CAST(sum(latency) // count(*) AS BIGINT) AS value FROM svc GROUP BY ALL)"
_INST = "m AS (SELECT instance AS entity_id, name AS parent, time_bucket, CAST(sum(latency) // count(*) AS BIGINT) AS value FROM svc GROUP BY ALL)"


def _instances(spark, sf):
    rows = fr.service_rows(spark, sf).withColumn("parent", F.col("name")).withColumn("entity_id", F.col("instance"))
    return R.values(R.states(rows, [HOURLY], ["parent"]), [HOURLY], ["parent"]).withColumnRenamed("service_resp_time", "value")


def _services(spark, sf):
    return R.values(R.states(fr.service_rows(spark, sf), [HOURLY]), [HOURLY]).withColumnRenamed("service_resp_time", "value")


@query("topk_metric", f"{W}, {_INST} SELECT entity_id, sum(value)::DOUBLE / count(*) AS value FROM m GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
def topk_metric(spark, sf):
    return topk.top_n(_instances(spark, sf), 5)


@query("topk_metric_int", f"{W}, {_INST} SELECT entity_id, CAST(trunc(sum(value)::DOUBLE / count(*)) AS BIGINT) AS value FROM m GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
def topk_metric_int(spark, sf):
    return topk.top_n(_instances(spark, sf), 5, truncate=True)


@query("attr_filter", f"{W}, {_INST} SELECT entity_id, sum(value)::DOUBLE / count(*) AS value FROM m WHERE parent <> 'svc_3' GROUP BY 1 ORDER BY 2, 1 LIMIT 4")
def attr_filter(spark, sf):
    return topk.top_n(topk.attr_filter(_instances(spark, sf), parent=("!=", "svc_3")), 4, descending=False)


@query("topk_of", f"""{W}, {_INST}, a AS (SELECT entity_id, sum(value)::DOUBLE / count(*) AS value FROM m GROUP BY 1),
t AS (SELECT * FROM (SELECT * FROM a ORDER BY value DESC, entity_id LIMIT 3) UNION ALL SELECT * FROM (SELECT * FROM a ORDER BY value, entity_id LIMIT 3))
SELECT * FROM t ORDER BY value DESC, entity_id LIMIT 4""")
def topk_of(spark, sf):
    m = _instances(spark, sf)
    return topk.top_n_of([topk.top_n(m, 3), topk.top_n(m, 3, descending=False)], 4)


def _records(spark, sf):
    from ..functions.timebucket import bucket_of

    o = fr.table(spark, sf, "orders")
    return o.select(F.col("o_orderpriority").alias("entity_id"), F.floor("o_totalprice").cast("bigint").alias("latency"),
                    F.col("o_orderkey").alias("statement"), bucket_of(F.col("o_orderdate"), "day").alias("time_bucket"))


_REC = "r AS (SELECT o_orderpriority AS entity_id, CAST(floor(o_totalprice) AS BIGINT) AS latency, o_orderkey AS statement, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS time_bucket FROM orders)"


@query("topk_record", f"WITH {_REC} SELECT * FROM r WHERE entity_id = '1-URGENT' AND time_bucket BETWEEN 19960101 AND 19981231 ORDER BY latency DESC, statement LIMIT 10")
def topk_record(spark, sf):
    return topk.top_records(_records(spark, sf), 10, "1-URGENT", (19960101, 19981231))


@query("q_slow_records", f"WITH {_REC} SELECT * FROM r WHERE time_bucket BETWEEN 19970101 AND 19971231 ORDER BY latency DESC, statement LIMIT 20")
def q_slow_records(spark, sf):
    return topk.top_records(_records(spark, sf), 20, bounds=(19970101, 19971231))


_TOPG = "SELECT entity_id, latency, statement, time_bucket FROM (SELECT *, row_number() OVER (PARTITION BY entity_id, {g} ORDER BY latency DESC, statement) AS rn FROM r) WHERE rn <= {n}"


@query("topk_stream", f"WITH {_REC} {_TOPG.format(g='time_bucket', n=2)}")
def topk_stream(spark, sf):
    return topk.sampled_top(_records(spark, sf), 2)


@query("st_topn", f"WITH {_REC} SELECT entity_id, latency, statement, time_bucket FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY latency DESC, statement) AS rn FROM r) WHERE rn <= 1200")
def st_topn(spark, sf):
    """More rows per group than Spark limits before the shuffle by itself: the salted two-step form."""
    return topk.first_per_group(_records(spark, sf), ["entity_id"], [F.col("latency").desc(), F.col("statement").asc()], 1200)


@query("topk_preagg", f"""{W}, {_INST}, r AS (SELECT *, row_number() OVER (PARTITION BY parent, time_bucket ORDER BY value DESC, entity_id) AS rn FROM m)
SELECT entity_id, time_bucket, parent, value FROM r WHERE rn <= 2""")
def topk_preagg(spark, sf):
    return topk.preaggregated_top(_instances(spark, sf), ["parent"], 2)


@query("agg_latest_entity", f"""{W} SELECT instance AS entity_id, max(time_bucket) AS time_bucket FROM svc GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 7""")
def agg_latest_entity(spark, sf):
    return topk.latest_entities(_instances(spark, sf), 7)


@query("page", f"WITH {_REC} SELECT * FROM r ORDER BY latency DESC, statement LIMIT 15 OFFSET 30")
def page(spark, sf):
    return topk.page(_records(spark, sf), [F.col("latency").desc(), F.col("statement").asc()], 15, 3)


@query("set_union_tables", f"""WITH {_REC} SELECT time_bucket // 100 AS month, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (time_bucket // 100 % 2 = 0) AS BIGINT) AS statements
FROM r WHERE time_bucket BETWEEN 19960115 AND 19960620 GROUP BY 1""")
def set_union_tables(spark, sf):
    """A range over one table a month; those of odd months have no statements."""
    from uuid import uuid4

    from ..sources.tables import read_range
    from .runtime import checkpoint_dir

    base = f"{checkpoint_dir(spark).rstrip('/')}/records-{uuid4().hex}"
    r = _records(spark, sf).withColumn("table", F.expr("time_bucket div 100")).withColumn("odd", F.col("table") % 2 == 1)
    for odd, columns in ((True, ["entity_id", "latency", "time_bucket", "table"]), (False, ["entity_id", "latency", "statement", "time_bucket", "table"])):
        r.filter(F.col("odd") == odd).select(*columns).write.mode("append").partitionBy("table").parquet(base)
    rows = read_range(spark, base, 19960115, 19960620).filter(F.col("time_bucket").between(19960115, 19960620))
    return rows.groupBy(F.expr("time_bucket div 100").alias("month")).agg(F.count(F.lit(1)).alias("n"), F.count("statement").alias("statements"))


# ---- extension points ----

@query("ext_metric_fn", f"{W} SELECT {G}, CAST(max(latency) - min(latency) AS BIGINT) AS value FROM svc GROUP BY {G}")
def ext_metric_fn(spark, sf):
    """A user function: the range of values, merged like any other state."""
    if "spread" not in A.REGISTRY:
        A.register(A.AggregateFn("spread", lambda v, a: {"hi": (v, "max"), "lo": (v, "min")}, lambda s, m, a: s["hi"] - s["lo"]))
    return A.aggregate(fr.service_rows(spark, sf), "spread", F.col("latency"))


@query("ext_filter", f"{W} SELECT event_id FROM svc WHERE latency BETWEEN 100 AND 200")
def ext_filter(spark, sf):
    P.register("between", lambda c, lo, hi: F.coalesce(F.col(c).between(lo, hi) if isinstance(c, str) else c.between(lo, hi), F.lit(False)))
    return fr.service_rows(spark, sf).filter(R.condition(("between", "latency", 100, 200))).select("event_id")


@query("ext_decorator", f"""{W} SELECT attr0, CAST(count(*) AS BIGINT) AS n FROM (SELECT upper(type) AS attr0 FROM svc) GROUP BY 1""")
def ext_decorator(spark, sf):
    """A decorator adds an attribute to the rows of its source."""
    R.DECORATORS.pop("decorated", None)
    R.register_decorator("decorated", lambda df: df.withColumn("attr0", F.upper("type")))
    return R.decorate(fr.service_rows(spark, sf), "decorated").groupBy("attr0").agg(F.count(F.lit(1)).alias("n"))


@query("ext_dispatcher", f"""{W} SELECT 'by_service' AS metric, entity_id, time_bucket, CAST(count(*) AS DOUBLE) AS value FROM svc GROUP BY ALL
UNION ALL SELECT 'by_instance', instance, time_bucket, CAST(count(*) AS DOUBLE) FROM svc GROUP BY ALL""")
def ext_dispatcher(spark, sf):
    """One source row feeds several metrics through frames of its own."""
    R.register_dispatcher("dispatched", "of_service", lambda df: df)
    R.register_dispatcher("dispatched", "of_instance", lambda df: df.withColumn("entity_id", F.col("instance")))
    rules = [Rule("by_service", "of_service", "count"), Rule("by_instance", "of_instance", "count")]
    return R.run_scope(fr.service_rows(spark, sf), "dispatched", rules).drop("label")


@query("ext_runtime", f"{W} SELECT {G}, CAST(sum(latency) AS BIGINT) AS total, CAST(count(*) AS BIGINT) AS n FROM svc GROUP BY {G}")
def ext_runtime(spark, sf):
    """Rules are data: the list is asked for when the plan is built."""
    from ..streaming.metrics import current

    active = current(lambda: [Rule("total", "service", "sum", "latency"), Rule("n", "service", "count")])
    return R.values(R.states(fr.service_rows(spark, sf), active), active)
