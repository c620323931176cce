"""Queries on time-series expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arith
from ..functions import labels as L
from ..functions.timebucket import Duration
from ..operators import aggregates as A
from ..operators import promql, topk
from ..operators import series as S
from . import catalog
from . import frames as fr
from .registry import query

RANGE = Duration("2024-01-01 00", "2024-01-30 23", "HOUR")
LO, HI = RANGE.start_bucket, RANGE.end_bucket
W = f"WITH {fr.SVC}"

# points of every service (plain) and of every service and instance (labelled) by hour
_PLAIN = f"p AS (SELECT entity_id, time_bucket, CAST(sum(latency) AS DOUBLE) AS value FROM svc WHERE time_bucket BETWEEN {LO} AND {HI} GROUP BY ALL)"
_ALT = f"q AS (SELECT entity_id, time_bucket, CAST(count(*) AS DOUBLE) AS value FROM svc WHERE status AND time_bucket BETWEEN {LO} AND {HI} GROUP BY ALL)"
_LAB = f"l AS (SELECT entity_id, time_bucket, endpoint, CAST(sum(latency) AS DOUBLE) AS value FROM svc WHERE time_bucket BETWEEN {LO} AND {HI} GROUP BY ALL)"
_LAB2 = f"k AS (SELECT entity_id, time_bucket, endpoint, CAST(count(*) AS DOUBLE) AS value FROM svc WHERE type <> 'MQ' AND time_bucket BETWEEN {LO} AND {HI} GROUP BY ALL)"
_GRID = f"grid AS (SELECT CAST(strftime(t, '%Y%m%d%H') AS BIGINT) AS time_bucket FROM range(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 HOUR) r(t))"


def _rows(spark, sf):
    return fr.service_rows(spark, sf).filter(F.col("time_bucket").between(LO, HI))


def plain(spark, sf):
    return _rows(spark, sf).groupBy("entity_id", "time_bucket").agg(F.sum("latency").cast("double").alias("value"))


def other(spark, sf):
    return _rows(spark, sf).filter("status").groupBy("entity_id", "time_bucket").agg(F.count(F.lit(1)).cast("double").alias("value"))


def _labelled(rows, agg):
    out = rows.groupBy("entity_id", "time_bucket", "endpoint").agg(agg.alias("value"))
    return out.select("entity_id", "time_bucket", F.create_map(F.lit("endpoint"), F.col("endpoint")).alias("labels"), "value")


def labelled(spark, sf):
    return _labelled(_rows(spark, sf), F.sum("latency").cast("double"))


def labelled2(spark, sf):
    return _labelled(_rows(spark, sf).filter("type <> 'MQ'"), F.count(F.lit(1)).cast("double"))


def flat(df):
    """Label maps as text, so that results compare as plain values."""
    return df.withColumn("labels", L.encode(F.col("labels"))) if "labels" in df.columns else df


_LT = "'{endpoint=' || endpoint || '}' AS labels"

# ---- filling and reading ----


@query("win_fill", f"""{W}, {_PLAIN}, {_GRID}, e AS (SELECT DISTINCT entity_id FROM p)
SELECT e.entity_id, grid.time_bucket, p.value FROM e CROSS JOIN grid LEFT JOIN p ON p.entity_id = e.entity_id AND p.time_bucket = grid.time_bucket""")
def win_fill(spark, sf):
    return S.fill(plain(spark, sf), RANGE)


@query("q_metric_series", f"""{W}, {_PLAIN}, {_GRID} SELECT 'svc_3' AS entity_id, grid.time_bucket, coalesce(p.value, 0.0::DOUBLE) AS value
FROM grid LEFT JOIN p ON p.entity_id = 'svc_3' AND p.time_bucket = grid.time_bucket""")
def q_metric_series(spark, sf):
    table = plain(spark, sf).withColumn("metric", F.lit("service_latency"))
    return S.fill(S.scan_metric(table, "service_latency", RANGE, "svc_3").drop("metric"), RANGE, 0.0)


@query("fill_absent", f"""{W}, {_PLAIN}, {_GRID}, e AS (SELECT 'svc_3' AS entity_id UNION ALL SELECT 'no such service')
SELECT e.entity_id, grid.time_bucket, coalesce(p.value, 0.0::DOUBLE) AS value
FROM e CROSS JOIN grid LEFT JOIN p ON p.entity_id = e.entity_id AND p.time_bucket = grid.time_bucket""")
def fill_absent(spark, sf):
    """An expected entity without any row has its default points."""
    wanted = ["svc_3", "no such service"]
    table = plain(spark, sf).withColumn("metric", F.lit("service_latency"))
    return S.fill(S.scan_metric(table, "service_latency", RANGE, wanted).drop("metric"), RANGE, 0.0, wanted)


@query("scan_metric_table", f"{W}, {_PLAIN} SELECT entity_id, time_bucket, value, 'service_latency' AS metric FROM p WHERE entity_id IN ('svc_1', 'svc_2') AND time_bucket BETWEEN 2024010300 AND 2024010323")
def scan_metric_table(spark, sf):
    table = plain(spark, sf).withColumn("metric", F.lit("service_latency"))
    return S.scan_metric(table, "service_latency", Duration("2024-01-03 00", "2024-01-03 23", "HOUR"), ["svc_1", "svc_2"])


@query("q_metric_value", f"{W}, {_PLAIN} SELECT entity_id, arg_max(value, time_bucket) AS value FROM p GROUP BY 1")
def q_metric_value(spark, sf):
    return S.latest_value(S.fill(plain(spark, sf), RANGE))


@query("q_metric_labeled", f"""{W}, {_LAB}, {_GRID}, e AS (SELECT DISTINCT entity_id, endpoint FROM l WHERE endpoint IN ('click', 'view'))
SELECT e.entity_id, '{{endpoint=' || e.endpoint || '}}' AS labels, grid.time_bucket, l.value
FROM e CROSS JOIN grid LEFT JOIN l ON l.entity_id = e.entity_id AND l.endpoint = e.endpoint AND l.time_bucket = grid.time_bucket""")
def q_metric_labeled(spark, sf):
    return flat(S.fill(S.select_labels(labelled(spark, sf), endpoint="click,view"), RANGE))


@query("fn_label_select", f"{W}, {_LAB} SELECT entity_id, time_bucket, {_LT}, value FROM l WHERE endpoint IN ('click', 'error')")
def fn_label_select(spark, sf):
    return flat(S.select_labels(labelled(spark, sf), endpoint="click,error"))


@query("q_metric_all_entities", f"{W}, {_LAB} SELECT entity_id, time_bucket, endpoint AS label, value, 'm' AS metric FROM l ORDER BY time_bucket DESC, entity_id, endpoint LIMIT 10")
def q_metric_all_entities(spark, sf):
    table = labelled(spark, sf).select("entity_id", "time_bucket", L.get(F.col("labels"), "endpoint").alias("label"), "value", F.lit("m").alias("metric"))
    return S.all_entities(table, "m", RANGE)


@query("q_heatmap", f"""{W}, h AS (SELECT entity_id, time_bucket, least(latency // 500, 4) * 500 AS bucket, count(*) AS n FROM svc WHERE time_bucket BETWEEN {LO} AND {HI} GROUP BY ALL),
{_GRID}, e AS (SELECT DISTINCT entity_id FROM h)
SELECT e.entity_id, grid.time_bucket, CAST(b.x AS BIGINT) AS bucket_min, CASE WHEN b.x = 2000 THEN 'Infinity'::DOUBLE ELSE CAST(b.x + 500 AS DOUBLE) END AS bucket_max, CAST(coalesce(h.n, 0) AS BIGINT) AS value
FROM e CROSS JOIN grid CROSS JOIN range(0, 2001, 500) b(x) LEFT JOIN h ON h.entity_id = e.entity_id AND h.time_bucket = grid.time_bucket AND h.bucket = b.x""")
def q_heatmap(spark, sf):
    histogram = A.aggregate(_rows(spark, sf), "histogram", F.col("latency"), {"step": 500, "max_steps": 4})
    return S.heatmap(histogram, RANGE)


@query("win_heatmap_fill", f"""{W}, h AS (SELECT DISTINCT entity_id, time_bucket FROM svc WHERE time_bucket BETWEEN {LO} AND {HI}), {_GRID}, e AS (SELECT DISTINCT entity_id FROM h)
SELECT e.entity_id, grid.time_bucket, CAST(5 AS BIGINT) AS columns_filled FROM e CROSS JOIN grid LEFT JOIN h ON h.entity_id = e.entity_id AND h.time_bucket = grid.time_bucket WHERE h.entity_id IS NULL""")
def win_heatmap_fill(spark, sf):
    """Heat-map columns of hours without data, all of whose buckets hold the default."""
    histogram = A.aggregate(_rows(spark, sf), "histogram", F.col("latency"), {"step": 500, "max_steps": 4})
    filled = S.heatmap(histogram, RANGE, default=-1)
    return filled.filter("value = -1").groupBy("entity_id", "time_bucket").agg(F.count(F.lit(1)).alias("columns_filled"))


# ---- binary operators ----

def _binary(name, op, sql_value, scalar=None, left=False):
    @query(name, f"{W}, {_PLAIN} SELECT entity_id, time_bucket, {sql_value} AS value FROM p")
    def run(spark, sf):
        return S.scalar_op(plain(spark, sf), op, scalar, left)


_binary("join_scalar", "/", "value / 7.0::DOUBLE", 7.0)
_binary("fn_compare", ">=", "CAST(value >= 1000 AS DOUBLE)", 1000.0)


@query("fn_arith", f"""{W}, {_PLAIN}, z AS (SELECT entity_id, time_bucket, value, (CAST(value AS BIGINT) % 3)::DOUBLE AS d FROM p)
SELECT entity_id, time_bucket, value + d AS a, value - d AS s, value * d AS m, CASE WHEN d = 0 THEN CASE WHEN value = 0 THEN 'NaN'::DOUBLE ELSE 'Infinity'::DOUBLE END ELSE value / d END AS q,
CASE WHEN d = 0 THEN 'NaN'::DOUBLE ELSE CAST(CAST(value AS BIGINT) % CAST(d AS BIGINT) AS DOUBLE) END AS r FROM z""")
def fn_arith(spark, sf):
    v, d = F.col("value"), (F.col("value").cast("bigint") % 3).cast("double")
    return plain(spark, sf).select("entity_id", "time_bucket", *[arith.binary(op, v, d).alias(n) for op, n in zip("+-*/%", "asmqr")])


@query("join_series_plain", f"{W}, {_PLAIN}, {_ALT} SELECT p.entity_id, p.time_bucket, p.value / q.value AS value FROM p LEFT JOIN q ON p.entity_id = q.entity_id AND p.time_bucket = q.time_bucket")
def join_series_plain(spark, sf):
    return S.series_op(plain(spark, sf), "/", other(spark, sf))


@query("join_series_label", f"{W}, {_LAB}, {_PLAIN} SELECT l.entity_id, l.time_bucket, {_LT.replace('endpoint ||', 'l.endpoint ||')}, l.value / nullif(p.value, 0) AS value FROM l LEFT JOIN p ON l.entity_id = p.entity_id AND l.time_bucket = p.time_bucket WHERE p.value > 0")
def join_series_label(spark, sf):
    return flat(S.series_op(labelled(spark, sf), "/", plain(spark, sf).filter("value > 0")).filter("value is not null"))


@query("join_series_labels", f"{W}, {_LAB}, {_LAB2} SELECT l.entity_id, l.time_bucket, '{{endpoint=' || l.endpoint || '}}' AS labels, l.value - k.value AS value FROM l LEFT JOIN k ON l.entity_id = k.entity_id AND l.time_bucket = k.time_bucket AND l.endpoint = k.endpoint")
def join_series_labels(spark, sf):
    return flat(S.series_op(labelled(spark, sf), "-", labelled2(spark, sf)))


@query("join_single_label", f"""{W}, {_LAB}, {_LAB2}, a AS (SELECT entity_id, endpoint, max(value) AS value FROM l GROUP BY ALL), b AS (SELECT entity_id, endpoint, sum(value) AS value FROM k GROUP BY ALL)
SELECT a.entity_id, '{{endpoint=' || a.endpoint || '}}' AS labels, a.value * b.value AS value FROM a LEFT JOIN b ON a.entity_id = b.entity_id AND a.endpoint = b.endpoint""")
def join_single_label(spark, sf):
    return flat(S.series_op(S.over_time(labelled(spark, sf), "max"), "*", S.over_time(labelled2(spark, sf), "sum")))


@query("fn_bool", f"""{W}, {_PLAIN}, {_ALT} SELECT p.entity_id, p.time_bucket, CASE WHEN q.value IS NULL THEN NULL ELSE CAST((p.value > 500 AND q.value >= 2) OR (p.value < 50) AS DOUBLE) END AS value
FROM p LEFT JOIN q ON p.entity_id = q.entity_id AND p.time_bucket = q.time_bucket""")
def fn_bool(spark, sf):
    both = S.series_op(S.compare(plain(spark, sf), ">", 500.0), "&&", S.compare(other(spark, sf), ">=", 2.0))
    return S.series_op(both, "||", S.compare(plain(spark, sf), "<", 50.0))


@query("fn_abs_ceil_floor", f"{W}, {_PLAIN} SELECT entity_id, time_bucket, floor(ceil(abs(value / 7.0::DOUBLE - 100)) / 2) AS value FROM p")
def fn_abs_ceil_floor(spark, sf):
    df = S.scalar_op(S.scalar_op(plain(spark, sf), "/", 7.0), "-", 100.0)
    return S.math(S.scalar_op(S.math(S.math(df, "abs"), "ceil"), "/", 2.0), "floor")


@query("fn_round", f"{W}, {_PLAIN} SELECT entity_id, time_bucket, CAST(round(CAST((value - 700) / 8 AS DECIMAL(30, 6)), 2) AS DOUBLE) AS value FROM p")
def fn_round(spark, sf):
    return S.math(S.scalar_op(S.scalar_op(plain(spark, sf), "-", 700.0), "/", 8.0), "round", 2)


# ---- aggregation ----

@query("mqe_avg", f"""{W}, {_PLAIN} SELECT fn, entity_id, value FROM (
SELECT entity_id, sum(value) / count(*) AS avg, sum(value) AS sum, CAST(count(*) AS DOUBLE) AS count, max(value) AS max, min(value) AS min, arg_max(value, time_bucket) AS latest FROM p GROUP BY 1)
UNPIVOT (value FOR fn IN (avg, sum, count, max, min, latest))""")
def mqe_avg(spark, sf):
    return S.all_over_time(S.fill(plain(spark, sf), RANGE), ("avg", "sum", "count", "max", "min", "latest")).select("fn", "entity_id", "value")


@query("mqe_agg_labels", f"""{W}, {_LAB} SELECT entity_id, time_bucket, '{{kind=}}' AS labels, sum(value) AS value FROM l GROUP BY 1, 2""")
def mqe_agg_labels(spark, sf):
    """Grouping by a label that no series has: it reads as empty text."""
    return flat(S.aggregate_labels(labelled(spark, sf), "sum", ["kind"]))


@query("q_mqe", f"""{W}, {_LAB}, m AS (SELECT time_bucket, max(value) AS value FROM l GROUP BY 1)
SELECT CAST(sum(CASE WHEN value > 2000 THEN 1.0 ELSE 0.0 END) >= 3 AS DOUBLE) AS value FROM m""")
def q_mqe(spark, sf):
    """``sum(aggregate_labels(latency, max) > 2000) >= 3`` over all services: one lazy plan."""
    top = S.aggregate_labels(labelled(spark, sf).drop("entity_id"), "max")
    return S.compare(S.over_time(S.compare(top, ">", 2000.0), "sum"), ">=", 3.0)


@query("prom_agg", f"""{W}, i AS (SELECT time_bucket, endpoint, type, CAST(sum(latency) AS DOUBLE) AS value FROM svc WHERE time_bucket BETWEEN {LO} AND {HI} GROUP BY ALL)
SELECT time_bucket, '{{endpoint=' || endpoint || '}}' AS labels, 'by' AS how, max(value) AS value FROM i GROUP BY ALL
UNION ALL SELECT time_bucket, '{{type=' || type || '}}', 'without', min(value) FROM i GROUP BY ALL""")
def prom_agg(spark, sf):
    rows = _rows(spark, sf).groupBy("time_bucket", "endpoint", "type").agg(F.sum("latency").cast("double").alias("value"))
    series = rows.select("time_bucket", F.create_map(F.lit("endpoint"), F.col("endpoint"), F.lit("type"), F.col("type")).alias("labels"), "value")
    by = promql.aggregate(series, "max", by=["endpoint"]).withColumn("how", F.lit("by"))
    without = promql.aggregate(series, "min", without=["endpoint"]).withColumn("how", F.lit("without"))
    return flat(by.unionByName(without))


@query("join_prom_matrix", f"{W}, {_LAB}, {_LAB2} SELECT l.entity_id, l.time_bucket, '{{endpoint=' || l.endpoint || '}}' AS labels, l.value / k.value AS value FROM l JOIN k ON l.entity_id = k.entity_id AND l.time_bucket = k.time_bucket AND l.endpoint = k.endpoint")
def join_prom_matrix(spark, sf):
    return flat(promql.matrix_op(labelled(spark, sf), "/", labelled2(spark, sf)))


@query("fn_prom_compare", f"""{W}, {_LAB}, {_LAB2}, j AS (SELECT l.entity_id, l.time_bucket, '{{endpoint=' || l.endpoint || '}}' AS labels, l.value, k.value AS other FROM l JOIN k ON l.entity_id = k.entity_id AND l.time_bucket = k.time_bucket AND l.endpoint = k.endpoint)
SELECT entity_id, time_bucket, labels, 'filter' AS how, value FROM j WHERE value > other
UNION ALL SELECT entity_id, time_bucket, labels, 'bool', CAST(value > other AS DOUBLE) FROM j""")
def fn_prom_compare(spark, sf):
    a, b = labelled(spark, sf), labelled2(spark, sf)
    kept = promql.compare(a, ">", b).withColumn("how", F.lit("filter"))
    return flat(kept.unionByName(promql.compare(a, ">", b, as_bool=True).withColumn("how", F.lit("bool"))))


@query("fn_prom_format", f"""{W}, {_PLAIN} SELECT entity_id, time_bucket, regexp_replace(regexp_replace(CAST(CAST(floor(value * 25 + 0.5) / 100 AS DECIMAL(18, 2)) AS VARCHAR), '(\\.\\d*?)0+$', '\\1'), '\\.$', '') AS value FROM p""")
def fn_prom_format(spark, sf):
    """Quarters have at most two decimals, so no rounding rule matters."""
    return promql.formatted(S.scalar_op(plain(spark, sf), "/", 4.0))


@query("prom_matchers", f"{W}, {_LAB} SELECT entity_id, time_bucket, {_LT}, value FROM l WHERE regexp_full_match(endpoint, 'c.*|view') AND endpoint <> 'view' AND NOT regexp_full_match(endpoint, 'x+')")
def prom_matchers(spark, sf):
    return flat(promql.match_labels(labelled(spark, sf), ("endpoint", "=~", "c.*|view"), ("endpoint", "!=", "view"), ("endpoint", "!~", "x+")))


@query("q_promql_range", f"{W}, {_PLAIN} SELECT entity_id, time_bucket, value, 'GENERAL' AS layer, 'service_latency' AS metric FROM p WHERE entity_id = 'svc_4'")
def q_promql_range(spark, sf):
    table = plain(spark, sf).withColumn("metric", F.lit("service_latency")).withColumn("layer", F.lit("GENERAL"))
    return promql.select_metric(table, "service_latency", RANGE, "GENERAL", ["GENERAL", "MESH"], "svc_4")


@query("q_promql_instant", f"{W}, {_LAB} SELECT entity_id, {_LT}, arg_max(value, time_bucket) AS value FROM l GROUP BY entity_id, endpoint")
def q_promql_instant(spark, sf):
    return flat(promql.instant(labelled(spark, sf)))


@query("q_promql_topn", f"{W}, {_PLAIN} SELECT entity_id, sum(value) / count(*) AS value FROM p GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3")
def q_promql_topn(spark, sf):
    table = plain(spark, sf).withColumn("metric", F.lit("service_latency")).withColumn("layer", F.lit("GENERAL"))
    return promql.select_metric(table, "service_latency", RANGE, "GENERAL", ["GENERAL"], top=3)


@query("q_promql_meta", f"{W}, {_LAB} SELECT DISTINCT 'value' AS kind, endpoint AS text FROM l UNION SELECT 'label', 'endpoint'")
def q_promql_meta(spark, sf):
    s = labelled(spark, sf)
    names = promql.label_names(s).select(F.lit("label").alias("kind"), F.col("label").alias("text"))
    return names.unionByName(promql.label_values(s, "endpoint").select(F.lit("value").alias("kind"), F.col("value").alias("text")))


@query("set_prom_union", f"""{W}, {_LAB} SELECT DISTINCT '{{"endpoint":"' || endpoint || '"}}' AS series FROM l WHERE endpoint = 'click' OR regexp_full_match(endpoint, 's.*')""")
def set_prom_union(spark, sf):
    return promql.series_of(labelled(spark, sf), [("endpoint", "=", "click")], [("endpoint", "=~", "s.*")])


# ---- trends ----

_FILLED = f"{_PLAIN}, {_GRID}, f AS (SELECT e.entity_id, grid.time_bucket, p.value FROM (SELECT DISTINCT entity_id FROM p) e CROSS JOIN grid LEFT JOIN p ON p.entity_id = e.entity_id AND p.time_bucket = grid.time_bucket)"
_TREND = "SELECT entity_id, time_bucket, {v} AS value FROM (SELECT *, value - lag(value, 2) OVER w AS d, row_number() OVER w AS rn FROM f WINDOW w AS (PARTITION BY entity_id ORDER BY time_bucket)) WHERE rn > 2"


@query("win_mqe_increase", f"{W}, {_FILLED} {_TREND.format(v='d')}")
def win_mqe_increase(spark, sf):
    return S.increase(S.fill(plain(spark, sf), RANGE), 2)


@query("win_mqe_rate", f"{W}, {_FILLED} {_TREND.format(v='d / 7200.0::DOUBLE')}")
def win_mqe_rate(spark, sf):
    return S.rate(S.fill(plain(spark, sf), RANGE), 2, RANGE.step_seconds)


# ---- ordering and labels ----

@query("sort_values", f"""{W}, {_LAB}, g AS (SELECT endpoint, time_bucket, sum(value) AS value FROM l GROUP BY ALL), a AS (SELECT endpoint, sum(value) / count(*) AS v, row_number() OVER (ORDER BY sum(value) / count(*) DESC, endpoint) AS rank FROM g GROUP BY 1)
SELECT '{{endpoint=' || g.endpoint || '}}' AS labels, g.time_bucket, g.value, CAST(rank AS INTEGER) AS rank FROM g JOIN a USING (endpoint) WHERE rank <= 2""")
def sort_values(spark, sf):
    series = S.aggregate_labels(labelled(spark, sf).drop("entity_id"), "sum", ["endpoint"])
    return flat(S.sort_values(series, "avg", descending=True, limit=2))


@query("sort_label_values", f"""{W}, {_LAB}, g AS (SELECT entity_id, endpoint, max(value) AS value FROM l GROUP BY ALL)
SELECT entity_id, {_LT}, value FROM g ORDER BY endpoint DESC""")
def sort_label_values(spark, sf):
    return flat(S.sort_label_values(S.over_time(labelled(spark, sf), "max"), ["endpoint"], descending=True))


@query("fn_relabels", f"""{W}, {_LAB} SELECT entity_id, time_bucket, CASE endpoint WHEN 'click' THEN '{{act=press}}' WHEN 'view' THEN '{{act=look}}' ELSE '{{endpoint=' || endpoint || '}}' END AS labels, value FROM l""")
def fn_relabels(spark, sf):
    return flat(S.relabels(labelled(spark, sf), "endpoint", "click,view", "act", "press,look"))


@query("set_view_as_seq", f"{W}, {_PLAIN} SELECT entity_id, time_bucket, value FROM p WHERE entity_id <> 'svc_2' UNION ALL SELECT entity_id, time_bucket, value + 1 FROM p WHERE entity_id = 'svc_2'")
def set_view_as_seq(spark, sf):
    p = plain(spark, sf)
    first = p.withColumn("value", F.when(F.col("entity_id") != "svc_2", F.col("value")))
    return S.view_as_seq([first, S.scalar_op(p, "+", 1.0)])


@query("set_is_present", f"{W}, {_PLAIN} SELECT entity_id, CASE WHEN max(value) > 5000 THEN 1.0 ELSE 0.0 END::DOUBLE AS value FROM p GROUP BY 1")
def set_is_present(spark, sf):
    big = plain(spark, sf).withColumn("value", F.when(F.col("value") > 5000, F.col("value")))
    return S.is_present([big, big.withColumn("value", F.lit(None).cast("double"))])


@query("join_baseline", f"""{W}, {_PLAIN}, b AS (SELECT entity_id, time_bucket, value * 2 AS upper FROM p WHERE CAST(value AS BIGINT) % 2 = 0),
m AS (SELECT DISTINCT entity_id, minute FROM svc WHERE time_bucket BETWEEN {LO} AND {HI})
SELECT m.entity_id, m.minute AS time_bucket, b.upper AS value FROM m LEFT JOIN b ON b.entity_id = m.entity_id AND b.time_bucket = m.minute // 100""")
def join_baseline(spark, sf):
    points = _rows(spark, sf).select("entity_id", F.col("minute").alias("time_bucket")).distinct().withColumn("value", F.lit(0.0))
    predictions = plain(spark, sf).filter(F.col("value").cast("bigint") % 2 == 0).select("entity_id", "time_bucket", (F.col("value") * 2).alias("upper"))
    return S.baseline(points, predictions, "minute", "upper")


@query("fn_duration", """SELECT event_id, (epoch_us(date_trunc('minute', ts)) // 1000000) AS start_s, CAST(strftime(date_trunc('minute', ts), '%Y%m%d%H%M') || '59' AS BIGINT) AS last_second,
CAST(strftime(ts, '%Y%m%d%H') AS BIGINT) AS hour_start FROM events""")
def fn_duration(spark, sf):
    """Query time texts of every event's minute and hour, parsed back."""
    from ..functions.timebucket import bucket_of, last_second, parse_text

    t = fr.service_rows(spark, sf).select("event_id", F.date_format("ts", "yyyy-MM-dd HHmm").alias("m"), F.date_format("ts", "yyyy-MM-dd HH").alias("h"))
    return t.select("event_id", F.unix_seconds(parse_text(F.col("m"), "minute")).alias("start_s"), last_second(F.col("m"), "minute").alias("last_second"),
                    bucket_of(parse_text(F.col("h"), "hour"), "hour").alias("hour_start"))


@query("fn_retain_day", f"{W} SELECT minute, minute // 10000 * 10000 AS day_start, minute // 10000 * 10000 + 2359 AS day_end FROM (SELECT DISTINCT minute FROM svc)")
def fn_retain_day(spark, sf):
    from ..functions.timebucket import day_end, day_start

    return fr.service_rows(spark, sf).select("minute").distinct().select("minute", day_start(F.col("minute")).alias("day_start"), day_end(F.col("minute")).alias("day_end"))


@query("fn_range_parse", f"{W} SELECT event_id FROM svc WHERE ms % 86400000 < 5400000")
def fn_range_parse(spark, sf):
    from ..functions.timebucket import parse_range_ms

    return fr.service_rows(spark, sf).filter(F.col("ms") % parse_range_ms("1d") < parse_range_ms("1h30m")).select("event_id")


@query("fn_time_bucket", """SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS d, CAST(strftime(ts, '%Y%m%d%H') AS BIGINT) AS h, CAST(strftime(ts, '%Y%m%d%H%M') AS BIGINT) AS m,
CAST(strftime(ts, '%Y%m%d%H%M%S') AS BIGINT) AS s, (epoch_us(date_trunc('minute', ts)) // 1000) AS back FROM events""")
def fn_time_bucket(spark, sf):
    from ..functions.timebucket import bucket_of_millis, to_ts

    ms = F.col("ms")
    out = fr.service_rows(spark, sf).select("event_id", *[bucket_of_millis(ms, s).alias(s[0]) for s in ("day", "hour", "minute", "second")])
    return out.withColumn("back", F.unix_millis(to_ts(F.col("m"))))


@query("fn_bucket_kind", f"""{W}, b AS (SELECT DISTINCT time_bucket AS b FROM svc UNION SELECT DISTINCT minute FROM svc UNION SELECT DISTINCT time_bucket // 100 FROM svc)
SELECT b, CASE length(CAST(b AS VARCHAR)) WHEN 8 THEN 'day' WHEN 10 THEN 'hour' WHEN 12 THEN 'minute' END AS kind FROM b""")
def fn_bucket_kind(spark, sf):
    from ..functions.timebucket import coarsen, kind_of

    s = fr.service_rows(spark, sf)
    b = s.select(F.explode(F.array("time_bucket", "minute", coarsen(F.col("time_bucket")))).alias("b")).distinct()
    return b.withColumn("kind", kind_of(F.col("b")))


@query("fn_label_codec", f"{W} SELECT DISTINCT '{{a=' || endpoint || ',b=' || instance || '}}' AS text, endpoint AS a, instance AS b, CASE WHEN endpoint = 'click' THEN 'raw' END AS other FROM svc")
def fn_label_codec(spark, sf):
    rows = fr.service_rows(spark, sf).select("endpoint", "instance").distinct()
    text = L.encode(F.create_map(F.lit("b"), F.col("instance"), F.lit("a"), F.col("endpoint")))
    back = L.decode(F.col("text"))
    raw = L.decode(F.when(F.col("endpoint") == "click", "raw").otherwise("{}"))
    return rows.withColumn("text", text).select("text", back["a"].alias("a"), back["b"].alias("b"), F.try_element_at(raw, F.lit("_")).alias("other"))


@query("fn_table_codec", f"""{W}, c AS (SELECT name, endpoint, count(*) AS n FROM svc GROUP BY ALL)
SELECT name, string_agg(endpoint || ',' || n, '|' ORDER BY endpoint) AS text, CAST(sum(n) AS BIGINT) AS total FROM c GROUP BY 1""")
def fn_table_codec(spark, sf):
    counts = fr.service_rows(spark, sf).groupBy("name", "endpoint").agg(F.count(F.lit(1)).alias("n"))
    tables = counts.groupBy("name").agg(F.map_from_entries(F.collect_list(F.struct("endpoint", "n"))).alias("t"))
    text = L.table_encode(F.col("t"))
    total = F.aggregate(F.map_values(L.table_decode(text)), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return tables.select("name", text.alias("text"), total.alias("total"))


@query("fn_table_merge", f"""{W}, a AS (SELECT name, endpoint, CAST(count(*) FILTER (status) AS BIGINT) AS x, CAST(count(*) FILTER (type = 'HTTP') AS BIGINT) AS y FROM svc GROUP BY ALL)
SELECT name, endpoint, CASE WHEN x > 0 THEN x ELSE 0 END + CASE WHEN y > 0 THEN y ELSE 0 END AS total, greatest(nullif(x, 0), nullif(y, 0)) AS hi, least(nullif(x, 0), nullif(y, 0)) AS lo FROM a WHERE x > 0 OR y > 0""")
def fn_table_merge(spark, sf):
    rows = fr.service_rows(spark, sf)
    side = lambda cond, out: (rows.filter(cond).groupBy("name", "endpoint").agg(F.count(F.lit(1)).alias("n")).groupBy("name")
                              .agg(F.map_from_entries(F.collect_list(F.struct("endpoint", "n"))).alias(out)))
    both = side("status", "x").join(side("type = 'HTTP'", "y"), "name")
    tables = [L.table_merge(F.col("x"), F.col("y"), h) for h in ("sum", "max", "min")]
    flat_rows = both.select("name", F.explode(tables[0]).alias("endpoint", "total"), tables[1].alias("h"), tables[2].alias("l"))
    return flat_rows.select("name", "endpoint", "total", F.col("h")[F.col("endpoint")].alias("hi"), F.col("l")[F.col("endpoint")].alias("lo"))


# ---- catalog ----

@query("q_list_metrics", f"""{W} SELECT 'endpoint_' || m AS metric, t AS type FROM (VALUES ('cpm', 'COMMON_VALUE'), ('resp_time', 'COMMON_VALUE'), ('sla', 'COMMON_VALUE'),
('percentile', 'LABELED_VALUE'), ('mq_consume_latency', 'COMMON_VALUE')) v(m, t) WHERE m <> 'mq_consume_latency' OR EXISTS (SELECT 1 FROM svc WHERE type = 'MQ')""")
def q_list_metrics(spark, sf):
    """Shipped metrics of the event tables' kind: the catalog joined with the metrics that the data gives."""
    from ..operators import rules as R

    data = R.run(fr.service_rows(spark, sf).withColumn("tag", F.create_map(F.lit("transmission.latency"), F.col("k").cast("string"))),
                 catalog.by_source("endpoint")).select("metric").distinct()
    return promql.metric_metadata(catalog.frame(spark).join(data, "metric", "left_semi"), "^endpoint_.*")
