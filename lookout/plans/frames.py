"""The driver's tables as engine frames, once in Spark and once as SQL common table expressions.

All derived values are exact integers or texts, so both sides agree bit for bit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.timebucket import bucket_of
from .runtime import stored, stored_by


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _ms(c: str):
    return F.unix_millis(F.col(c).cast("timestamp"))


def service_rows(spark, sf, events: DataFrame | None = None) -> DataFrame:
    """One row per event: a call of ``endpoint`` on ``instance`` of service ``name``. ``time_bucket`` is the hour.

    ``events``: the same table as a stream."""
    e = table(spark, sf, "events") if events is None else events
    k = F.regexp_extract("props", r"(\d+)", 1).cast("bigint")
    d = k % 10
    kind = F.when(d == 0, "MQ").when(d < 4, "HTTP").otherwise("RPC")
    return e.select(
        "event_id", "ts", "user_id", _ms("ts").alias("ms"), F.concat(F.lit("svc_"), (F.col("user_id") % 10).cast("string")).alias("name"),
        F.concat(F.lit("i_"), (F.col("user_id") % 30).cast("string")).alias("instance"), F.col("event_type").alias("endpoint"),
        F.floor(F.col("value") * 10).cast("bigint").alias("latency"), (F.col("event_type") != "error").alias("status"), k.alias("k"),
        F.when(d == 0, 500).when(d == 1, 404).otherwise(200).alias("http_status"), kind.alias("type"),
        F.concat(F.lit("svc_"), (F.col("user_id") % 10).cast("string")).alias("entity_id"), bucket_of(F.col("ts"), "hour").alias("time_bucket"),
        bucket_of(F.col("ts"), "minute").alias("minute"))


SVC = r"""svc AS (SELECT event_id, ts, user_id, (epoch_us(ts) // 1000) AS ms, 'svc_' || (user_id % 10) AS name, 'i_' || (user_id % 30) AS instance,
  event_type AS endpoint, CAST(floor(value * 10) AS BIGINT) AS latency, event_type <> 'error' AS status,
  CAST(regexp_extract(props, '(\d+)', 1) AS BIGINT) AS k,
  CASE CAST(regexp_extract(props, '(\d+)', 1) AS BIGINT) % 10 WHEN 0 THEN 500 WHEN 1 THEN 404 ELSE 200 END AS http_status,
  CASE WHEN CAST(regexp_extract(props, '(\d+)', 1) AS BIGINT) % 10 = 0 THEN 'MQ' WHEN CAST(regexp_extract(props, '(\d+)', 1) AS BIGINT) % 10 < 4 THEN 'HTTP' ELSE 'RPC' END AS type,
  'svc_' || (user_id % 10) AS entity_id,
  CAST(strftime(ts, '%Y%m%d%H') AS BIGINT) AS time_bucket, CAST(strftime(ts, '%Y%m%d%H%M') AS BIGINT) AS minute FROM events)"""


def relation_rows(spark, sf) -> DataFrame:
    """One row per line item: customer service calls supplier service; the line number says who saw it. Day buckets."""
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    j = li.join(o.select("o_orderkey", "o_custkey"), li.l_orderkey == o.o_orderkey)
    return j.select(
        F.concat(F.lit("cust_"), (F.col("o_custkey") % 20).cast("string")).alias("source"),
        F.concat(F.lit("supp_"), (F.col("l_suppkey") % 10).cast("string")).alias("target"),
        F.when(F.col("l_linenumber") % 2 == 0, "CLIENT").otherwise("SERVER").alias("detect_point"),
        F.col("l_linenumber").alias("component_id"), F.col("l_quantity").cast("bigint").alias("latency"),
        (F.col("l_returnflag") != "R").alias("status"), bucket_of(F.col("l_shipdate"), "day").alias("time_bucket"))


REL = """rel AS (SELECT 'cust_' || (o_custkey % 20) AS source, 'supp_' || (l_suppkey % 10) AS target,
  CASE WHEN l_linenumber % 2 = 0 THEN 'CLIENT' ELSE 'SERVER' END AS detect_point, l_linenumber AS component_id,
  CAST(l_quantity AS BIGINT) AS latency, l_returnflag <> 'R' AS status, CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) AS time_bucket
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def samples(spark, sf) -> DataFrame:
    """Gauge samples named by event type, labelled by service and instance."""
    e = service_rows(spark, sf)
    return e.select(F.col("endpoint").alias("name"), F.create_map(F.lit("svc"), F.col("name"), F.lit("inst"), F.col("instance")).alias("labels"),
                    F.col("ms").alias("ts"), F.col("latency").cast("double").alias("value"), F.col("event_id").alias("seq"), "time_bucket",
                    (F.floor(F.col("ms") / 3_600_000) * 3_600_000).cast("bigint").alias("scrape"))


SAMPLES = SVC + """, samples AS (SELECT endpoint AS name, name AS svc, instance AS inst, ms AS ts, CAST(latency AS DOUBLE) AS value,
  event_id AS seq, time_bucket, (ms // 3600000) * 3600000 AS scrape FROM svc)"""


#: a total order of an order's lines; lines that tie are alike in all columns that spans use
LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
#: lines that one task makes spans of, about; adaptive execution would go by the bytes of lines, and spans are ten times wider
LINES_TOGETHER = 1 << 18


def _trace(key: str):
    return F.concat(F.lit("t"), F.col(key).cast("string")).alias("trace_id")


def _parts(spark, sf, together: int) -> int:
    """Above ``together`` lines a core, the number of parts that hold about so many; else 0."""
    parts = -(-table(spark, sf, "lineitem").count() // together)
    return max(parts, int(spark.conf.get("spark.sql.shuffle.partitions"))) if parts > spark.sparkContext.defaultParallelism else 0


def _by_trace(spark, sf, df: DataFrame, together: int) -> DataFrame:
    """Above ``together`` lines a core, ``df`` dealt by trace over so many parts that what a task makes, sorts and gathers of their
    spans stays in memory, however large the tables are."""
    parts = _parts(spark, sf, together)
    return df.repartition(parts, "trace_id") if parts else df


def lines_by_order(spark, sf, together: int = LINES_TOGETHER) -> DataFrame:
    """The lines of orders with the columns that spans use and the trace of their order, by which many are dealt."""
    return _by_trace(spark, sf, table(spark, sf, "lineitem").select("l_orderkey", *LINE_ORDER, _trace("l_orderkey")), together)


def orders_by_trace(spark, sf, together: int = LINES_TOGETHER) -> DataFrame:
    """The orders with the columns that spans use, dealt as their lines are: all spans of a trace are made in one part, where they
    can be gathered without being moved."""
    orders = table(spark, sf, "orders").select(_trace("o_orderkey"), "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    return _by_trace(spark, sf, orders, together)


def spans(spark, sf) -> DataFrame:
    """One span per line item of an order (= trace). Line numbers repeat, so a line's rank within its order is its span id.

    Span n hangs under span n/2; span 0 (the order itself) is the root. Times are ms from the order date.
    """
    li, o = lines_by_order(spark, sf), orders_by_trace(spark, sf)
    rank = F.row_number().over(Window.partitionBy("trace_id").orderBy(*LINE_ORDER))
    line = li.select("trace_id", rank.alias("l_linenumber"), F.struct("l_partkey", "l_suppkey", "l_quantity", "l_returnflag").alias("x"))
    start = _ms("o_orderdate")
    trace = F.col("trace_id")
    layer = F.element_at(F.array(*[F.lit(x) for x in ("Http", "Database", "MQ", "RPCFramework", "Cache")]), (F.col("l_linenumber") % 5 + 1).cast("int"))
    child = line.join(o.select("trace_id", "o_orderdate"), "trace_id")
    kids = child.select(
        trace, F.concat(trace, F.lit(".a")).alias("segment_id"),
        F.concat(F.lit("supp_"), (F.col("x.l_suppkey") % 10).cast("string")).alias("service"),
        F.concat(F.lit("i_"), (F.col("x.l_suppkey") % 30).cast("string")).alias("instance"), F.col("l_linenumber").cast("int").alias("span_id"),
        F.floor(F.col("l_linenumber") / 2).cast("int").alias("parent_span_id"), (start + F.col("l_linenumber") * 1000).alias("start_time"),
        (start + F.col("l_linenumber") * 1000 + F.col("x.l_quantity").cast("bigint")).alias("end_time"),
        F.concat(F.lit("/part/"), (F.col("x.l_partkey") % 50).cast("string")).alias("operation"),
        F.concat(F.lit("addr_"), (F.col("x.l_suppkey") % 10).cast("string")).alias("peer"),
        F.when(F.col("l_linenumber") % 3 == 0, "Entry").when(F.col("l_linenumber") % 3 == 1, "Exit").otherwise("Local").alias("span_type"),
        layer.alias("span_layer"), F.col("l_linenumber").cast("int").alias("component_id"), (F.col("x.l_returnflag") == "R").alias("is_error"),
        F.col("x.l_partkey").alias("part"))
    root = o.select(
        trace, F.concat(trace, F.lit(".a")).alias("segment_id"), F.concat(F.lit("cust_"), (F.col("o_custkey") % 20).cast("string")).alias("service"),
        F.concat(F.lit("i_"), (F.col("o_custkey") % 30).cast("string")).alias("instance"), F.lit(0).alias("span_id"), F.lit(-1).alias("parent_span_id"),
        start.alias("start_time"), (start + 100).alias("end_time"), F.concat(F.lit("/order/"), F.substring("o_orderpriority", 1, 1)).alias("operation"),
        F.lit("").alias("peer"), F.lit("Entry").alias("span_type"), F.lit("Http").alias("span_layer"), F.lit(0).alias("component_id"),
        (F.col("o_orderstatus") == "F").alias("is_error"), F.col("o_custkey").alias("part"))
    both = root.unionByName(kids)
    tags = F.array(F.struct(F.lit("http.status_code").alias("key"), F.when(F.col("is_error"), "500").otherwise("200").alias("value")),
                   F.struct(F.lit("db.type").alias("key"), F.when(F.col("part") % 2 == 0, "MySQL").otherwise("mongodb").alias("value")),
                   F.struct(F.lit("db.statement").alias("key"), F.concat(F.lit("select "), F.col("part").cast("string")).alias("value")),
                   F.struct(F.lit("cache.type").alias("key"), F.when(F.col("part") % 2 == 0, "Redis").otherwise("memcached").alias("value")),
                   F.struct(F.lit("cache.op").alias("key"), F.when(F.col("part") % 3 == 0, "read").otherwise("write").alias("value")),
                   F.struct(F.lit("mq.topic").alias("key"), F.concat(F.lit("topic_"), (F.col("part") % 4).cast("string")).alias("value")),
                   F.struct(F.lit("transmission.latency").alias("key"), (F.col("part") % 100).cast("string").alias("value")))
    ref = F.struct(F.lit("CrossProcess").alias("ref_type"), F.col("trace_id").alias("trace_id"), F.concat("trace_id", F.lit(".a")).alias("parent_segment_id"),
                   F.col("parent_span_id").alias("parent_span_id"), F.concat(F.lit("cust_"), (F.col("part") % 20).cast("string")).alias("parent_service"),
                   F.concat(F.lit("i_"), (F.col("part") % 30).cast("string")).alias("parent_instance"),
                   F.concat(F.lit("/order/"), (F.col("part") % 5).cast("string")).alias("parent_endpoint"), F.col("peer").alias("network_address"))
    refs = F.when((F.col("span_type") == "Entry") & (F.col("span_id") > 0), F.array(ref)).otherwise(F.slice(F.array(ref), F.lit(1), F.lit(0)))
    return both.withColumn("skip_analysis", F.lit(False)).withColumn("tags", tags).withColumn("refs", refs).drop("part")


def stored_spans(spark, sf, together: int = LINES_TOGETHER) -> DataFrame:
    """:func:`spans` written once and read back, to be gathered whole; many are written in the parts that their lines are dealt over, by
    trace, and gathered there."""
    parts = _parts(spark, sf, together)
    return stored_by(spans(spark, sf), "trace_id", parts) if parts else stored(spans(spark, sf))[0]


SPANS = f"""kid AS (SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LINE_ORDER)}) AS INTEGER) AS l_linenumber,
  l_partkey AS partkey, l_suppkey AS suppkey, l_quantity AS quantity, l_returnflag AS flag FROM lineitem),
spans AS (
  SELECT 't' || o_orderkey AS trace_id, 't' || o_orderkey || '.a' AS segment_id, 'cust_' || (o_custkey % 20) AS service, 'i_' || (o_custkey % 30) AS instance,
    0 AS span_id, -1 AS parent_span_id, (epoch_us(o_orderdate) // 1000) AS start_time, (epoch_us(o_orderdate) // 1000) + 100 AS end_time,
    '/order/' || substr(o_orderpriority, 1, 1) AS operation, '' AS peer, 'Entry' AS span_type, 'Http' AS span_layer, 0 AS component_id,
    o_orderstatus = 'F' AS is_error, o_custkey AS part FROM orders
  UNION ALL
  SELECT 't' || o_orderkey, 't' || o_orderkey || '.a', 'supp_' || (suppkey % 10), 'i_' || (suppkey % 30), l_linenumber, l_linenumber // 2,
    (epoch_us(o_orderdate) // 1000) + l_linenumber * 1000, (epoch_us(o_orderdate) // 1000) + l_linenumber * 1000 + CAST(quantity AS BIGINT),
    '/part/' || (partkey % 50), 'addr_' || (suppkey % 10),
    CASE l_linenumber % 3 WHEN 0 THEN 'Entry' WHEN 1 THEN 'Exit' ELSE 'Local' END,
    CASE l_linenumber % 5 WHEN 0 THEN 'Http' WHEN 1 THEN 'Database' WHEN 2 THEN 'MQ' WHEN 3 THEN 'RPCFramework' ELSE 'Cache' END,
    l_linenumber, flag = 'R', partkey FROM kid JOIN orders ON l_orderkey = o_orderkey)"""


def logs(spark, sf) -> DataFrame:
    """One log per document, a second apart; service by source, tags by language and labels."""
    d, l = table(spark, sf, "documents"), table(spark, sf, "labels")
    j = d.join(l, "doc_id", "left")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return j.select(
        F.col("source").alias("service"), F.concat(F.lit("i_"), (F.col("doc_id") % 3).cast("string")).alias("instance"),
        F.concat(F.lit("/"), "lang").alias("endpoint"), F.lit("GENERAL").alias("layer"), (F.col("doc_id") * 1000 + 1704067200000).alias("ts"),
        F.concat(F.lit("t"), (F.col("doc_id") % 100).cast("string")).alias("trace_id"), F.concat(F.lit("g"), F.col("doc_id").cast("string")).alias("segment_id"),
        (F.col("doc_id") % 7).cast("int").alias("span_id"), F.lit("TEXT").alias("body_type"), F.col("text").alias("body"),
        F.create_map(F.lit("lang"), F.col("lang"), F.lit("level"), F.when(F.col("toxic") == 1, "ERROR").otherwise("INFO"), F.lit("quality"), text("quality")).alias("tags"),
        F.col("doc_id"))


LOGS = """logs AS (SELECT source AS service, 'i_' || (doc_id % 3) AS instance, '/' || lang AS endpoint, 'GENERAL' AS layer,
  doc_id * 1000 + 1704067200000 AS ts, 't' || (doc_id % 100) AS trace_id, 'g' || doc_id AS segment_id, CAST(doc_id % 7 AS INTEGER) AS span_id,
  text AS body, lang, CASE WHEN toxic = 1 THEN 'ERROR' ELSE 'INFO' END AS level, coalesce(CAST(quality AS VARCHAR), '') AS quality, doc_id
  FROM documents LEFT JOIN labels USING (doc_id))"""


def json_logs(spark, sf) -> DataFrame:
    """One log per event with its properties as JSON body."""
    s = service_rows(spark, sf)
    e = table(spark, sf, "events").select("event_id", "props", "event_type")
    return (s.join(e, "event_id").select(
        F.col("name").alias("service"), "instance", F.lit(None).cast("string").alias("endpoint"), F.lit("").alias("layer"), F.col("ms").alias("ts"),
        F.concat(F.lit("t"), F.col("event_id").cast("string")).alias("trace_id"), F.lit(None).cast("string").alias("segment_id"), F.lit(None).cast("int").alias("span_id"),
        F.lit("JSON").alias("body_type"), F.col("props").alias("body"), F.create_map(F.lit("kind"), F.col("event_type")).alias("tags"), "event_id"))


def stacks(spark, sf) -> DataFrame:
    """One weighted stack per part: type, brand and the words of its name as frames."""
    p = table(spark, sf, "part")
    return p.select("p_partkey", F.concat(F.array("p_type", "p_brand"), F.split("p_name", " ")).alias("stack"), F.col("p_size").cast("bigint").alias("weight"),
                    F.concat(F.lit("seg_"), (F.col("p_partkey") % 5).cast("string")).alias("segment_id"), F.col("p_partkey").alias("sequence"),
                    (F.col("p_partkey") * 10 + F.col("p_size")).alias("dump_time"))


STACKS = """stacks AS (SELECT p_partkey, [p_type, p_brand] || string_split(p_name, ' ') AS stack, CAST(p_size AS BIGINT) AS weight,
  'seg_' || (p_partkey % 5) AS segment_id, p_partkey AS sequence, p_partkey * 10 + p_size AS dump_time FROM part)"""


def usage(spark, sf) -> DataFrame:
    """One model call per conversation turn; tokens are text lengths by role."""
    c = table(spark, sf, "conversations")
    model = F.element_at(F.array(*[F.lit(m) for m in ("gpt-4o-mini-x", "gpt-4o", "claude-4-sonnet-1", "other")]), (F.col("conv_id") % 4 + 1).cast("int"))
    n = F.length("text").cast("bigint")
    return c.select("conv_id", "turn", model.alias("model"), F.when(F.col("role") == "user", n).otherwise(0).alias("input_tokens"),
                    F.when(F.col("role") == "user", 0).otherwise(n).alias("output_tokens"), (n % 1000).alias("latency"),
                    (F.col("turn") % 5 != 4).alias("status"), (F.col("turn") % 3).cast("int").alias("time_to_first_token"),
                    (202401010000 + F.col("conv_id") % 60).alias("time_bucket"))


USAGE = """usage AS (SELECT conv_id, turn, CASE conv_id % 4 WHEN 0 THEN 'gpt-4o-mini-x' WHEN 1 THEN 'gpt-4o' WHEN 2 THEN 'claude-4-sonnet-1' ELSE 'other' END AS model,
  CASE WHEN role = 'user' THEN length(text) ELSE 0 END AS input_tokens, CASE WHEN role = 'user' THEN 0 ELSE length(text) END AS output_tokens,
  length(text) % 1000 AS latency, turn % 5 <> 4 AS status, CAST(turn % 3 AS INTEGER) AS time_to_first_token, 202401010000 + conv_id % 60 AS time_bucket FROM conversations)"""


def key_text(c: str = "labels"):
    """Label map as readable text, for results."""
    return L.encode(F.col(c))
