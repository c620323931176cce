"""Profiles, span trees, topologies, hierarchies and name patterns."""

import random

import pytest
from pyspark.sql import functions as F

from lookout.functions import ids
from lookout.operators import hierarchy as H
from lookout.operators import naming, profiles, topology
from lookout.operators import traces as T
from lookout.sources import zipkin

from conftest import SF, rows


def paths(df, *cols):
    return {r["p"]: tuple(r[c] for c in cols) for r in df.select(F.array_join("path", ">").alias("p"), *cols).collect()}


def snapshots(spark, stacks):
    return spark.createDataFrame([("s", i, i * 10, st.split("-")) for i, st in enumerate(stacks)], "segment_id string, sequence bigint, dump_time bigint, stack array<string>")


def test_thread_snapshots(spark):
    got = paths(profiles.flame_from_snapshots(snapshots(spark, ["A-B-C", "A-B", "A-B-C-D"])), "count", "duration", "self_duration")
    assert got == {"A": (3, 20, 0), "A>B": (3, 20, 20), "A>B>C": (2, 0, 0), "A>B>C>D": (1, 0, 0)}


def test_two_roots(spark):
    got = paths(profiles.flame_from_snapshots(snapshots(spark, ["A-B-C", "B-C-D"])), "count", "duration", "self_duration")
    assert got == {p: (1, 0, 0) for p in ("A", "A>B", "A>B>C", "B", "B>C", "B>C>D")}


def kernel(spark, stacks):
    data = [(i, int(s.split(":")[0]), s.split(":")[1].split("-")) for i, s in enumerate(stacks)]
    return spark.createDataFrame(data, "upload_time bigint, dump_count bigint, stack array<string>")


def test_kernel_stacks(spark):
    assert paths(profiles.flame_kernel(kernel(spark, ["3:A-B-C", "5:A-B", "3:A-B"])), "weight") == {"A": (11,), "A>B": (11,), "A>B>C": (3,)}
    got = paths(profiles.flame_kernel(kernel(spark, ["2:A-B-C", "3:A-C-B", "4:A-B-A"])), "weight")
    assert got == {"A": (9,), "A>B": (6,), "A>B>C": (2,), "A>B>A": (4,), "A>C": (3,), "A>C>B": (3,)}


def test_repeated_kernel_reports_count_once(spark):
    df = kernel(spark, ["3:A-B"]).unionByName(kernel(spark, ["3:A-B"]))
    assert paths(profiles.flame_kernel(df), "weight") == {"A": (3,), "A>B": (3,)}


@pytest.mark.parametrize("seed,chunk", [(0, 3), (1, 7), (2, 1), (3, 1000)])
def test_islands_do_not_depend_on_chunks(spark, seed, chunk):
    rnd = random.Random(seed)
    seqs = sorted(rnd.sample(range(60), 40))
    df = spark.createDataFrame([("k", s, s * 7) for s in seqs], "k string, sequence bigint, dump_time bigint")
    want, start, prev = 0, None, None
    for s in seqs + [None]:
        if prev is None or s != prev + 1:
            want += 0 if prev is None else (prev - start) * 7
            start = s
        prev = s
    assert rows(profiles.island_duration(df, ["k"], chunk=chunk), "duration", "count") == [(want, 40)]


def test_go_profile_gets_a_virtual_root(spark):
    df = spark.createDataFrame([("s", ["a", "b"], 2), ("s", ["c"], 3)], "segment_id string, stack array<string>, samples bigint")
    got = paths(profiles.flame_go(df, 10), "count", "duration", "self_duration")
    assert got == {"root": (5, 50, 0), "root>a": (2, 20, 0), "root>a>b": (2, 20, 20), "root>c": (3, 30, 30)}


# ---- span trees ----

REFS = T.REFS_TYPE


def tree(spark, data):
    """(segment, span, parent, start, parent segment of a reference)"""
    df = spark.createDataFrame([("t", *d) for d in data], "trace_id string, segment_id string, span_id int, parent_span_id int, start_time bigint, ref string")
    ref = F.from_json(F.when(F.col("ref").isNotNull(), F.concat(F.lit('[{"parent_segment_id":"'), F.split("ref", "/")[0], F.lit('","parent_span_id":'), F.split("ref", "/")[1], F.lit("}]"))), REFS)
    return T.with_keys(df.withColumn("refs", F.coalesce(ref, F.from_json(F.lit("[]"), REFS))))


def listing(df):
    found = [[r["span_key"] for r in T.order_tree(df, together=n).orderBy("trace_id", "position").collect()] for n in (10_000, 0)]
    assert found[0] == found[1]
    return found[0]


def test_tree_is_listed_depth_first(spark):
    df = tree(spark, [("a", 0, -1, 1, None), ("a", 2, 0, 9, None), ("a", 1, 0, 5, None), ("b", 0, -1, 6, "a/1"), ("b", 1, 0, 7, None), ("z", 0, -1, 0, "lost/4")])
    assert listing(df) == ["zS0", "aS0", "aS1", "bS0", "bS1", "aS2"]


def test_deep_chain_and_cycle(spark):
    chain = [("a", i, i - 1, i, None) for i in range(70)]
    cycle = [("c", 0, -1, 1, "d/0"), ("d", 0, -1, 2, "c/0"), ("d", 1, 0, 3, None)]
    assert listing(tree(spark, chain + cycle)) == [f"aS{i}" for i in range(70)]


@pytest.mark.parametrize("together", [10_000, 2])
def test_deep_and_wide_trees_and_pages(spark, together):
    n = 10_000
    i = F.col("id").cast("int")
    chain = spark.range(n).select(F.lit("deep").alias("trace_id"), F.lit("a").alias("segment_id"), i.alias("span_id"), (i - 1).alias("parent_span_id"), F.lit(0).cast("bigint").alias("start_time"))
    wide = spark.range(n).select(F.lit("wide").alias("trace_id"), F.lit("a").alias("segment_id"), i.alias("span_id"), F.when(i == 0, -1).otherwise(0).alias("parent_span_id"), (n - F.col("id")).alias("start_time"))
    df = T.with_keys(chain.unionByName(wide).withColumn("refs", F.from_json(F.lit("[]"), REFS)))
    got = T.order_tree(df, together=together).cache()
    assert got.count() == 2 * n
    assert got.filter("trace_id = 'deep' and (position <> span_id + 1 or depth <> span_id + 1)").count() == 0
    assert got.filter(f"trace_id = 'wide' and (position <> if(span_id = 0, 1, {n} - span_id + 1) or depth <> if(span_id = 0, 1, 2))").count() == 0
    got.unpersist()
    page = T.order_tree(df, spark.createDataFrame([("wide",), ("none",)], "trace_id string"))
    assert page.count() == n and rows(page.select("trace_id").distinct()) == [("wide",)]
    assert rows(page.filter("span_id in (0, 1)"), "span_id", "position", "depth") == [(0, 1, 1), (1, n, 2)]


@pytest.mark.parametrize("together", [10_000, 30, 0])
def test_random_forests_equal_a_walk(spark, together):
    import random

    rng = random.Random(4)
    data = [(f"t{rng.randint(0, 3)}", f"s{rng.randint(0, 2)}", i, rng.randint(-1, i + 2), rng.randint(0, 9)) for i in range(120)]
    data = [(t, s, i, -1 if p >= i else p, st) for t, s, i, p, st in data]
    df = spark.createDataFrame(data, "trace_id string, segment_id string, span_id int, parent_span_id int, start_time bigint")
    keyed = T.with_keys(df.withColumn("refs", F.from_json(F.lit("[]"), REFS)))
    want = {}
    for t in {d[0] for d in data}:
        spans = {(s, i): (st, s, i, p) for tt, s, i, p, st in data if tt == t}
        kids = {}
        for (s, i), (st, _, _, p) in spans.items():
            kids.setdefault((s, p) if (s, p) in spans else None, []).append((st, s, i))
        count = [0]

        def walk(node, depth):
            for st, s, i in sorted(kids.get(node, [])):
                count[0] += 1
                want[t, s, i] = (count[0], depth)
                walk((s, i), depth + 1)
        walk(None, 1)
    got = {(r.trace_id, r.segment_id, r.span_id): (r.position, r.depth) for r in T.order_tree(keyed, together=together).collect()}
    assert got == want


def test_set_algebra_reads_spans_once(spark):
    from lookout.operators import traceql as q

    df = spark.createDataFrame([("x", "a", False), ("x", "b", True), ("y", "a", True), ("z", "c", True), ("w", "d", False)], "trace_id string, service string, is_error boolean")
    got = q.traces_where(df, {"a": q.field("service", "=", "a"), "b": q.field("service", "=", "b"), "bad": q.all_of(q.field("service", "=", "c"), q.status("=", "error"))},
                         lambda a, b, bad: (a & b) | bad)
    assert rows(got) == [("x",), ("z",)]
    assert rows(q.traces_where(df, {"a": q.field("service", "=", "a"), "b": q.field("service", "=", "b")}, lambda a, b: a & ~b)) == [("y",)]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") + got._jdf.queryExecution().optimizedPlan().toString().count("LocalRelation") == 1
    tagged = spark.createDataFrame([("k", ["a", "b"]), ("k", ["c"]), ("l", ["a"])], "key string, tags array<string>")
    assert rows(T.with_tags(tagged, "tags", ["a", "c", "a"], "key")) == [("k",)] and T.with_tags(tagged, "tags", ["a", "b"]).count() == 1


def test_segment_rows_from_spans_equal_those_from_segments(spark):
    from lookout.plans import frames as fr

    s = fr.spans(spark, "/root/testdata/sf0.001").withColumn("service", F.lit("g")).withColumn("instance", F.lit("i"))
    for mode in ("any", "first", "entry"):
        one, other = T.segment_rows_of(s, error_mode=mode), T.segment_rows(T.gather_segments(s), error_mode=mode)
        assert one.columns == other.columns
        assert rows(one) == rows(other.withColumn("tags", F.sort_array("tags")).withColumn("is_error", F.coalesce("is_error", F.lit(False))))


SEARCH_SPANS = [("t1", "s", "svc", "i", n, n // 2, 100 + n, 140 + 3 * n, f"/op{n}", "peer", "Entry" if n % 3 == 0 else "Exit", "Http", n, n == 4, False,
                 [("http.status_code", str(200 + n)), ("db.statement", "x" * 300), ("db.type", "y" * 300), ("mq.topic", None)] if n != 7 else [], [])
                for n in range(8)] + [("t2", "s2", "svc", "i", 0, -1, 5, 9, "/a", "", "Entry", "Http", 0, None, False, None, [])]


def _search_spans(spark):
    return spark.createDataFrame(SEARCH_SPANS, "trace_id string, segment_id string, service string, instance string, span_id int, parent_span_id int, start_time bigint, end_time bigint, "
                                 f"operation string, peer string, span_type string, span_layer string, component_id int, is_error boolean, skip_analysis boolean, tags {T.TAGS_TYPE}, refs {T.REFS_TYPE}")


def test_only_what_a_search_reads_is_gathered(spark):
    s = _search_spans(spark)
    whole = T.segment_rows(T.gather_segments(s))
    assert rows(T.segment_rows(T.gather_segments(T.searched(s)))) == rows(whole)
    untagged = T.segment_rows(T.gather_segments(T.searched(s, tags=False)))
    assert untagged.columns == whole.columns[:-1] and rows(untagged) == rows(whole.drop("tags"))


@pytest.mark.parametrize("name,unread", [("src_spans", ("refs", "tags")), ("sort_trace", ("refs", "tags")), ("tr_sampling", ("refs", "tags")),
                                         ("fn_tags_search", ("refs",)), ("sink_kafka_trace", ("refs",))])
def test_unread_fields_of_spans_are_not_shuffled(spark, name, unread):
    from lookout.plans import registry

    registry.load()
    plan = registry.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    built = {"refs": "CrossProcess", "tags": "db.statement"}
    assert "collect_list" in plan and not any(built[c] in plan for c in unread)


def test_kafka_gets_whole_segments(spark):
    from lookout.sinks import writers

    s = _search_spans(spark).withColumn("refs", F.when(F.col("span_id") == 3, F.array(F.struct(*[F.lit(str(n)).alias(c) if c != "parent_span_id" else F.lit(n).alias(c) for n, c in enumerate(
        ("ref_type", "trace_id", "parent_segment_id", "parent_span_id", "parent_service", "parent_instance", "parent_endpoint", "network_address"))]))).otherwise(F.col("refs")))
    segments = T.gather_segments(s)
    sent = writers.kafka_traces(T.segment_rows(segments, whole=True))
    back = sent.select("key", F.from_json("value", segments.schema).alias("s")).select("key", "s.*")
    assert rows(back, "key", *segments.columns) == rows(segments.select(F.col("segment_id").alias("key"), *segments.columns)) and sent.count() == 2
    row = T.segment_rows(segments)
    assert rows(sent.select(F.from_json("value", row.schema).alias("r")).select("r.*")) == rows(row)
    assert rows(writers.kafka_traces(T.segment_rows(segments, whole=True), errors_only=True)) == [r for r in rows(sent) if r[0] == "s"]


def test_kafka_messages_of_the_query_hold_all_spans(spark, tmp_path):
    import json
    from datetime import datetime

    import duckdb
    from lookout.plans import registry

    registry.load()
    day = datetime(2024, 1, 2)
    tables = {"orders": (" o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_orderpriority string, o_orderstatus string",
                         [(1, 21, day, "1-URGENT", "F"), (2, 22, day, "5-LOW", "O"), (3, 23, day, "2-HIGH", "O"), (4, 24, day, "3-MEDIUM", "F")]),
              "lineitem": ("l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_returnflag string",
                           [(1, n, 50 + n, 30 + n, 5.0 + n, "N") for n in range(1, 7)] + [(1, 6, 56, 36, 11.0, "N")] + [(2, n, 9 * n, n, 1.0, "R" if n == 3 else "A") for n in range(1, 5)] + [(3, 1, 7, 8, 9.0, "N")])}
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name, (schema, data) in tables.items():
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    got = registry.QUERIES["sink_kafka_trace"](spark, str(tmp_path))
    assert got.columns == ["key", "value"]
    messages = dict(rows(got))
    assert messages == dict(con.execute(registry.ORACLE["sink_kafka_trace"]).fetchall())
    spans = {k: json.loads(v)["spans"] for k, v in messages.items()}
    assert {k: len(v) for k, v in spans.items()} == {"t1.a": 8, "t2.a": 5, "t4.a": 1}
    assert all(tuple(x) == T.SPAN_FIELDS and len(x["tags"]) == 7 for v in spans.values() for x in v)
    assert [[r["parent_service"] for r in x["refs"]] for x in spans["t1.a"]] == [[], [], [], ["cust_13"], [], [], ["cust_16"], []]


def test_spans_that_are_written_are_the_same_and_not_moved_again(spark):
    from lookout.plans import frames

    text = lambda df: rows(df.select(F.to_json(F.struct("*"))))
    want = text(frames.spans(spark, SF))
    few, many = frames.stored_spans(spark, SF), frames.stored_spans(spark, SF, 100)
    assert text(few) == text(many) == want and many.columns == frames.spans(spark, SF).columns
    segments = T.gather_segments(many)
    assert "Exchange" not in segments._jdf.queryExecution().executedPlan().toString()
    assert segments.count() == T.gather_segments(few).count() and not [t for t in spark.catalog.listTables() if t.name.startswith("round_")]


def test_lines_of_many_orders_are_dealt_over_bounded_parts(spark):
    from lookout.plans import frames

    n = frames.table(spark, SF, "lineitem").count()
    few, many = frames.lines_by_order(spark, SF), frames.lines_by_order(spark, SF, n // 40)
    exchange = "REPARTITION_BY_NUM"
    assert exchange not in few._jdf.queryExecution().toString() and exchange in many._jdf.queryExecution().toString()
    assert many.rdd.getNumPartitions() == -(-n // (n // 40)) and rows(many) == rows(few)
    parts = many.select("l_orderkey", F.spark_partition_id().alias("p")).distinct()
    assert parts.count() == many.select("l_orderkey").distinct().count()


def test_spans_of_dealt_lines_are_the_same(spark, monkeypatch):
    from lookout.plans import frames

    whole = rows(frames.spans(spark, SF).select("trace_id", "span_id", "service", "operation", "is_error"))
    plain = frames.lines_by_order
    monkeypatch.setattr(frames, "lines_by_order", lambda s, sf: plain(s, sf, 100))
    dealt = frames.spans(spark, SF)
    assert "REPARTITION_BY_NUM" in dealt._jdf.queryExecution().toString()
    assert rows(dealt.select("trace_id", "span_id", "service", "operation", "is_error")) == whole


def test_dealt_spans_are_gathered_where_they_are_made(spark, monkeypatch):
    from lookout.operators import traces as T
    from lookout.plans import frames

    text = lambda df: rows(df.select("trace_id", F.to_json("spans")))
    whole = text(T.gather_segments(frames.spans(spark, SF)))
    for name in ("lines_by_order", "orders_by_trace"):
        monkeypatch.setattr(frames, name, lambda s, sf, plain=getattr(frames, name): plain(s, sf, 100))
    dealt = T.gather_segments(frames.spans(spark, SF))
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" in plan and "REPARTITION_BY_NUM" in plan and "ENSURE_REQUIREMENTS" not in plan
    assert text(dealt) == whole


def test_a_page_of_traces_is_found_once(spark):
    from lookout.plans import registry

    registry.load()
    got = registry.QUERIES["q_trace_page"](spark, SF)
    assert "collect_list" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert got.select("trace_id").distinct().count() == 10


# ---- lookups with uneven keys ----

def test_heavy_keys_are_dealt_over_tasks(spark):
    from lookout.plans.runtime import lookup_join

    rows_ = spark.range(40_000).select(F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string"))).alias("k"), "id")
    table = spark.range(997).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), F.col("id").alias("v")).unionByName(spark.createDataFrame([("hot", -1)], "k string, v bigint"))
    want = rows(rows_.join(table, "k", "left"))
    assert rows(lookup_join(rows_, table, ["k"])) == want  # broadcast
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for c, v in zip(before, ("false", "16", "-1")):
            spark.conf.set(c, v)
        salted = lookup_join(rows_, table, ["k"], broadcast_rows=10, fraction=0.5)
        per = sorted(r["count"] for r in salted.groupBy(F.spark_partition_id()).count().collect())
        assert len(per) == 16 and per[-1] < 3 * 40_000 / 16
        plain = sorted(r["count"] for r in rows_.join(table, "k", "left").groupBy(F.spark_partition_id()).count().collect())
        assert plain[-1] > 20_000
        assert rows(salted) == want
        assert rows(lookup_join(rows_, table, ["k"], "inner", broadcast_rows=0, fraction=0.5)) == rows(rows_.join(table, "k"))
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    with pytest.raises(ValueError):
        lookup_join(rows_, table, ["k"], "full")


# ---- topologies ----

def sid(name, normal=True):
    import base64

    return base64.b64encode(name.encode()).decode() + (".1" if normal else ".0")


def test_client_and_server_sides_are_merged(spark):
    e = spark.createDataFrame([("client", sid("a"), sid("b"), 1), ("server", sid("a"), sid("b"), 2), ("client", sid("b"), sid("db:3306", False), 3), ("server", sid("User", False), sid("a"), 4)],
                              "side string, source string, target string, component_id int")
    comp = spark.createDataFrame([(1, "Feign", "x", 0), (2, "SpringMVC", "x", 0), (3, "mysql-connector", "Mysql", 0), (4, "Tomcat", "x", 0)], "component_id int, component string, server_name string, priority int")
    nodes, calls = topology.service_map(e, components=comp)
    assert rows(nodes, "name", "type", "is_real") == [("User", "USER", False), ("a", "Tomcat", True), ("b", "SpringMVC", True), ("db:3306", "Mysql", False)]
    merged = calls.filter(F.col("source") == sid("a")).first()
    assert (merged["detect_points"], merged["source_components"], merged["target_components"]) == (["client", "server"], ["Feign"], ["SpringMVC"])


def test_higher_priority_component_names_the_node(spark):
    e = spark.createDataFrame([("server", sid("a"), sid("b"), 1), ("server", sid("a"), sid("b"), 2)], "side string, source string, target string, component_id int")
    comp = spark.createDataFrame([(1, "low", "x", 0), (2, "high", "x", 9)], "component_id int, component string, server_name string, priority int")
    assert rows(topology.service_nodes(e, comp).filter("type is not null"), "type") == [("high",)]


def test_aliases_and_outside_callers(spark):
    e = spark.createDataFrame([("client", sid("a"), sid("1.2.3.4:80"), 1), ("server", sid("g"), sid("a"), 7)], "side string, source string, target string, component_id int")
    alias = spark.createDataFrame([("1.2.3.4:80", "b", "i", 1)], "address string, alias_service string, alias_instance string, time_bucket bigint")
    assert rows(topology.resolve_aliases(e, alias), "target") == [(sid("a"),), (sid("b"),)]
    nodes, calls = topology.service_map(e, [sid("1.2.3.4:80")])
    assert calls.count() == 1 and rows(nodes.filter(F.col("name") == "a"), "type") == [("7",)]


# ---- hierarchies ----

def test_matching_rules(spark):
    svc = spark.createDataFrame([("a::order", "GENERAL"), ("order.ns.x", "K8S_SERVICE"), ("order.ns", "K8S_SERVICE"), ("order", "K8S_SERVICE"), ("db.ns.svc.cluster.local:3306", "VIRTUAL_DATABASE"), ("x::db.ns", "MYSQL")],
                                "name string, layer string")
    assert rows(H.match_services(svc), "upper", "lower") == [("a::order", "order.ns"), ("db.ns.svc.cluster.local:3306", "x::db.ns")]


def test_relations_that_follow_are_dropped(spark):
    rel = spark.createDataFrame([("g", "GENERAL", "a", "APISIX"), ("a", "APISIX", "k", "K8S_SERVICE"), ("g", "GENERAL", "k", "K8S_SERVICE"), ("g", "GENERAL", "k2", "K8S_SERVICE")],
                                "upper string, upper_layer string, lower string, lower_layer string")
    assert rows(H.reduce_relations(rel), "upper", "lower") == [("a", "k"), ("g", "a"), ("g", "k2")]


# ---- names ----

def brute_match(patterns, uri):
    """A tree of tokens walked greedily in definition order."""
    root = []

    def child(nodes, tok, var):
        for n in nodes:
            if n["var"] == var and (var or n["tok"] == tok):
                return n
        n = {"tok": tok, "var": var, "kids": [], "expr": None}
        nodes.append(n)
        return n

    for p in patterns:
        nodes = root
        for i, tok in enumerate(naming.split_pattern(p)):
            node = child(nodes, tok, tok == "{var}" and i > 0)
            nodes = node["kids"]
        node["expr"] = p
    toks = naming.split_pattern(uri)
    if len(toks) == 1:
        return True, uri
    nodes, node = root, None
    for tok in toks:
        node = next((n for n in nodes if n["var"] or n["tok"] == tok), None)
        if node is None:
            return False, uri
        nodes = node["kids"]
    return (True, node["expr"]) if node["expr"] else (False, uri)


@pytest.mark.parametrize("seed", range(3))
def test_patterns_equal_the_tree_walk(spark, seed):
    rnd = random.Random(seed)
    tok = lambda: rnd.choice(["a", "b", "{var}"])
    patterns = ["/" + "/".join([rnd.choice("ab")] + [tok() for _ in range(rnd.randint(1, 3))]) for _ in range(8)]
    uris = ["/" + "/".join(rnd.choice("abc") for _ in range(rnd.randint(1, 5))) for _ in range(60)] + ["/a/", "/a/b/", "x", "/a//b"]
    df = spark.createDataFrame([("s", u) for u in uris], "service string, endpoint string")
    got = {r["endpoint"]: (r["matched"], r["formatted"]) for r in naming.match_patterns(df, [("s", p) for p in patterns]).collect()}
    assert got == {u: brute_match(patterns, u) for u in uris}


def test_names_beyond_the_cap_are_abandoned(spark):
    df = spark.createDataFrame([("s", "/x/1", 1), ("s", "/x/2", 2), ("s", "/x/3", 3), ("s", "/v/9", 4)], "service string, endpoint string, ts bigint")
    out = naming.group_endpoints(df, patterns=[("s", "/v/{var}")], max_unformatted=2)
    assert rows(out, "ts", "formatted") == [(1, "/x/1"), (2, "/x/2"), (3, "_abandoned"), (4, "/v/{var}")]


def test_many_regex_rules_use_a_join(spark):
    df = spark.createDataFrame([("s7", "/a/1", 1), ("s7", "/b", 2)], "service string, endpoint string, ts bigint")
    rules = [(f"s{i}", r"/a/\d+", f"/a{i}") for i in range(300)]
    assert rows(naming.match_regex(df, rules), "formatted") == [("/a7",), ("/b",)]


# ---- span sampling ----

def test_span_sampling_keeps_debug_and_whole_traces(spark):
    data = [(f"{i:032x}", str(i), i % 50 == 0, 1000 * i) for i in [2 ** 62 + 5, 2 ** 63 + 9, 2 ** 64 - 1, 7, 50, 100]]
    df = spark.createDataFrame([(t, s, d, 1_000_000) for t, s, d, _ in data], "trace_id string, span_id string, debug boolean, timestamp_us bigint")
    def magnitude(i):
        return abs(i - 2 ** 64) if i >= 2 ** 63 else i
    want = sorted(s for t, s, d, _ in data if d or magnitude(int(t, 16)) <= int((2 ** 63 - 1) * 0.25))
    assert sorted(r["span_id"] for r in zipkin.sample(df, 2500).collect()) == want
    capped = zipkin.sample(df, max_per_second=2)
    assert capped.count() == 2 + 2
