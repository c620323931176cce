"""Sample families, counters and alarms."""

import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from lookout.functions import labels as L
from lookout.operators import alarms, counters
from lookout.operators import samples as M

from conftest import rows

SCHEMA = "name string, labels map<string,string>, ts bigint, value double, seq bigint"


def fam(spark, data):
    return spark.createDataFrame([(n, dict(l), t, v, i) for i, (n, l, t, v) in enumerate(data)], SCHEMA)


def got(df):
    return rows(df.select("name", L.encode(F.col("labels")).alias("l"), "ts", "value"))


A1 = [("a", {"x": "1"}, 1, 6.0), ("a", {"x": "2"}, 1, 8.0)]


def test_binary_takes_the_first_match(spark):
    right = fam(spark, [("b", {"x": "1"}, 1, 2.0), ("b", {"x": "1"}, 1, 100.0)])
    assert got(M.binary(fam(spark, A1), "/", right)) == [("a", "{x=1}", 1, 3.0)]


@pytest.mark.parametrize("op,n", [("+", 2), ("-", 2), ("*", 0), ("/", 2), ("safe_div", 0)])
def test_absent_right_family(spark, op, n):
    out = got(M.binary(fam(spark, A1), op, fam(spark, []).limit(0)))
    assert len(out) == n
    if op == "/":
        assert all(v == float("inf") for *_, v in out)


def test_absent_left_family_is_negated(spark):
    assert got(M.binary(fam(spark, []).limit(0), "-", fam(spark, A1))) == [("a", "{x=1}", 1, -6.0), ("a", "{x=2}", 1, -8.0)]


def test_families_are_told_apart_by_time(spark):
    left = fam(spark, A1 + [("a", {"x": "1"}, 2, 5.0)])
    right = fam(spark, [("b", {"x": "1"}, 2, 1.0)])
    assert got(M.binary(left, "+", right)) == [("a", "{x=1}", 1, 6.0), ("a", "{x=1}", 2, 6.0), ("a", "{x=2}", 1, 8.0)]


def test_safe_division(spark):
    assert [v for *_, v in got(M.binary(fam(spark, A1), "safe_div", fam(spark, [("b", {"x": "1"}, 1, 0.0)])))] == [0.0]


def test_counts(spark):
    f = fam(spark, [("a", {"s": "1", "i": "x"}, 1, 1.0), ("a", {"s": "1", "i": "y"}, 1, 1.0), ("a", {"s": "1", "i": "y"}, 1, 1.0), ("a", {"s": "2"}, 1, 1.0), ("a", {"i": " "}, 1, 1.0)])
    assert [v for *_, v in got(M.count(f))] == [5.0]
    assert [v for *_, v in got(M.count(f, ["i"]))] == [2.0]
    assert got(M.count(f, ["s", "i"])) == [("a", "{s=1}", 1, 2.0)]


def test_histogram_bounds_become_milliseconds(spark):
    f = fam(spark, [("h", {"le": "0.005"}, 1, 1.0), ("h", {"le": "+Inf"}, 1, 2.0), ("h", {"other": "1"}, 1, 3.0)])
    assert [l for _, l, *_ in got(M.histogram(f))] == ["{le=5}", "{le=9223372036854775807}", "{other=1}"]


def test_scope_removes_used_labels(spark):
    f = fam(spark, [("m", {"cluster": "c", "svc": "s", "pod": "p", "k": "v"}, 60_000, 0.4)])
    out = M.to_meter_rows(M.bind_instance(f, ["cluster", "none", "svc"], ["pod"], "K8S_SERVICE", "::"))
    assert rows(out, "service", "instance", "label", "metric_value", "time_bucket") == [("c::s", "p", "{k=v}", 1, 197001010001)]


def test_retag(spark):
    pods = spark.createDataFrame([("ns", "p1", "svc1")], "namespace string, pod string, service string")
    f = fam(spark, [("m", {"pod": "p1", "ns": "ns"}, 1, 1.0), ("m", {"pod": "p2", "ns": "ns"}, 1, 1.0), ("m", {"pod": "p1"}, 1, 1.0)])
    out = M.retag_by_pod(f, "service", "pod", "ns", pods)
    assert rows(out.select(F.try_element_at("labels", F.lit("service")).alias("s"), "seq")) == [(None, 2), ("", 1), ("svc1", 0)]


# ---- counters against a queue walked sample by sample ----

def walk(points, window):
    queue, out = [], []
    for ts, v in points:
        queue.append((ts, v))
        queue.sort()
        edge = ts - window
        if queue[0][0] > edge:
            out.append(queue[0])
            continue
        low = queue[0]
        while queue[0][0] < edge:
            low = queue.pop(0)
        out.append(low if edge - low[0] <= queue[0][0] - edge else queue[0])
    return out


@pytest.mark.parametrize("seed,chunk", [(0, 1), (1, 4_000), (2, 100_000), (3, 1)])
def test_look_back_equals_the_walk(spark, seed, chunk):
    rnd = random.Random(seed)
    t, points = 0, []
    for _ in range(150):
        t += rnd.choice([1, 40, 500, 900, 1500, 9000, 70_000])
        points.append((t, float(rnd.randint(0, 99))))
    df = fam(spark, [("c", {"s": "hot"}, ts, v) for ts, v in points])
    out = counters.look_back(df, 1000, chunk_ms=chunk)
    assert rows(out, "seq", "low_ts", "low_value") == sorted([(i, *low) for i, low in enumerate(walk(points, 1000))], key=lambda r: str(r[0]))


def test_look_back_bears_ties_and_nulls_without_a_sliding_frame(spark):
    """A sliding frame adds up its window anew for each row, which is quadratic in the samples of a window."""
    rnd = random.Random(5)
    points = [(rnd.choice([None, 0, 1000, 1001, 2000, 2500, 3000, 7000]), rnd.choice([None, 1.0, 2.0, 3.0])) for _ in range(60)]
    df = fam(spark, [("c", {"s": "hot"}, ts, v) for ts, v in points])
    order = lambda p: (p[0] is not None, p[0] or 0, p[1] is not None, p[1] or 0)
    want = []
    for i, (ts, _) in enumerate(points):
        if ts is None:
            want.append((i, *min((p for p in points if p[0] is None), key=order)))
            continue
        known = [p for p in points if p[0] is not None]
        before = [t for t, _ in known if t < ts]
        old = max((p for p in known if p[0] < ts - 1000), key=order, default=None)
        new = min((p for p in known if ts - 1000 <= p[0] <= ts), key=order)
        use = old is not None and old[0] >= max(before) - 1000 and ts - 1000 - old[0] <= new[0] - (ts - 1000)
        want.append((i, *(old if use else new)))
    out = counters.look_back(df, 1000)
    assert rows(out, "seq", "low_ts", "low_value") == sorted(want, key=lambda r: tuple((x is not None, str(x)) for x in r))
    assert "RangeFrame, -1000," not in out._jdf.queryExecution().optimizedPlan().toString()


def test_rates(spark):
    df = fam(spark, [("c", {}, 0, 0.0), ("c", {}, 10_000, 100.0), ("c", {}, 10_500, 500.0), ("c", {}, 20_000, 50.0)])
    assert [v for *_, v in got(counters.irate(df))] == [0.0, 10.0, 0.0, -50.0]
    assert [v for *_, v in got(counters.increase(df, "10s"))] == [0.0, 100.0, 500.0, -50.0]


# ---- alarms ----

def machine(matches, silence, recovery):
    import pandas as pd

    return alarms.run_machine(pd.DataFrame({"tick": range(len(matches)), "match": matches}), silence, recovery)[0]


N, F_, S_, O, R = alarms.NORMAL, alarms.FIRING, alarms.SILENCED, alarms.OBSERVING, alarms.RECOVERED


@pytest.mark.parametrize("matches,silence,recovery,want", [
    ([1, 1, 1], 0, 0, [F_, F_, F_]),
    ([1, 1, 1, 1], 2, 0, [F_, S_, S_, F_]),
    ([0, 1, 0, 0, 0], 0, 0, [N, F_, R, N, N]),
    ([1, 0, 0, 0], 0, 2, [F_, O, O, R]),
    ([1, 0, 1, 0, 0, 0, 0], 3, 1, [F_, O, S_, O, R, N, N]),
    ([1, 0, 0, 1], 0, 0, [F_, R, N, F_]),
])
def test_state_machine(matches, silence, recovery, want):
    assert machine(matches, silence, recovery) == want


def test_machine_starts_afresh_after_an_empty_window():
    import pandas as pd

    ticks = pd.DataFrame({"tick": [1, 2, 9], "match": [True, False, True]})
    assert alarms.run_machine(ticks, 5, 5)[0] == [F_, O, F_]


def test_windows_and_messages(spark):
    rule = alarms.AlarmRule("r", lambda: {"n": F.sum((F.col("v") > 1).cast("int"))}, lambda: F.col("n") >= 2, period=3, silence=1, message="{name} is slow")
    data = [("e", m, v) for m, v in ((0, 5), (1, 5), (2, 0), (3, 0))]
    df = spark.createDataFrame(data, "entity_id string, m bigint, v int").withColumn("minute", F.timestamp_seconds(F.col("m") * 60)).withColumn("name", F.col("entity_id"))
    ticks = alarms.windows(df, rule).select((F.unix_seconds("minute") / 60).cast("int").alias("m"), "match")
    assert sorted(tuple(r) for r in ticks.collect()) == [(0, False), (1, True), (2, True), (3, False), (4, False), (5, False)]
    out = alarms.evaluate(df, rule, name="name").select((F.unix_seconds("minute") / 60).cast("int").alias("m"), "state", "message")
    assert sorted(tuple(r) for r in out.collect()) == [(1, F_, "e is slow"), (3, R, "e is slow")]


def test_entity_filters(spark):
    rule = alarms.AlarmRule("r", dict, lambda: F.lit(True), 1, include_regex="a.*", exclude=("ab",), exclude_regex=".*z")
    df = spark.createDataFrame([("aa",), ("ab",), ("az",), ("b",)], "name string")
    assert rows(alarms.select_entities(df, rule)) == [("aa",)]


def test_reports_with_differing_buckets_are_refused(spark):
    from lookout.operators import samples as M

    rows_ = [("e", 202401010000, 1, "", le, 1) for le in (10, 20)] + [("e", 202401010000, 2, "", le, 1) for le in (10, 30)]
    df = spark.createDataFrame(rows_, "entity_id string, time_bucket bigint, ts bigint, label string, le bigint, metric_value bigint")
    assert M.meter(df, "SUM", histogram=True).count() == 3
    with pytest.raises(Exception, match="differing buckets"):
        M.meter(df, "SUM", histogram=True, report="ts").collect()
    assert M.meter(df.filter("ts = 1"), "SUM", histogram=True, report="ts").count() == 2


def test_yaml_bodies_keep_what_is_nested(spark):
    import json

    from lookout.operators import logs as G

    body = "a: 1\nb:\n  c: two words\n  d:\n    - x\n    - y: 1\n      z: 'q'\nlist:\n- p\n- q\nurl: http://h:1/x\ne:\n# note\nf: \"g: h\"\na: 2\n"
    got = G.yaml_fields(body)
    assert got["a"] == "2" and got["url"] == "http://h:1/x" and got["e"] == "" and got["f"] == "g: h"
    assert json.loads(got["b"]) == {"c": "two words", "d": ["x", {"y": "1", "z": "q"}]} and json.loads(got["list"]) == ["p", "q"]
    deep = "a: |\n  one\n\n  # two\nb: >\n  x\n  y\n\n  z\nkeep: |+\n  k\n\nstrip: >-\n  s\n    t\n  u\nc: [1, 'p, q', {k: v}]\nd: {a: [b, c],\n  e: f}\ng:\n  - h: |-\n      in\n  - [u, w]\nq: a: b\nr: [unclosed\n"
    assert G.yaml_fields(deep) == {"a": "one\n\n# two\n", "b": "x y\nz\n", "keep": "k\n\n", "strip": "s\n  t\nu", "c": '["1", "p, q", {"k": "v"}]', "d": '{"a": ["b", "c"], "e": "f"}',
                                   "g": '[{"h": "in"}, ["u", "w"]]', "q": "a: b", "r": "[unclosed"}
    assert G.yaml_fields("no map") is None and G.yaml_fields(None) is None and G.yaml_fields("") is None


def test_retention_by_granularity(spark):
    from lookout.sinks import writers

    assert writers.ttl_of("metrics", "hour") == 7 and writers.ttl_of("metrics", "hour", {"metrics.hour": 30}) == 30
    assert writers.ttl_of("metrics", "day", {"metrics": 9, "metrics.hour": 30}) == 9
    got = rows(writers.retention_frame(spark, {"metrics.day": 90}))
    assert got == rows(spark.createDataFrame([("records", None, 3), ("metrics", "minute", 7), ("metrics", "hour", 7), ("metrics", "day", 90)], "category string, granularity string, days int"))


# ---- alarms ----

@pytest.mark.parametrize("silence,recovery,chunk", [(5, 0, 7), (2, 3, 4), (0, 0, 1), (1, 2, 1440)])
def test_chunks_of_an_alarm_series_equal_one_run(spark, silence, recovery, chunk):
    import random

    import pandas as pd

    rng = random.Random(silence * 10 + recovery)
    rule = alarms.AlarmRule("r", dict, lambda: F.lit(True), 1, silence=silence, recovery=recovery)
    data = [(e, t, rng.random() < p) for e, p in (("a", 0.5), ("b", 0.9), ("c", 0.15)) for t in range(1000, 1090) if e != "b" or rng.random() < 0.95]
    df = spark.createDataFrame(data, "entity_id string, tick bigint, match boolean").withColumn("minute", F.timestamp_seconds(F.col("tick") * 60))
    got = {(r.entity_id, r.tick): r.state for r in alarms.states(df, rule, chunk=chunk).withColumn("tick", F.expr("unix_seconds(minute) div 60")).collect()}
    want = {}
    for e in "abc":
        mine = sorted((t, m) for ee, t, m in data if ee == e)
        found, _ = alarms.run_machine(pd.DataFrame(mine, columns=["tick", "match"]), silence, recovery)
        want |= {(e, t): s for (t, _), s in zip(mine, found)}
    assert got == want


def test_recovery_names_its_firing_and_shows_its_values(spark):
    rule = alarms.AlarmRule("slow", lambda: {"hits": F.sum((F.col("v") > 5).cast("int"))}, lambda: F.col("hits") >= 1, 2, silence=1, recovery=0, message="{name} is slow",
                            expression="sum(v > 5) >= 1", hooks=("h",), layers=("GENERAL",))
    data = [("s", m, v) for m, v in enumerate([9, 1, 1, 1, 1, 8, 1, 1, 1, 1])]
    df = spark.createDataFrame(data, "entity_id string, m bigint, v int").withColumn("minute", F.timestamp_seconds(F.col("m") * 60))
    out = alarms.evaluate(df, rule, values=("v",)).withColumn("m", F.expr("unix_seconds(minute) div 60"))
    found = {r.m: r for r in out.collect()}
    assert {m: r.state for m, r in found.items()} == {0: "FIRING", 2: "RECOVERED", 5: "FIRING", 7: "RECOVERED"}
    assert [found[m].firing_id for m in (0, 2, 5, 7)] == ["slow@s@0", "slow@s@0", "slow@s@300", "slow@s@300"]
    assert [[x.v for x in found[m].snapshot] for m in (0, 2, 5, 7)] == [[9], [9], [1, 8], [1, 8]]
    assert found[2].hooks == ["h"] and found[2].expression == "sum(v > 5) >= 1" and found[2].layers == ["GENERAL"] and found[2].recovered


def test_values_behind_the_window_are_late(spark):
    rule = alarms.AlarmRule("r", dict, lambda: F.lit(True), 3)
    # (minute, arrival)
    data = [(10, 1), (11, 2), (8, 2), (9, 2), (20, 3), (17, 3), (18, 3), (12, 1500), (19, 1500), (16, 4)]
    df = spark.createDataFrame(data, "m bigint, arrival bigint").withColumn("minute", F.timestamp_seconds(F.col("m") * 60))
    fresh, late = alarms.split_late(df, rule)
    assert rows(late, "m", "arrival") == sorted([(8, 2), (17, 3), (12, 1500), (16, 4)], key=lambda r: tuple(map(str, r)))
    assert fresh.count() == 6 and alarms.split_late(df.filter("false"), rule)[1].count() == 0


def test_tables_of_a_range_with_different_columns(spark, tmp_path):
    from lookout.sources.tables import read_range

    base = str(tmp_path / "t")
    for name, columns in (("r_202401", "1 as a"), ("r_202402", "2 as a, 'x' as b"), ("r_202403", "3 as a, 'y' as b"), ("r_202404", "4 as a"), ("other", "9 as a")):
        spark.sql(f"select {columns}").write.parquet(f"{base}/{name}")
    got = read_range(spark, base, 20240131, 20240315)
    assert rows(got, "a", "b") == [(1, None), (2, "x"), (3, "y")]
    with pytest.raises(ValueError):
        read_range(spark, base, 20250101, 20250102)


def test_variables_of_a_rule(spark):
    from lookout.operators import logs as G

    df = spark.createDataFrame([("7", False), ("2", False), ("5", True)], "x string, aborted boolean")
    out = G.define(df, n=lambda v: F.col("x").cast("int"), twice=lambda v: v.n * 2)
    out = G.define(out, n=lambda v: v.twice + 1)
    assert rows(out.select("x", G.defined("n").alias("n"), G.defined("twice").alias("t"))) == [("2", 5, 4), ("5", None, None), ("7", 15, 14)]
