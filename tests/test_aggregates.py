"""Rule and meter functions on values worked out by hand, and merging of partial states."""

import random

import pytest
from pyspark.sql import functions as F

from lookout.operators import aggregates as A
from lookout.operators import rules as R
from lookout.operators import topk
from lookout.operators.rules import Rule
from lookout.plans import catalog

from conftest import rows


def frame(spark, values, bucket=202401010000, entity="e"):
    return spark.createDataFrame([(entity, bucket, v) for v in values], "entity_id string, time_bucket bigint, v bigint")


def value(df):
    return [r["value"] for r in df.collect()]


def apdex(spark, pairs):
    df = spark.createDataFrame([("e", 202401010000, l, ok) for l, ok in pairs], "entity_id string, time_bucket bigint, v bigint, ok boolean")
    return value(A.aggregate(df, "apdex", F.col("v"), {"threshold": F.lit(500), "status": F.col("ok")}))[0]


def test_apdex(spark):
    assert apdex(spark, [(200, True)]) == 10000
    assert apdex(spark, [(1000, True)]) == 5000
    assert apdex(spark, [(2000, True)]) == 5000
    assert apdex(spark, [(3000, True)]) == 0
    assert apdex(spark, [(200, True), (1500, True)]) == 7500
    assert apdex(spark, [(200, False), (300, True), (1500, True)]) == 5000


def test_averages_and_extremes(spark):
    assert value(A.aggregate(frame(spark, [1, 2]), "long_avg", F.col("v"))) == [1]
    assert value(A.aggregate(frame(spark, [0, 0, 1]), "meter_avg", F.col("v"))) == [1]
    assert value(A.aggregate(frame(spark, [0, 0, 1]), "long_avg", F.col("v"))) == [0]
    assert value(A.aggregate(frame(spark, [-5, -3]), "max", F.col("v"))) == [0]
    assert value(A.aggregate(frame(spark, [-5, -3]), "min", F.col("v"))) == [-5]


def test_rate_without_denominator(spark):
    args = {"num": F.col("v") > 0, "den": F.col("v") > 100}
    assert value(A.aggregate(frame(spark, [1, 2]), "rate", None, args)) == [0]


@pytest.mark.parametrize("bucket,minutes", [(202401010000, 1), (2024010100, 60), (20240101, 1440)])
def test_cpm_divides_by_the_bucket(spark, bucket, minutes):
    assert value(A.aggregate(frame(spark, [1] * 3000, bucket), "cpm")) == [3000 // minutes]


def reference_percentile(values, precision, ranks=A.RANKS):
    """Independent walk over the sorted buckets."""
    import numpy as np

    counts = {}
    for v in values:
        counts[v // precision] = counts.get(v // precision, 0) + 1
    total, out = len(values), {}
    for r in ranks:
        roof = int(np.floor(float(np.float32(np.float32(total * r) / np.float32(100))) + 0.5))
        seen = 0
        for k in sorted(counts):
            seen += counts[k]
            if seen >= roof:
                out[str(r)] = k * precision
                break
    return out


@pytest.mark.parametrize("seed", range(4))
def test_percentile2(spark, seed):
    rnd = random.Random(seed)
    values = [rnd.randint(0, 900) for _ in range(rnd.randint(1, 60))]
    got = {r["p"]: r["value"] for r in A.aggregate(frame(spark, values), "percentile2", F.col("v"), {"precision": 10}).collect()}
    assert got == reference_percentile(values, 10)


def test_histogram_fills_every_bucket(spark):
    out = rows(A.aggregate(frame(spark, [0, 5, 25, 999]), "histogram", F.col("v"), {"step": 10, "max_steps": 4}), "bucket", "value")
    assert sorted(out) == [(0, 2), (10, 0), (20, 1), (30, 0), (40, 1)]


def test_label_cap_keeps_the_first_to_appear(spark):
    df = spark.createDataFrame([("e", 1, "late", 5), ("e", 1, "b", 1), ("e", 1, "a", 1), ("e", 1, "late", 6)], "entity_id string, time_bucket bigint, l string, ts bigint")
    out = A.aggregate(df, "label_count", None, {"label": F.col("l"), "ts": F.col("ts"), "max_labels": 2}, minutes=F.lit(1))
    assert rows(out, "label", "value") == [("a", 1), ("b", 1)]


def test_empty_histogram_total(spark):
    df = spark.createDataFrame([("e", 202401010000, "", 10, 0), ("e", 202401010000, "", 20, 0)], "entity_id string, time_bucket bigint, label string, le bigint, v bigint")
    args = {"label": F.col("label"), "le": F.col("le"), "ranks": (50, 90)}
    assert rows(A.aggregate(df, "meter_sum_histogram_percentile", F.col("v"), args), "p", "value") == [("50", 0), ("90", 0)]


@pytest.mark.parametrize("fn,args", [("long_avg", {}), ("max", {}), ("meter_min", {}), ("percentile2", {"precision": 10}), ("histogram", {"step": 100, "max_steps": 9})])
def test_merged_partials_equal_one_pass(spark, fn, args):
    rnd = random.Random(1)
    df = frame(spark, [rnd.randint(1, 999) for _ in range(200)]).withColumn("part", F.monotonically_increasing_id() % 3)
    parts = [A.fold(df.filter(F.col("part") == i), fn, F.col("v"), args) for i in range(3)]
    merged = A.merge(parts[0].unionByName(parts[1]).unionByName(parts[2]), fn)
    assert rows(A.finalise(merged, fn, args)) == rows(A.aggregate(df, fn, F.col("v"), args))


def test_rules_leave_unmatched_metrics_absent(spark):
    rules = [Rule("a", "s", "count"), Rule("b", "s", "sum", "v", (("gt", "v", 100),))]
    out = R.run(frame(spark, [1, 2]), rules)
    assert rows(out, "metric", "value") == [("a", 2.0)]


def test_rollup_merges_states_not_values(spark):
    rules = [Rule("avg", "s", "long_avg", "v")]
    df = frame(spark, [10] * 3, 202401010001).unionByName(frame(spark, [100], 202401010002))
    hours = R.rollup(R.states(df, rules), rules)
    assert rows(R.values(hours, rules), "time_bucket", "avg") == [(2024010100, 32)]


def test_catalog_rules_are_unique_and_known():
    rules = catalog.rules()
    assert len({r.name for r in rules}) == len(rules)
    assert all(r.fn in A.REGISTRY for r in rules)


def test_first_per_group_beyond_sparks_own_limit(spark):
    df = spark.range(5000).select((F.col("id") % 3 == 0).cast("int").alias("g"), F.col("id").alias("v"))
    got = topk.first_per_group(df, ["g"], [F.col("v").desc()], 1500)
    want = [(g, v) for g in (0, 1) for v in sorted((i for i in range(5000) if (i % 3 == 0) == bool(g)), reverse=True)[:1500]]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_hot_group_is_limited_before_the_shuffle(spark):
    df = spark.range(1000).select(F.lit("hot").alias("g"), F.col("id").alias("v"))
    plan = topk.first_per_group(df.union(df), ["g"], [F.col("v")], 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_unknown_attribute_is_an_error(spark):
    with pytest.raises(ValueError):
        topk.attr_filter(frame(spark, [1]), attr9="x")


def test_incompatible_buckets(spark):
    df = spark.createDataFrame([("a", 1, "r1", 10), ("a", 1, "r1", 20), ("a", 1, "r2", 10), ("b", 1, "r1", 10), ("b", 1, "r2", 10)], "entity_id string, time_bucket bigint, report string, le bigint")
    assert rows(A.incompatible_buckets(df), "entity_id") == [("a",)]
