"""Series expressions on the two-series fixture: ids 100 and 300, label values 1 and 2."""

import math

import pytest
from pyspark.sql import functions as F

from lookout.functions import labels as L
from lookout.functions.timebucket import Duration
from lookout.operators import promql
from lookout.operators import series as S

from conftest import rows

T1, T2 = 202401010000, 202401010001


def plain(spark, a, b):
    return spark.createDataFrame([(T1, a), (T2, b)], "time_bucket bigint, value double")


def labelled(spark, data):
    return spark.createDataFrame([(dict(l), t, v) for l, t, v in data], "labels map<string,string>, time_bucket bigint, value double")


def got(df):
    cols = ["time_bucket", "value"] if "labels" not in df.columns else [L.encode(F.col("labels")).alias("l"), "time_bucket", "value"]
    return rows(df.select(*cols))


TWO = [((("label", "1"),), T1, 100.0), ((("label", "1"),), T2, 300.0), ((("label", "2"),), T1, 101.0), ((("label", "2"),), T2, 301.0)]


def test_plain_with_plain(spark):
    assert got(S.series_op(plain(spark, 100.0, 300.0), "-", plain(spark, 50.0, None))) == [(T1, 50.0), (T2, None)]


def test_labelled_with_plain_in_both_orders(spark):
    l, p = labelled(spark, TWO), plain(spark, 1.0, 2.0)
    assert got(S.series_op(l, "-", p)) == [("{label=1}", T1, 99.0), ("{label=1}", T2, 298.0), ("{label=2}", T1, 100.0), ("{label=2}", T2, 299.0)]
    assert got(S.series_op(p, "-", l)) == [("{label=1}", T1, -99.0), ("{label=1}", T2, -298.0), ("{label=2}", T1, -100.0), ("{label=2}", T2, -299.0)]


def test_unmatched_labels_become_empty(spark):
    right = labelled(spark, TWO[:2])
    assert got(S.series_op(labelled(spark, TWO), "+", right)) == [("{label=1}", T1, 200.0), ("{label=1}", T2, 600.0), ("{label=2}", T1, None), ("{label=2}", T2, None)]


def test_scalar_on_either_side(spark):
    assert got(S.scalar_op(plain(spark, 10.0, None), "/", 0)) == [(T1, math.inf), (T2, None)]
    assert got(S.scalar_op(plain(spark, 10.0, 4.0), "-", 100, scalar_left=True)) == [(T1, 90.0), (T2, 96.0)]


def test_single_value_frame_as_operand(spark):
    total = S.over_time(plain(spark, 1.0, 3.0), "sum")
    assert got(S.single_op(plain(spark, 10.0, 20.0), "+", total)) == [(T1, 14.0), (T2, 24.0)]


def test_over_time(spark):
    df = plain(spark, None, 4.0)
    assert [S.over_time(df, f).first()["value"] for f in ("avg", "sum", "count", "max", "min", "latest")] == [4.0, 4.0, 1.0, 4.0, 4.0, 4.0]
    empty = plain(spark, None, None)
    assert [S.over_time(empty, f).first()["value"] for f in ("avg", "sum", "count", "max", "latest")] == [None, 0.0, 0.0, None, None]


def test_chosen_point_keeps_its_trace(spark):
    df = spark.createDataFrame([(T1, 5.0, "t5"), (T2, 1.0, "t1")], "time_bucket bigint, value double, trace_id string")
    assert rows(S.over_time(df, "max"), "value", "trace_id") == [(5.0, "t5")]
    assert rows(S.over_time(df, "latest"), "value", "trace_id") == [(1.0, "t1")]


def test_latest_needs_time(spark):
    with pytest.raises(ValueError):
        S.over_time(S.over_time(plain(spark, 1.0, 2.0), "max"), "latest")


def test_aggregate_labels(spark):
    assert got(S.aggregate_labels(labelled(spark, TWO), "sum")) == [(T1, 201.0), (T2, 601.0)]
    assert got(S.aggregate_labels(labelled(spark, TWO), "max", ["label", "none"]))[0] == ("{label=1,none=}", T1, 100.0)


def test_trend(spark):
    d = Duration("2024-01-01 0000", "2024-01-01 0003", "MINUTE")
    df = spark.createDataFrame([(202401010000, 1.0), (202401010001, 4.0), (202401010003, 9.0)], "time_bucket bigint, value double")
    filled = S.fill(df.withColumn("entity_id", F.lit("e")), d)
    assert rows(S.increase(filled, 1), "time_bucket", "value") == [(202401010001, 3.0), (202401010002, None), (202401010003, None)]
    assert rows(S.rate(filled, 2, 60).filter("value is not null"), "time_bucket", "value") == [(202401010003, (9 - 4) / 120)]


def test_sort_values(spark):
    out = S.sort_values(labelled(spark, TWO), "max", descending=True, limit=1)
    assert got(out) == [("{label=2}", T1, 101.0), ("{label=2}", T2, 301.0)]
    p = plain(spark, 1.0, 2.0)
    assert S.sort_values(p, "max") is p


def test_relabels(spark):
    out = S.relabels(labelled(spark, TWO), "label", "1", "x", "9")
    assert [r[0] for r in got(out)] == ["{label=2}", "{label=2}", "{x=9}", "{x=9}"]
    with pytest.raises(ValueError):
        S.relabels(plain(spark, 1.0, 2.0), "a", "1", "b", "2")


def test_view_as_seq_and_is_present(spark):
    empty, full = plain(spark, None, None), plain(spark, None, 2.0)
    assert got(S.view_as_seq([empty, full, plain(spark, 7.0, 7.0)])) == [(T1, None), (T2, 2.0)]
    assert got(S.view_as_seq([empty, empty])) == [(T1, None), (T2, None)]
    assert S.is_present([empty, full]).first()["value"] == 1.0 and S.is_present([empty]).first()["value"] == 0.0


def test_size_check(spark):
    a, b = plain(spark, 1.0, 2.0), plain(spark, 1.0, 2.0).limit(1)
    assert S.check_same_size(a.withColumn("entity_id", F.lit("e")), b.withColumn("entity_id", F.lit("e"))).count() == 1
    assert promql.matrix_errors(labelled(spark, TWO), labelled(spark, TWO)).count() == 0
    assert promql.matrix_errors(labelled(spark, TWO), labelled(spark, TWO[:3])).count() == 1


def test_prom_selector_needs_a_layer(spark):
    with pytest.raises(ValueError):
        promql.select_metric(plain(spark, 1.0, 2.0), "m", None, "NOPE", ["GENERAL"])


def test_prom_compare(spark):
    l = labelled(spark, TWO)
    assert len(got(promql.compare(l, ">", 100.5))) == 3
    assert [r[2] for r in got(promql.compare(l, ">", 100.5, as_bool=True))] == [0.0, 1.0, 1.0, 1.0]
