"""Column functions on hand-made values."""

import math

import pytest
from pyspark.sql import functions as F

from lookout.functions import arith, ids, labels, predicates, text
from lookout.functions import timebucket as tb
from lookout.operators.traces import java_hash, sample_bucket

from conftest import rows


def one(spark, *cols):
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first())


def test_division_follows_ieee(spark):
    got = one(spark, arith.safe_div(1.0, 0.0), arith.safe_div(-1.0, 0.0), arith.safe_div(0.0, 0.0), arith.safe_div(3.0, 2.0),
              arith.safe_mod(-5.0, 3.0), arith.safe_mod(5.0, 0.0), arith.safe_div(F.lit(None).cast("double"), 0.0))
    assert got[0] == math.inf and got[1] == -math.inf and math.isnan(got[2]) and got[3] == 1.5 and got[4] == -2.0 and math.isnan(got[5]) and got[6] is None


def test_integer_division_truncates(spark):
    assert one(spark, arith.int_div(F.lit(-7), 2), arith.int_div(F.lit(7), 2)) == (-3, 3)


@pytest.mark.parametrize("total,rank,roof", [(10, 50, 5), (3, 50, 2), (1, 99, 1), (11, 95, 10), (100, 99, 99), (0, 50, 0)])
def test_rank_roof_rounds_half_up(spark, total, rank, roof):
    assert one(spark, arith.rank_roof(F.lit(total), rank)) == (roof,)


def test_sample_value_to_long(spark):
    vs = [-3.0, 0.0, 0.2, 0.99, 1.0, 1.5, 2.4]
    assert one(spark, *[arith.to_metric_long(F.lit(v)) for v in vs]) == (0, 0, 1, 1, 1, 2, 2)


def test_formatting(spark):
    vs = {1.0: "1", 1.5: "1.5", 0.125: "0.12", 2.345: "2.34", -3.10: "-3.1", 100.0: "100"}
    assert one(spark, *[arith.format_two_decimals(F.lit(v)) for v in vs]) == tuple(vs.values())


def test_round_half_up_of_negative(spark):
    assert one(spark, arith.round_half_up(F.lit(-2.5), 0), arith.round_half_up(F.lit(2.5), 0)) == (-3.0, 3.0)


def test_like_needs_a_percent_sign(spark):
    c = F.lit("service-a")
    got = one(spark, *[predicates.like(c, p) for p in ("%ice%", "%-a", "serv%", "service-a", '"serv%"', None)])
    assert got == (True, True, True, False, True, False)


def test_predicates_are_total(spark):
    null = F.lit(None)
    s, n, a = null.cast("string"), null.cast("int"), null.cast("array<string>")
    got = one(spark, predicates.str_eq(s, None), predicates.str_eq(s, "x"), predicates.ne(s, "x"), predicates.gt(n, 1), predicates.contains(a, "x"),
              predicates.not_contains(a, "x"), predicates.is_true(null.cast("boolean")), predicates.is_not_true(null.cast("boolean")), predicates.is_in(s, ["x"]))
    assert got == (True, False, True, False, False, False, False, True, False)


def test_quotes_are_stripped(spark):
    assert one(spark, predicates.str_eq(F.lit('"a"'), "a"), predicates.str_eq(F.lit("a"), '"a"')) == (True, True)


def test_ids_round_trip(spark):
    sid = ids.service_id(F.lit("a::b"))
    iid = ids.instance_id(sid, F.lit("host_1-x"))
    rel = ids.endpoint_relation_id(sid, F.lit("/p-1"), sid, F.lit("/q_2"))
    got = one(spark, sid, ids.parse_service(sid)["name"], ids.parse_service(sid)["normal"], ids.parse_part(iid)["name"], ids.parse_endpoint_relation(rel)["source"],
              ids.parse_endpoint_relation(rel)["dest"], ids.parse_service(ids.service_id(F.lit(""), False))["name"])
    assert got == ("YTo6Yg==.1", "a::b", True, "host_1-x", "/p-1", "/q_2", "_blank")


def test_time_buckets(spark):
    ts = F.lit("2024-02-29 23:59:58").cast("timestamp")
    minute = tb.bucket_of(ts)
    got = one(spark, minute, tb.bucket_of(ts, "second"), tb.coarsen(minute), tb.coarsen(minute, 2), tb.minutes_in(tb.coarsen(minute)), tb.minutes_in(tb.coarsen(minute, 2)),
              tb.kind_of(minute), tb.day_start(minute), F.unix_seconds(tb.to_ts(minute)))
    assert got == (202402292359, 20240229235958, 2024022923, 20240229, 60, 1440, "minute", 202402290000, 1709251140)


@pytest.mark.parametrize("text_,ms", [("PT1M", 60000), ("5m", 300000), ("100ms", 100), ("1h30m", 5400000), ("P1DT2H", 93600000), ("1.5s", 1500)])
def test_ranges(text_, ms):
    assert tb.parse_range_ms(text_) == ms


def test_bad_range():
    with pytest.raises(ValueError):
        tb.parse_range_ms("five minutes")


def test_duration():
    d = tb.Duration("2024-01-01 0000", "2024-01-01 0009", "MINUTE")
    assert (d.points, d.start_bucket, d.end_bucket, d.second_range) == (10, 202401010000, 202401010009, (20240101000000, 20240101000959))
    assert d.widened(5).start_bucket == 202312312355
    with pytest.raises(ValueError):
        tb.Duration("2024-01-02", "2024-01-01", "DAY")


def test_label_keys_do_not_depend_on_order(spark):
    a = F.create_map(F.lit("b"), F.lit("2"), F.lit("a"), F.lit("1"))
    b = F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2"))
    assert one(spark, labels.key_of(a) == labels.key_of(b), labels.encode(a), labels.from_key(labels.key_of(a))["b"]) == (True, "{a=1,b=2}", "2")


def test_label_decode(spark):
    got = one(spark, labels.decode(F.lit("{a=1,b=x}"))["b"], labels.decode(F.lit("plain"))["_"], F.size(labels.decode(F.lit("{}"))))
    assert got == ("x", "plain", 0)


def test_tables(spark):
    t = labels.table_decode(F.lit("{p=50},12|x,3"))
    u = F.create_map(F.lit("x"), F.lit(5).cast("bigint"))
    got = one(spark, labels.table_encode(t), labels.table_merge(t, u, "sum")["x"], labels.table_merge(t, u, "max")["x"], labels.table_merge(t, u, "min")["x"], labels.table_merge(t, u, "sum")["{p=50}"])
    assert got == ("x,3|{p=50},12", 8, 5, 3, 12)


def test_relabel_pairs_must_match():
    with pytest.raises(ValueError):
        labels.relabel(F.lit(None), "a", ["1"], "b", ["x", "y"])


def test_names(spark):
    n = F.lit("grp::svc::x")
    assert one(spark, text.group_of(n), text.short_name(n), text.group_of(F.lit("::x")), text.short_name(F.lit("::x"))) == ("grp", "svc::x", "", "::x")


def test_logic_endpoint(spark):
    le = lambda tag, local: text.logic_endpoint(F.lit(tag), F.lit(local), F.lit("op"), F.lit(7), F.lit(True))["name"]
    assert one(spark, le('{"logic-span": true}', True), le('{"logic-span": true}', False), le('{"name":"n","latency":1,"status":true}', False), le('{"name":"n"}', True)) == ("op", None, "n", None)


def test_java_hash(spark):
    got = one(spark, *[java_hash(F.lit(s)) for s in ("abc", "", "polygenelubricants", "hello world")])
    assert got == (96354, 0, -2147483648, 1794106052)
    assert one(spark, sample_bucket(F.lit("polygenelubricants")), sample_bucket(F.lit("abc"))) == (-3648, 6354)


def test_json_props(spark):
    assert one(spark, text.json_props_merge(F.lit('{"a":"1","b":"2"}'), F.lit('{"b":"3"}')), text.json_props_merge(F.lit(None).cast("string"), F.lit('{"b":"3"}'))) == ('{"a":"1","b":"3"}', '{"b":"3"}')


def test_nan_differs_from_everything(spark):
    from lookout.functions import arith

    nan = float("nan")
    df = spark.createDataFrame([(nan, 1.0), (nan, nan), (1.0, nan), (2.0, 1.0), (None, 1.0)], "a double, b double")
    got = {op: [r[0] for r in df.select(arith.compare(op, F.col("a"), F.col("b"))).collect()] for op in ("==", "!=", ">", "<", ">=", "<=")}
    assert got["=="] == [0.0, 0.0, 0.0, 0.0, None] and got["!="] == [1.0, 1.0, 1.0, 1.0, None]
    assert got[">"] == got[">="] == [0.0, 0.0, 0.0, 1.0, None] and got["<"] == got["<="] == [0.0, 0.0, 0.0, 0.0, None]


def test_whole_text_patterns_refuse_a_line_feed(spark):
    from lookout.operators import promql, samples

    df = spark.createDataFrame([({"svc": "svc_1"},), ({"svc": "svc_1\n"},)], "labels map<string,string>")
    assert samples.tag_filter(df, "match", svc="svc_.").count() == 1
    assert df.where(promql.matcher(F.element_at("labels", F.lit("svc")), "=~", "svc_.|x")).count() == 1
