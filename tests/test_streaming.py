"""Streams give what batches give."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lookout.functions import labels as L
from lookout.operators import alarms, counters
from lookout.operators import rules as R
from lookout.operators.rules import Rule
from lookout.plans import frames as fr
from lookout.sinks import state_table, writers
from lookout.sources import tables
from lookout.streaming import metrics, stateful

from conftest import SF, rows

RULES = [Rule("resp", "service", "long_avg", "latency"), Rule("sla", "service", "percent", None, (), {"cond": ("is_true", "status")}),
         Rule("slow", "service", "count", None, (("gt", "latency", 500),))]


def parts(spark, tmp_path, df, n=3, order="ts"):
    """A frame as ``n`` files in time order, so that each trigger reads a later part."""
    folder = str(tmp_path / "in")
    total = df.count()
    ranked = df.orderBy(order).toPandas()
    step = -(-total // n)
    for i in range(n):
        spark.createDataFrame(ranked.iloc[i * step:(i + 1) * step], df.schema).coalesce(1).write.mode("append").parquet(folder)
    return folder


def service_rows(spark):
    return fr.service_rows(spark, SF).select("entity_id", "time_bucket", "latency", "status", "type", F.col("ts").cast("timestamp").alias("ts"), "minute", "event_id")


def run(stream_writer, checkpoint):
    q = stream_writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination(180)
    assert q.exception() is None


def test_upsert_and_rollups_equal_one_batch(spark, tmp_path):
    df = service_rows(spark).withColumn("time_bucket", F.col("minute"))
    folder = parts(spark, tmp_path, df, order="event_id")
    src = tables.read_stream(spark, folder, df.schema, files_per_trigger=1)
    minute, hour, day = (str(tmp_path / n) for n in ("minute", "hour", "day"))
    run(src.writeStream.foreachBatch(metrics.upsert_batch(minute, lambda: RULES, hour, day)), str(tmp_path / "cp"))
    batch = R.states(df, RULES)
    for path, levels in ((minute, 0), (hour, 1), (day, 2)):
        want = R.values(R.rollup(batch, RULES, levels) if levels else batch, RULES)
        got = R.values(state_table.merged(spark, path, RULES), RULES)
        assert rows(got) == rows(want)
    assert spark.read.parquet(minute).select("batch").distinct().count() == 3


def test_repeated_batch_replaces_itself_and_late_rows_merge(spark, tmp_path):
    df = service_rows(spark)
    path = str(tmp_path / "t")
    late = F.col("event_id") % 7 == 0
    write = metrics.upsert_batch(path, RULES)
    write(df.filter(~late), 0)
    write(df.filter(~late), 0)
    write(df.filter(late), 1)
    assert rows(R.values(state_table.merged(spark, path, RULES), RULES)) == rows(R.values(R.states(df, RULES), RULES))


KEYED = RULES + [Rule("pct", "service", "percentile2", "latency", (), {"precision": 10}), Rule("pct_slow", "service", "percentile2", "latency", (("gt", "latency", 500),), {"precision": 10}),
                 Rule("heat", "service", "histogram", "latency", (), {"step": 100, "max_steps": 20}), Rule("kinds", "service", "label_count", None, (), {"label": "type", "ts": "ts"})]


def few_days(spark):
    return service_rows(spark).filter("time_bucket div 100 between 20240104 and 20240105")


def test_keyed_rules_stream_as_in_batch(spark, tmp_path):
    df = few_days(spark).withColumn("time_bucket", F.col("minute"))
    folder = parts(spark, tmp_path, df, order="event_id")
    src = tables.read_stream(spark, folder, df.schema, files_per_trigger=1)
    minute, hour, day = (str(tmp_path / n) for n in ("minute", "hour", "day"))
    run(src.writeStream.foreachBatch(metrics.upsert_batch(minute, KEYED, hour, day, compact_every=2)), str(tmp_path / "cp"))
    from lookout.functions.timebucket import coarsen

    cols = ("metric", "entity_id", "time_bucket", "value", "label")
    for path, levels in ((minute, 0), (hour, 1), (day, 2)):
        coarse = df.withColumn("time_bucket", coarsen(F.col("time_bucket"), levels)) if levels else df
        got = rows(state_table.values(spark, path, KEYED), *cols)
        assert got == rows(R.run(coarse, KEYED), *cols) and len({r[0] for r in got}) == len(KEYED)


def test_shared_keyed_states_equal_each_rule_alone(spark):
    df = service_rows(spark)
    keyed = [r for r in KEYED if R.is_keyed(r)]
    together = R.run(df, keyed)
    for rule in keyed:
        alone = R.keyed_values(R.keyed(df, rule), rule)
        label = next(c for c in alone.columns if c not in ("entity_id", "time_bucket", "value"))
        want = alone.select("entity_id", "time_bucket", F.col("value").cast("double").alias("value"), F.col(label).cast("string").alias("label"))
        assert rows(together.filter(F.col("metric") == rule.name).drop("metric"), "entity_id", "time_bucket", "value", "label") == rows(want, "entity_id", "time_bucket", "value", "label")


def test_late_rows_of_a_folded_day_count_once(spark, tmp_path):
    df = few_days(spark)
    path = str(tmp_path / "t")
    write = metrics.upsert_batch(path, KEYED)
    cols = ("metric", "entity_id", "time_bucket", "value", "label")
    write(df.filter("event_id % 3 = 0"), 0)
    state_table.compact(spark, path, KEYED, 20240105)
    write(df.filter("event_id % 3 = 1"), 1)
    write(df.filter("event_id % 3 = 1"), 1)
    state_table.compact(spark, path, KEYED)
    state_table.compact(spark, path, KEYED)
    write(df.filter("event_id % 3 = 2"), 2)
    want = rows(R.run(df, KEYED), *cols)
    assert rows(state_table.values(spark, path, KEYED), *cols) == want
    state_table.compact(spark, path, KEYED)
    assert rows(state_table.values(spark, path, KEYED), *cols) == want
    # a fold holds one row per group, and reading takes nothing else
    assert state_table.read(spark, path).count() == R.states(df, RULES).count()


def folders(df):
    """Folders of the files that a scan reads, below the table's path."""
    return sorted({r[0].rsplit("/", 1)[0].split("rea0/t", 1)[1] for r in df.select(F.input_file_name()).distinct().collect()})


def test_a_fold_is_all_that_is_read_and_old_files_go_later(spark, tmp_path):
    df = few_days(spark)
    path = str(tmp_path / "t")
    write = metrics.upsert_batch(path, KEYED)
    cols = ("metric", "entity_id", "time_bucket", "value", "label")
    for b in range(3):
        write(df.filter(f"event_id % 4 = {b}"), b)
    early = state_table.read(spark, path)
    before = rows(early.select("entity_id", "time_bucket", "batch"))
    state_table.compact(spark, path, KEYED)
    after = state_table.read(spark, path)
    assert folders(after) == ["_folded/day=20240104/upto=2", "_folded/day=20240105/upto=2"]
    plan = after._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "upto" in plan[plan.index("PartitionFilters"):].split("PushedFilters")[0]
    # within the time to keep, a reader that started before the fold still answers
    assert state_table.vacuum(spark, path) == 0 and rows(early.select("entity_id", "time_bucket", "batch")) == before
    write(df.filter("event_id % 4 = 3"), 3)
    want = rows(R.run(df, KEYED), *cols)
    assert rows(state_table.values(spark, path, KEYED), *cols) == want
    assert state_table.vacuum(spark, path, keep_ms=0) == 12  # three batches of two days, plain and keyed
    assert rows(state_table.values(spark, path, KEYED), *cols) == want
    write(df.filter("event_id % 4 = 1"), 1)  # a repeated batch that a fold holds
    assert rows(state_table.values(spark, path, KEYED), *cols) == want
    state_table.compact(spark, path, KEYED)
    state_table.vacuum(spark, path, keep_ms=0)
    assert folders(state_table.read(spark, path)) == ["_folded/day=20240104/upto=3", "_folded/day=20240105/upto=3"]
    assert rows(state_table.values(spark, path, KEYED), *cols) == want
    assert state_table.expire(spark, path, 20240108, 3) == [20240104]
    assert rows(state_table.values(spark, path, KEYED), *cols) == rows(R.run(df.filter("time_bucket div 100 = 20240105"), KEYED), *cols)
    assert state_table.expire_all(spark, {path: ("metrics", "hour")}, 20240120, {"metrics.hour": 1}) == {path: [20240105]}


def files_in(path):
    import pathlib

    return sorted(str(p.parent.relative_to(path)) for p in pathlib.Path(path).rglob("*.parquet"))


@pytest.mark.parametrize("flush", ["1 hour"])
def test_cached_states_are_written_once_per_flush(spark, tmp_path, flush):
    from lookout.streaming import cache

    df = few_days(spark).withColumn("time_bucket", F.col("minute")).filter("entity_id in ('svc_1', 'svc_2')")
    hours = F.col("event_id") % 5  # rows of any time arrive in any of five hours, a late one too
    df = df.withColumn("arrived", F.timestamp_seconds(F.when(F.col("event_id") % 50 == 7, 40).otherwise(hours) * 60 + 1_000_000))
    last = df.limit(1).withColumn("entity_id", F.lit("last")).withColumn("arrived", F.timestamp_seconds(F.lit(1_900_000)))
    cols = ("metric", "entity_id", "time_bucket", "value", "label")
    want = rows(R.run(df, KEYED), *cols)
    written = []
    for n in (2, 5):
        base = tmp_path / str(n)
        base.mkdir()
        folder = parts(spark, base, df, n=n, order="arrived")
        src = tables.read_stream(spark, folder, df.schema, files_per_trigger=1)
        path, hour = str(base / "t"), str(base / "hour")

        def drain():
            for q in cache.stream_cached(src, path, KEYED, str(base / "cp"), hour, arrival=F.col("arrived"), flush=flush, trigger={"availableNow": True}):
                q.awaitTermination(180)
                assert q.exception() is None

        drain()
        last.coalesce(1).write.mode("append").parquet(folder)
        drain()
        got = rows(state_table.values(spark, path, KEYED).filter("entity_id <> 'last'"), *cols)
        assert got == want
        hourly = R.values(state_table.merged(spark, hour, RULES), RULES).filter("entity_id <> 'last'")
        assert rows(hourly) == rows(R.values(R.rollup(R.states(df, RULES), RULES), RULES))
        written.append((files_in(path), len(files_in(path + "_keyed"))))
        held = spark.read.format("statestore").option("stateVarName", "held").load(str(base / "cp" / "plain"))
        assert rows(held.select("key.entity_id")) == [("last",)]
    assert len(set(written[0][0])) == len(set(written[1][0])) == 2  # one partition a day, however many batches
    assert len(written[0][0]) == len(written[1][0]) and written[0][1] == written[1][1]


def test_late_rows_of_an_alarm_stream_go_to_a_side_table(spark, tmp_path):
    rule = alarms.AlarmRule("r", dict, lambda: F.lit(True), 3)
    data = [(10, 0), (11, 0), (9, 1), (8, 1), (20, 1), (17, 2), (18, 2), (19, 2), (25, 3), (22, 3)]
    df = spark.createDataFrame(data, "m bigint, arrival bigint").withColumn("minute", F.timestamp_seconds(F.col("m") * 60))
    path = str(tmp_path / "t")
    write = metrics.late_batch(path, rule)
    for b in (0, 1, 2, 2, 1, 3):  # repeated batches see what they saw at first
        write(df.filter(F.col("arrival") == b), b)
    write(df.filter("false"), 4)
    fresh, late = alarms.split_late(df, rule)
    assert rows(spark.read.parquet(f"{path}/late"), "m", "arrival") == rows(late, "m", "arrival") and late.count() == 4
    assert rows(spark.read.parquet(f"{path}/fresh"), "m", "arrival") == rows(fresh, "m", "arrival")


def test_metric_table_is_pruned_by_metric_and_day(spark, tmp_path):
    path = str(tmp_path / "m")
    table = R.run(few_days(spark), KEYED)
    state_table.write_metrics(table, path)
    read = tables.read_metrics(spark, path, "resp", 20240105, 20240106)
    assert rows(read, "entity_id", "time_bucket", "value") == rows(
        table.filter("metric = 'resp' and time_bucket div 100 between 20240105 and 20240106"), "entity_id", "time_bucket", "value")
    plan = read._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):].split("PushedFilters")[0]
    assert "metric" in filters and "day" in filters


def test_windowed_stream_equals_batch(spark, tmp_path):
    df = service_rows(spark)
    folder = parts(spark, tmp_path, df)
    src = tables.read_stream(spark, folder, df.schema, files_per_trigger=1)
    agg = {"n": F.count(F.lit(1)), "total": F.sum("latency")}
    out = str(tmp_path / "out")
    run(metrics.windowed(src, agg, window="1 hour", delay="10 minutes").writeStream.outputMode("append").format("parquet").option("path", out), str(tmp_path / "cp"))
    got = spark.read.parquet(out)
    newest = df.agg(F.max("ts")).first()[0]
    want = metrics.windowed(df, agg, window="1 hour").filter(F.col("end") <= F.lit(newest) - F.expr("INTERVAL 10 MINUTES"))
    assert rows(got, "entity_id", "time_bucket", "n", "total") == rows(want, "entity_id", "time_bucket", "n", "total")


def test_alarm_states_across_batches(spark, tmp_path):
    rule = alarms.AlarmRule("r", dict, lambda: F.lit(True), 1, silence=2, recovery=1)
    matches = [1, 1, 0, 0, 1, 0, 0, 0, 1, 1, 1, 1, 0, 1]
    df = spark.createDataFrame([(e, m, bool(x) if e == "a" else not x) for e in "ab" for m, x in enumerate(matches)], "entity_id string, m bigint, match boolean")
    df = df.withColumn("minute", F.timestamp_seconds(F.col("m") * 60 + 86400)).withColumn("turn", F.expr("m div 5 * 5 + (m * 3) % 5"))
    # files out of order: the ticks of five minutes are shuffled and the parts overlap
    folder = parts(spark, tmp_path, df, n=3, order="turn")
    src = tables.read_stream(spark, folder, df.schema, files_per_trigger=1)
    out = str(tmp_path / "out")
    run(stateful.alarm_states(src, rule, "6 minutes").writeStream.outputMode("append").format("parquet").option("path", out), str(tmp_path / "cp"))
    passed = F.col("minute") <= F.timestamp_seconds(F.lit((len(matches) - 1 - 6) * 60 + 86400))
    assert rows(spark.read.parquet(out), "entity_id", "minute", "state") == rows(alarms.states(df, rule).filter(passed), "entity_id", "minute", "state")


def test_quiet_entities_leave_no_alarm_state(spark, tmp_path):
    rule = alarms.AlarmRule("r", dict, lambda: F.lit(True), 1, silence=2, recovery=1)
    df = spark.createDataFrame([("gone", m, True) for m in range(3)] + [("stays", m, True) for m in range(30)], "entity_id string, m bigint, match boolean")
    df = df.withColumn("minute", F.timestamp_seconds(F.col("m") * 60 + 86400))
    folder = parts(spark, tmp_path, df, n=3, order="m")
    src = tables.read_stream(spark, folder, df.schema, files_per_trigger=1)
    cp = str(tmp_path / "cp")
    run(stateful.alarm_states(src, rule).writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out")), cp)
    state = spark.read.format("statestore").option("stateVarName", "machine").load(cp)
    assert rows(state.select("key.entity_id")) == [("stays",)]


@pytest.mark.parametrize("window", [None, 3_000_000])
def test_counters_across_batches(spark, tmp_path, window):
    s = fr.samples(spark, SF).withColumn("labels", F.create_map(F.lit("svc"), F.col("labels")["svc"])).select("name", "labels", "ts", "value")
    df = s.filter(L.get(F.col("labels"), "svc").isin("svc_1", "svc_2"))
    folder = parts(spark, tmp_path, df.withColumn("labels", L.key_of(F.col("labels"))), n=3)
    src = tables.read_stream(spark, folder, df.withColumn("labels", L.key_of(F.col("labels"))).schema, files_per_trigger=1)
    src = src.withColumn("labels", L.from_key(F.col("labels")))
    out = str(tmp_path / "out")
    run(stateful.rates(src, window, "1 second", 10 ** 12).withColumn("labels", L.encode(F.col("labels"))).writeStream.outputMode("append").format("parquet").option("path", out), str(tmp_path / "cp"))
    newest = df.agg(F.max("ts")).first()[0]
    want = (counters.rate(df, f"{window}ms") if window else counters.irate(df)).filter(F.col("ts") < newest - 1000)
    assert rows(spark.read.parquet(out), "name", "labels", "ts", "value") == rows(want.withColumn("labels", L.encode(F.col("labels"))), "name", "labels", "ts", "value")


def test_top_records_across_batches(spark, tmp_path):
    from lookout.plans.q_rules import _records

    df = _records(spark, SF).withColumn("time_bucket", F.expr("time_bucket div 100"))
    folder = parts(spark, tmp_path, df, order="statement")
    src = tables.read_stream(spark, folder, df.schema, files_per_trigger=1)
    path = str(tmp_path / "top")
    run(src.writeStream.foreachBatch(metrics.top_batch(path, 3)), str(tmp_path / "cp"))
    from lookout.operators.topk import sampled_top

    assert rows(metrics.read_top(spark, path, 3).select(df.columns)) == rows(sampled_top(df, 3))


def test_inventory_stream_lists_keys_once(spark, tmp_path):
    df = service_rows(spark).select("entity_id", "type", "ts")
    folder = parts(spark, tmp_path, df)
    src = tables.read_stream(spark, folder, df.schema, files_per_trigger=1)
    out = str(tmp_path / "out")
    run(metrics.first_seen(src, ["entity_id", "type"], delay="60 days").writeStream.outputMode("append").format("parquet").option("path", out), str(tmp_path / "cp"))
    got = spark.read.parquet(out)
    assert rows(got, "entity_id", "type") == rows(df.select("entity_id", "type").distinct())


def test_record_stream(spark, tmp_path):
    df = service_rows(spark).select("event_id", "ts", F.lit(20240105101112).cast("bigint").alias("time_bucket"))
    folder = parts(spark, tmp_path, df)
    src = tables.read_stream(spark, folder, df.schema)
    out = str(tmp_path / "out")
    q = writers.stream_records(src, out, str(tmp_path / "cp"), {"availableNow": True})
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    assert got.count() == df.count() and rows(got.select("day").distinct()) == [(20240105,)]


def test_retention_drops_old_partitions(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS ttl_probe")
    spark.range(10).withColumn("day", 20240101 + F.col("id")).write.partitionBy("day").option("path", str(tmp_path / "t")).saveAsTable("ttl_probe")
    assert writers.drop_expired(spark, "ttl_probe", 20240110, 3) == 6
    assert rows(spark.table("ttl_probe").select("day")) == [(d,) for d in range(20240107, 20240111)]
    spark.sql("DROP TABLE ttl_probe")


def test_kafka_options():
    o = tables.kafka_options("h:1", ("segments", "logs_json"), "prod")
    assert o["subscribe"] == "prod-segments,prod-logs-json" and o["kafka.bootstrap.servers"] == "h:1"
