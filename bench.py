"""Time the headline queries: ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores; prints one JSON line.

Each query runs to a sink that reads every row, as often as ``BENCH_RUNS`` (1) says, after one query has warmed the
session up; the best run counts. ``throughput`` folds the event table, repeated in memory, through the shared service rules and reports
source rows per second.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

HEADLINE = (
    "flagship agg_partial_final oal_percentile2 oal_histogram agg_rollup agg_rule_catalog topk_metric topk_stream "
    "win_fill join_series_labels win_mqe_increase sort_values q_heatmap prom_agg join_sample_binary win_mal_rate mtr_sum_hist_pct "
    "tr_segment tr_entry join_alias q_trace_detail set_spanset join_client_server agg_component_set agg_flame_trace agg_flame_merge "
    "join_hierarchy st_alarm_state log_keyword join_uri_rule st_rate_limit src_otlp_metrics src_jvm join_price").split()
REPEAT = 100


def run(df) -> float:
    t = time.time()
    df.write.format("noop").mode("overwrite").save()
    return time.time() - t


def throughput(spark, sf_dir) -> int:
    from lookout.operators import rules as R
    from lookout.plans import frames
    from lookout.plans.q_rules import SERVICE_RULES

    rows = frames.service_rows(spark, sf_dir)
    n = rows.count() * REPEAT
    many = rows.repartition(spark.sparkContext.defaultParallelism).withColumn("_r", F.explode(F.sequence(F.lit(1), F.lit(REPEAT))))
    return int(n / run(R.values(R.states(many, SERVICE_RULES), SERVICE_RULES)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.sql.shuffle.partitions", cpus)
             .config("spark.driver.memory", "12g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from lookout.plans import registry

    registry.load()
    names = sys.argv[1:] or HEADLINE
    times: dict[str, float] = {}
    # one query warms the session up; each of the others is compiled within its own measured run
    run(registry.QUERIES[names[0]](spark, sf_dir))
    for name in names:
        best = None
        for _ in range(runs):
            t = time.time()
            df = registry.QUERIES[name](spark, sf_dir)
            run(df)
            took = time.time() - t
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
    out = {"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
           "sf": os.path.basename(sf_dir).replace("sf", "")}
    if not sys.argv[1:]:
        out["rows_per_second"] = throughput(spark, sf_dir)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
