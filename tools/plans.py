"""Audit physical plans: ``python tools/plans.py [sf] [name ...]`` lists nested-loop joins, row-at-a-time Python and
single-partition exchanges; with names it prints the formatted plans."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tools.check import session

MARKS = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "SinglePartition")


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    from lookout.plans import registry

    registry.load()
    for name, fn in registry.QUERIES.items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        df = fn(spark, f"/root/testdata/sf{sf}")
        if sys.argv[2:]:
            df.explain("formatted")
            continue
        text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
        found = [m for m in MARKS if m in text]
        if found:
            print(name, found, text.count("Exchange "))


if __name__ == "__main__":
    main()
