"""Compare registered queries with their SQL on DuckDB: ``python tools/check.py [sf] [name-prefix ...]``."""

from __future__ import annotations

import importlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
from pyspark.sql import SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def session():
    return (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g")
            .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate())


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null" if v is None else "nan"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return repr(v)
    if hasattr(v, "as_integer_ratio"):
        return repr(int(v)) if v == int(v) and not isinstance(v, float) else repr(v)
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    registry = importlib.import_module("lookout.plans.registry")
    registry.load()
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    bad = 0
    for name, fn in registry.QUERIES.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            got = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark {str(e)[:1500]}")
            bad += 1
            continue
        dt = time.time() - t0
        sql = registry.ORACLE.get(name)
        if sql is None:
            print(f"rows {name}: {len(got)} rows {dt:.1f}s")
            continue
        try:
            cur = con.execute(sql)
            cols = [d[0] for d in cur.description]
            types = [str(d[1]) for d in cur.description]
            want = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb {str(e)[:1200]}")
            bad += 1
            continue
        if sorted(cols) != sorted(df.columns):
            print(f"FAIL {name}: columns {df.columns} vs {cols}")
            bad += 1
            continue
        a, b = rows_of(df.columns, got), rows_of(cols, want)
        stypes = {f.name: f.dataType.simpleString() for f in df.schema}
        note = [(c, stypes[c], t) for c, t in zip(cols, types) if {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}.get(stypes[c], "?") != t]
        if a != b:
            bad += 1
            only_a, only_b = [x for x in a if x not in set(b)][:3], [x for x in b if x not in set(a)][:3]
            print(f"FAIL {name}: {len(a)} vs {len(b)} rows; spark-only {only_a} duck-only {only_b} types {note}")
        else:
            print(f"ok   {name}: {len(a)} rows {dt:.1f}s" + (f"  types {note}" if note else "") + ("  EMPTY" if not a else ""))
    print("bad", bad)


if __name__ == "__main__":
    main()
