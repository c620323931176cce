"""Registered queries against their SQL on DuckDB. ``LOOKOUT_ORACLE=all`` checks every query, else one in eight."""

import importlib
import os

import duckdb
import pytest

from lookout.plans import registry
from tools.check import TABLES, rows_of

from conftest import SF

registry.load()
NAMES = sorted(registry.ORACLE)
CHOSEN = NAMES if os.environ.get("LOOKOUT_ORACLE") == "all" else NAMES[::8] + ["flagship"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_sql(spark, con, name):
    df = registry.QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(registry.ORACLE[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, got) == rows_of(columns, cur.fetchall())


def test_entry(spark):
    entry = importlib.import_module("__spark_entry__")
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.QUERIES) == set(registry.ORACLE)
    assert set(registry.QUERIES) <= set(entry.queries())
