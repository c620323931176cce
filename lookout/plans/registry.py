"""Registered queries: name -> builder over the driver's tables, and the equivalent SQL for the check."""

from __future__ import annotations

import textwrap
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Decorator. Wall-clock buckets are those of UTC, as in the tables."""
    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = name, fn.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = textwrap.dedent(sql).strip()
        return fn
    return add


def load() -> None:
    from . import q_logs, q_meta, q_rules, q_samples, q_series, q_sources, q_traces  # noqa: F401
