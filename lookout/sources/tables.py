"""Reading frames: files, streams, Kafka topics and the metric table."""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Topic of each kind of agent data.
TOPICS = {"segments": "segments", "metrics": "metrics", "meters": "meters", "logs": "logs", "logs_json": "logs-json",
          "managements": "managements", "profilings": "profilings"}


def read(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def kafka_options(servers: str, kinds=tuple(TOPICS), namespace: str = "", **options) -> dict[str, str]:
    prefix = f"{namespace}-" if namespace else ""
    return {"kafka.bootstrap.servers": servers, "subscribe": ",".join(prefix + TOPICS[k] for k in kinds),
            "startingOffsets": "latest", **options}


def read_kafka(spark: SparkSession, servers: str, kinds=tuple(TOPICS), namespace: str = "", **options) -> DataFrame:
    """One stream over the topics; needs the Kafka connector on the class path."""
    raw = spark.readStream.format("kafka").options(**kafka_options(servers, kinds, namespace, **options)).load()
    return route_kafka(raw, namespace)


def route_kafka(raw: DataFrame, namespace: str = "") -> DataFrame:
    """Records with the kind of data their topic stands for."""
    topic = F.regexp_replace("topic", f"^{namespace}-", "") if namespace else F.col("topic")
    kind = F.lit(None).cast("string")
    for k, t in TOPICS.items():
        kind = F.when(topic == t, k).otherwise(kind)
    return raw.withColumn("kind", kind)


def parse_kind(routed: DataFrame, kind: str, schema: str | T.StructType) -> DataFrame:
    """JSON payloads of one kind as rows; payloads that do not parse are left out."""
    body = F.from_json(F.col("value").cast("string"), schema)
    return routed.filter(F.col("kind") == kind).select(body.alias("_b")).filter(F.col("_b").isNotNull()).select("_b.*")


def read_range(spark: SparkSession, base: str, start_day: int, end_day: int) -> DataFrame:
    """One frame over the tables below ``base`` that a range of days touches; columns that a table lacks are null.

    Each table is a folder whose name ends with its year, month or day (``records_202401``, ``day=20240115``), with
    columns of its own. Tables with equal columns are read together, so the plan has one scan for each set of
    columns, not for each table. Rows outside the range that share a table with it are not filtered here.
    """
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    same: dict[str, list[str]] = {}
    for folder in sorted(str(f.getPath()) for f in found or ()):
        digits = re.search(r"(\d{4}(?:\d\d){0,2})$", folder)
        if digits and int(digits[1].ljust(8, "0")) <= end_day and int(digits[1].ljust(8, "9")) >= start_day:
            same.setdefault(spark.read.parquet(folder).schema.json(), []).append(folder)
    if not same:
        raise ValueError(f"no table below {base} between {start_day} and {end_day}")
    frames = [spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(*folders) for schema, folders in same.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_metrics(spark: SparkSession, path: str, metric: str, start_day: int | None = None, end_day: int | None = None) -> DataFrame:
    """The metric table, partitioned by metric and day: both filters prune directories."""
    out = spark.read.parquet(path).filter(F.col("metric") == metric)
    if start_day is not None:
        out = out.filter(F.col("day").between(start_day, end_day if end_day is not None else start_day))
    return out
