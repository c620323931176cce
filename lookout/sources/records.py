"""Events, model usage spans and keep-alive pings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.timebucket import bucket_of_millis


def events(rows: DataFrame) -> DataFrame:
    """Events (uuid, service, instance, endpoint, name, type, message, parameters map, start_time, end_time, layer).

    The time is the start, or the end where there is no start.
    """
    t = F.coalesce(F.when(F.col("start_time") > 0, F.col("start_time")), F.when(F.col("end_time") > 0, F.col("end_time")))
    return rows.select(
        "uuid", text.service_name(F.col("service")).alias("service"), text.instance_name(F.col("instance")).alias("instance"),
        text.endpoint_name(F.col("endpoint")).alias("endpoint"), "name", "type", "message",
        F.when(F.size("parameters") > 0, F.to_json("parameters")).alias("parameters"), "start_time", "end_time", "layer",
        t.alias("timestamp"), bucket_of_millis(t, "second").alias("time_bucket"))


# Tag keys of model calls.
MODEL = "gen_ai.response.model"
PROVIDER, SYSTEM = "gen_ai.provider.name", "gen_ai.system"
INPUT, OUTPUT = "gen_ai.usage.input_tokens", "gen_ai.usage.output_tokens"
FIRST_TOKEN = "gen_ai.server.time_to_first_token"


def genai_usage(spans: DataFrame) -> DataFrame:
    """Span rows (tags map, timestamp_us, duration_us) to usage rows; counts that are no numbers read as 0."""
    tag = lambda k: F.try_element_at("tags", F.lit(k))
    filled = lambda k: F.when(F.trim(tag(k)) != "", tag(k))
    number = lambda k, t: F.coalesce(tag(k).try_cast(t), F.lit(0).cast(t))
    ms = lambda c: F.call_function("div", F.col(c), F.lit(1000).cast("bigint"))
    return (spans.filter(F.coalesce(tag(MODEL), F.lit("")) != "")
            .select(tag(MODEL).alias("model"), F.coalesce(filled(PROVIDER), filled(SYSTEM)).alias("named_provider"), number(INPUT, "bigint").alias("input_tokens"),
                    number(OUTPUT, "bigint").alias("output_tokens"), number(FIRST_TOKEN, "int").alias("time_to_first_token"),
                    ms("duration_us").alias("latency"), (F.trim(F.coalesce(tag("error"), F.lit(""))) == "").alias("status"),
                    bucket_of_millis(ms("timestamp_us")).alias("time_bucket")))


def pings(rows: DataFrame) -> DataFrame:
    """Keep-alive and property reports (service, instance, ts, properties) to inventory pings."""
    return rows.select(text.service_name(F.col("service")).alias("service"), text.instance_name(F.col("instance")).alias("name"),
                       bucket_of_millis(F.col("ts")).alias("time_bucket"), bucket_of_millis(F.col("ts")).alias("last_ping"), "properties")
