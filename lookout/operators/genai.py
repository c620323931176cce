"""Usage of language models: provider and price by longest prefix, access rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids, text
from ..plans.runtime import lookup_join

UNKNOWN = "unknown"


def match_models(usage: DataFrame, providers: DataFrame, prices: DataFrame, model: str = "model") -> DataFrame:
    """Adds provider, input_price and output_price.

    ``providers``: prefix, provider. ``prices``: prefix, input_price, output_price. Every prefix of a distinct model
    name is looked up by equality in one table of both, and the longest hit counts, so usage rows are only joined with
    one row per model.
    A provider named by the span itself wins over the looked-up one.
    """
    names = usage.select(F.col(model).alias("_m")).distinct().filter(F.coalesce("_m", F.lit("")) != "")
    tries = names.select("_m", F.explode(F.transform(F.sequence(F.lit(1), F.length("_m")), lambda i: F.substring("_m", F.lit(1), i))).alias("prefix"))
    rules = (providers.select("prefix", "provider", F.lit(True).alias("_names"))
             .unionByName(prices.select("prefix", "input_price", "output_price", F.lit(True).alias("_prices")), allowMissingColumns=True))
    longest = lambda c, flag: F.max_by(c, F.when(F.col(flag), F.length("prefix"))).alias(c)
    resolved = tries.join(rules, "prefix").groupBy(F.col("_m").alias(model)).agg(
        longest("provider", "_names"), longest("input_price", "_prices"), longest("output_price", "_prices"))
    known = F.coalesce("named_provider", "provider") if "named_provider" in usage.columns else F.col("provider")
    return lookup_join(usage, resolved, [model]).withColumn("provider", F.coalesce(known, F.lit(UNKNOWN)))


def cost(input_tokens: Column, output_tokens: Column) -> Column:
    """Tokens times price per million, summed and left undivided; prices that are not above 0 add nothing."""
    part = lambda n, p: F.when(F.coalesce(p, F.lit(0.0)) > 0, n * p).otherwise(F.lit(0.0))
    return part(input_tokens, F.col("input_price")) + part(output_tokens, F.col("output_price"))


def access_rows(matched: DataFrame) -> dict[str, DataFrame]:
    """Provider and model access rows. Input: model, provider, tokens, latency, status, ttft, time_bucket."""
    # half-up rounding to a whole number
    total = F.floor(cost(F.col("input_tokens"), F.col("output_tokens")) + 0.5).cast("bigint")
    provider = text.service_name(F.col("provider"))
    sid = ids.service_id(provider, False)
    base = ["input_tokens", "output_tokens", total.alias("total_estimated_cost"), "latency", "status", "time_bucket"]
    return {
        "provider": matched.select(provider.alias("name"), sid.alias("entity_id"), *base),
        "model": matched.select(provider.alias("service"), text.instance_name(F.col("model")).alias("name"),
                                ids.instance_id(sid, text.instance_name(F.col("model"))).alias("entity_id"),
                                "time_to_first_token", *base),
    }
