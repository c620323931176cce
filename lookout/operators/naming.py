"""Endpoint name grouping: regular-expression rules, path patterns, and the cap on unformatted names."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import whole
from ..plans.runtime import LITERAL_ENTRIES
from .topk import first_per_group

ABANDONED = "_abandoned"
VAR = "{var}"


def tokens(uri: Column) -> Column:
    """Path pieces; one leading slash and one trailing slash do not count."""
    parts = F.split(F.regexp_replace(uri, "^/", ""), "/")
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


def split_pattern(pattern: str) -> list[str]:
    body = pattern[1:] if pattern.startswith("/") else pattern
    parts = body.split("/")
    return parts[:-1] if parts[-1] == "" else parts


_NODE = T.StructType([
    T.StructField("_svc", T.StringType()), T.StructField("_node", T.LongType()),
    T.StructField("_names", T.MapType(T.StringType(), T.StructType([T.StructField("ord", T.LongType()), T.StructField("id", T.LongType())]))),
    T.StructField("_var", T.StructType([T.StructField("ord", T.LongType()), T.StructField("id", T.LongType())])),
    T.StructField("_expr", T.StringType())])


def pattern_table(spark: SparkSession, patterns: Sequence[tuple[str, str]]) -> tuple[DataFrame, int]:
    """Rule text (service, pattern) as a table of tree nodes and the depth of the tree. Node 0 is a service's root.

    The first token of a pattern is always literal; of several children that match, the one defined first counts.
    """
    nodes: dict[tuple, dict] = {}
    ids: dict[tuple, int] = {}
    depth = 0
    for service, pattern in patterns:
        parts = split_pattern(pattern)
        depth = max(depth, len(parts))
        for i in range(len(parts) + 1):
            path = (service, *parts[:i])
            if path not in nodes:
                ids[path] = 0 if i == 0 else len(ids) + 1
                nodes[path] = {"names": {}, "var": None, "expr": None}
                if i:
                    parent, entry = nodes[path[:-1]], (len(ids), ids[path])
                    if parts[i - 1] == VAR and i > 1:
                        parent["var"] = entry
                    else:
                        parent["names"][parts[i - 1]] = entry
        nodes[(service, *parts)]["expr"] = pattern
    rows = [(path[0], ids[path], n["names"], n["var"], n["expr"]) for path, n in nodes.items()]
    return spark.createDataFrame(rows, _NODE), depth


#: rule text up to this many characters is broadcast as a table; more is joined like any other table
RULE_BYTES = 4_000_000


def match_patterns(df: DataFrame, patterns: Sequence[tuple[str, str]], service: str = "service", uri: str = "endpoint",
                   out: str = "formatted") -> DataFrame:
    """Adds ``out`` and ``matched``. One-token names match unchanged; others walk the pattern tree token by token.

    The walk is one narrow join per tree level with the rule table, which is as small as the rule text; nothing is
    decided row by row in Python.
    """
    table, depth = pattern_table(df.sparkSession, patterns)
    # the table holds each token of the rule text about once
    small = sum(len(s) + len(p) for s, p in patterns) <= RULE_BYTES
    walked = df.withColumn("_t", tokens(F.col(uri))).withColumn("_at", F.lit(0).cast("bigint"))
    step = F.broadcast(table) if small else table
    for level in range(depth):
        here = walked.join(step, (F.col(service) == F.col("_svc")) & (F.col("_at") == F.col("_node")), "left")
        token = F.get("_t", F.lit(level))
        named = F.try_element_at("_names", token)
        var = F.col("_var")
        pick = F.when(named.isNotNull() & (var.isNull() | (named["ord"] < var["ord"])), named["id"]).otherwise(var["id"])
        # beyond the last token the position stays; a dead end is -1
        walked = (here.withColumn("_at", F.when(F.size("_t") <= level, F.col("_at")).otherwise(F.coalesce(pick, F.lit(-1))))
                  .drop("_svc", "_node", "_names", "_var", "_expr"))
    leaf = table.filter(F.col("_expr").isNotNull()).select("_svc", "_node", "_expr")
    done = walked.join(F.broadcast(leaf) if small else leaf, (F.col(service) == F.col("_svc")) & (F.col("_at") == F.col("_node")), "left")
    single = F.size("_t") == 1
    hit = single | (F.col("_expr").isNotNull() & (F.size("_t") <= depth))
    return (done.withColumn("matched", F.coalesce(hit, F.lit(False)))
            .withColumn(out, F.when(single, F.col(uri)).otherwise(F.when(F.col("matched"), F.col("_expr")).otherwise(F.col(uri))))
            .drop("_t", "_at", "_svc", "_node", "_expr"))


def match_regex(df: DataFrame, rules: Sequence[tuple[str, str, str]], service: str = "service", name: str = "endpoint",
                out: str = "formatted") -> DataFrame:
    """Rules (service, regular expression, group name); the first one that matches the whole name renames it."""
    if len(rules) <= LITERAL_ENTRIES:
        pick: Column = F.lit(None).cast("string")
        for s, regex, group in reversed(rules):
            pick = F.when((F.col(service) == s) & F.col(name).rlike(whole(regex)), group).otherwise(pick)
        df = df.withColumn("_g", pick)
    else:
        table = (df.sparkSession.createDataFrame([(i, *r) for i, r in enumerate(rules)], "ord int, _svc string, regex string, grp string")
                 .groupBy("_svc").agg(F.sort_array(F.collect_list(F.struct("ord", "regex", "grp"))).alias("_rules")))
        joined = df.join(table, F.col(service) == F.col("_svc"), "left")
        first = F.get(F.filter("_rules", lambda r: F.rlike(F.col(name), F.concat(F.lit(r"\A(?:"), r["regex"], F.lit(r")\z")))), F.lit(0))
        df = joined.withColumn("_g", first["grp"]).drop("_svc", "_rules")
    return (df.withColumn("matched", F.col("_g").isNotNull()).withColumn(out, F.coalesce("_g", name)).drop("_g"))


def cap_unformatted(df: DataFrame, n: int, service: str = "service", name: str = "formatted", ts: str = "ts") -> DataFrame:
    """Of the names no rule formatted, the first ``n`` to appear per service stay; the others become one name."""
    seen = (df.filter(~F.col("matched")).groupBy(service, name).agg(F.min(ts).alias("_first")))
    kept = first_per_group(seen, [service], [F.col("_first").asc(), F.col(name).asc()], n).select(
        service, name, F.lit(True).alias("_kept"))
    return (df.join(kept, [service, name], "left")
            .withColumn(name, F.when(F.col("matched") | F.col("_kept"), F.col(name)).otherwise(ABANDONED)).drop("_kept"))


def group_endpoints(df: DataFrame, api_rules=(), custom_rules=(), patterns=(), max_unformatted: int | None = None,
                    service: str = "service", name: str = "endpoint", ts: str = "ts") -> DataFrame:
    """API definitions first, then custom rules, then path patterns; names are cut to their limit before."""
    from ..functions.text import endpoint_name

    out = df.withColumn(name, endpoint_name(F.col(name))).withColumn("_api", F.lit(None).cast("string"))
    for rules in (api_rules, custom_rules):
        if rules:
            out = match_regex(out, rules, service, name, "_f").withColumn(
                "_api", F.coalesce("_api", F.when(F.col("matched"), F.col("_f")))).drop("matched", "_f")
    if patterns:
        out = match_patterns(out, patterns, service, name, "_f").withColumn(
            "_api", F.coalesce("_api", F.when(F.col("matched"), F.col("_f")))).drop("matched", "_f")
    out = out.withColumn("matched", F.col("_api").isNotNull()).withColumn("formatted", F.coalesce("_api", name)).drop("_api")
    return cap_unformatted(out, max_unformatted, service, "formatted", ts) if max_unformatted else out
