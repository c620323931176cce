"""Service and instance hierarchies across layers.

Every matching rule is an equality of two derived keys, so relations come from one equi join instead of comparing all
pairs of services.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..plans.runtime import stored

# Upper layer -> lower layer -> rule.
DEFINITION = {
    "MESH": {"MESH_DP": "name", "K8S_SERVICE": "short-name"},
    "MESH_DP": {"K8S_SERVICE": "short-name"},
    "GENERAL": {"APISIX": "lower-short-name-remove-ns", "K8S_SERVICE": "lower-short-name-remove-ns", "KONG": "lower-short-name-remove-ns"},
    "MYSQL": {"K8S_SERVICE": "short-name"},
    "POSTGRESQL": {"K8S_SERVICE": "short-name"},
    "APISIX": {"K8S_SERVICE": "short-name"},
    "NGINX": {"K8S_SERVICE": "short-name"},
    "ROCKETMQ": {"K8S_SERVICE": "short-name"},
    "RABBITMQ": {"K8S_SERVICE": "short-name"},
    "KAFKA": {"K8S_SERVICE": "short-name"},
    "CLICKHOUSE": {"K8S_SERVICE": "short-name"},
    "PULSAR": {"K8S_SERVICE": "short-name"},
    "ACTIVEMQ": {"K8S_SERVICE": "short-name"},
    "KONG": {"K8S_SERVICE": "short-name"},
    "AIRFLOW": {"K8S_SERVICE": "short-name"},
    "VIRTUAL_DATABASE": {"MYSQL": "lower-short-name-with-fqdn", "POSTGRESQL": "lower-short-name-with-fqdn",
                         "CLICKHOUSE": "lower-short-name-with-fqdn"},
    "VIRTUAL_MQ": {"ROCKETMQ": "lower-short-name-with-fqdn", "RABBITMQ": "lower-short-name-with-fqdn",
                   "KAFKA": "lower-short-name-with-fqdn", "PULSAR": "lower-short-name-with-fqdn"},
    "CILIUM_SERVICE": {"K8S_SERVICE": "short-name"},
}
# Layer levels.
LEVELS = {
    "MESH": 3, "GENERAL": 3, "VIRTUAL_DATABASE": 3, "VIRTUAL_MQ": 3,
    "MYSQL": 2, "POSTGRESQL": 2, "APISIX": 2, "NGINX": 2, "ROCKETMQ": 2, "CLICKHOUSE": 2, "RABBITMQ": 2, "KAFKA": 2,
    "PULSAR": 2, "ACTIVEMQ": 2, "KONG": 2, "AIRFLOW": 2,
    "MESH_DP": 1, "CILIUM_SERVICE": 1,
    "K8S_SERVICE": 0,
}
FQDN = ".svc.cluster.local"


def _before_last(c: Column, sep: str) -> Column:
    """Text before the last separator, null when there is none or nothing before it."""
    cut = F.regexp_extract(c, r"^(.+)" + sep + r"[^" + sep + r"]*$", 1)
    return F.when(cut != "", cut)


def _keys(name: Column, short: Column) -> dict[str, tuple[Column, Column]]:
    """Rule -> (key of an upper service, key of a lower service). A null key matches nothing."""
    return {
        "name": (name, name),
        "short-name": (short, short),
        "lower-short-name-remove-ns": (short, _before_last(short, r"\.")),
        "lower-short-name-with-fqdn": (_before_last(short, ":"), F.concat(short, F.lit(FQDN))),
    }


def _pick(rule: Column, side: int, keys) -> Column:
    out = F.lit(None).cast("string")
    for r, pair in keys.items():
        out = F.when(rule == r, pair[side]).otherwise(out)
    return out


def match_services(services: DataFrame, definition: Mapping[str, Mapping[str, str]] = DEFINITION) -> DataFrame:
    """Relations (upper, upper_layer, lower, lower_layer) among services (name, layer)."""
    pairs = [(u, l, r) for u, lowers in definition.items() for l, r in lowers.items()]
    table = lambda key, other: F.create_map(*[x for k in dict.fromkeys(p[key] for p in pairs) for x in (
        F.lit(k), F.array(*[F.struct(F.lit(p[other]).alias("layer"), F.lit(p[2]).alias("rule")) for p in pairs if p[key] == k]))])
    svc = services.select("name", "layer", text.short_name(F.col("name")).alias("short")).distinct()
    keys = _keys(F.col("name"), F.col("short"))
    side = lambda key, other: svc.select("name", "layer", "short", F.explode(F.try_element_at(table(key, other), F.col("layer"))).alias("r"))
    upper = side(0, 1).select(F.col("name").alias("upper"), F.col("layer").alias("upper_layer"), F.col("r.layer").alias("lower_layer"),
                              F.col("r.rule").alias("rule"), _pick(F.col("r.rule"), 0, keys).alias("k"))
    lower = side(1, 0).select(F.col("name").alias("lower"), F.col("layer").alias("lower_layer"), F.col("r.layer").alias("upper_layer"),
                              F.col("r.rule").alias("rule"), _pick(F.col("r.rule"), 1, keys).alias("k"))
    return (upper.filter(F.col("k").isNotNull()).join(lower.filter(F.col("k").isNotNull()), ["upper_layer", "lower_layer", "rule", "k"])
            .select("upper", "upper_layer", "lower", "lower_layer").distinct())


REL = ("upper", "upper_layer", "lower", "lower_layer")


def longest_way(definition: Mapping[str, Mapping[str, str]] = DEFINITION) -> int:
    """Relations in the longest way down through the definition's layers; a layer does not count below itself."""
    def down(layer: str, above: frozenset[str]) -> int:
        lowers = [l for l in definition.get(layer, {}) if l not in above]
        return max((1 + down(l, above | {l}) for l in lowers), default=0)
    return max((down(layer, frozenset([layer])) for layer in definition), default=0)


def reduce_relations(relations: DataFrame, definition: Mapping[str, Mapping[str, str]] = DEFINITION) -> DataFrame:
    """Drop relations that follow from a longer way down; ways are no longer than the definition allows."""
    levels = max(longest_way(definition), 2)
    r = relations.select(*REL).distinct()
    step = r.select(F.col("upper").alias("lower"), F.col("upper_layer").alias("lower_layer"),
                    F.col("lower").alias("_n"), F.col("lower_layer").alias("_nl"))
    reach, longer = r, None
    for _ in range(levels - 1):
        reach = reach.join(step, ["lower", "lower_layer"]).select(
            "upper", "upper_layer", F.col("_n").alias("lower"), F.col("_nl").alias("lower_layer")).distinct()
        longer = reach if longer is None else longer.unionByName(reach)
    return r.join(longer, list(REL), "left_anti")


def around_service(relations: DataFrame, name: str, layer: str, max_depth: int = 10) -> DataFrame:
    """Relations found from one service, going up and down at every step.

    The relations are written once, in both directions. A round joins them with the services that the round before
    reached anew, and with nothing else; rounds end when there are none.
    """
    r = relations.select(*REL)
    down = r.select("*", F.col("upper").alias("_from"), F.col("upper_layer").alias("_fl"), F.col("lower").alias("_to"), F.col("lower_layer").alias("_tl"))
    up = r.select("*", F.col("lower").alias("_from"), F.col("lower_layer").alias("_fl"), F.col("upper").alias("_to"), F.col("upper_layer").alias("_tl"))
    edges, _ = stored(down.unionByName(up))
    seen = frontier = relations.sparkSession.createDataFrame([(name, layer)], "_from string, _fl string")
    for _ in range(max_depth - 1):
        near = edges.join(frontier, ["_from", "_fl"], "left_semi").select(F.col("_to").alias("_from"), F.col("_tl").alias("_fl"))
        frontier, _ = stored(near.join(seen, ["_from", "_fl"], "left_anti").distinct())
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
    return edges.join(seen, ["_from", "_fl"], "left_semi").select(*REL).distinct()


def service_hierarchy(relations: DataFrame, name: str, layer: str, max_depth: int = 10,
                      definition: Mapping[str, Mapping[str, str]] = DEFINITION) -> DataFrame:
    """The reduced relations around one service; the services are read and matched once."""
    relations, _ = stored(relations.select(*REL).distinct())
    return reduce_relations(relations, definition).join(around_service(relations, name, layer, max_depth), list(REL), "left_semi")


def related_instances(instances: DataFrame, relations: DataFrame) -> DataFrame:
    """Instance pairs of related services: equal names, the same pod or hostname, or one's name is the other's host.

    ``instances``: service, layer, name, attributes (map). Each way of matching is a key, all in one equi join.
    """
    attrs = F.map_entries("attributes")
    hosts = F.filter(attrs, lambda a: F.lower(a["key"]).isin("pod", "hostname"))
    host = F.get(hosts, F.lit(0))
    key = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("key"))
    left = F.array(key("name", F.col("name")),
                   F.when(host.isNotNull(), key("host", F.concat(host["key"], F.lit("="), host["value"]))),
                   F.when(host.isNotNull(), key("is", host["value"])),
                   F.when(host.isNotNull(), key("of", F.col("name"))))
    right = F.concat(F.array(key("name", F.col("name")), key("is", F.col("name"))),
                     F.transform(attrs, lambda a: key("host", F.concat(a["key"], F.lit("="), a["value"]))),
                     F.transform(hosts, lambda a: key("of", a["value"])))
    ends = (relations.select(F.col("upper").alias("service"), F.col("upper_layer").alias("layer"), F.col("lower").alias("_rs"),
                             F.col("lower_layer").alias("_rl"), F.lit("lower").alias("direction"))
            .unionByName(relations.select(F.col("lower").alias("service"), F.col("lower_layer").alias("layer"), F.col("upper").alias("_rs"),
                                          F.col("upper_layer").alias("_rl"), F.lit("upper").alias("direction"))))
    mine = (instances.join(ends, ["service", "layer"]).select("service", "layer", "name", "_rs", "_rl", "direction",
                                                              F.inline(F.filter(left, lambda x: x.isNotNull()))))
    theirs = instances.select(F.col("service").alias("_rs"), F.col("layer").alias("_rl"), F.col("name").alias("related"), F.inline(right)).distinct()
    hits = mine.join(theirs, ["_rs", "_rl", "kind", "key"])
    return (hits.groupBy("service", "layer", "name", F.col("_rs").alias("related_service"), F.col("_rl").alias("related_layer"), "direction")
            .agg(F.min("related").alias("related")))


def layer_levels(spark) -> DataFrame:
    return spark.createDataFrame(list(LEVELS.items()), "layer string, level int")
