"""Service, instance, endpoint and process maps from relation rows.

An edge row is (side, source, target, component_id): ``side`` is client or server and says who reported it.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids
from ..functions.timebucket import Duration

USER_ID_NAME = "User"


def relation_rows(calls: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Relation metric rows: per (relation, side, bucket) the sorted set of component ids."""
    return (calls.groupBy("entity_id", "source_id", "dest_id", "detect_point", "time_bucket", *extra)
            .agg(F.sort_array(F.collect_set("component_id")).alias("components")))


def merge_relation_rows(rows: DataFrame) -> DataFrame:
    """Merge partial relation rows; the id sets are united."""
    keys = [c for c in rows.columns if c != "components"]
    return (rows.select(*keys, F.explode_outer("components").alias("c")).groupBy(*keys)
            .agg(F.sort_array(F.collect_set("c")).alias("components")))


def edges_in_range(rows: DataFrame, duration: Duration | None = None, source="source_id", target="dest_id") -> DataFrame:
    """Distinct edges over a time range, one row per component."""
    if duration is not None:
        rows = rows.filter(F.col("time_bucket").between(duration.start_bucket, duration.end_bucket))
    comp = F.explode_outer("components").alias("component_id") if "components" in rows.columns else F.col("component_id")
    return rows.select(F.lower("detect_point").alias("side"), F.col(source).alias("source"), F.col(target).alias("target"), comp).distinct()


def resolve_aliases(edges: DataFrame, aliases: DataFrame) -> DataFrame:
    """Client edges to a known network address point at the real service behind it."""
    target = ids.parse_service(F.col("target"))["name"]
    right = aliases.select(F.col("address").alias("_addr"), ids.service_id(F.col("alias_service")).alias("_real"))
    joined = edges.withColumn("_addr", F.when(F.col("side") == "client", target)).join(right, "_addr", "left")
    return joined.withColumn("target", F.coalesce("_real", "target")).drop("_addr", "_real")


def _named(edges: DataFrame, components: DataFrame | None) -> DataFrame:
    """Adds component name, server name and priority."""
    if components is None:
        c = F.col("component_id").cast("string")
        return edges.withColumn("component", c).withColumn("server_name", c).withColumn("priority", F.col("component_id"))
    return edges.join(components.select("component_id", "component", "server_name", "priority"), "component_id", "left")


def calls(edges: DataFrame, components: DataFrame | None = None) -> DataFrame:
    """One row per relation with the detect points and components of both sides.

    Both sides are folded in one aggregation; the collected sets hold at most two sides and the registered components.
    """
    e = _named(edges, components)
    on = lambda side: F.sort_array(F.collect_set(F.when(F.col("side") == side, F.col("component"))))
    return (e.groupBy("source", "target")
            .agg(F.sort_array(F.collect_set("side")).alias("detect_points"), on("client").alias("source_components"),
                 on("server").alias("target_components"))
            .withColumn("id", ids.relation_id(F.col("source"), F.col("target"))))


def _is_normal(sid: Column) -> Column:
    return sid.endswith(".1")


def service_nodes(edges: DataFrame, components: DataFrame | None = None) -> DataFrame:
    """Nodes with a type. What a server reports about itself wins, the component of highest priority first; then what
    it says of an inferred caller; then what a client says of an inferred callee. The user node has its own type."""
    e = _named(edges, components)
    entry = lambda node, rank, kind: F.struct(F.col(node).alias("id"), F.lit(rank).alias("rank"), kind.alias("type"),
                                              F.coalesce("priority", F.lit(-1)).alias("priority"),
                                              (-F.col("component_id")).alias("tie"))
    nothing = F.lit(None).cast("string")
    server = F.col("side") == "server"
    items = F.array(
        F.when(server, entry("target", 3, F.col("component"))).otherwise(
            entry("target", 1, F.when(~_is_normal(F.col("target")), F.col("server_name")))),
        F.when(server & ~_is_normal(F.col("source")), entry("source", 2, F.col("server_name"))).otherwise(
            entry("source", 0, nothing)))
    flat = e.select(F.inline(items))
    order = F.when(F.col("type").isNotNull(), F.struct("rank", "priority", "tie"))
    node = flat.groupBy("id").agg(F.max_by("type", order).alias("type"))
    name = ids.parse_service(F.col("id"))["name"]
    user = (name == USER_ID_NAME) & ~_is_normal(F.col("id"))
    return node.select("id", name.alias("name"), F.when(user, "USER").otherwise(F.col("type")).alias("type"),
                       _is_normal(F.col("id")).alias("is_real"))


def around(edges: DataFrame, service_ids: Sequence[str]) -> DataFrame:
    """Edges that touch any of the services."""
    wanted = list(service_ids)
    return edges.filter(F.col("source").isin(wanted) | F.col("target").isin(wanted))


def service_map(edges: DataFrame, service_ids: Sequence[str] | None = None, components: DataFrame | None = None,
                aliases: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(nodes, calls) of the whole system or around some services.

    In the latter case a caller outside the set is only seen as a client, so its type is looked up among the edges in
    which it is the server.
    """
    near = around(edges, service_ids) if service_ids is not None else edges
    if aliases is not None:
        near = resolve_aliases(near, aliases)
    nodes = service_nodes(near, components)
    if service_ids is not None:
        wanted = list(service_ids)
        outside = near.filter((F.col("side") == "client") & ~F.col("source").isin(wanted)).select(F.col("source").alias("id")).distinct()
        served = _named(edges.filter(F.col("side") == "server"), components)
        found = (served.withColumnRenamed("target", "id").join(outside, "id", "left_semi").groupBy("id")
                 .agg(F.max_by("component", F.struct(F.coalesce("priority", F.lit(-1)).alias("p"), (-F.col("component_id")).alias("c"))).alias("_t")))
        nodes = nodes.join(found, "id", "left").withColumn("type", F.coalesce("type", "_t")).drop("_t")
    return nodes, calls(near, components)


def filter_layer(edges: DataFrame, services: DataFrame, layer: str) -> DataFrame:
    """Edges with an end in a layer. ``services``: id, layer."""
    wanted = services.filter(F.col("layer") == layer).select("id").distinct()
    ends = edges.withColumn("_end", F.explode(F.array_distinct(F.array("source", "target"))))
    return ends.join(wanted.withColumnRenamed("id", "_end"), "_end", "left_semi").drop("_end").distinct()


def instance_map(edges: DataFrame, client_service: str, server_service: str, components: DataFrame | None = None) -> DataFrame:
    """Calls between the instances of two services, in both directions."""
    s, t = ids.parse_part(F.col("source"))["service_id"], ids.parse_part(F.col("target"))["service_id"]
    between = ((s == client_service) & (t == server_service)) | ((s == server_service) & (t == client_service))
    return calls(edges.filter(between), components)


def endpoint_map(edges: DataFrame, endpoint_id: str) -> DataFrame:
    """Up- and downstream endpoints; only servers report them."""
    near = edges.filter((F.col("side") == "server") & ((F.col("source") == endpoint_id) | (F.col("target") == endpoint_id)))
    return near.select("source", "target", ids.relation_id(F.col("source"), F.col("target")).alias("id")).distinct()


def process_map(edges: DataFrame, processes: DataFrame, instance_id: str, components: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(nodes, calls) among the processes of an instance. ``processes``: process_id, name, service_id, instance_id, virtual."""
    own = processes.filter(F.col("instance_id") == instance_id).select("process_id")
    touched = (edges.join(own.withColumnRenamed("process_id", "source"), "source", "left_semi")
               .unionByName(edges.join(own.withColumnRenamed("process_id", "target"), "target", "left_semi")).distinct())
    ends = touched.select(F.explode(F.array("source", "target")).alias("process_id")).distinct()
    nodes = processes.join(ends, "process_id", "left_semi").select(
        "process_id", "name", "service_id", "instance_id", (~F.col("virtual")).alias("is_real"))
    return nodes, calls(touched, components)
