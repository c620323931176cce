"""Flame graphs. A node of the call tree is the path from the root frame, so a tree is a table of paths.

Identical stacks are folded before paths are spread out, because that step multiplies rows by the stack depth.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RUN = ("lo", "hi", "lo_t", "hi_t", "n")
CHUNK = 100_000


def _prefixes(stack: str = "stack") -> Column:
    return F.transform(F.sequence(F.lit(1), F.size(stack)), lambda i: F.slice(stack, 1, i))


def _merge(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join runs that touch each other in sequence order, inside one group."""
    w = Window.partitionBy(*keys).orderBy("lo", "hi", "lo_t")
    starts = F.coalesce((F.col("lo") != F.lag("hi").over(w) + 1).cast("int"), F.lit(1))
    numbered = runs.withColumn("_start", starts).withColumn("_run", F.sum("_start").over(w))
    return (numbered.groupBy(*keys, "_run")
            .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("lo_t").alias("lo_t"), F.max("hi_t").alias("hi_t"),
                 F.sum("n").alias("n")).drop("_run"))


def merge_runs(runs: DataFrame, keys: Sequence[str], chunk: int = CHUNK) -> DataFrame:
    """Continuous sequence runs per key.

    Sequences are cut into chunks that are merged on their own. Only the first and last run of a chunk can continue in
    a neighbour, so a second pass joins these at most two rows per chunk, however long the group is; the runs between
    them stay in their chunk, where nothing touches them.
    """
    keys = list(keys)
    cut = runs.withColumn("_chunk", F.floor(F.col("lo") / chunk))
    inner = _merge(cut, [*keys, "_chunk"])
    up = Window.partitionBy(*keys, "_chunk").orderBy("lo", "hi")
    down = Window.partitionBy(*keys, "_chunk").orderBy(F.col("lo").desc(), F.col("hi").desc())
    edge = (F.row_number().over(up) == 1) | (F.row_number().over(down) == 1)
    placed = inner.withColumn("_edge", edge).withColumn("_chunk", F.when(~F.col("_edge"), F.col("_chunk")))
    return _merge(placed.select(*keys, "_chunk", *RUN), [*keys, "_chunk"]).select(*keys, *RUN)


def runs_of(rows: DataFrame, keys: Sequence[str], seq: str = "sequence", time: str = "dump_time", chunk: int = CHUNK) -> DataFrame:
    single = rows.select(*keys, F.col(seq).alias("lo"), F.col(seq).alias("hi"), F.col(time).alias("lo_t"), F.col(time).alias("hi_t"),
                         F.lit(1).cast("bigint").alias("n"))
    return merge_runs(single, keys, chunk)


def island_duration(rows: DataFrame, keys: Sequence[str], seq: str = "sequence", time: str = "dump_time", chunk: int = CHUNK) -> DataFrame:
    """Sum over continuous runs of last minus first time; a lone sample lasts 0."""
    return (runs_of(rows, keys, seq, time, chunk).groupBy(*keys)
            .agg(F.sum(F.col("hi_t") - F.col("lo_t")).alias("duration"), F.sum("n").alias("count")))


def _self_weight(nodes: DataFrame, keys: Sequence[str], value: str, out: str, floor: bool = False) -> DataFrame:
    """Adds ``out`` = value minus the values of the children: every node also charges its parent, so one aggregation
    by path does it without joining the tree to itself."""
    rest = [c for c in nodes.columns if c not in (*keys, "path", value)]
    own = F.struct(F.col("path"), F.col(value).alias(value), F.col(value).alias("_own"), *[F.col(c).alias(c) for c in rest])
    parent = F.slice("path", F.lit(1), F.size("path") - 1)
    none = lambda c: F.lit(0).cast(nodes.schema[c].dataType).alias(c)
    charge = F.struct(parent.alias("path"), none(value), (-F.col(value)).alias("_own"), *[none(c) for c in rest])
    items = F.when(F.size("path") > 1, F.array(own, charge)).otherwise(F.array(own))
    total = F.sum("_own")
    return (nodes.select(*keys, F.inline(items)).groupBy(*keys, "path")
            .agg(*[F.sum(c).alias(c) for c in (value, *rest)], (F.greatest(total, F.lit(0)) if floor else total).alias(out)))


def flame_from_snapshots(snapshots: DataFrame, keys: Sequence[str] = ("segment_id",), chunk: int = CHUNK) -> DataFrame:
    """Thread snapshots (keys, sequence, dump_time, stack) to nodes (keys, path, count, duration, self_duration).

    Runs of one unchanged stack are folded first, then runs of every path prefix.
    """
    keys = list(keys)
    rows = snapshots.filter(F.size("stack") > 0).select(*keys, "sequence", "dump_time", "stack").distinct()
    stacked = runs_of(rows, [*keys, "stack"], chunk=chunk)
    spread = stacked.select(*keys, F.explode(_prefixes()).alias("path"), *RUN)
    merged = merge_runs(spread, [*keys, "path"], chunk)
    nodes = merged.groupBy(*keys, "path").agg(F.sum("n").alias("count"), F.sum(F.col("hi_t") - F.col("lo_t")).alias("duration"))
    return _self_weight(nodes, keys, "duration", "self_duration")


def flame_from_weights(stacks: DataFrame, keys: Sequence[str] = (), weight: str = "weight", distinct_by: Sequence[str] | None = None) -> DataFrame:
    """Weighted stacks to nodes (keys, path, weight). ``distinct_by`` drops repeated reports first."""
    keys = list(keys)
    rows = stacks.filter(F.size("stack") > 0)
    if distinct_by:
        rows = rows.dropDuplicates([*keys, *distinct_by])
    folded = rows.groupBy(*keys, "stack").agg(F.sum(weight).alias("weight"))
    return (folded.select(*keys, F.explode(_prefixes()).alias("path"), "weight").groupBy(*keys, "path")
            .agg(F.sum("weight").alias("weight")))


def flame_kernel(stacks: DataFrame, keys: Sequence[str] = (), aggregate: str = "COUNT") -> DataFrame:
    """Kernel stacks (dump_count, duration, stack): distinct reports, weighted by DURATION or COUNT."""
    weight = {"COUNT": "dump_count", "DURATION": "duration"}[aggregate]
    return flame_from_weights(stacks, keys, weight, distinct_by=("upload_time", "stack", weight))


def flame_go(samples: DataFrame, period_ms: int = 10, keys: Sequence[str] = ("segment_id",)) -> DataFrame:
    """Sampled stacks with counts: duration is count times the sampling period; self time is never negative.

    With several root frames a virtual root above them carries their totals.
    """
    keys = list(keys)
    folded = samples.filter(F.size("stack") > 0).groupBy(*keys, "stack").agg(F.sum("samples").alias("count"))
    nodes = (folded.select(*keys, F.explode(_prefixes()).alias("path"), "count").groupBy(*keys, "path").agg(F.sum("count").alias("count")))
    tops = (nodes.filter(F.size("path") == 1).groupBy(*keys).agg(F.count(F.lit(1)).alias("_roots"), F.sum("count").alias("count")))
    many = tops.filter(F.col("_roots") > 1)
    lifted = nodes.join(many.select(*keys, F.lit(True).alias("_many")), keys, "left").withColumn(
        "path", F.when(F.col("_many"), F.concat(F.array(F.lit("root")), "path")).otherwise(F.col("path"))).drop("_many")
    nodes = lifted.unionByName(many.select(*keys, F.array(F.lit("root")).alias("path"), "count"))
    nodes = nodes.withColumn("duration", F.col("count") * period_ms)
    return _self_weight(nodes, keys, "duration", "self_duration", floor=True)


def merge_trees(trees: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Call trees of many instances (path, total, self) summed by signature path."""
    return trees.groupBy(*keys, "path").agg(F.sum("total").alias("total"), F.sum("self").alias("self"))


def select_snapshots(snapshots: DataFrame, queries: DataFrame, limit: int) -> DataFrame:
    """Snapshots of chosen segments inside their time ranges; of each query at most ``limit`` sequences are analysed.

    ``queries``: segment_id, start, end. The sequence window is that of the first and last snapshot in the range.
    """
    q = queries.select("segment_id", F.col("start").alias("_s"), F.col("end").alias("_e"))
    inside = snapshots.join(q, "segment_id").filter(F.col("dump_time").between(F.col("_s"), F.col("_e")))
    window = inside.groupBy("segment_id", "_s", "_e").agg(F.min("sequence").alias("_lo"), (F.max("sequence") + 1).alias("_hi"))
    window = window.withColumn("_end", F.least(F.col("_hi"), F.col("_lo") + limit))
    picked = snapshots.join(window.drop("_s", "_e", "_hi"), "segment_id").filter(
        (F.col("sequence") >= F.col("_lo")) & (F.col("sequence") < F.col("_end")))
    return picked.drop("_lo", "_end").distinct()


def analyse(snapshots: DataFrame, queries: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """Flame graphs of the chosen segments, and the tip of :func:`over_limit` (no row where all snapshots were analysed)."""
    return flame_from_snapshots(select_snapshots(snapshots, queries, limit)), over_limit(snapshots, queries, limit)


def over_limit(snapshots: DataFrame, queries: DataFrame, limit: int) -> DataFrame:
    """One row (found, tip) when the queries cover more snapshots than are analysed."""
    q = queries.select("segment_id", F.col("start").alias("_s"), F.col("end").alias("_e"))
    spans = (snapshots.join(q, "segment_id").filter(F.col("dump_time").between(F.col("_s"), F.col("_e")))
             .groupBy("segment_id", "_s", "_e").agg((F.max("sequence") + 1 - F.min("sequence")).alias("n")))
    found = spans.agg(F.sum("n").alias("found")).filter(F.col("found") > limit)
    return found.withColumn("tip", F.concat(F.lit(f"The tree covers {limit} of "), F.col("found").cast("string"), F.lit(" snapshots.")))
