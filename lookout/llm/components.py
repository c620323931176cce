"""Connected components of an edge table: chunks of edges shrink to stars in tasks, then alternating star contraction
with a written table after each round."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, frugal, table

#: edges that one task contracts at once; a table of at most so many needs no round
TOGETHER = 1 << 18


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) in chunks of about ``TOGETHER``; of each chunk every node with the smallest one it reaches there."""
    held: list[pa.RecordBatch] = []

    def flush() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        nodes = pc.unique(pa.chunked_array(rows.column("a").chunks + rows.column("b").chunks))
        nodes = nodes.take(pc.sort_indices(nodes))
        a, b = (pc.index_in(rows.column(c), nodes).to_numpy() for c in ("a", "b"))
        label = joined(np.arange(len(nodes)), a, b)
        above = np.flatnonzero(label != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([nodes.take(pa.array(above)), nodes.take(pa.array(label[above]))], schema=rows.schema)

    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= TOGETHER:
            yield flush()
            held.clear()
    if sum(x.num_rows for x in held):
        yield flush()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``root`` for every node of an edge: ``root`` is the smallest node that can be reached.

    Tasks first shrink chunks of up to ``TOGETHER`` edges to stars. What is left of them is one more chunk, or where it is
    larger goes through rounds. Each round hangs every node's larger neighbours, then its smaller ones, on the smallest
    neighbour; the number of rounds grows with the logarithm of the component size. Rows with a null end are left out,
    loops and repeated edges change nothing, an empty table gives an empty result. Hubs are held by aggregation, not by
    collecting.
    """
    spark = edges.sparkSession
    links = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null and a <> b")
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in links.schema)
    shrunk = lambda rows: rows.mapInArrow(frugal(_stars), kind)
    links, path = table(shrunk(links))
    count = links.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
    while count[0]:
        if count[0] <= TOGETHER:
            links, _ = table(shrunk(links.coalesce(1)))
            forget(spark, path)
            break
        # larger neighbours to the smallest of the neighbourhood
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # smaller neighbours and the node itself to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        links, new = table(small)
        now = links.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        done = now == count
        forget(spark, path)
        path, count = new, now
        if done:
            break
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label`` (the smallest place that each place is connected to) after the links ``a[i], b[i]``; for one task's rows."""
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        if (label == before).all():
            break
    return label
