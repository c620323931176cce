"""Embedding near-duplicates: int8 tile products with rigorous error bounds, doubtful pairs recomputed in full."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .components import components, joined
from .vectors import matrix, usable, whole_tiles

#: vectors of a block; a tile is the product of two
BLOCK = 2048
#: pairs recomputed at once
PAIRS = 1 << 16


class Quantised:
    """Unit vectors as int8 codes with one scale each; ``code``, ``norm`` and ``rest`` bound every product's error.

    With x = scale * q + r, |x.y - scale_x scale_y q_x.q_y| <= |scale_x q_x| |r_y| + |r_x| |scale_y q_y| + |r_x| |r_y|.
    """

    def __init__(self, x: np.ndarray):
        self.raw = x
        unit = x / np.abs(x).max(axis=1, keepdims=True)  # no square overflows
        unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
        self.scale = np.abs(unit).max(axis=1) / 127
        codes = np.rint(unit / self.scale[:, None])
        rest = unit - self.scale[:, None] * codes
        self.norm = self.scale * np.sqrt((codes * codes).sum(axis=1))
        self.rest = np.sqrt((rest * rest).sum(axis=1)) + 1e-9
        # products of int8 codes are whole numbers that single precision holds exactly up to 1040 components
        self.code = codes.astype(np.int8).astype(np.float32 if x.shape[1] <= 1040 else np.float64)
        self.unit = unit

    def may_reach(self, other: Quantised, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Places of the pairs whose cosine may be the threshold or more."""
        product = self.code @ other.code.T
        # scale_x scale_y p + |..| >= threshold, the bound written as a sum of two outer products
        need = threshold - np.outer(self.norm + self.rest, other.rest) - np.outer(self.rest, other.norm)
        return np.nonzero(product * np.outer(self.scale, other.scale) >= need)

    def cosines(self, other: Quantised, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Cosines of the pairs in double precision."""
        out = np.empty(len(a))
        for i in range(0, len(a), PAIRS):
            out[i:i + PAIRS] = np.einsum("ij,ij->i", self.unit[a[i:i + PAIRS]], other.unit[b[i:i + PAIRS]])
        return out


def _tiles(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_tiles(batches):
            side, ids = rows.column("side").to_numpy(), rows.column("row").to_numpy()
            x = matrix(rows.column("v"))
            own = side[0] == 2
            left = np.arange(len(ids)) if own else np.flatnonzero(side == 0)
            right = left if own else np.flatnonzero(side == 1)
            if not len(left) or not len(right):
                continue
            p, q = Quantised(x[left]), Quantised(x[right])
            a, b = p.may_reach(q, threshold)
            if own:
                a, b = a[a < b], b[a < b]
            near = p.cosines(q, a, b) >= threshold
            a, b = left[a[near]], right[b[near]]
            if not len(a):
                continue
            links = np.bincount(a, minlength=len(ids)) + np.bincount(b, minlength=len(ids))
            root = joined(np.arange(len(ids)), a, b)
            hit = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array(ids[hit]), pa.array(links[hit].astype(np.int64)), pa.array(ids[root[hit]])], ["row", "n", "root"])
    return run


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = 0.98) -> DataFrame:
    """One row per vector: ``key``, long ``n_links``, ``component_id`` and boolean ``kept``.

    Vectors are compared when their labels are equal and not null (and they have equally many components); pairs with
    cosine >= ``threshold`` in double precision are links. Each label's vectors are dealt over blocks of about ``BLOCK``
    and every two blocks meet in one task, so a label of any size is split. A tile multiplies int8 codes; only pairs
    that the error bound leaves possible are recomputed. It gives out counts and a spanning forest, not pairs.

    Vectors that are null, empty, zero or hold null or non-finite components, and vectors without a label, have no
    links and are their own component. A null key takes part; its component_id is null if no key is reached. Repeated
    rows are vectors of their own and linked with each other. An empty table gives an empty result. Other columns are
    not read.
    """
    rows = vectors.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v"), F.col(label).alias("label"))
    rows = rows.withColumn("good", usable(F.col("v")) & F.col("label").isNotNull()).withColumn("row", F.monotonically_increasing_id())
    rows, _ = table(rows)
    good = rows.where("good").withColumn("size", F.size("v"))
    blocks = good.groupBy("label", "size").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n"))
    dealt = good.join(blocks, ["label", "size"]).withColumn("i", F.pmod(F.xxhash64("row"), F.col("n")).cast("int"))
    dealt = dealt.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    tile = F.xxhash64("label", "size", F.least("i", "j"), F.greatest("i", "j"))
    side = F.when(F.col("i") == F.col("j"), 2).when(F.col("i") < F.col("j"), 0).otherwise(1)
    dealt = dealt.select(tile.alias("tile"), side.alias("side"), "row", "v").repartition("tile").sortWithinPartitions("tile")
    found, _ = table(dealt.mapInArrow(_tiles(threshold), "row long, n long, root long"))
    counts = found.groupBy("row").agg(F.sum("n").alias("n_links"))
    roots = components(found, "row", "root").withColumnRenamed("node", "row")
    members = rows.select("key", "row").join(roots, "row")
    least = members.groupBy("root").agg(F.min("key").alias("component_id"))
    members = members.join(least, "root").select("row", "component_id", F.lit(True).alias("linked"))
    out = rows.select("key", "row").join(counts, "row", "left").join(members, "row", "left")
    component = F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("key"))
    return out.select(F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("key") == component, component.isNull()).alias("kept"))
