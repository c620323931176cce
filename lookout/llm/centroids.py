"""Centroid clustering: the nearest centroid by the threshold algorithm over centroid lists sorted in each dimension."""

from __future__ import annotations

import hashlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .vectors import matrix

#: components that one step of a search holds at once: vectors times centroids times dimensions
STEP = 1 << 21
#: components saturate here, so that no squared distance of 64 dimensions leaves 64 bits
LARGEST = 1 << 27
_FAR = np.iinfo(np.int64).max


class Lists:
    """The centroids as one list in each dimension, sorted by that component."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        order = np.argsort(centroids, axis=0, kind="stable")
        self.order, self.values = order, np.take_along_axis(centroids, order, axis=0)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of each row's nearest centroid; of equally near ones the smallest number.

        Each dimension's list is walked outward from the row's own value, one centroid a step. What a step meets first
        is measured exactly. A centroid that no list has met is at least as far in every dimension as the step's
        frontier, so a row is done when the sum of the squared frontiers is strictly above its best distance.
        """
        n, d = x.shape
        k = len(self.centroids)
        dims = np.arange(d)
        distance = np.full((n, k), _FAR)
        high = np.empty((n, d), dtype=np.int64)
        for j in dims:
            high[:, j] = np.searchsorted(self.values[:, j], x[:, j])
        low = high - 1
        live = np.arange(n)
        for _ in range(k):
            at = x[live]
            below = np.where(low >= 0, at - self.values[np.maximum(low, 0), dims], _FAR)
            above = np.where(high < k, self.values[np.minimum(high, k - 1), dims] - at, _FAR)
            down = below <= above
            met = np.zeros((len(live), k), dtype=bool)
            met[np.arange(len(live))[:, None], self.order[np.where(down, low, np.minimum(high, k - 1)), dims]] = True
            row, number = np.nonzero(met & (distance[live] == _FAR))
            distance[live[row], number] = ((at[row] - self.centroids[number]) ** 2).sum(axis=1)
            frontier = np.minimum(below, above)
            going = (frontier * frontier).sum(axis=1) <= distance[live].min(axis=1)
            live, low, high = live[going], (low - down)[going], (high + ~down)[going]
            if not len(live):
                break
        which = distance.argmin(axis=1)
        return which, distance[np.arange(n), which]


def _steps(batches: Iterator[pa.RecordBatch], k: int, d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    most = max(1, STEP // (k * d))
    for batch in batches:
        for at in range(0, batch.num_rows, most):
            part = batch.slice(at, most)
            yield part, matrix(part.column("v"), np.int64)


def _sums(centroids: np.ndarray):
    """Each task's sums of the vectors of every centroid, and their number at place -1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, d = centroids.shape
        lists = Lists(centroids)
        held, count = np.zeros((k, d), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for _, x in _steps(batches, k, d):
            which, _ = lists.nearest(x)
            for c in np.flatnonzero(np.bincount(which, minlength=k)):
                held[c] += x[which == c].sum(axis=0)
            count += np.bincount(which, minlength=k)
        some = np.flatnonzero(count)
        if len(some):
            sums = np.column_stack((count[some], held[some]))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(some, d + 1), pa.int32()), pa.array(np.tile(np.arange(-1, d), len(some)), pa.int32()), pa.array(sums.ravel())], ["cluster", "place", "value"])
    return run


def _assigned(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(centroids)
        for part, x in _steps(batches, *centroids.shape):
            which, distance = lists.nearest(x)
            yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(which, pa.int32()), pa.array(distance)], ["key", "cluster", "distance"])
    return run


def clustered(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", dimensions: int = 64, k: int = 8, rounds: int = 10,
              salt: str = "3:", scale: int = 1024) -> DataFrame:
    """k-means in whole numbers: ``key``, int ``cluster``, long ``distance`` (squared), ``cluster_inertia``, ``inertia``
    (distances summed over the cluster and over all) and ``centroid_sha256`` (of the final components, joined by commas).

    Vectors of exactly ``dimensions`` finite components are kept, each component x as floor(scale * x). The first
    centroids are the ``k`` kept vectors with the smallest sha256 of salt and key, in that order. A round gives every
    vector to its nearest centroid and replaces each centroid that has vectors by their componentwise floor of the
    mean; rounds end early when nothing moves, which changes no result. All vectors take part in every round. A task
    sends ``k`` sums, so no cluster is ever gathered; the driver holds ``k`` centroids of ``dimensions`` components.

    Null vectors, other lengths and vectors with null or non-finite components have no row. Zero vectors count. Scaled
    components saturate at 2**27 either way, so that distances fit a long; a sum of distances beyond a long is null.
    A null key has its row and starts no centroid unless fewer than ``k`` rows have a key. Repeated rows are vectors of
    their own; of equal keys the smaller vector starts first. Fewer than ``k`` vectors make as many centroids; without
    any, and for an empty table, the result is empty. Other columns are not read.
    """
    v = F.col(vector).cast("array<double>")
    whole = (F.size(v) == dimensions) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    limit = float(LARGEST)
    scaled = F.transform(v, lambda x: F.floor(F.greatest(F.least(x * float(scale), F.lit(limit)), F.lit(-limit))).cast("int"))
    rows, _ = table(vectors.where(F.coalesce(whole, F.lit(False))).select(F.col(key).alias("key"), scaled.alias("v")))
    spark = rows.sparkSession
    first = rows.orderBy(F.sha2(F.concat(F.lit(salt), F.col("key").cast("string")), 256).asc_nulls_last(), "v").limit(k).select("v").collect()
    out = "key " + rows.schema["key"].dataType.simpleString() + ", cluster int, distance long"
    if not first:
        empty = spark.createDataFrame([], out + ", cluster_inertia long, inertia long, centroid_sha256 string")
        return empty.withColumnRenamed("key", key)
    centroids = np.array([r.v for r in first], dtype=np.int64)
    for _ in range(rounds):
        sums = rows.mapInArrow(_sums(centroids), "cluster int, place int, value long")
        found = sums.groupBy("cluster", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
        count = {r.cluster: int(r.value) for r in found if r.place < 0}
        moved = centroids.copy()
        for r in found:
            if r.place >= 0:
                moved[r.cluster, r.place] = int(r.value) // count[r.cluster]
        if (moved == centroids).all():
            break
        centroids = moved
    placed, _ = table(rows.mapInArrow(_assigned(centroids), out))
    inertia = {r.cluster: int(r.s) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    total = sum(inertia.values())

    def fits(x: int) -> int | None:
        return x if x <= _FAR else None

    about = [(c, fits(x), fits(total), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, x in inertia.items()]
    about = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(about), "cluster").select(  # at most k rows
        F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
