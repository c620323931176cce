"""Approximate nearest neighbours by inner product: a hierarchical k-means tree searched best bin first."""

from __future__ import annotations

import heapq
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table
from .vectors import matrix, usable

#: rows of a leaf that one task holds at once, and queries that are compared with them there
CHUNK, ASKED = 4096, 65_536


class Tree:
    """Nodes in levels of ``branch`` children; ``centres`` of all nodes, children ranges, and leaf numbers."""

    def __init__(self, sample: np.ndarray, leaves: int, branch: int = 8, seed: int = 10):
        rng = np.random.default_rng(seed)
        self.centres, self.children, self.leaf = [sample.mean(axis=0) if len(sample) else np.zeros(sample.shape[1])], [[]], [-1]
        # the largest node is split until there are enough leaves
        members = {0: np.arange(len(sample))}
        heap = [(-len(sample), 0)]
        count = 1
        while heap and count + branch - 1 <= leaves:
            size, node = heapq.heappop(heap)
            if -size < 2 * branch:
                break
            at = members.pop(node)
            label, centres = self._means(sample[at], branch, rng)
            if len(np.unique(label)) < 2:
                continue  # equal rows stay one leaf
            for c in range(len(centres)):
                child = len(self.centres)
                self.centres.append(centres[c])
                self.children.append([])
                self.leaf.append(-1)
                self.children[node].append(child)
                members[child] = at[label == c]
                heapq.heappush(heap, (-len(members[child]), child))
            count += len(centres) - 1
        self.centres = np.array(self.centres)
        for n, node in enumerate(i for i, c in enumerate(self.children) if not c):
            self.leaf[node] = n
        self.leaves = n + 1

    @staticmethod
    def _means(x: np.ndarray, k: int, rng, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
        distinct = np.sort(np.unique(x, axis=0, return_index=True)[1])
        centres = x[distinct[rng.choice(len(distinct), min(k, len(distinct)), replace=False)]]
        for _ in range(rounds):
            label = ((centres * centres).sum(1) - 2 * x @ centres.T).argmin(axis=1)
            counts = np.bincount(label, minlength=len(centres))
            sums = np.zeros_like(centres)
            np.add.at(sums, label, x)
            centres = sums[counts > 0] / counts[counts > 0][:, None]
        label = ((centres * centres).sum(1) - 2 * x @ centres.T).argmin(axis=1)
        return label, centres

    def distances(self, x: np.ndarray) -> np.ndarray:
        return (self.centres * self.centres).sum(1) - 2 * x @ self.centres.T

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector: down the nearest children."""
        node = np.zeros(len(x), dtype=np.int64)
        d = self.distances(x)
        active = np.arange(len(x))
        while len(active):
            for n in np.unique(node[active]):
                if self.children[n]:
                    at = active[node[active] == n]
                    kids = np.array(self.children[n])
                    node[at] = kids[d[np.ix_(at, kids)].argmin(axis=1)]
            active = active[[bool(self.children[n]) for n in node[active]]]
        return np.array(self.leaf)[node]

    def visit(self, x: np.ndarray, most: int, filled: np.ndarray | None = None, least: np.ndarray | None = None) -> list[list[int]]:
        """Leaves of each query in best-bin-first order, ``most`` of them: the nearest waiting node is opened first.

        With ``filled``, the rows of each leaf, more are opened until they hold ``least`` rows.
        """
        out = []
        for i, d in enumerate(self.distances(x)):
            queue, seen, held = [(0.0, 0)], [], 0
            while queue and (len(seen) < most or (filled is not None and held < least[i])):
                _, node = heapq.heappop(queue)
                kids = self.children[node]
                if not kids:
                    seen.append(self.leaf[node])
                    held += 0 if filled is None else filled[self.leaf[node]]
                for k in kids:
                    heapq.heappush(queue, (d[k], k))
            out.append(seen)
        return out


def _raised(x: np.ndarray, most: float) -> np.ndarray:
    """One more component that makes all rows equally long, so that the nearest is the one with the largest inner product."""
    return np.column_stack([x, np.sqrt(np.maximum(most * most - (x * x).sum(axis=1), 0))])


def _best(queries: np.ndarray, owners: np.ndarray, data: np.ndarray, ids: np.ndarray, floors: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each query the ``k`` best of ``data`` at its floor or above, the query's own id left out; ties to smaller ids.

    A matrix product preselects with a margin for its rounding; what is given out is summed pair by pair.
    """
    for first in range(0, len(queries), 512):
        q = queries[first:first + 512]
        s = q @ data.T
        s[owners[first:first + 512, None] == ids[None, :]] = -np.inf
        margin = 1e-9 * (np.abs(s[np.isfinite(s)]).max() if np.isfinite(s).any() else 0.0)
        cut = np.full(len(q), -np.inf) if s.shape[1] <= k else np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
        cut = np.maximum(cut, floors[first:first + 512]) - margin
        a, b = np.nonzero((s >= cut[:, None]) & (s > -np.inf))
        exact = np.empty(len(a))
        for i in range(0, len(a), 1 << 16):
            exact[i:i + (1 << 16)] = np.einsum("ij,ij->i", q[a[i:i + (1 << 16)]], data[b[i:i + (1 << 16)]])
        order = np.lexsort((ids[b], -exact, a))
        a, b, exact = a[order], b[order], exact[order]
        begin = np.searchsorted(a, np.arange(len(q)))
        top = np.arange(len(a)) - begin[a] < k
        yield first + a[top], b[top], exact[top]


def _search(k: int):
    """Tiles arrive sorted, each with its data rows before its queries; the data of one tile is held at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held, ids, data = None, [], None, None
        for batch in batches:
            tiles, side = batch.column("tile").to_numpy(), batch.column("side").to_numpy()
            edge = np.flatnonzero((tiles[1:] != tiles[:-1]) | (side[1:] != side[:-1])) + 1
            for lo, hi in zip([0, *edge], [*edge, len(tiles)]):
                part = batch.slice(lo, hi - lo)
                if not part.num_rows:
                    continue
                if tile != tiles[lo]:
                    tile, held, ids, data = tiles[lo], [], None, None
                if side[lo] == 0:
                    held.append(part)
                    continue
                if not held:
                    continue
                if data is None:
                    whole = pa.Table.from_batches(held)
                    ids, data = whole.column("id").to_numpy(), matrix(whole.column("v"))
                owners, rows, floors = part.column("id").to_numpy(), part.column("row").to_numpy(), part.column("floor").to_numpy()
                for a, b, s in _best(matrix(part.column("v")), owners, data, ids, floors, k):
                    yield pa.RecordBatch.from_arrays([pa.array(rows[a]), pa.array(owners[a]), pa.array(ids[b]), pa.array(s)], ["row", "query_id", "vec_id", "score"])
    return run


def nearest(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 20, every: int = 20, recall: float = 0.95,
            leaf_rows: int = 256, most_leaves: int = 1024, sample_rows: int = 20_000, calibration: int = 200, apart: int = 64) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found by inner product for each row whose key is divisible by ``every``.

    1. The ``apart`` longest vectors (half of a smaller table at most) are compared with every query, so that a few
       very long ones do not flatten the space of the others. Of equal vectors only the rows of the ``k + 1`` smallest
       keys can be among the ``k`` nearest of any query; the others are not indexed.
    2. A tree of k-means splits is fitted on a sample of at most ``sample_rows`` of the rest (the first by a digest of
       the key), with one leaf for about ``leaf_rows`` rows, ``most_leaves`` at most. Vectors get one more component
       that makes them equally long, which turns the largest inner product into the smallest distance.
    3. Every vector goes to its leaf. ``calibration`` queries are compared with all vectors, and the number of leaves
       to visit is the smallest at which best-bin-first order reaches ``recall`` of their true neighbours.
    4. Each query visits these leaves, and more while they hold fewer than ``k`` rows of other keys. Its first ones
       give a floor for its ``k``-th score; the other leaves give only what reaches the floor. Large leaves are dealt
       over chunks of ``CHUNK`` rows, which a query visits all, and many queries of a leaf over parts of ``ASKED``.

    Scores are inner products of the given vectors in double precision; ties go to the smaller key. Vectors that are
    null, empty, zero, hold null or non-finite components or are not of the most frequent length, and rows without a
    key, take no part. A query leaves out the rows of its own key; a repeated query row has its own list. Fewer
    candidates than ``k``: all of them. An empty table gives an empty result. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v")).where(F.col(key).isNotNull() & usable(F.col(vector)))
    rows, _ = table(rows.withColumn("row", F.monotonically_increasing_id()))
    common = rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").first()
    kind = vectors.schema[key].dataType.simpleString()
    if common is None:
        return spark.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    size, total = common["size"], common["n"]
    rows = rows.where(F.size("v") == size)
    length = F.sqrt(F.expr("aggregate(v, 0D, (a, x) -> a + x * x)"))
    apart = min(apart, total // 2)
    head = rows.select(length.alias("length"), "id", "row", "v").orderBy(F.desc("length"), "row").limit(apart + 1).toPandas()  # apart + 1 rows
    longest, head = head["length"].iloc[-1], head[:apart]
    head_ids, head_rows = head["id"].to_numpy(), np.vstack([np.zeros((0, size)), *head["v"]])
    copies = Window.partitionBy(F.xxhash64("v"), "v").orderBy("id")
    indexed = rows.where(~F.col("row").isin([int(r) for r in head["row"]])).withColumn("_n", F.dense_rank().over(copies)).where(F.col("_n") <= k + 1)
    indexed, _ = table(indexed.select("id", "row", "v"))
    total = indexed.count()
    sample = indexed.select(F.xxhash64(F.lit(3), "id").alias("o"), "row", "v").orderBy("o", "row").limit(sample_rows).select("v").toPandas()
    tree = Tree(_raised(np.vstack(sample["v"]), longest), max(1, min(most_leaves, total // leaf_rows)))
    shared = spark.sparkContext.broadcast(tree)  # most_leaves centres and their parents

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = shared.value.assign(_raised(matrix(batch.column("v")), longest))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf.astype(np.int32))], [*batch.schema.names, "leaf"])

    data, _ = table(indexed.mapInArrow(assign, "id long, row long, v array<double>, leaf int"))
    queries = rows.where(F.col("id") % every == 0)
    trial = queries.select(F.xxhash64(F.lit(4), "id").alias("o"), "id", "row", "v").orderBy("o", "row").limit(calibration).toPandas()
    if not len(trial):
        return spark.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    tq, towners = np.vstack(trial["v"]), trial["id"].to_numpy()

    def truth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each batch's best for the calibration queries, merged as they come."""
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, leaf = batch.column("id").to_numpy(), batch.column("leaf").to_numpy()
            for a, b, s in _best(tq, towners, matrix(batch.column("v")), ids, np.full(len(tq), -np.inf), k):
                new = pd.DataFrame({"q": a, "id": ids[b], "leaf": leaf[b], "s": s})
                held = new if held is None else pd.concat([held, new])
            held = held.sort_values(["q", "s", "id"], ascending=[True, False, True], kind="stable").groupby("q").head(k)
        if held is not None:
            yield pa.RecordBatch.from_pandas(held.astype({"q": np.int32, "leaf": np.int32}), preserve_index=False)

    best = data.select("id", "v", "leaf").mapInArrow(truth, "q int, id long, leaf int, s double")
    best = best.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("s"), "id"))).where(F.col("n") <= k)
    wanted = best.select("q", "leaf").toPandas()  # calibration x k rows
    order = tree.visit(_query(tq), tree.leaves)
    place = np.zeros((len(tq), tree.leaves), dtype=np.int64)
    for i, leaves in enumerate(order):
        place[i, leaves] = np.arange(len(leaves))
    ranks = np.sort(place[wanted["q"], wanted["leaf"]]) if len(wanted) else np.zeros(1, np.int64)
    visits = int(ranks[min(int(np.ceil(recall * len(ranks))), len(ranks)) - 1]) + 1
    first = max(1, -(-visits // 16))

    counts = data.groupBy("leaf").agg(F.count("*").alias("n"))
    held = np.zeros(tree.leaves, dtype=np.int64)
    for leaf, n in counts.collect():  # most_leaves rows
        held[leaf] = n
    again = queries.groupBy("id").agg(F.count("*").alias("own")).where("own > 1")  # rows that a query leaves out

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaves = shared.value.visit(_query(matrix(batch.column("v"))), visits, held, k + batch.column("own").to_numpy())
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(leaves, pa.list_(pa.int32()))], ["id", "row", "v", "leaves"])

    asking = queries.join(again, "id", "left").select("id", "row", "v", F.coalesce("own", F.lit(1)).alias("own"))
    routed, _ = table(asking.mapInArrow(route, "id long, row long, v array<double>, leaves array<int>"))
    longest_way = routed.agg(F.max(F.size("leaves"))).first()[0]
    found_as = "row long, query_id long, vec_id long, score double"

    def ahead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best of the longest vectors for each query."""
        for batch in batches:
            if batch.num_rows:
                owners, at = batch.column("id").to_numpy(), batch.column("row").to_numpy()
                for a, b, s in _best(matrix(batch.column("v")), owners, head_rows, head_ids, np.full(len(owners), -np.inf), k):
                    yield pa.RecordBatch.from_arrays([pa.array(at[a]), pa.array(owners[a]), pa.array(head_ids[b]), pa.array(s)], ["row", "query_id", "vec_id", "score"])

    def search(from_: int, upto: int, floors: DataFrame | None = None) -> DataFrame:
        """What the leaves of these places on each query's way give."""
        asked = routed.select("id", "row", "v", F.explode(F.slice("leaves", from_, upto)).alias("leaf"))
        parts = asked.groupBy("leaf").agg(F.ceil(F.count("*") / ASKED).cast("int").alias("parts"))
        parts = F.broadcast(counts.join(parts, "leaf").select("leaf", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"), "parts"))  # most_leaves rows
        asked = asked.withColumn("floor", F.lit(float("-inf"))) if floors is None else asked.join(floors, "row", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
        dealt = data.withColumn("floor", F.lit(0.0)).join(parts, "leaf").withColumn("c", F.pmod(F.xxhash64("row"), F.col("chunks")).cast("int")).withColumn(
            "p", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        sent = asked.join(parts, "leaf").withColumn("p", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")).withColumn(
            "c", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        both = [x.select(F.xxhash64("leaf", "c", "p").alias("tile"), F.lit(side).alias("side"), "id", "row", "v", "floor") for side, x in enumerate((dealt, sent))]
        return both[0].unionByName(both[1]).repartition("tile").sortWithinPartitions("tile", "side").mapInArrow(_search(k), found_as)

    ranked = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    start = search(1, first)
    if apart:
        start = start.unionByName(queries.select("id", "row", "v").mapInArrow(ahead, found_as))
    near = start.withColumn("n", F.row_number().over(ranked)).where(F.col("n") <= k).drop("n")
    near, _ = table(near)
    floors = near.groupBy("row").agg(F.when(F.count("*") >= k, F.min("score")).alias("floor"))
    found = near.unionByName(search(first + 1, tree.leaves, floors)) if longest_way > first else near
    out = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    return out.select(F.col("query_id").cast(kind).alias("query_id"), "rank", F.col("vec_id").cast(kind).alias("vec_id"), "score")


def _query(x: np.ndarray) -> np.ndarray:
    return np.column_stack([x, np.zeros(len(x))])
