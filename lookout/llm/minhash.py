"""MinHash near-duplicate detection by min-max hashing, with every link confirmed on whole shingle sets."""

from __future__ import annotations

import hashlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, frugal, mix, shingle_sets, table, text_chunks
from .components import components, joined
from .vectors import whole_tiles

#: one permutation gives two values, its minimum and its maximum; a band has ``ROWS`` values of ``ROWS // 2`` permutations
BANDS, ROWS = 32, 4
_rng = np.random.default_rng(9)
_FACTORS = _rng.integers(1, 2**63, BANDS * ROWS // 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _rng.integers(0, 2**63, BANDS * ROWS // 2, dtype=np.uint64)
#: turns of leaders go on while each leaves at most this share of the pairs of different components, but not beyond TURNS
PROGRESS, TURNS = 0.5, 4
#: signature bytes of 128 that two similar sets share at least: 0.8 of them less six standard deviations
AGREE = 75
#: members of a band that one tile holds
TILE = 2048


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """``len(sets)`` x ``BANDS`` keys, and a byte of every signature value. Each permutation is evaluated once and gives
    both its ends; sets are not empty."""
    flat = np.concatenate(sets)
    begin = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    out = np.zeros((len(sets), BANDS), dtype=np.uint64)
    short = np.zeros((len(sets), BANDS * ROWS), dtype=np.uint8)
    for i in range(BANDS * ROWS // 2):
        v = (flat ^ _SHIFTS[i]) * _FACTORS[i]
        v ^= v >> np.uint64(32)
        band = i // (ROWS // 2)
        low, high = np.minimum.reduceat(v, begin), np.maximum.reduceat(v, begin)
        out[:, band] = mix(mix(out[:, band] + low) + high + np.uint64(band + 1))
        short[:, 2 * i], short[:, 2 * i + 1] = mix(low), mix(high)  # the lowest eight bits
    return out, short


def _signed(texts: str, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_chunks(batch.column(texts)):
                sets = shingle_sets(data, offsets, k)
                counts = np.array([len(s) for s in sets], dtype=np.int64)
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                full = np.flatnonzero(counts)
                bands = np.zeros((0, BANDS), np.uint64)
                if len(full):
                    bands, _ = signatures([sets[i] for i in full])
                has = (counts > 0).astype(np.int32) * BANDS
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(has))), pa.int32()),
                                                 pa.array(bands.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_key").slice(first, end - first), pa.array(counts), pa.array(digests, pa.binary()), lists],
                    ["key", "n_shingles", "digest", "bands"])
    return run


def _sets(texts: str, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_chunks(batch.column(texts)):
                sets = [s for s in shingle_sets(data, offsets, k) if len(s)]
                if not sets:
                    continue
                raw = [s.tobytes() for s in sets]
                digests = [hashlib.blake2b(r, digest_size=16).digest() for r in raw]
                short = [v.tobytes() for v in signatures(sets)[1]]
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.binary()) for v in (digests, raw, short)], ["digest", "shingles", "short"])
    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (a, b) in enumerate(zip(batch.column("sa"), batch.column("sb"))):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (a, b))
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    continue
                both = np.concatenate((x, y))
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                keep[i] = 100 * shared >= percent * (len(x) + len(y) - shared)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep))
    return run


def _pairs_of(groups: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all pairs within equal neighbours of ``groups``, some thousand at a time."""
    starts = np.flatnonzero(np.append(True, groups[1:] != groups[:-1]))
    ends = np.append(starts[1:], len(groups))
    size = np.repeat(ends, ends - starts) - np.arange(len(groups)) - 1  # partners behind each place
    done = 0
    while done < len(groups):
        upto = max(int(np.searchsorted(np.cumsum(size[done:]), 50_000, side="right")), 1) + done
        n = size[done:upto]
        left = np.repeat(np.arange(done, upto), n)
        yield left, left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)
        done = upto


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For members of a tile that may be similar to others by their signatures, the first of their kind; tiles arrive sorted."""
    held: list[pa.RecordBatch] = []

    def flush(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        tiles, side = rows.column("tile").to_numpy(), rows.column("side").to_numpy()
        roots, digests = rows.column("root").combine_chunks().dictionary_encode().indices.to_numpy(), rows.column("digest").combine_chunks()
        short = np.frombuffer(b"".join(rows.column("short").to_pylist()), dtype=np.uint8).reshape(rows.num_rows, -1)
        label = np.arange(rows.num_rows)
        for a, b in _pairs_of(tiles):
            # a tile of two blocks compares members of different blocks, a tile of one block all of its own
            ok = (roots[a] != roots[b]) & ((side[a] != side[b]) | (side[a] == 2))
            a, b = a[ok], b[ok]
            near = (short[a] == short[b]).sum(axis=1) >= AGREE
            if near.any():
                label = joined(label, a[near], b[near])
        hit = np.flatnonzero(label != np.arange(len(label)))
        if len(hit):
            yield pa.RecordBatch.from_arrays([digests.take(pa.array(hit)), digests.take(pa.array(label[hit]))], ["a", "b"])

    for batch in batches:
        held.append(batch)
        rows = pa.Table.from_batches(held)
        tiles = rows.column("tile").to_numpy()
        whole = int(np.searchsorted(tiles, tiles[-1], side="left"))
        if whole:
            yield from flush(rows.slice(0, whole))
            held = rows.slice(whole).combine_chunks().to_batches()
    if held:
        yield from flush(pa.Table.from_batches(held))


def _dealt(members: DataFrame, group: str, size: int, columns: list[str]) -> DataFrame:
    """``members`` by tile: those of one group are dealt over blocks of about ``size``, and every two blocks meet in one tile.

    ``side`` is 2 in the tile of a block with itself, else 0 and 1 for its two blocks.
    """
    n = members.groupBy(group).agg(F.ceil(F.count("*") / size).cast("int").alias("_n"))
    dealt = members.join(n, group).withColumn("_i", F.pmod(F.xxhash64("digest", F.lit(1)), F.col("_n")).cast("int"))
    dealt = dealt.withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    tile = F.xxhash64(group, F.least("_i", "_j"), F.greatest("_i", "_j"))
    side = F.when(F.col("_i") == F.col("_j"), 2).when(F.col("_i") < F.col("_j"), 0).otherwise(1)
    return dealt.select(tile.alias("tile"), side.alias("side"), *columns).repartition("tile").sortWithinPartitions("tile")


def _remaining(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect what pairs of different components sharing a band still connect.

    Tiles of bands compare signatures and give out, for each member, only the first one it may be similar to through
    others; the components of that are clusters. Tiles of clusters then compare signatures again and whole sets where
    they agree, and give out the links that join components: at most one for each member and tile.
    """
    short = members.join(sets.select("digest", "short"), "digest")
    likely = _dealt(short, "band", TILE, ["digest", "root", "short"]).mapInArrow(frugal(_alike), "a binary, b binary")
    clusters, _ = table(components(likely))
    roots = members.select("digest", "root").distinct()
    inside = clusters.select(F.col("node").alias("digest"), F.col("root").alias("cluster")).join(roots, "digest").join(sets, "digest")
    return _dealt(inside, "cluster", TILE // 2, ["digest", "root", "short", "shingles"]).mapInArrow(frugal(_joining(percent)), "a binary, b binary")


def _joining(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_tiles(batches):
            side = rows.column("side").to_numpy()
            digests = rows.column("digest").to_pylist()
            label = rows.column("root").combine_chunks().dictionary_encode().indices.to_numpy().copy()
            short = np.frombuffer(b"".join(rows.column("short").to_pylist()), dtype=np.uint8).reshape(rows.num_rows, -1)
            sets = [np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in rows.column("shingles").combine_chunks()]
            sizes = np.array([len(v) for v in sets])
            hashed: dict[int, frozenset] = {}
            left, right, found = np.arange(len(side)), np.arange(len(side)), []
            if side[0] != 2:
                left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            for i in left:
                others = right[right > i] if side[0] == 2 else right
                others = others[label[others] != label[i]]
                others = others[100 * np.minimum(sizes[others], sizes[i]) >= percent * np.maximum(sizes[others], sizes[i])]
                agree = (short[others] == short[i]).sum(axis=1)
                others = others[agree >= AGREE][np.argsort(-agree[agree >= AGREE], kind="stable")]
                for j in others:
                    if label[i] == label[j]:
                        continue
                    x, y = (hashed.get(k) or hashed.setdefault(k, frozenset(sets[k].tolist())) for k in (int(i), int(j)))
                    shared = len(x & y)
                    if 100 * shared >= percent * (len(x) + len(y) - shared):
                        found.append((digests[i], digests[j]))
                        label[label == label[j]] = label[i]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.binary())], ["a", "b"])
    return run


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole shingle sets are similar enough."""
    left = sets.select(F.col("digest").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("digest").alias("b"), F.col("shingles").alias("sb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(frugal(_confirm(percent)), "a binary, b binary")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: ``key``, long ``n_shingles``, ``component_id`` and boolean ``kept``.

    A document's set holds the distinct shingles of ``words`` words (longest runs of characters other than space, tab
    to carriage return; A-Z lower-cased); fewer words make one shingle. Documents are linked when 100 * intersection
    >= ``percent`` * union. ``component_id`` is the smallest key that links reach, and ``kept`` marks its document.

    1. Each permutation is evaluated once and gives its minimum and its maximum, so ``BANDS`` x ``ROWS`` signature
       values cost half as many evaluations. At 0.8 all bands miss a pair with probability (1 - 0.8**4)**32, 5e-8.
    2. Equal sets become one class (a digest), so copies cost one row from then on.
    3. Classes that share a band are compared with one leader of it, and links are confirmed on the whole sets. Leaders
       change from turn to turn as long as that joins components quickly; bands that lie in one component drop out.
    4. What is left in bands is compared pair by pair in tiles of bounded size: first on the signatures, then, where
       ``AGREE`` of 128 values agree (a pair at 0.8 fails that with a probability near 1e-9), on the whole sets. Tiles
       give out spanning links, not pairs. So a band of n classes never gives n * n rows, and no pair that shares a
       band is skipped unless its ends are connected already.

    Texts that are null, empty or blank have an empty set and are linked with nothing: component_id is their own key.
    A null key is linked by its text like any other; component_id is null where all keys are. Repeated rows stay, each
    with the class's result. An empty table gives an empty result. Only the named columns are read.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    rows, _ = table(source.mapInArrow(frugal(_signed("_text", words)), f"key {kind}, n_shingles long, digest binary, bands array<long>"), batch=1000)
    full = rows.where("digest is not null")
    classes = full.groupBy("digest").agg(F.min("key").alias("least"), F.first("bands").alias("bands"))
    band = classes.select("digest", F.posexplode("bands").alias("_i", "_b")).select("digest", F.xxhash64("_i", "_b").alias("band"))
    shared = band.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    buckets, buckets_at = table(band.join(shared, "band").withColumn("root", F.col("digest")))
    nodes = buckets.select("digest").distinct()
    # the whole texts of one document of each class that shares a band
    wanted = rows.join(nodes, "digest", "left_semi").groupBy("digest").agg(F.min("key").alias("w")).select("w").distinct()
    whole = source.join(wanted, F.col("_key").eqNullSafe(F.col("w")), "left_semi").mapInArrow(frugal(_sets("_text", words)), "digest binary, shingles binary, short binary")
    sets, _ = table(whole.join(nodes, "digest", "left_semi").dropDuplicates(["digest"]), batch=1000)
    links = None
    roots, turn, before = None, 0, 0
    while True:
        left = buckets.groupBy("band", "root").agg(F.count("*").alias("n")).groupBy("band").agg(
            F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("q")).where("n * n > q")
        left, _ = table(left)
        pairs = left.agg(F.sum((F.col("n") * F.col("n") - F.col("q")) / 2)).first()[0]
        if not pairs:
            break
        open_ = buckets.join(left.select("band"), "band")
        last = turn >= TURNS or bool(turn) and pairs > PROGRESS * before
        before = pairs
        if last:
            new, _ = table(_remaining(open_, sets, percent), batch=1000)
        else:
            order = F.struct(F.xxhash64("digest", F.lit(turn)).alias("o"), "digest", "root")
            lead = open_.groupBy("band").agg(F.min(order).alias("l")).select("band", F.col("l.digest").alias("b"), F.col("l.root").alias("_r"))
            found = open_.withColumnRenamed("digest", "a").join(lead, "band").where("root <> _r").select("a", "b").distinct()
            new, _ = table(_links(found, sets, percent), batch=1000)
        links = new if links is None else links.unionByName(new)
        roots = components(links)
        if last:
            break
        roots, _ = table(roots)
        buckets = buckets.drop("root").join(roots.select(F.col("node").alias("digest"), "root"), "digest", "left")
        older = buckets_at
        buckets, buckets_at = table(buckets.withColumn("root", F.coalesce("root", "digest")))
        forget(spark, older)
        turn += 1
    return _result(rows, classes, roots, key)


def _result(rows: DataFrame, classes: DataFrame, roots: DataFrame | None, key: str) -> DataFrame:
    members = classes.select("digest", "least")
    if roots is not None:
        members = members.join(roots.select(F.col("node").alias("digest"), "root"), "digest", "left")
        members = members.withColumn("root", F.coalesce("root", "digest"))
        least = members.groupBy("root").agg(F.min("least").alias("component_id"))
        members = members.join(least, "root").select(F.col("digest").alias("_d"), "component_id")
    else:
        members = members.select(F.col("digest").alias("_d"), F.col("least").alias("component_id"))
    out = rows.join(members, F.col("digest") == F.col("_d"), "left")
    component = F.when(F.col("digest").isNull(), F.col("key")).otherwise(F.col("component_id"))
    return out.select(F.col("key").alias(key), "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col(key) == F.col("component_id"), F.col("component_id").isNull()))


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are the first of their component: the smallest key, of rows with
    one key any one. Documents without words are linked with nothing and stay."""
    columns = docs.columns
    inner = docs.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(columns)]).withColumn("_row", F.monotonically_increasing_id())
    k, t = (f"_c{columns.index(c)}" for c in (key, text))
    found = near_duplicates(inner.select(F.struct(F.col(k).alias("id"), F.col("_row").alias("row")).alias("k"), F.col(t).alias("t")), "k", "t", words, percent)
    kept = found.where("kept").select(F.col("k.row").alias("_kept"))
    return inner.join(kept, F.col("_row") == F.col("_kept"), "left_semi").select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(columns)])
