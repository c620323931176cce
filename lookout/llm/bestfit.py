"""Best-fit packing by exact complements: lengths are combined so that they fill a sequence exactly, the rest goes best-fit."""

from __future__ import annotations

import zlib
from collections import Counter
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, table, text_chunks
from .packing import Words


class Complements:
    """Which sums one, two and three of the available lengths can have, and combinations that have a given sum.

    ``available`` holds how many pieces there are of each length. The sums are tables addressed by the sum itself; they
    are made anew only when a length runs out.
    """

    def __init__(self, available: np.ndarray):
        self.available = available
        self.index()

    def index(self) -> None:
        size = len(self.available)
        self.single = self.available > 0
        lengths = np.flatnonzero(self.single).tolist()
        whole = (1 << size) - 1
        one = sum(1 << a for a in lengths)  # bit s is set if the sum s can be had; a shift adds a length to all sums
        two = three = 0
        for a in lengths:
            two |= one << a
        two &= whole
        for a in lengths:
            three |= two << a
        self.pair, self.triple = (
            np.unpackbits(np.frombuffer((x & whole).to_bytes(size // 8 + 1, "little"), np.uint8), count=size, bitorder="little").astype(bool)
            for x in (two, three))

    def filling(self, gap: int, taken: Counter) -> tuple[int, ...] | None:
        """One, two or three lengths with the sum ``gap``, the largest first, that are left beside those ``taken``; none
        for no gap."""
        def left(*lengths: int) -> bool:
            return all(self.available[n] >= taken[n] + lengths.count(n) for n in set(lengths))

        if not gap:
            return ()
        if self.single[gap] and left(gap):
            return (gap,)
        if self.pair[gap]:
            for a in self.places(self.single, gap):
                if left(a, gap - a):
                    return (a, gap - a)
        if self.triple[gap]:
            for a in self.places(self.pair, gap):
                for b in self.places(self.single, gap - a):
                    if left(a, b, gap - a - b):
                        return (a, b, gap - a - b)
        return None

    def places(self, rest: np.ndarray, gap: int) -> list[int]:
        """Lengths a, the largest first, for which ``rest`` holds gap - a."""
        a = np.arange(gap - 1, 0, -1)
        return a[self.single[a] & rest[gap - a]].tolist()


def plan(counts: np.ndarray) -> list[tuple[dict[int, int], int]]:
    """Sequences as (pieces by length, how many such sequences) from the numbers of pieces by length.

    Lengths come in descending order. Pieces of a length go into the smallest gap that takes them, else they open
    sequences. If one, two or three of the available lengths then fill the gap exactly, that combination is consumed as often as
    the numbers allow; otherwise the length is put in as often as it fits and the gap that is left stays open for
    shorter ones. All sequences alike are one step, so work and result depend on the number of lengths, not on that of
    pieces.
    """
    size = len(counts) - 1
    available = counts.astype(np.int64)
    out: list[tuple[dict[int, int], int]] = []
    open_: dict[int, list[tuple[Counter, int]]] = {}
    if available[size]:
        out.append(({size: 1}, int(available[size])))
        available[size] = 0
    found = Complements(available)
    for n in np.flatnonzero(available)[::-1].tolist():
        while left := int(available[n]):
            room = min((g for g in open_ if g >= n), default=size)
            held, times = open_[room].pop() if room in open_ else (Counter(), left)
            if room in open_ and not open_[room]:
                del open_[room]
            # no longer length is left, so three reach at most 3 * n
            tries = range(max(1, -(-room // n) - 3), min(room // n, left) + 1)
            fills = ((j, (n,) * j + rest) for j in tries if (rest := found.filling(room - n * j, Counter({n: j}))) is not None)
            j, new = next(fills, (0, ()))
            taken = Counter(new) if j else Counter({n: min(room // n, left)})
            used = min(times, *(int(available[x]) // c for x, c in taken.items()))
            for x, c in taken.items():
                available[x] -= c * used
            if j:
                out.append((dict(held + taken), used))
            else:
                open_.setdefault(room - n * taken[n], []).append((held + taken, used))
            if held and times > used:
                open_.setdefault(room, []).append((held, times - used))
            if any(found.single[x] and not available[x] for x in taken):
                found.index()
    return out + [(dict(p), t) for group in open_.values() for p, t in group]


class Places:
    """Where the piece of a length with a rank among that length goes: its sequence and its offset there."""

    def __init__(self, made: list[tuple[dict[int, int], int]], length: int):
        used, sequence = np.zeros(length + 1, dtype=np.int64), 0
        rows: dict[int, list[tuple[int, int, int, int]]] = {}
        for pieces, times in made:
            offset = 0
            for n, each in sorted(pieces.items(), reverse=True):
                rows.setdefault(n, []).append((int(used[n]), each, sequence, offset))
                used[n] += each * times
                offset += n * each
            sequence += times
        self.rows = {n: np.array(r, dtype=np.int64).T for n, r in rows.items()}
        self.sequences = sequence

    def of(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
        for n in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == n)
            start, each, first, begin = self.rows[n]
            i = np.searchsorted(start, ranks[at], side="right") - 1
            time, slot = np.divmod(ranks[at] - start[i], each[i])
            sequence[at], offset[at] = first[i] + time, begin[i] + slot * n
        return sequence, offset


def _pieces(path: str, end_id: int, length: int):
    """The pieces of each document; ``part`` and ``place`` number the pieces of one length in a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = Words.of(path), TaskContext.get().partitionId()
        met = [0] * (length + 1)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            for first, stop, _, _ in text_chunks(batch.column("_text"), 4 * CHUNK_BYTES):
                ids, ends = words.of_column(batch.column("_text").slice(first, stop - first))
                raw, begin = ids.tobytes(), 0
                rows: list[tuple] = []
                for doc, last in enumerate((4 * ends).tolist()):
                    text, begin = raw[begin:last] + end, last
                    for piece, at in enumerate(range(0, len(text), 4 * length)):
                        cut = text[at:at + 4 * length]
                        n = len(cut) // 4
                        rows.append((first + doc, piece, n, zlib.crc32(cut), met[n]))
                        met[n] += 1
                doc, piece, n, crc, place = (np.array(c, dtype=np.int64) for c in zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_key").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(piece * length), pa.array(n), pa.array(crc),
                     pa.array(np.full(len(n), part, dtype=np.int32)), pa.array(place)],
                    ["key", "piece", "start", "length", "ids_crc32", "part", "place"])
    return run


def _placed(places: Places):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = places.of(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            names = ["key", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])
    return run


def packed(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = 0, length: int = 2048) -> DataFrame:
    """Pack all documents into few sequences of at most ``length`` tokens; one row per piece of a document.

    A document is the ids of its whole text by the tokenizer file, then ``end_id``. Only documents longer than
    ``length`` are cut, into pieces of that length and a last, shorter one. How pieces combine depends on their lengths
    alone: Spark counts the pieces of each length, the driver plans combinations on at most ``length`` counts
    (``plan``), and each piece finds its place by its rank among the pieces of its length. Ranks are counted by task
    and length, so no length is ever one group.

    Returns ``key``, int ``piece`` (from 0), long ``start`` (ids of the document before it), ``length``, ``ids_crc32``,
    ``sequence_id`` and ``offset`` (gapless from 0 in the sequence). Null and empty texts are the end id alone; null keys
    and repeated rows are documents like any other; an empty table gives an empty result. Only the named columns are
    read.
    """
    kind = docs.schema[key].dataType.simpleString()
    shape = f"key {kind}, piece int, start long, length long, ids_crc32 long"
    pieces = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInArrow(
        _pieces(tokenizer, end_id, length), shape + ", part int, place long")
    pieces, _ = table(pieces)
    counts, _ = table(pieces.groupBy("length", "part").agg(F.count("*").alias("n")))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = counts.select("length", "part", F.coalesce(before, F.lit(0)).alias("base"))
    total = np.zeros(length + 1, dtype=np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # one row a length
        total[r.length] = r.n
    # the counts grow with the tasks, so they are not broadcast
    ranked = pieces.join(bases.hint("merge"), ["length", "part"]).select("key", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("place")).alias("rank"))
    out = ranked.mapInArrow(_placed(Places(plan(total), length)), shape + ", sequence_id long, offset long")
    return out.withColumnRenamed("key", key)
