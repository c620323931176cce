"""Ranked lexical search: bit-sliced Bloom signatures bound every document's score, what they cannot exclude is scored exactly."""

from __future__ import annotations

import math
from typing import Any, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import _LOWER, CHUNK_BYTES, mix, span_hashes, table, text_chunks, word_bounds

#: a term: a longest run of ASCII letters, digits and all other characters above ASCII
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_OUTSIDE = np.ones(256, dtype=bool)
_OUTSIDE[0x30:0x3A] = _OUTSIDE[0x41:0x5B] = _OUTSIDE[0x61:0x7B] = _OUTSIDE[0x80:] = False
#: a term is in a signature once for each of these numbers of occurrences that it reaches
LEVELS = (1, 2, 4)
#: bits that a term sets, and bits of a signature for each entry it is made for
HASHES, BITS = 3, 8
#: entries and documents of a block at most, unless one document has more
ENTRIES, DOCS = 1 << 18, 2048
#: documents that are scored at once
SCORED = 64


def _windows(data: np.ndarray, offsets: np.ndarray, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Texts in runs of bounded size: first document, bytes, offsets. A longer text comes in parts that end outside a term."""
    if len(offsets) > 2 or len(data) <= 2 * most:
        yield 0, data, offsets
        return
    at = 0
    while at < len(data):
        end = min(at + most, len(data))
        while end < len(data) and not _OUTSIDE[data[end]]:
            gaps = np.flatnonzero(_OUTSIDE[data[end:end + most]])
            end = end + int(gaps[0]) if len(gaps) else min(end + most, len(data))
        yield 0, data[at:end], np.array([0, end - at])
        at = end


def _strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The lower-cased byte spans as strings."""
    size = end - start
    offsets = np.concatenate(([0], np.cumsum(size)))
    at = np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(_LOWER[data[at]])])


def _counted(row: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows and hashes that differ, in order, with the sums of ``n`` and the place of one example each."""
    order = np.lexsort((h, row))
    r, g = row[order], h[order]
    new = np.ones(len(r), dtype=bool)
    new[1:] = (r[1:] != r[:-1]) | (g[1:] != g[:-1])
    at = np.flatnonzero(new)
    return r[at], g[at], np.add.reduceat(n[order], at) if len(at) else n[:0], order[at]


def _documents(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]]:
    """Runs of documents: document, term hash and occurrences of each distinct term, and a dictionary of the run (hashes, terms)."""
    for first, _, data, offsets in text_chunks(column):
        parts = []
        for _, part, bounds in _windows(data, offsets, CHUNK_BYTES):
            start, end, row = word_bounds(part, bounds, _OUTSIDE)
            h = span_hashes(part, start, end)
            r, g, n, at = _counted(row, h, np.ones(len(h), dtype=np.int64))
            known, one = np.unique(g, return_index=True)
            parts.append((r, g, n, known, _strings(part, start[at[one]], end[at[one]])))
        r, g, n = (np.concatenate([p[i] for p in parts]) for i in range(3))
        if len(parts) > 1:
            r, g, n, _ = _counted(r, g, n)
        yield first + r, g, n, np.concatenate([p[3] for p in parts]), pa.concat_arrays([p[4] for p in parts])


def _places(h: np.ndarray, level: int, width: int) -> list[np.ndarray]:
    """The bits of terms at a level in signatures of ``width`` bits."""
    seed = mix(h + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64))
    return [(mix(seed + np.uint64(i)) & np.uint64(width - 1)).astype(np.int64) for i in range(HASHES)]


class Block:
    """Documents of one signature width, whose signatures lie as one bitmap of documents for each bit."""

    names = ["keys", "lengths", "tops", "n_docs", "n_terms", "width", "slices", "hashes", "words", "held", "sizes", "ids", "counts"]

    def __init__(self, width: int):
        self.width, self.entries, self.docs = width, 0, 0
        self.keys: list[pa.Array] = []
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.known: list[tuple[np.ndarray, pa.Array]] = []

    def add(self, keys: pa.Array, doc: np.ndarray, h: np.ndarray, n: np.ndarray, entries: int, known: tuple[np.ndarray, pa.Array]) -> None:
        self.keys.append(keys)
        self.parts.append((doc + self.docs, h, n))
        self.known.append(known)
        self.docs += len(keys)
        self.entries += entries

    def row(self) -> pa.RecordBatch:
        doc, h, n = (np.concatenate([p[i] for p in self.parts]) for i in range(3))
        words, one = np.unique(np.concatenate([k[0] for k in self.known]), return_index=True)
        mine = np.unique(h)
        words, one = mine, one[np.searchsorted(words, mine)]  # a run's dictionary also has terms of other widths
        strings = pa.concat_arrays([k[1] for k in self.known]).take(pa.array(one))
        bits = np.zeros((self.width, -(-self.docs // 8) * 8), dtype=bool)
        for j, least in enumerate(LEVELS):
            some = n >= least
            for place in _places(h[some], j, self.width):
                bits[place, doc[some]] = True
        ids = np.searchsorted(words, h).astype(np.uint32)
        sizes = np.bincount(doc, minlength=self.docs)
        ends = np.cumsum(sizes)
        lengths, tops = np.add.reduceat(n, ends - sizes), np.maximum.reduceat(n, ends - sizes)
        lists = [pa.concat_arrays(self.keys), pa.array(lengths), pa.array(tops)]
        columns = [pa.ListArray.from_arrays(pa.array([0, self.docs], pa.int32()), x) for x in lists]
        columns += [pa.array([x], pa.int64()) for x in (self.docs, int(lengths.sum()), self.width)]
        columns += [pa.array([x.tobytes()], pa.binary()) for x in (np.packbits(bits, axis=1, bitorder="little"), words)]
        whole = pa.array([0, len(words)], pa.int32())
        columns += [pa.ListArray.from_arrays(whole, strings.cast(pa.string())), pa.ListArray.from_arrays(whole, pa.array(np.bincount(ids, minlength=len(words))))]
        columns += [pa.array([x.tobytes()], pa.binary()) for x in (sizes.astype(np.uint32), ids, np.minimum(n, 2**32 - 1).astype(np.uint32))]
        return pa.RecordBatch.from_arrays(columns, self.names)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    open_: dict[int, Block] = {}
    for batch in batches:
        for doc, h, n, known, strings in _documents(batch.column("text")):
            if not len(doc):
                continue
            docs, first, size = np.unique(doc, return_index=True, return_counts=True)
            entries = sum(np.add.reduceat((n >= least).astype(np.int64), first) for least in LEVELS)
            # widths grow by fours, so that few blocks are open at once
            width = BITS * 16 * 4 ** np.ceil(np.maximum(np.log2(entries / 16), 0) / 2).astype(np.int64)
            for w in np.unique(width).tolist():
                mine = np.flatnonzero(width == w)
                most = max(1, min(DOCS, ENTRIES * BITS // w))
                while len(mine):
                    block = open_.setdefault(w, Block(w))
                    take, mine = mine[:most - block.docs], mine[most - block.docs:]
                    at = np.repeat(first[take] - np.concatenate(([0], np.cumsum(size[take])[:-1])), size[take]) + np.arange(size[take].sum())
                    own = np.isin(known, h[at])
                    block.add(batch.column("key").take(pa.array(docs[take])), np.repeat(np.arange(len(take)), size[take]), h[at], n[at], int(entries[take].sum()),
                              (known[own], strings.filter(pa.array(own))))
                    if block.docs >= most or block.entries >= ENTRIES:
                        yield open_.pop(w).row()
    for block in open_.values():
        yield block.row()


def index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Blocks of documents with their signatures in slices, their dictionary and their exact term lists, written to the
    shared folder. Documents without a term are left out. A block holds at most ``DOCS`` documents or about ``ENTRIES`` terms."""
    kind = docs.schema[key].dataType.simpleString()
    blocks = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(_index, (
        f"keys array<{kind}>, lengths array<long>, tops array<long>, n_docs long, n_terms long, width long, slices binary, hashes binary, "
        "words array<string>, held array<long>, sizes binary, ids binary, counts binary"))
    return table(blocks)[0]


class Item:
    """A query: its terms' numbers in the chunk and weights, and the best documents met so far."""

    def __init__(self, row: int, terms: list[int], weights: list[int]):
        self.row, self.terms, self.weights = row, np.array(terms, dtype=np.int64), np.array(weights, dtype=np.int64)
        self.best: list[tuple[int, bool, Any]] = []

    def offer(self, scores: np.ndarray, keys: list, most: int) -> None:
        self.best += [(-s, k is None, k) for s, k in zip(scores.tolist(), keys)]
        self.best.sort(key=lambda x: x if not x[1] else x[:2])
        del self.best[most:]

    def floor(self, most: int) -> int:
        """A document with a smaller score is not among the best."""
        return -self.best[-1][0] if len(self.best) == most else 1


def gains(count: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term's weight is multiplied by, for its occurrences in a document of measure ``m``; it grows with them."""
    return (1_000_000_000 * count) // (1000 * count + 8 * m)


def _search(items: list[tuple[int, list[int], list[int]]], words: list[str], n_docs: int, n_terms: int, most: int):
    """The best documents of each item among those of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = [w.encode() for w in words]
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        ends = np.cumsum([len(w) for w in raw])
        h = span_hashes(data, ends - [len(w) for w in raw], ends)
        asked = [Item(*i) for i in items]
        kind = None
        for batch in batches:
            kind = batch.schema.field("keys").type.value_type
            for i in range(batch.num_rows):
                _meet({c: batch.column(c)[i] for c in Block.names}, asked, h, words, n_docs, n_terms, most)
        rows = [(item.row, -s, k) for item in asked for s, _, k in item.best]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[2] for r in rows], kind), pa.array([r[1] for r in rows], pa.int64())], ["row", "key", "score"])
    return run


def _meet(block: dict[str, pa.Scalar], asked: list[Item], h: np.ndarray, words: list[str], n_docs: int, n_terms: int, most: int) -> None:
    """Bound all scores of a block's documents for each item, and score exactly, from the largest bound on, what may be among the best."""
    def numbers(name: str, dtype) -> np.ndarray:
        return np.frombuffer(block[name].as_py(), dtype=dtype)

    keys = block["keys"].values
    known, width = numbers("hashes", np.uint64), block["width"].as_py()
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    held = np.flatnonzero(known[at] == h)
    same = block["words"].values.take(pa.array(at[held])).to_pylist()
    held = held[[words[j] == w for j, w in zip(held.tolist(), same)]] if len(held) else held
    local = np.full(len(h), -1)
    local[held] = np.arange(len(held))
    slices = numbers("slices", np.uint8).reshape(width, -1)
    levels = []
    for j in range(len(LEVELS)):
        a, *more = _places(h[held], j, width)
        bits = slices[a]
        for b in more:
            bits = bits & slices[b]
        levels.append(bits & levels[-1] if levels else bits)
    lengths, tops = block["lengths"].values.to_numpy(), block["tops"].values.to_numpy()
    if int(lengths.max()) * 90 * n_docs < 2**63:
        m = 10 + (90 * lengths * n_docs) // n_terms
    else:
        m = np.array([10 + 90 * x * n_docs // n_terms for x in lengths.tolist()])
    most_of_level = [gains(np.full(len(m), n - 1), m) for n in LEVELS[1:]] + [gains(tops, m)]
    steps = np.maximum(np.diff(np.array([np.zeros(len(m), dtype=np.int64), *most_of_level]), axis=0), 0).astype(np.float64)
    sizes = numbers("sizes", np.uint32).astype(np.int64)
    begins = np.cumsum(sizes) - sizes
    ids, counts = numbers("ids", np.uint32), numbers("counts", np.uint32)
    weight_of = np.zeros(len(known), dtype=np.int64)
    for item in asked:
        mine = local[item.terms]
        weights, mine = item.weights[mine >= 0], mine[mine >= 0]
        if not len(mine):
            continue
        bound = np.zeros(len(m))
        for bits, step in zip(levels, steps):
            there = np.unpackbits(bits[mine], axis=1, count=len(m), bitorder="little")
            bound += (weights.astype(np.float64) @ there) * step
        bound *= 1 + 1e-9  # doubles hold the sums exactly, but for items of very many terms
        order = np.flatnonzero(bound >= item.floor(most))
        order = order[np.argsort(-bound[order], kind="stable")]
        weight_of[at[held[mine]]] = weights
        for first in range(0, len(order), SCORED):
            some = order[first:first + SCORED]
            some = some[bound[some] >= item.floor(most)]
            if not len(some):
                break
            n = sizes[some]
            ends = np.cumsum(n)
            where = np.repeat(begins[some] - (ends - n), n) + np.arange(ends[-1])
            weight = weight_of[ids[where]]
            hit = np.flatnonzero(weight)
            doc = np.searchsorted(ends, hit, side="right")
            scores = np.zeros(len(some), dtype=np.int64)
            np.add.at(scores, doc, weight[hit] * gains(counts[where[hit]].astype(np.int64), m[some[doc]]))
            enough = np.flatnonzero(scores >= item.floor(most))
            if len(enough):
                item.offer(scores[enough], keys.take(pa.array(some[enough])).to_pylist(), most)
        weight_of[at[held[mine]]] = 0


def _terms(text: str) -> Column:
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_distinct(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0)))


def ranked(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
           most: int = 10, terms_at_once: int = 1 << 14) -> DataFrame:
    """The ``most`` highest-scoring documents of each item: ``item_key``, int ``rank`` (from 1), ``key``, long ``score``.

    Terms are maximal runs of ASCII letters, digits and characters above ASCII in whole texts, A-Z lower-cased. A score
    sums, over an item's distinct terms, weight * ((10**9 * tf) div (1000 * tf + 8 * m)); the weight is
    floor(1000 * ln((2N + 2) / (2 df + 1))), m is 10 + (90 * n * N) div L, with N, L and df over all documents.

    ``index`` gives each block of documents Bloom signatures as one bitmap of documents for each bit. The bitmaps of a
    term's bits, intersected, show at least the documents that hold it (or hold it twice, four times); the sums of
    weights over them bound every score from above, and all documents whose bound reaches the worst of the best so far
    are scored exactly from their term lists, so none is lost. A task sends ``most`` documents an item. Items meet the
    index in chunks of about ``terms_at_once`` terms, one pass each, so what a task receives of them is bounded.

    Terms are told apart in a block by 64-bit hashes, and an item's terms are compared as strings. Documents with null
    or empty text or no term are not counted and never found; items without such a term have no rows. Equal scores
    come by ascending key, null keys last. Repeated documents are found as often as they come; repeated items have their rows
    as often; null item keys are keys. Without items, documents or scores above 0 the result is empty. Only the named
    columns are read.
    """
    spark = docs.sparkSession
    blocks = index(docs, key, text)
    total = blocks.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    rows = items.select(F.col(item_key).alias("item"), F.col(item_text).alias("text")).withColumn("row", F.monotonically_increasing_id())
    rows, _ = table(rows)
    terms = rows.select("row", F.explode(_terms("text")).alias("word"))
    asked = terms.select("word").distinct()
    held = blocks.select(F.explode(F.arrays_zip("words", "held")).alias("x")).select(F.col("x.words").alias("word"), F.col("x.held").alias("n"))
    frequency = held.join(asked, "word", "left_semi").groupBy("word").agg(F.sum("n").alias("df"))
    terms, _ = table(terms.join(frequency, "word"))
    chunks = -(-terms.count() // terms_at_once)
    shape = "row long, key " + docs.schema[key].dataType.simpleString() + ", score long"
    found = spark.createDataFrame([], shape)
    for c in range(chunks):
        part = terms.where(F.pmod(F.xxhash64("row"), F.lit(chunks)) == c).orderBy("row", "word").collect()
        words = sorted({r.word for r in part})
        number = {w: i for i, w in enumerate(words)}
        weight = {r.word: math.floor(1000 * math.log((2 * total[0] + 2) / (2 * r.df + 1))) for r in part}
        by_row: dict[int, list[str]] = {}
        for r in part:
            if weight[r.word]:
                by_row.setdefault(r.row, []).append(r.word)
        asks = [(row, [number[w] for w in ws], [weight[w] for w in ws]) for row, ws in by_row.items()]
        hits, _ = table(blocks.mapInArrow(_search(asks, words, total[0], total[1], most), shape), batch=4)
        found = found.unionByName(hits)
    best = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("key").asc_nulls_last())
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most)
    return found.join(rows.select("row", "item"), "row").select(F.col("item").alias(item_key), "rank", F.col("key").alias(key), "score")
