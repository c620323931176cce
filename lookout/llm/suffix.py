"""Suffix-array deduplication: removes every byte of a string of ``LENGTH`` bytes that starts anywhere else as well."""

from __future__ import annotations

import hashlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, mix, table, text_chunks

#: bytes of a repeated string
LENGTH = 200
#: the anchor of a string is the smallest hash of GRAM bytes among its first REACH places, the leftmost of equal ones
GRAM, REACH = 8, 150
#: so the LEAD bytes behind the anchor belong to the string wherever in reach its anchor lies
LEAD = LENGTH - REACH + 1
#: bytes of suffixes that one local sort takes
SORTED_BYTES = 8 << 20
#: a lead shared by more different contexts is compared string by string, dealt over all tasks
HOT = 20_000


def contexts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The runs of neighbouring strings with one anchor: row, anchor, and the first and last start of a string."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none, none, none, none
    grams = np.ndarray(shape=(n - GRAM + 1,), dtype="<u8", buffer=data.tobytes(), strides=(1,))
    best = (mix(grams ^ np.uint64(0x5851F42D4C957F2D)) & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while 2 * width <= REACH:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    best = np.minimum(best[:len(best) - (REACH - width)], best[REACH - width:])
    sizes = np.diff(offsets)
    counts = np.maximum(sizes - LENGTH + 1, 0)
    row = np.repeat(np.arange(len(sizes)), counts)
    start = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(offsets[:-1], counts)
    anchor = (best[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    fresh = np.ones(len(row), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(fresh)
    end = np.append(at[1:], len(row)) - 1
    return row[at], anchor[at], start[at], start[end]


def _lead_hashes(data: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the LEAD bytes from each anchor on."""
    from .common import powers, _BYTE

    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[:-1], out=sums[1:])
    return mix((sums[anchor + LEAD] - sums[anchor]) * down[anchor])


def _leads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text: each different lead, and whether the text has it more than once."""
    for batch in batches:
        for first, end, data, offsets in text_chunks(batch.column("_text")):
            row, anchor, _, _ = contexts(data, offsets)
            if not len(row):
                continue
            h = _lead_hashes(data, anchor)
            order = np.lexsort((h, row))
            h, row = h[order], row[order]
            at = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (row[1:] != row[:-1])))
            counts = np.diff(np.append(at, len(h)))
            keys = [c.slice(first, end - first).take(pa.array(row[at])) for c in (batch.column("_key"), batch.column("_hash"))]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(h[at].view(np.int64)), pa.array(counts)], ["_key", "_hash", "lead", "n"])


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The contexts whose leads repeat, one row for each (text, context); a task sends a context's bytes once a batch."""
    for batch in batches:
        known: set[bytes] = set()
        for first, end, data, offsets in text_chunks(batch.column("_text")):
            row, anchor, low, high = contexts(data, offsets)
            if not len(row):
                continue
            h = _lead_hashes(data, anchor).view(np.int64)
            lists = batch.column("leads").slice(first, end - first)
            wanted = lists.flatten().to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(end - first), np.diff(lists.offsets.to_numpy()))
            pairs = np.rec.fromarrays([np.concatenate((owner, row)), np.concatenate((wanted, h))])
            _, codes = np.unique(pairs, return_inverse=True)
            keep = np.flatnonzero(np.isin(codes[len(wanted):], codes[:len(wanted)]))
            raw = data.tobytes()
            found: dict[tuple[int, bytes], list[int]] = {}
            first_of: dict[tuple[int, bytes], tuple[int, int, int]] = {}
            for i in keep:
                a, lo, hi = int(anchor[i]), int(low[i]), int(high[i])
                digest = hashlib.blake2b(raw[lo:hi + LENGTH], digest_size=16, salt=(a - lo).to_bytes(2, "little")).digest()
                at = (int(row[i]), digest)
                found.setdefault(at, []).append(a - int(offsets[row[i]]))
                first_of.setdefault(at, (a, lo, hi))
            if not found:
                continue
            rows = pa.array([r for r, _ in found])
            bodies, offs = [], []
            for (r, digest), (a, lo, hi) in first_of.items():
                bodies.append(None if digest in known else raw[lo:hi + LENGTH])
                known.add(digest)
                offs.append(a - lo)
            keys = [c.slice(first, end - first).take(rows) for c in (batch.column("_key"), batch.column("_hash"))]
            yield pa.RecordBatch.from_arrays(
                [*keys, pa.array([d for _, d in found], pa.binary()), pa.array(list(found.values()), pa.list_(pa.int32())),
                 pa.array(offs, pa.int32()), pa.array(bodies, pa.binary())], ["_key", "_hash", "digest", "anchors", "off", "body"])


def multikey(words: np.ndarray) -> np.ndarray:
    """The order of the rows of a matrix of 64-bit words: sorted by the first, equal ones by the next, and so on."""
    order = np.argsort(words[:, 0], kind="stable")
    group = np.cumsum(np.append(0, words[order][1:, 0] != words[order][:-1, 0]))
    for w in range(1, words.shape[1]):
        counts = np.bincount(group)
        open_ = np.flatnonzero(counts[group] > 1)
        if not len(open_):
            break
        part, of = order[open_], group[open_]
        key = words[part, w]
        again = np.lexsort((key, of))
        order[open_] = part[again]
        key, of = key[again], of[again]
        split = np.zeros(len(order), np.int64)
        split[open_[1:]] = (key[1:] != key[:-1]) & (of[1:] == of[:-1])
        group = np.cumsum(np.append(0, (group[1:] != group[:-1]) | (split[1:] > 0)))
    return order


def _classes(texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted place of each row of bytes, and the bytes it shares with the row before it."""
    wide = np.zeros((len(texts), -(-texts.shape[1] // 8) * 8), np.uint8)
    wide[:, :texts.shape[1]] = texts
    order = multikey(wide.view(">u8").astype(np.uint64))
    ranked = texts[order]
    shared = np.zeros(len(texts), np.int64)
    for i in range(1, len(texts), 1 << 14):
        differs = ranked[i:i + (1 << 14)] != ranked[i - 1:i - 1 + len(ranked[i:i + (1 << 14)])]
        shared[i:i + (1 << 14)] = np.where(differs.any(axis=1), differs.argmax(axis=1), texts.shape[1])
    place = np.empty(len(texts), np.int64)
    place[order] = np.arange(len(texts))
    return place, shared


def repeated(bodies: list[bytes], offs: np.ndarray, many: np.ndarray) -> np.ndarray:
    """For different contexts, each with its anchor's place: which of its strings, by the anchor's place in the string,
    start anywhere else as well. ``many``: the context itself occurs more than once, so all of them do.

    The suffixes from the anchors and the reversed prefixes before them are sorted. Two contexts share the string with
    the anchor at o if they share LENGTH - o bytes of suffix and o bytes of prefix; runs of neighbours that share so
    many bytes number the classes.
    """
    n = len(bodies)
    sizes = np.array([len(b) for b in bodies])
    lowest = offs - (sizes - LENGTH)  # the smallest o
    right, left = np.zeros((n, LENGTH), np.uint8), np.zeros((n, REACH), np.uint8)
    for i, b in enumerate(bodies):
        o = int(offs[i])
        tail = b[o:o + LENGTH]
        right[i, :len(tail)] = np.frombuffer(tail, np.uint8)
        if o:
            left[i, :o] = np.frombuffer(b[:o], np.uint8)[::-1]
    rplace, rshared = _classes(right)
    lplace, lshared = _classes(left)
    out = np.zeros((n, REACH), bool)
    for o in range(REACH):
        some = np.flatnonzero((lowest <= o) & (o <= offs))
        if not len(some):
            continue
        key = np.cumsum(rshared < LENGTH - o)[rplace[some]] * (n + 1) + np.cumsum(lshared < o)[lplace[some]]
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        out[some[order[1:][same]], o] = True
        out[some[order[:-1][same]], o] = True
        out[some[many[some]], o] = True
    return out


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by lead; whole leads are sorted and compared together, some megabytes at a time."""
    held: list[tuple[bytes, bytes, int, int, bytes]] = []
    size = 0

    def flush(rows) -> pa.RecordBatch | None:
        merged: dict[bytes, list] = {}
        for lead, digest, off, n, body in rows:
            if digest in merged:
                merged[digest][2] += n
            else:
                merged[digest] = [body, off, n]
        keys = list(merged)
        masks = repeated([merged[k][0] for k in keys], np.array([merged[k][1] for k in keys]), np.array([merged[k][2] > 1 for k in keys]))
        hit = np.flatnonzero(masks.any(axis=1))
        if not len(hit):
            return None
        packed = np.packbits(masks[hit], axis=1)
        return pa.RecordBatch.from_arrays([pa.array([keys[i] for i in hit], pa.binary()), pa.array([p.tobytes() for p in packed], pa.binary())], ["digest", "mask"])

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("lead", "digest", "off", "n", "body"))):
            if size > SORTED_BYTES and held[-1][0] != row[0]:
                out = flush(held)
                held, size = [], 0
                if out is not None:
                    yield out
            held.append(row)
            size += len(row[4])
    if held:
        out = flush(held)
        if out is not None:
            yield out


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each string of hot contexts by itself."""
    for batch in batches:
        for digest, off, n, body in zip(*(batch.column(c).to_pylist() for c in ("digest", "off", "n", "body"))):
            hashes = [hashlib.blake2b(body[i:i + LENGTH], digest_size=16, salt=(off - i).to_bytes(2, "little")).digest() for i in range(len(body) - LENGTH + 1)]
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.binary()), pa.array([digest] * len(hashes), pa.binary()),
                                              pa.array([off - i for i in range(len(hashes))], pa.int32()), pa.array([n] * len(hashes), pa.int64())], ["s", "digest", "o", "n"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Remove the marked strings from each text."""
    for batch in batches:
        texts = batch.column("_text").to_pylist()
        marks = batch.column("marks").to_pylist()
        rows = []
        for text, found in zip(texts, marks):
            raw = (text or "").encode("utf-8", "surrogatepass")
            if not found:
                rows.append((len(raw), 0, 0, hashlib.sha256(raw).hexdigest()))
                continue
            edges = np.zeros(len(raw) + 1, np.int64)
            for m in found:
                o = np.flatnonzero(np.unpackbits(np.frombuffer(m["mask"], np.uint8))[:REACH])
                starts = (np.array(m["anchors"])[:, None] - o[None, :]).ravel()
                np.add.at(edges, starts, 1)
                np.add.at(edges, starts + LENGTH, -1)
            gone = np.cumsum(edges[:-1]) > 0
            spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
            kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
            rows.append((len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
        columns = [list(c) for c in zip(*rows)] or [[]] * 4
        yield pa.RecordBatch.from_arrays([batch.column("_key"), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())],
                                         ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def marked(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``_key, _hash, marks``: for each text with repeated strings their places, as anchors and masks of strings before them.

    1. Every string of LENGTH bytes has an anchor that depends on its bytes alone, so equal strings have it at the same
       place. A text is a row of contexts: neighbouring strings with one anchor. Leads, the bytes that follow an
       anchor, are counted over all texts; a string can only repeat if its context's lead does.
    2. The contexts with repeated leads are the suffixes to sort. Equal contexts are merged before they are sent. Spark
       range-partitions the rest by lead with sampled splitters, so no lead stands on both sides of a boundary; each
       bucket is sorted by multikey quicksort and neighbours are compared.
    3. A lead with more than HOT different contexts is not sorted in one bucket: its strings are hashed (128 bits) and
       counted one by one over all tasks.
    """
    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(key).alias("_key"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_hash"), F.col(text).alias("_text"))
    leads = source.mapInArrow(_leads, f"_key {kind}, _hash long, lead long, n long")
    again = leads.groupBy("lead").agg(F.sum("n").alias("n")).where("n > 1").select("lead")
    again, again_at = table(again)
    per_text = leads.select("_key", "_hash", "lead").join(again, "lead").groupBy("_key", "_hash").agg(F.collect_set("lead").alias("leads"))
    per_text = per_text.withColumnsRenamed({"_key": "_k", "_hash": "_h"})
    found = source.join(per_text, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_hash") == F.col("_h"))).select("_key", "_hash", "_text", "leads")
    found, _ = table(found.mapInArrow(_candidates, f"_key {kind}, _hash long, digest binary, anchors array<int>, off int, body binary"), batch=2000)
    # one count for each place, the bytes once a batch
    counts = found.groupBy("digest").agg(F.sum(F.size("anchors")).alias("n"))
    bodies = found.where("body is not null").select("digest", "off", "body")
    bodies = bodies.withColumn("lead", F.expr(f"substring(body, off + 1, {LEAD})")).join(counts, "digest")
    bodies, _ = table(bodies.groupBy("digest").agg(F.first("off").alias("off"), F.first("n").alias("n"), F.first("lead").alias("lead"), F.first("body").alias("body")))
    hot = bodies.groupBy(F.xxhash64("lead").alias("l")).agg(F.count("*").alias("c")).where(F.col("c") > HOT).select("l")
    hot, _ = table(hot)
    none = hot.limit(1).count() == 0
    cold = bodies if none else bodies.join(hot, F.xxhash64("lead") == F.col("l"), "left_anti")
    masks = cold.repartitionByRange("lead").sortWithinPartitions("lead").select("lead", "digest", "off", "n", "body").mapInArrow(_compare, "digest binary, mask binary")
    if not none:
        each = bodies.join(hot, F.xxhash64("lead") == F.col("l"), "left_semi").select("digest", "off", "n", "body").mapInArrow(
            _strings, "s binary, digest binary, o int, n long")
        twice = each.groupBy("s").agg(F.sum("n").alias("t")).where("t > 1").select("s")
        bits = each.join(twice, "s").groupBy("digest").agg(F.collect_set("o").alias("os"))
        masks = masks.unionByName(bits.mapInArrow(_packed, "digest binary, mask binary"))
    masks, _ = table(masks)
    places = found.select("_key", "_hash", "digest", "anchors").join(masks, "digest")
    forget(docs.sparkSession, again_at)
    return places.groupBy("_key", "_hash").agg(F.collect_set(F.struct("anchors", "mask")).alias("marks"))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        masks = np.zeros((batch.num_rows, REACH), bool)
        for i, o in enumerate(batch.column("os").to_pylist()):
            masks[i, o] = True
        yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array([p.tobytes() for p in np.packbits(masks, axis=1)], pa.binary())], ["digest", "mask"])


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key``, long ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256``.

    Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere else, in the same document or another,
    is removed; strings are judged on the input, overlaps count and no string crosses documents. ``n_spans`` counts
    the maximal removed runs and ``kept_sha256`` is the digest of what is left.

    Null counts as an empty text. A document that comes twice is a repeat of itself; its rows have the same result. Null
    keys are keys. Texts shorter than ``LENGTH`` lose nothing. An empty table gives an empty result. Only the named
    columns are read.
    """
    kind = docs.schema[key].dataType.simpleString()
    marks = marked(docs, key, text).withColumnsRenamed({"_key": "_k", "_hash": "_h"})
    source = docs.select(F.col(key).alias("_key"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_hash"), F.col(text).alias("_text"))
    both = source.join(marks, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_hash") == F.col("_h")), "left").select("_key", "_text", "marks")
    out = both.mapInArrow(_cut, f"key {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.withColumnRenamed("key", key)
