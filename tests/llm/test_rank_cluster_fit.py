"""Centroid clustering, ranked lexical search and best-fit packing against brute force on small fixtures."""

import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from test_llm import SCHEMA, TOKENIZER, prose, texts  # noqa: F401

from lookout.llm import bestfit, centroids, lexical


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "de", None][i % 3], ["a", "b", None, "c"][i % 4], "d", i, "k", "s") for i, t in enumerate(texts())]
    rows += [rows[3], rows[3], (None, "null key text with some words", "en", None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# clusters

def brute_clusters(rows, d, k, rounds, scale=1024):
    kept = [(key, [min(max(math.floor(float(x) * scale), -2**27), 2**27) for x in v]) for key, v in rows
            if v is not None and len(v) == d and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    means = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(means))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        means = [[sum(x) // len(groups[i]) for x in zip(*groups[i])] if i in groups else c for i, c in enumerate(means)]
    found = [(key, *nearest(v)) for key, v in kept]
    inertia = {}
    for _, dist, c in found:
        inertia[c] = inertia.get(c, 0) + dist
    total = sum(inertia.values())
    return sorted(((key, c, dist, inertia[c], total, hashlib.sha256(",".join(map(str, means[c])).encode()).hexdigest()) for key, dist, c in found), key=str)


VECTORS = "vec_id long, embedding array<float>, label int, key string, v int, cluster int, inertia string"


def vectors(n, d, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, (rng.integers(-3, 4, d) / 2).tolist()) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(n // 2)]  # a third are copies
    rows += [(5, rows[1][1]), (5, rows[2][1]), (5, rows[2][1]), (None, rows[3][1]), (-1, [0.0] * d), (-2, None), (-3, []), (-4, [1.0] * (d + 1)),
             (-5, [float("nan")] + [0.0] * (d - 1)), (-6, [float("inf")] * d), (-7, [None] + [1.0] * (d - 1)), (-8, [3e30] * d)]
    return rows


@pytest.mark.parametrize("n,d,k,rounds", [(60, 4, 5, 10), (90, 3, 8, 2), (40, 64, 8, 10), (4, 4, 30, 3)])
def test_clusters(spark, n, d, k, rounds):
    rows = vectors(n, d, n)
    df = spark.createDataFrame([(*r, 1, "x", 2, 3, "y") for r in rows], VECTORS).repartition(3)
    got = centroids.clustered(df, dimensions=d, k=k, rounds=rounds)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_clusters(rows, d, k, rounds)


def test_clusters_of_nothing(spark):
    none = centroids.clustered(spark.createDataFrame([], VECTORS))
    assert none.count() == 0 and none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert centroids.clustered(spark.createDataFrame([(1, [1.0], 0, "", 0, 0, "")], VECTORS)).count() == 0


def test_walk_stops_early_and_right():
    rng = np.random.default_rng(4)
    for d, k in ((1, 50), (2, 40), (6, 9)):
        c = rng.integers(-20, 20, (k, d))
        x = rng.integers(-25, 25, (500, d))
        far = ((x[:, None] - c) ** 2).sum(axis=2)
        which, distance = centroids.Lists(c).nearest(x)
        assert (which == far.argmin(axis=1)).all() and (distance == far.min(axis=1)).all()


# ranked search

def terms_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute_ranked(rows, items, most=10):
    held = [(key, terms_of(t)) for key, t in rows]
    held = [(key, t) for key, t in held if t]
    docs, total = len(held), sum(len(t) for _, t in held)
    df = {}
    for _, t in held:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    out = []
    for item, text in items:
        scores = []
        for key, t in held:
            m = 10 + 90 * len(t) * docs // total
            s = sum(math.floor(1000 * math.log((2 * docs + 2) / (2 * df[w] + 1))) * (10**9 * t.count(w) // (1000 * t.count(w) + 8 * m))
                    for w in set(terms_of(text)) if w in df)
            if s > 0:
                scores.append((-s, key is None, key or 0))
        out += [(item, rank, None if none else key, -s) for rank, (s, none, key) in enumerate(sorted(scores)[:most], 1)]
    return sorted(out, key=str)


ITEMS = [(1, "alpha1 BETA22 gamma light"), (2, None), (3, ""), (4, "not-in-any zzzz"), (5, "words null Ünï 😀"), (5, "la la la"), (6, "x two one x"), (None, "aaa " + "a" * 3000),
         (8, " ".join(f"stone{i} over{i} seven{i}" for i in range(150)))]


@pytest.mark.parametrize("chunk", [1 << 14, 40])
def test_ranked(spark, docs, chunk):
    items = spark.createDataFrame([(*i, "z", 1, 2) for i in ITEMS], "item_id long, text string, word string, row int, score int")
    want = brute_ranked([(r.doc_id, r.text) for r in docs.collect()], ITEMS)
    assert sorted((tuple(r) for r in lexical.ranked(docs, items, terms_at_once=chunk).collect()), key=str) == want


def test_ranked_of_nothing(spark, docs, empty):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical.ranked(empty, items).count() == 0 and lexical.ranked(docs, items.limit(0)).count() == 0
    bare = spark.createDataFrame([(1, None), (2, ""), (3, "... !")], "doc_id long, text string")
    assert lexical.ranked(bare, items).count() == 0


def test_long_texts_come_in_parts_and_small_blocks_lose_nothing(monkeypatch):
    rng = __import__("random").Random(7)
    rows = [(i, t) for i, t in enumerate(texts())] + [(1000, "é" * 700 + " " + prose(rng, 900)), (1001, "b" * 5000)]
    monkeypatch.setattr(lexical, "CHUNK_BYTES", 300)
    monkeypatch.setattr(lexical, "DOCS", 5)
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], ["key", "text"])
    blocks = list(lexical._index(iter([batch.slice(0, 30), batch.slice(30)])))
    docs, total = (sum(b.column(c)[0].as_py() for b in blocks) for c in ("n_docs", "n_terms"))
    df = {}
    for b in blocks:
        for w, n in zip(b.column("words")[0].as_py(), b.column("held")[0].as_py()):
            df[w] = df.get(w, 0) + n
    held = [terms_of(t) for _, t in rows]
    assert docs == sum(map(bool, held)) and total == sum(map(len, held))
    assert df == {w: sum(w in set(t) for t in held) for w in {w for t in held for w in t}}
    words = sorted(df)
    number, weight = {w: i for i, w in enumerate(words)}, {w: math.floor(1000 * math.log((2 * docs + 2) / (2 * df[w] + 1))) for w in df}
    asks = [(i, [number[w] for w in dict.fromkeys(terms_of(t)) if w in df], [weight[w] for w in dict.fromkeys(terms_of(t)) if w in df]) for i, (_, t) in enumerate(ITEMS)]
    got = pa.Table.from_batches(lexical._search(asks, words, docs, total, 10)(iter(blocks))).to_pydict()
    want = brute_ranked(rows, [(i, t) for i, (_, t) in enumerate(ITEMS)])
    assert sorted(zip(got["row"], got["key"], got["score"])) == sorted((i, key, s) for i, _, key, s in want)


# best fit

def test_fit(docs, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    rows = [r.asDict() for r in bestfit.packed(docs, TOKENIZER, length=128).collect()]
    whole = {}
    for r in docs.select("doc_id", "text").collect():
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        whole.setdefault(r.doc_id, []).append(ids)
    want = sorted(((key, i // 128, i, len(ids[i:i + 128]), zlib.crc32(ids[i:i + 128].tobytes())) for key, texts in whole.items() for ids in texts
                   for i in range(0, len(ids), 128)), key=str)
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows), key=str) == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        ends = np.cumsum([0] + [n for _, n in sorted(parts)])
        assert [at for at, _ in sorted(parts)] == ends[:-1].tolist() and ends[-1] <= 128
    assert len(sequences) <= len(decreasing([r[3] for r in want], 128)) + 1  # a fixture of few pieces
    assert bestfit.packed(empty, TOKENIZER).count() == 0


def decreasing(lengths, size):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, g in enumerate(gaps) if g >= n]
        if fits:
            gaps[min(fits, key=lambda i: gaps[i])] -= n
        else:
            gaps.append(size - n)
    return gaps


@pytest.mark.parametrize("seed", range(8))
def test_plan(seed):
    rng = np.random.default_rng(seed)
    size = [64, 2048][seed % 2]
    lengths = np.clip(rng.lognormal(math.log(size) - [1, 2, 0.5, 3][seed // 2], 1, 700).astype(int), 1, size)
    lengths[:230] = lengths[0]  # one length holds a third
    counts = np.bincount(lengths, minlength=size + 1)
    made = bestfit.plan(counts)
    used = np.zeros_like(counts)
    for pieces, times in made:
        assert sum(n * c for n, c in pieces.items()) <= size and times > 0
        for n, c in pieces.items():
            used[n] += c * times
    assert (used == counts).all()
    total = sum(t for _, t in made)
    assert -(-lengths.sum() // size) <= total <= 1.02 * len(decreasing(lengths.tolist(), size))
    places, seen = bestfit.Places(made, size), set()
    for n in np.flatnonzero(counts):
        sequence, offset = places.of(np.full(counts[n], n), np.arange(counts[n]))
        for s, o in zip(sequence.tolist(), offset.tolist()):
            assert 0 <= s < total and not seen & {(s, o + i) for i in range(n)}
            seen |= {(s, o + i) for i in range(n)}


def test_plan_grows_with_lengths_not_with_pieces():
    counts = np.bincount(np.random.default_rng(1).integers(1, 200, 3000), minlength=257)
    few, many = bestfit.plan(counts), bestfit.plan(counts * 10**9)
    assert len(many) <= 3 * len(few) + 300 and sum(t for _, t in many) >= 10**9


def test_exact_complements_come_first():
    counts = np.zeros(101, dtype=np.int64)
    counts[[60, 40, 30, 20, 10]] = [3, 1, 1, 2, 2]
    made = sorted(tuple(sorted(p.items())) for p, t in bestfit.plan(counts) for _ in range(t))
    assert made == [((10, 1),), ((10, 1), (30, 1), (60, 1)), ((20, 2), (60, 1)), ((40, 1), (60, 1))]
