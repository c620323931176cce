"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import mix, text_chunks

#: hashed features; n-grams of 1 to 3 characters share them
BUCKETS = 1 << 15
_FACTOR = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)]


def _table_of_letters() -> np.ndarray:
    """Code point -> its lower-case letter, or 32 for what is no letter."""
    out = np.full(0x110000, 32, dtype=np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    if not _letters:
        _letters.append(_table_of_letters())
    return _letters[0]


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature of each n-gram, the row offsets, and whether a row has a letter.

    Runs of other characters count as one space; n-grams stay within a text and hold at least one letter. Each row's
    n-grams stand together.
    """
    raw = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    x = letters()[raw]
    row = np.repeat(np.arange(len(texts)), sizes)
    keep = np.ones(len(x), bool)
    keep[1:] = (x[1:] != 32) | (x[:-1] != 32) | (row[1:] != row[:-1])
    x, row = x[keep], row[keep]
    has = np.bincount(row[x != 32], minlength=len(texts)) > 0
    found, rows = [], []
    for n in (1, 2, 3):
        m = len(x) - n + 1
        if m <= 0:
            break
        h = np.full(m, n, dtype=np.uint64)
        for j in range(n):
            h += x[j:j + m].astype(np.uint64) * _FACTOR[j]
        ok = row[:m] == row[n - 1:n - 1 + m]
        if n == 1:
            ok &= x != 32
        found.append((mix(h[ok]) % np.uint64(BUCKETS)).astype(np.int32))
        rows.append(row[:m][ok])
    features = np.concatenate(found) if found else np.zeros(0, np.int32)
    rows = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    order = np.argsort(rows, kind="stable")
    offsets = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=len(texts)))))
    return features[order], offsets, has


def _pieces(column: pa.Array) -> Iterator[tuple[int, int, list[str]]]:
    for first, end, _, _ in text_chunks(column):
        yield first, end, [t or "" for t in column.slice(first, end - first).to_pylist()]


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a task: texts, and for each feature the texts that have it."""
    total = np.zeros(BUCKETS + 1, dtype=np.int64)
    for batch in batches:
        for _, _, texts in _pieces(batch.column("_text")):
            features, offsets, _ = ngrams(texts)
            for i in range(len(texts)):
                seen = np.zeros(BUCKETS, bool)
                seen[features[offsets[i]:offsets[i + 1]]] = True
                total[:-1] += seen
            total[-1] += len(texts)
    yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.int64()))], ["n"])


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, texts in _pieces(batch.column("_text")):
            features, offsets, _ = ngrams(texts)
            index, value = [], []
            for i in range(len(texts)):
                f, c = np.unique(features[offsets[i]:offsets[i + 1]], return_counts=True)
                index.append(f.astype(np.int32))
                value.append((c / max(c.sum(), 1)).astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).slice(first, end - first) for c in ("_lang", "_order", "_tie")),
                 pa.array(index, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float32()))], ["lang", "o", "tie", "f", "v"])


class Ftrl:
    """Follow-the-regularised-leader for multinomial logistic regression with per-coordinate rates and elastic net."""

    def __init__(self, classes: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 1e-3, l2: float = 1e-3):
        self.z, self.n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, rows=slice(None)) -> np.ndarray:
        z, n = self.z[rows], self.n[rows]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, f: np.ndarray, v: np.ndarray, y: int) -> None:
        w = self.weights(f)
        s = v @ w
        p = np.exp(s - s.max())
        p /= p.sum()
        p[y] -= 1
        g = v[:, None] * p
        n = self.n[f]
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[f] += g - sigma * w
        self.n[f] = n + g * g


def inverse_frequencies(counts: np.ndarray) -> np.ndarray:
    return np.log((1.0 + counts[-1]) / (1.0 + counts[:-1])) + 1.0


def train(sample: pd.DataFrame, languages: list[str], idf: np.ndarray, shares: dict[str, int], epochs: int = 5) -> tuple[np.ndarray, float]:
    """Weights (last row: intercept) that apply to relative n-gram frequencies, and the temperature.

    Four in five sampled rows train, in the sample's shuffled order; the temperature minimises the log loss of the rest.
    The sample has languages more evenly than the corpus, so the corpus's ``shares`` enter the intercepts at the end.
    """
    sample = sample.sort_values([c for c in ("o", "tie") if c in sample], kind="stable")
    index = {c: i for i, c in enumerate(languages)}
    xs, scale = [], 20.0
    for f, v in zip(sample["f"], sample["v"]):
        f = np.asarray(f, dtype=np.int64)
        xs.append((np.append(f, BUCKETS), np.append(np.asarray(v, dtype=np.float64) * idf[f] * scale, 1.0)))
    ys = [index[c] for c in sample["lang"]]
    held = np.arange(len(xs)) % 5 == 4
    if held.all() or not held.any():
        held[:] = False
    model = Ftrl(len(languages))
    for _ in range(epochs):
        for x, y, h in zip(xs, ys, held):
            if not h:
                model.learn(*x, y)
    w = model.weights()
    use = held if held.any() else ~held
    logits = np.array([v @ w[f] for (f, v), u in zip(xs, use) if u]).reshape(-1, len(languages))
    truth = np.array([y for y, u in zip(ys, use) if u], dtype=np.int64)
    best, temperature = np.inf, 1.0
    for t in np.geomspace(0.05, 20, 61):
        s = logits / t
        s = s - s.max(1, keepdims=True)
        loss = float((np.log(np.exp(s).sum(1)) - s[np.arange(len(s)), truth]).mean()) if len(s) else 0.0
        if loss < best - 1e-12:
            best, temperature = loss, float(t)
    w[:-1] *= idf[:, None] * scale
    taken = np.bincount(ys, minlength=len(languages)) + 1.0
    w[-1] += temperature * (np.log([shares[c] + 1.0 for c in languages]) - np.log(taken))
    return w.astype(np.float32), temperature


def held_out(key: Column, folds: int = 4, fold: int = 2) -> Column:
    """crc32 of the key as text modulo ``folds`` is ``fold``; a null key is not held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == fold, F.lit(False))


def identified(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 4, fold: int = 2,
               sample_per_language: int = 1000) -> DataFrame:
    """``key, held_out, lang_pred, score`` for every row of ``docs``.

    Features are hashed character n-grams of the whole lower-cased text; term frequencies are relative, and inverse
    document frequencies count all rows outside the held-out fold. The model is fitted on a bounded sample of labelled rows
    outside the fold: the ``sample_per_language`` first of each language by a digest of the key, rows of equal keys by one of
    the text. Every language that such a row names is learned. The score is the probability of ``lang_pred`` after temperature calibration.

    A text that is null or has no letter is ``und`` with score 0, as is every row when no language can be learned. A
    null key is not held out; rows without a language are not learned from; repeated rows count each. Empty tables
    give empty results. Only the named columns are read.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.col(lang).alias("_lang"))
    known = rows.where(~held_out(F.col("_key"), folds, fold) & F.col("_lang").isNotNull())
    counts = (known.where("_text is not null").select("_text").mapInArrow(_document_frequencies, "n array<long>").select(F.posexplode("n").alias("i", "n"))
              .groupBy("i").agg(F.sum("n").alias("n")))
    frequency = np.zeros(BUCKETS + 1, dtype=np.int64)
    for r in counts.collect():  # BUCKETS + 1 numbers
        frequency[r["i"]] = r["n"]
    idf = inverse_frequencies(frequency)
    shares = {r["_lang"]: r["count"] for r in known.groupBy("_lang").count().collect()}  # one row a language
    names = sorted(shares)
    if not names:
        return docs.select(F.col(key), held_out(F.col(key), folds, fold).alias("held_out"), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    # the key and language alone give each language's last digest; only the rows up to it send their texts
    known = known.withColumn("_order", F.xxhash64(F.lit(7), "_key"))
    place = F.row_number().over(Window.partitionBy("_lang").orderBy("_order"))

    def of(numbers: dict[str, int]) -> Column:
        return F.create_map(*[F.lit(x) for kv in numbers.items() for x in kv])[F.col("_lang")]

    # digests are even, so the lowest share of them holds four times the sample; only these are put in order, unless equal
    # keys left too few
    cut = {c: -2**63 + min(2**64 * 4 * sample_per_language // max(n, 1), 2**64 - 1) for c, n in shares.items()}
    got = {r["_lang"]: r["count"] for r in known.where(F.col("_order") <= of(cut)).groupBy("_lang").count().collect()}
    cut = {c: v if got.get(c, 0) >= min(sample_per_language, shares[c]) else 2**63 - 1 for c, v in cut.items()}
    last = known.where(F.col("_order") <= of(cut)).select("_lang", "_order", place.alias("_n")).where(F.col("_n") <= sample_per_language)
    ends = {r["_lang"]: r["e"] for r in last.groupBy("_lang").agg(F.max("_order").alias("e")).collect()}
    near = known.where(F.col("_order") <= of(ends)).withColumn("_tie", F.xxhash64(F.lit(8), "_text"))
    place = F.row_number().over(Window.partitionBy("_lang").orderBy("_order", "_tie", "_text"))
    chosen = near.withColumn("_n", place).where(F.col("_n") <= sample_per_language).select("_text", "_lang", "_order", "_tie")
    sample = chosen.mapInArrow(_sample_features, "lang string, o long, tie long, f array<int>, v array<float>")

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        w, t = train(frame, names, idf, shares)
        at = np.flatnonzero(np.abs(w).sum(1) > 0).astype(np.int32)
        return pd.DataFrame({"i": np.append(at, -1), "w": [*w[at].tolist(), [t]]})

    # one task holds the bounded sample
    fitted = sample.withColumn("g", F.lit(0)).groupBy("g").applyInPandas(fit, "i int, w array<double>").collect()
    weights, temperature = np.zeros((BUCKETS + 1, len(names)), dtype=np.float32), 1.0
    for r in fitted:
        if r["i"] < 0:
            temperature = r["w"][0]
        else:
            weights[r["i"]] = r["w"]
    model = spark.sparkContext.broadcast(weights)  # BUCKETS x languages

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = model.value
        for batch in batches:
            for first, end, texts in _pieces(batch.column("_text")):
                features, offsets, has = ngrams(texts)
                sums = np.zeros((len(texts), w.shape[1]))
                full = np.flatnonzero(np.diff(offsets))
                if len(full):
                    sums[full] = np.add.reduceat(w[features], offsets[full], axis=0)
                logits = (sums / np.maximum(np.diff(offsets), 1)[:, None] + w[-1]) / temperature
                logits -= logits.max(1, keepdims=True)
                p = np.exp(logits)
                p /= p.sum(1, keepdims=True)
                best = p.argmax(1)
                pred = np.where(has, np.array(names, dtype=object)[best], "und")
                score = np.where(has, p[np.arange(len(p)), best], 0.0)
                yield pa.RecordBatch.from_arrays([batch.column("_key").slice(first, end - first), pa.array(pred, pa.string()), pa.array(score.astype(np.float64))],
                                                 ["key", "lang_pred", "score"])

    out = rows.select("_key", "_text").mapInArrow(predict, f"key {kind}, lang_pred string, score double")
    return out.select(F.col("key").alias(key), held_out(F.col("key"), folds, fold).alias("held_out"), "lang_pred", "score")
