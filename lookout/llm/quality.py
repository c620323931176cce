"""Quality classifier: regularised quadratic discriminant analysis over transformed statistics of whole texts."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import frugal, span_hashes, table, text_chunks, word_bounds

#: the statistics, in order, with the rate of each in ordinary prose; PSEUDO words or characters of ordinary prose are
#: added to every text, so that a few words alone do not make a text look odd
STATISTICS = {"word_length": 5.2, "word_length_spread": 2.7, "upper": 0.02, "digit": 0.002, "punctuation": 0.025, "marks": 0.005, "bars": 0.002,
              "high_bytes": 0.02, "distinct_words": 0.8, "top_word": 0.05, "repeated_neighbours": 0.01, "distinct_lines": 0.95,
              "line_words": 45.0, "sentence_ends": 0.1}
PSEUDO = {"characters": 150.0, "words": 25.0, "lines": 4.0}
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
_MARK = np.zeros(256, bool)
_MARK[[33, 63]] = True
_BAR = np.zeros(256, bool)
_BAR[[60, 62, 91, 93, 123, 124, 125]] = True
_STOP = np.zeros(256, bool)
_STOP[[33, 46, 63]] = True


def _rate(name: str, count: np.ndarray, of: np.ndarray, unit: str) -> np.ndarray:
    """The smoothed share ``count`` / ``of`` on the logit scale."""
    extra = PSEUDO[unit]
    p = np.clip((count + extra * STATISTICS[name]) / (of + extra), 1e-6, 1 - 1e-6)
    return np.log(p) - np.log1p(-p)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows x len(STATISTICS) of finite numbers; an empty text has those of zero counts."""
    n = len(offsets) - 1

    def per_row(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return (sums[offsets[1:]] - sums[offsets[:-1]]).astype(np.float64)

    size = np.diff(offsets).astype(np.float64)
    start, end, row = word_bounds(data, offsets)
    words = np.bincount(row, minlength=n).astype(np.float64)
    length = (end - start).astype(np.float64)
    total, squares = np.bincount(row, length, n), np.bincount(row, length * length, n)
    mean = total / np.maximum(words, 1)
    spread = np.sqrt(np.maximum(squares / np.maximum(words, 1) - mean * mean, 0))
    h = span_hashes(data, start, end)
    order = np.lexsort((h, row))
    sorted_h, sorted_row = h[order], row[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (sorted_h[1:] != sorted_h[:-1]) | (sorted_row[1:] != sorted_row[:-1])
    distinct = np.bincount(sorted_row[fresh], minlength=n).astype(np.float64)
    runs = np.diff(np.append(np.flatnonzero(fresh), len(h)))
    top = np.zeros(n)
    np.maximum.at(top, sorted_row[fresh], runs)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    neighbours = np.bincount(row[same], minlength=n).astype(np.float64)
    # lines: runs of bytes without a line feed
    inside = data != 10
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    some = offsets[:-1] < offsets[1:]
    first[offsets[:-1][some]] = inside[offsets[:-1][some]]
    last[offsets[1:][some] - 1] = inside[offsets[1:][some] - 1]
    ls, le = np.flatnonzero(first), np.flatnonzero(last) + 1
    lrow = np.searchsorted(offsets, ls, side="right") - 1
    lines = np.bincount(lrow, minlength=n).astype(np.float64)
    lh = span_hashes(data, ls, le)
    lo = np.lexsort((lh, lrow))
    new = np.ones(len(lh), bool)
    new[1:] = (lh[lo][1:] != lh[lo][:-1]) | (lrow[lo][1:] != lrow[lo][:-1])
    distinct_lines = np.bincount(lrow[lo][new], minlength=n).astype(np.float64)
    letters = per_row(_LETTER[data])
    extra = PSEUDO["words"]
    mean = (total + extra * STATISTICS["word_length"]) / (words + extra)
    spread = np.sqrt((words * spread ** 2 + extra * STATISTICS["word_length_spread"] ** 2) / (words + extra))
    line_words = (words + PSEUDO["lines"] * STATISTICS["line_words"]) / (lines + PSEUDO["lines"])
    return np.column_stack([
        np.log(mean), np.log(spread), _rate("upper", per_row(_UPPER[data]), letters, "characters"), _rate("digit", per_row(_DIGIT[data]), size, "characters"),
        _rate("punctuation", per_row(_PUNCT[data]), size, "characters"), _rate("marks", np.minimum(per_row(_MARK[data]), words), words, "words"),
        _rate("bars", np.minimum(per_row(_BAR[data]), words), words, "words"), _rate("high_bytes", per_row(data >= 128), size, "characters"),
        _rate("distinct_words", distinct, words, "words"), _rate("top_word", top, words, "words"),
        _rate("repeated_neighbours", neighbours, words, "words"), _rate("distinct_lines", distinct_lines, lines, "lines"),
        np.log(line_words), _rate("sentence_ends", np.minimum(per_row(_STOP[data]), words), words, "words")])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, data, offsets in text_chunks(batch.column("_text")):
            x = statistics(data, offsets)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*[c.slice(first, end - first) for c in batch.columns[:-1]], lists], [*batch.schema.names[:-1], "x"])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per class: count, sums and products, one row a task."""
    d = len(STATISTICS)
    sums = {c: np.zeros(1 + d + d * d) for c in (0, 1)}
    for batch in batches:
        x, y = _matrix(batch.column("x")), batch.column("y").to_numpy(zero_copy_only=False)
        for c in (0, 1):
            part = x[y == c]
            sums[c] += np.concatenate(([len(part)], part.sum(0), (part.T @ part).ravel()))
    for c, v in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([v.tolist()])], ["y", "m"])


class Discriminant:
    """Two Gaussian classes with shrunk covariances; their Cholesky factors are computed once and kept."""

    def __init__(self, moments: dict[int, np.ndarray], shrink: float = 0.3, ridge: float = 1e-3):
        d = len(STATISTICS)
        m = {c: np.asarray(moments.get(c, np.zeros(1 + d + d * d)), dtype=np.float64) for c in (0, 1)}
        n = {c: m[c][0] for c in m}
        total = m[0] + m[1]
        everything = max(total[0], 1.0)
        centre = total[1:1 + d] / everything
        pooled = total[1 + d:].reshape(d, d) / everything - np.outer(centre, centre)
        scale = np.sqrt(np.maximum(np.diag(pooled), 1e-12))
        scale[scale < 1e-6] = 1.0
        self.centre, self.scale = centre, scale
        self.mean, self.factor, self.constant = {}, {}, {}
        for c in m:
            if n[c]:
                mean = m[c][1:1 + d] / n[c]
                cov = m[c][1 + d:].reshape(d, d) / n[c] - np.outer(mean, mean)
            else:
                mean, cov = centre, pooled
            z = cov / np.outer(scale, scale)
            z = (1 - shrink) * z + shrink * (0.5 * np.diag(np.diag(z)) + 0.5 * np.trace(z) / d * np.eye(d)) + ridge * np.eye(d)
            factor = np.linalg.cholesky(z)
            self.mean[c] = (mean - centre) / scale
            self.factor[c] = np.linalg.inv(factor)
            self.constant[c] = np.log((n[c] + 1) / (n[0] + n[1] + 2)) - np.log(np.diag(factor)).sum()

    def score(self, x: np.ndarray, temperature: float = 1.0) -> np.ndarray:
        z = (x - self.centre) / self.scale
        density = {}
        for c in (0, 1):
            w = (z - self.mean[c]) @ self.factor[c].T
            density[c] = self.constant[c] - 0.5 * (w * w).sum(1)
        return 1 / (1 + np.exp(-np.clip((density[1] - density[0]) / temperature, -35, 35)))


def held_out(key: Column, folds: int = 5) -> Column:
    """crc32 of the key as text modulo ``folds`` is 0; a null key is not held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == 0, F.lit(False))


def fitted(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, folds: int, shrink: float) -> tuple[Discriminant, DataFrame]:
    """The classifier learned from all labelled rows outside the held-out fold, and the statistics ``key, x`` of every row."""
    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("_text"))
    rows, _ = table(source.mapInArrow(frugal(_features), f"key {kind}, x array<double>"), batch=2000)
    y = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.min(label).alias("y"))
    known = rows.where(~held_out(F.col("key"), folds)).join(y, "key").select("x", F.col("y").cast("int").alias("y"))
    sums = known.mapInArrow(frugal(_moments), "y int, m array<double>").select("y", F.posexplode("m").alias("i", "v")).groupBy("y", "i").agg(F.sum("v").alias("v"))
    moments = {c: np.zeros(1 + len(STATISTICS) + len(STATISTICS) ** 2) for c in (0, 1)}
    for r in sums.collect():  # 2 x (1 + d + d * d) numbers
        moments[r["y"]][r["i"]] = r["v"]
    return Discriminant(moments, shrink), rows


def scored(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
           threshold: float = 0.3, folds: int = 5, shrink: float = 0.3) -> DataFrame:
    """``key, held_out, score, predicted`` for every row of ``docs``.

    The inputs are ``STATISTICS`` of the whole text alone. All labelled rows outside the held-out fold give the two
    classes' counts, means and covariances, summed in Spark; d * d numbers a task reach the driver. Covariances are
    shrunk towards their diagonal and a sphere. The score is the logistic function of the difference of the two
    log densities (Mahalanobis distance, log determinant, log prior).

    Null or empty texts score by the statistics of an empty text; rows without a label, with a null label or a null key
    are scored but not learned from; a key labelled twice counts with its smaller label; repeated documents count
    each; without labels of a class both classes share all rows' moments. Empty tables give empty results. Other
    columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    model, rows = fitted(docs, labels, key, text, label, folds, shrink)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(model.score(_matrix(batch.column("x"))) if batch.num_rows else np.zeros(0))],
                                             ["key", "score"])

    out = rows.mapInArrow(frugal(score), f"key {kind}, score double")
    return out.select(F.col("key").alias(key), held_out(F.col("key"), folds).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
             threshold: float = 0.3, folds: int = 5, shrink: float = 0.3) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score reaches the threshold; nothing is shuffled for it."""
    model, _ = fitted(docs, labels, key, text, label, folds, shrink)
    at = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_chunks(batch.column(at)):
                good = model.score(statistics(data, offsets)) >= threshold
                yield batch.slice(first, end - first).filter(pa.array(good))

    return docs.mapInArrow(frugal(keep), docs.schema)
