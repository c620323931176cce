"""Shared helpers: tables in the cluster's shared folder, text chunks of bounded size, and hashing of words."""

from __future__ import annotations

import atexit
import ctypes
import uuid
from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: bytes of text that one vectorised step works on; a longer single text is one step of its own
CHUNK_BYTES = 1 << 19
_made: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names. Only where it is unset on a local master, as in tests, one below the
    warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    try:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # noqa: BLE001  the session has ended; the folder is the cluster's to clean then
        pass


def forget(spark: SparkSession, *paths: str) -> None:
    """Delete tables that ``table`` made and that no later step reads."""
    for path in paths:
        _delete(spark, path)


@atexit.register
def _forget_all() -> None:
    for spark, path in _made:
        _delete(spark, path)


def table(df: DataFrame, codec: str = "zstd", batch: int | None = None) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends there, and any executor may be lost.

    ``batch``: rows that go to Python at once meanwhile. Returns the frame and its path, for ``forget``. What is left at the end of the driver program goes with it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(rows)
    try:
        if batch:
            spark.conf.set(rows, batch)
        df.write.option("compression", codec).parquet(path)
    finally:
        spark.conf.set(rows, before)
    _made.append((spark, path))
    return spark.read.schema(df.schema).parquet(path), path


def give_back() -> None:
    """Memory that this process has freed goes back to the system, where its C library knows how."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def frugal(step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``step`` for ``mapInArrow`` whose worker gives memory back at the end of a task. Spark keeps its Python workers, so
    what they hold counts for the executor in all steps that follow."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from step(batches)
        give_back()
    return run


def text_chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of rows of about ``most`` bytes: first row, end row, UTF-8 bytes, offsets in them.

    Null counts as empty. A single longer text makes a run of its own.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        end = min(max(end, first + 1), n)
        lo, hi = offsets[first], offsets[end]
        yield first, end, data[lo:hi], offsets[first:end + 1] - lo
        first = end


_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base ** i`` and its inverse modulo 2**64 for i below ``n``."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 2 * CHUNK_BYTES)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_bounds(data: np.ndarray, offsets: np.ndarray, outside: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word: a longest run of bytes other than those ``outside``; by default space, tab to carriage return."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~outside[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[begins] = inside[begins]
    ends = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[ends] = inside[ends]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hashes of the byte spans; ``lower``: A-Z count as a-z."""
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((_BYTE_LOWER if lower else _BYTE)[data] * up[:-1], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


_ORDER = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """The sorted distinct hashes of ``k`` consecutive lower-cased words of each row; fewer words: the whole sequence
    as one; none: empty."""
    start, end, row = word_bounds(data, offsets)
    n = len(offsets) - 1
    h = span_hashes(data, start, end)
    counts = np.bincount(row, minlength=n)
    ends = np.cumsum(counts)
    grams = np.zeros(max(len(h) - k + 1, 0), dtype=np.uint64)
    for j in range(k):
        grams += h[j:j + len(grams)] * _ORDER[j]
    grams = mix(grams)
    out = []
    for i in range(n):
        c = counts[i]
        at = ends[i] - c
        if c >= k:
            out.append(np.unique(grams[at:at + c - k + 1]))
        elif c:
            out.append(mix((h[at:at + c] * _ORDER[:c]).sum(keepdims=True) + np.uint64(c)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
