"""Packing documents into training sequences: vector bin packing by the dot-product heuristic."""

from __future__ import annotations

import json
import re
import zlib
from itertools import chain
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, frugal, text_chunks

#: words whose ids a worker remembers: so many new ones, and as many of the generation before
REMEMBERED = 400_000
#: white space other than space, tab, line feed and carriage return; left inside words, for the tokenizer to judge
_ODD = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_WORD = re.compile("[^ \t\n\r]+")
#: words whose runs are counted apart from the tokenizer: visible ASCII characters and Latin letters
_PLAIN = r"^[!-~\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]*$"
#: a run of a lower-cased word, as the pre-tokenizer below cuts it
_RUN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
# How a vocabulary of lower-cased words prepares texts, as its file states it.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
_MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>", "byte_fallback": False, "ignore_merges": False}


class Words:
    """Ids of texts by a tokenizer file; one that drops white space encodes each word once and remembers it.

    Such a file, and no other, has the normalizer, pre-tokenizer and model settings above: white space never reaches its merges, so the
    ids of a text are those of its words in order. Unknown words are encoded together and their ids cut apart again
    after the tokens that end a run (``</w>``). By any other file whole texts are encoded.
    """

    #: one for each vocabulary in a worker process, which lives through many tasks
    made: dict[str, Words] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        model = {k: said["model"].get(k) for k in _MODEL}
        added = [t for t in said["added_tokens"] if t["lstrip"] or t["rstrip"] or t["normalized"] or re.search(r"\s", t["content"])]
        self.by_words = (said["normalizer"], said["pre_tokenizer"], model, added) == (_NORMALIZER, _PRE_TOKENIZER, _MODEL, [])
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> Words:
        if path not in cls.made:
            cls.made[path] = cls(path)
        return cls.made[path]

    def learn(self, words: list[str]) -> None:
        known, older = self.known, self.older
        for w in words:
            if w in older:
                known[w] = older[w]
        column = pa.array([w for w in words if w not in known], pa.large_string())
        plain = pc.and_(pc.match_substring_regex(column, _PLAIN), pc.invert(pc.match_substring(column, "<|")))
        for w in column.filter(pc.invert(plain)).to_pylist():  # other scripts, special tokens: the tokenizer judges
            known[w] = np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, dtype="<u4").tobytes()
        column = column.filter(plain)
        if not len(column):
            return
        runs = np.cumsum(pc.count_substring_regex(pc.utf8_lower(column), _RUN).to_numpy())
        column = column.to_numpy(zero_copy_only=False).tolist()
        # each run of a word ends with the only token of it that ends a run
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(column)], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = np.concatenate(([0], 4 * (np.flatnonzero(self.last[ids]) + 1)))
        if len(ends) != runs[-1] + 1:
            raise ValueError("the vocabulary does not end each run with a token of its own")
        raw, start = ids.tobytes(), 0
        for w, end in zip(column, ends[runs].tolist()):
            known[w] = raw[start:end]
            start = end

    def ids(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        if not self.by_words:
            for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
                yield np.array(found.ids, dtype="<u4")
            return
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        split = [_WORD.findall(t) if _ODD.search(t) else t.split() for t in texts]
        known = self.known
        self.learn([w for w in dict.fromkeys(chain.from_iterable(split)) if w not in known])
        for words in split:
            yield np.frombuffer(b"".join([known[w] for w in words]), dtype="<u4")


    def of_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where those of each text end; null counts as empty.

        Arrow splits at ASCII white space and numbers the distinct words, so Python sees each word of the column once.
        """
        if not self.by_words:
            each = list(self.ids([t or "" for t in texts.to_pylist()]))
            return np.concatenate([np.zeros(0, "<u4"), *each]), np.cumsum([len(i) for i in each], dtype=np.int64)
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        numbered = lists.flatten().dictionary_encode()
        words, known = numbered.dictionary.to_numpy(zero_copy_only=False).tolist(), self.known
        self.learn([w for w in words if w not in known])
        raw = [known[w] for w in words]
        sizes = np.array([len(r) for r in raw], dtype=np.int64) // 4
        distinct, begins = np.frombuffer(b"".join(raw), dtype="<u4"), np.cumsum(sizes) - sizes
        number = numbered.indices.to_numpy()
        n = sizes[number]
        ends = np.cumsum(n)
        ids = distinct[np.repeat(begins[number] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
        counts = np.concatenate(([0], ends))
        return ids, counts[np.cumsum(pc.list_value_length(lists).to_numpy())]


class Piece:
    """A run of one document's ids. The last ``loss`` of its ``total`` ids bear loss."""

    __slots__ = ("key", "ids", "start", "total", "loss")

    def __init__(self, key, ids: np.ndarray, start: int, total: int, loss: int):
        self.key, self.ids, self.start, self.total, self.loss = key, ids, start, total, loss

    def __len__(self) -> int:
        return len(self.ids)

    def bearing(self) -> int:
        return max(0, self.start + len(self.ids) - max(self.start, self.total - self.loss))

    def head(self, tokens: int, loss: float) -> int:
        """The length of the longest head with at most so many tokens and loss-bearing tokens."""
        return int(min(tokens, len(self.ids), max(0, self.total - self.loss - self.start) + loss))

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return (Piece(self.key, self.ids[:n], self.start, self.total, self.loss),
                Piece(self.key, self.ids[n:], self.start + n, self.total, self.loss))


class Packer:
    """Vector bin packing with limits on tokens, segments and loss-bearing tokens of a sequence.

    A piece goes to the open bin whose remaining room has the largest dot product with the piece's demands, both as
    shares of the limits. When none has room and ``most`` bins are open, the fullest is filled with the head of the
    piece and closed. A closed bin that is neither full nor a power of two long is cut into powers of two, so that
    nothing is padded. Memory holds ``most`` bins and one document.
    """

    def __init__(self, length: int = 2048, segments: int = 256, loss: int | None = None, most: int = 32):
        self.length = length
        self.limits = np.array([length, segments, length if loss is None else loss], dtype=np.float64)
        if self.limits.min() < 1:
            raise ValueError("each limit is 1 at least")
        self.most = most
        self.room = np.zeros((0, 3))
        self.bins: list[list[Piece]] = []

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        """Place a document; yields the sequences that this closes."""
        while len(piece):
            n = max(1, piece.head(self.length, self.limits[2]))
            part, rest = piece.cut(n)
            need = np.array([n, 1, part.bearing()], dtype=np.float64)
            if n == self.length:  # a sequence of its own
                yield [part]
                piece = rest
                continue
            fits = (self.room >= need).all(axis=1)
            if fits.any():
                score = (self.room / self.limits) @ (need / self.limits)
                at = int(np.where(fits, score, -1).argmax())
            elif len(self.bins) < self.most:
                self.bins.append([])
                self.room = np.vstack([self.room, self.limits])
                at = len(self.bins) - 1
            else:
                at = int(self.room[:, 0].argmin())
                n = piece.head(int(self.room[at, 0]), self.room[at, 2]) if self.room[at, 1] else 0
                if n:
                    part, piece = piece.cut(n)
                    self.bins[at].append(part)
                yield from self.close(at)
                continue
            self.bins[at].append(part)
            self.room[at] -= need
            if not self.room[at, 0]:
                yield from self.close(at)
            piece = rest

    def close(self, at: int) -> Iterator[list[Piece]]:
        self.room = np.delete(self.room, at, axis=0)
        yield from exact(self.bins.pop(at), self.length)

    def finish(self) -> Iterator[list[Piece]]:
        """Join what the open bins hold as far as the limits allow, and close it."""
        held, room = [], self.limits.copy()
        for piece in [p for b in self.bins for p in b]:
            while len(piece):
                n = piece.head(int(room[0]), room[2]) if room[1] else 0
                if n:
                    part, piece = piece.cut(n)
                    held.append(part)
                    room -= (n, 1, part.bearing())
                if not n or not room[0]:
                    yield from exact(held, self.length)
                    held, room = [], self.limits.copy()
        if held:
            yield from exact(held, self.length)
        self.bins, self.room = [], np.zeros((0, 3))


def exact(pieces: list[Piece], length: int) -> Iterator[list[Piece]]:
    """The pieces as sequences that need no padding: full, or powers of two long."""
    total = sum(map(len, pieces))
    if total == length:
        yield pieces
        return
    room, current = 0, []
    for piece in pieces:
        while len(piece):
            room = room or 1 << (total.bit_length() - 1)
            part, piece = piece.cut(min(room, len(piece)))
            current.append(part)
            room -= len(part)
            total -= len(part)
            if not room:
                yield current
                current = []


def _run(path: str, end_id: int, limits: dict, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer = Words.of(path), Packer(**limits)
        base = TaskContext.get().partitionId() << 40
        made = 0
        names = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
        rows: list[tuple] = []

        def batch_of() -> pa.RecordBatch:
            columns = [pa.array([r[0] for r in rows], kind), *(pa.array([r[i] for r in rows], pa.int64()) for i in range(1, 7))]
            if with_ids:
                ends = np.cumsum([0, *(r[2] for r in rows)])
                columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([r[7] for r in rows]).astype(np.int32))))
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        def put(sequences: Iterator[list[Piece]]) -> None:
            nonlocal made
            for pieces in sequences:
                offset = 0
                for p in pieces:
                    rows.append((p.key, p.start, len(p), zlib.crc32(p.ids.tobytes()), p.total, base + made, offset) + ((p.ids,) if with_ids else ()))
                    offset += len(p)
                made += 1

        kind = None
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            kind = batch.column("_key").type
            for first, stop, _, _ in text_chunks(batch.column("_text"), 4 * CHUNK_BYTES):
                keys, losses = (batch.column(c).slice(first, stop - first).to_pylist() for c in ("_key", "_loss"))
                every, ends = words.of_column(batch.column("_text").slice(first, stop - first))
                for key, ids, loss in zip(keys, np.split(every, ends[:-1]), losses):
                    ids = np.concatenate((ids, end))
                    bears = len(ids) if loss is None else min(max(loss, 0), len(ids))
                    put(packer.add(Piece(key, ids, 0, len(ids), bears)))
                if rows:
                    yield batch_of()
        put(packer.finish())
        if rows:
            yield batch_of()
    return run


def packed(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", loss: str | None = None, end_id: int = 1,
           length: int = 2048, segments: int = 256, loss_tokens: int | None = None, open_bins: int = 32, ids: bool = True) -> DataFrame:
    """Pack all documents into sequences of at most ``length`` tokens; one row per piece of a document.

    A document is the ids of its whole text by the tokenizer file, then ``end_id``; its last ``loss`` ids (a column;
    null or none: all) bear loss. A sequence holds at most ``segments`` pieces and ``loss_tokens`` loss-bearing ids.
    Each task packs the documents of its own partition, in one pass and in their order, so nothing is shuffled and a
    lost task is repeated alike. Sequences are full or powers of two long: none is padded.

    Returns ``key``, long ``start`` (ids of the document before the piece), ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset`` (gapless from 0 in the sequence) and, with ``ids``, the ids. Null and empty texts
    are the end id alone; null keys and repeated rows are documents like any other; empty tables give empty results.
    Only the named columns are read.
    """
    kind = docs.schema[key].dataType.simpleString()
    bears = F.col(loss).cast("long") if loss else F.lit(None).cast("long")
    limits = {"length": length, "segments": segments, "loss": loss_tokens, "most": open_bins}
    out = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), bears.alias("_loss")).mapInArrow(
        frugal(_run(tokenizer, end_id, limits, ids)),
        f"key {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * ids)
    return out.withColumnRenamed("key", key)
