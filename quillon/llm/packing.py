"""Packing token sequences along a space-filling curve.

A document's tokens are hashed into a signed vector, damped by a logarithm,
normalised, and projected to a few dimensions by a fixed random matrix.  Each
projection, a normal number for a document of random words, is mapped to equal
parts of the unit interval by the normal distribution and gives a cell; the
place of the cell on the Hilbert curve is the document's key.  Documents are
range-sorted by key, so that neighbours share words, and their tokens form one
stream, which is cut at every full sequence.  Only the last sequence is padded.

Tokens are computed once and written as two bytes each (four for a larger
vocabulary).  Words repeat, so a worker remembers the ids of those it has seen,
``REMEMBERED`` at most; each word is tokenised by itself, which equals
tokenising the text because the vocabulary's own splitting never crosses white
space.  Bounds of the ranges come from a summary of all keys; the low bits of a
key are a hash of the row, so equal documents, however many, spread over ranges.
Tokens are summed by range (one row a range reaches the driver), the rows are
shuffled once by range, sorted within it, and each task cuts what it holds: the
place of a range in the stream is known, so no task waits for another.  A range
has ``range_tokens`` at most up to ``most_ranges`` ranges (1 TB of tokens) and
grows beyond; a task sorts on disk and streams what it cuts.

Defined results: a null text is empty and gives the end token alone; equal keys
go by row number; repeated rows are documents of their own; a document longer
than a sequence is cut across several; an empty table gives an empty result.
Only the columns named in ``keep`` come back, whatever their names.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm._words import mix, words
from quillon.scratch import Scratch

REMEMBERED = 1 << 20
VOCABULARY = "word_bpe_49k.json"
HASH_BITS = 23


@dataclass(frozen=True)
class Settings:
    length: int = 4096
    end: int = 2
    hashed: int = 256
    dims: int = 4
    bits: int = 10
    seed: int = 13
    range_tokens: int = 1 << 25
    most_ranges: int = 1 << 14


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells``, whose entries are below ``2 ** bits``.

    The curve of a cube is made of the curves of its halves along each axis,
    mirrored or with two axes exchanged; so, from the top bit down, an axis whose
    bit is set mirrors the first axis and one whose bit is not exchanges its lower
    bits with the first.  Gray code then numbers the halves.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(dims):
            high = (x[i] >> b) & 1 == 1
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> b) & 1 == 1, (1 << b) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | (x[i] >> b) & 1
    return key


@functools.cache
def _hashed_tokens(s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and sign of each token (ids beyond ``1 << 17`` share them), and the random axes."""
    spread = mix(np.arange(1 << 17, dtype=np.uint64) + np.uint64(s.seed))
    axes = np.random.Generator(np.random.PCG64(s.seed)).standard_normal((s.hashed, s.dims))
    return (spread % np.uint64(s.hashed)).astype(np.int64), np.where(spread >> np.uint64(63), 1.0, -1.0), axes


def cells(row: np.ndarray, ids: np.ndarray, rows: int, s: Settings) -> np.ndarray:
    """The cell of each document from its tokens: ``row`` has the document of each of ``ids``."""
    bucket, sign, axes = _hashed_tokens(s)
    token = ids.astype(np.int64) & 0x1FFFF
    vector = np.bincount(row * s.hashed + bucket[token], sign[token], rows * s.hashed).reshape(rows, s.hashed)
    vector = np.sign(vector) * np.log1p(np.abs(vector))
    vector /= np.maximum(np.sqrt((vector * vector).sum(1, keepdims=True)), 1e-9)
    share = 1 / (1 + np.exp(-1.702 * (vector @ axes)))  # close to the normal distribution function
    return np.minimum((share * (1 << s.bits)).astype(np.int64), (1 << s.bits) - 1)


class WordIds:
    """Token ids of words; those seen before are remembered by the hash of the word."""

    _of: dict[str, WordIds] = {}

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.forget()

    @classmethod
    def of(cls, path: str) -> WordIds:
        """The one of this worker, which lives as long as the worker does."""
        if path not in cls._of:
            cls._of[path] = cls(path)
        return cls._of[path]

    def forget(self) -> None:
        self.known, self.first, self.size, self.flat = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, self.dtype)

    def __call__(self, w) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words of a chunk, one after the other, and how many each word has."""
        own, where, back = np.unique(w.hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, own)
        fresh = self.known[np.minimum(at, len(self.known) - 1)] != own if len(self.known) else np.ones(len(own), bool)
        if fresh.any() and len(self.known) + len(own) > REMEMBERED:
            self.forget()
            at, fresh = np.zeros(len(own), np.int64), np.ones(len(own), bool)
        if fresh.any():
            spelt = [w.data[w.starts[i] : w.ends[i]].tobytes().decode("utf-8", "replace") for i in where[fresh]]
            got = [e.ids for e in self.tokenizer.encode_batch_fast(spelt, add_special_tokens=False)]
            size = np.fromiter(map(len, got), np.int64, len(got))
            self.known = np.insert(self.known, at[fresh], own[fresh])
            self.first = np.insert(self.first, at[fresh], len(self.flat) + np.cumsum(size) - size)
            self.size = np.insert(self.size, at[fresh], size)
            self.flat = np.concatenate([self.flat, np.fromiter((i for ids in got for i in ids), self.dtype, int(size.sum()))])
            at = np.searchsorted(self.known, own)
        size = self.size[at][back]
        place = np.repeat(self.first[at][back] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return self.flat[place], size


def tokenised(docs: DataFrame, keep: list[str], text: str, path: str, s: Settings) -> DataFrame:
    """``row`` (the columns ``keep``), ``cell_key``, ``n`` and ``ids`` (little-endian, the end token last) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = WordIds.of(path)
        for batch in batches:
            for w in words(batch.column(1), lower=False):
                ids, size = ids_of(w)
                bounds = np.concatenate([[0], np.cumsum(size)])[w.bounds]
                n = np.diff(bounds) + 1
                row = np.repeat(np.arange(w.rows), n - 1)
                stream = np.insert(ids, bounds[1:], np.array(s.end, ids.dtype))
                width = stream.dtype.itemsize
                binary = pa.Array.from_buffers(pa.binary(), w.rows, [None, pa.py_buffer((np.concatenate([[0], np.cumsum(n)]) * width).astype(np.int32)), pa.py_buffer(stream.tobytes())])
                key = hilbert_key(cells(row, ids, w.rows, s), s.bits)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(w.first, w.rows), pa.array(key), pa.array(n), binary], ["row", "cell_key", "n", "ids"])

    given = docs.select(F.struct(*[docs[c].alias(c) for c in keep]).alias("row"), docs[text].alias("text"))
    return given.mapInArrow(run, f"row {given.schema['row'].dataType.simpleString()}, cell_key long, n long, ids binary")


def pack(docs: DataFrame, keep: list[str], text: str = "text", path: str | None = None, s: Settings = Settings()) -> DataFrame:
    """Columns ``keep`` of each piece's document and ``piece``, a struct of ``start``, ``length``, ``ids`` (little-endian
    unsigned 32-bit), ``doc_tokens``, ``sequence_id``, ``offset`` and ``doc_key``, the document's place on the curve."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    spark = docs.sparkSession
    scratch = Scratch(spark)
    rows = tokenised(docs, keep, text, path, s).withColumn("uid", F.monotonically_increasing_id())
    spread = F.shiftrightunsigned(F.xxhash64(F.lit(s.seed), "uid"), 64 - HASH_BITS)
    rows = scratch.save(rows.withColumn("place", F.shiftleft("cell_key", HASH_BITS).bitwiseOR(spread)))
    tokens = rows.agg(F.sum("n")).first()[0] or 0
    ranges = min(s.most_ranges, max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(tokens / s.range_tokens)))
    bounds = rows.agg(F.percentile_approx("place", [i / ranges for i in range(1, ranges)], max(10_000, 50 * ranges))).first()[0] if ranges > 1 else []
    edges = np.array(sorted(set(bounds or [])), np.int64)

    def range_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            span = np.searchsorted(edges, batch.column("place").to_numpy(), "left").astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(span)], [*batch.schema.names, "span"])

    sums = rows.select("place", "n").mapInArrow(range_of, "place long, n long, span int").groupBy("span").agg(F.sum("n").alias("n")).collect()
    totals = np.zeros(len(edges) + 1, np.int64)
    for r in sums:
        totals[r["span"]] = r["n"]
    base = np.cumsum(totals) - totals
    wide = np.uint16 if _two_bytes(path) else np.uint32
    kind = rows.schema["row"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, at = -1, 0
        for batch in batches:
            span, n = batch.column("span").to_numpy(), batch.column("n").to_numpy()
            ends = np.cumsum(n)
            begin = ends - n
            # a range starts at its base, wherever in the batch; the first goes on from the batch before
            turn = np.flatnonzero(np.diff(span, prepend=last))
            offset = np.full(len(n), at, np.int64)
            for i in turn.tolist():
                offset[i:] = base[span[i]] - begin[i]
            first = begin + offset
            pieces = (first + n - 1) // s.length - first // s.length + 1
            doc = np.repeat(np.arange(len(n)), pieces)
            nth = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            sequence = first[doc] // s.length + nth
            start = np.maximum(sequence * s.length, first[doc])
            stop = np.minimum((sequence + 1) * s.length, (first + n)[doc])
            flat = np.concatenate([np.frombuffer(x.as_buffer(), wide) for x in batch.column("ids")]).astype("<u4")
            lo, size = start - first[doc], stop - start
            place = np.concatenate([[0], np.cumsum(size)]) * 4
            data = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(place.astype(np.int32)), pa.py_buffer(flat.tobytes())])
            columns = [pa.array(lo), pa.array(size), data, pa.array(n[doc]), pa.array(sequence), pa.array(start - sequence * s.length), batch.column("cell_key").take(pa.array(doc))]
            yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(doc)), *columns], ["row", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "doc_key"])
            last, at = int(span[-1]), int(offset[-1] + ends[-1])

    kinds = f"row {kind}, cell_key long, n long, ids binary, uid long, place long, span int"
    dealt = rows.mapInArrow(range_of, kinds).repartitionByRange(ranges, "span").sortWithinPartitions("span", "place", "uid")
    pieces = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, doc_key long"
    out = dealt.mapInArrow(cut, f"row {kind}, {pieces}")
    return out.select("row.*", F.struct(*[p.split()[0] for p in pieces.split(", ")]).alias("piece"))


def _two_bytes(path: str) -> bool:
    return WordIds.of(path).dtype == np.uint16
