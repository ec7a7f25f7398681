"""Benchmark decontamination: a BM25 inverted index of test items, searched by block-max WAND.

Every word of the test set has a posting list of the items that hold it, with
their BM25 impacts, cut into blocks of ``BLOCK`` items of similar length; a list
knows its largest impact and that of each of its blocks.  Document frequencies
and the mean length are those of the whole test set.

Every document is a query of its distinct words.  As in block-max WAND, its lists
are ordered by their largest impacts: those whose largest impacts together stay
under the threshold cannot bring an item over it, so only the blocks of the
other lists are looked at; a block is opened only if the largest impacts of all
its lists reach the threshold; and only in open blocks are postings added up.
The steps of many documents are taken at once, on arrays, in groups of bounded
size.

What is retrieved is verified on 5-word shingles: a document leaks an item if
it holds half of the question's and half of the answer's shingles, or three
quarters of both together, wherever they stand in it.  The answer of a
one-column item is its last sentence.

An item's threshold is a lower bound on the score of any document that meets
this rule, so retrieval loses no leak.  Every word's impact is divided evenly
among the item's shingles that hold it; a text with some of the shingles scores
at least the sum of their shares, and so at least that of as many of the
smallest shares as the rule asks for (``least_score``).

Items are streamed to the driver, which indexes ``Settings.pass_words`` words of
them at a time; a larger test set takes more passes over the documents.  The
driver holds the document frequencies of the test set's distinct words.

Defined results: null and empty texts and items match nothing; an item of under
five words is one shingle; repeated documents are reported each; repeated items
too; an empty table on either side gives an empty result; ``item_id`` keeps its
type; columns of the documents pass through ``mark_leaks``, which replaces ``leaked``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quillon.llm._arrow import add_columns
from quillon.llm._words import shingles, words
from quillon.scratch import Scratch

BLOCK = 8
GROUP = 1 << 18  # words times blocks looked at together
WORD = r"[^\x20\x09-\x0D]+"
REACHED = 0.999  # of a threshold, which leaves room for rounding


@dataclass(frozen=True)
class Settings:
    part: float = 0.5
    whole: float = 0.75
    pass_words: int = 1 << 21
    k1: float = 1.2
    b: float = 0.75


@dataclass
class Index:
    """Posting lists of some items, by word.

    ``entry`` names each block of each list (word * blocks + block), ``block_max``
    is its largest impact and ``first`` its first posting; ``item`` and ``impact``
    are the postings.  Impacts are relative to each item's threshold; ``least`` is
    the threshold relative to the item's own score.  ``known`` are all shingles.
    """

    ids: list
    vocabulary: np.ndarray
    list_max: np.ndarray
    list_first: np.ndarray
    entry: np.ndarray
    block_max: np.ndarray
    first: np.ndarray
    item: np.ndarray
    impact: np.ndarray
    question: list[np.ndarray]
    answer: list[np.ndarray]
    known: np.ndarray
    least: np.ndarray

    @property
    def blocks(self) -> int:
        return -(-len(self.ids) // BLOCK)


@dataclass
class Statistics:
    """What BM25 knows of a test set: its size, mean length, words and the items that hold each."""

    items: int
    mean_length: float
    vocabulary: np.ndarray
    df: np.ndarray


def _hashes(texts: list[str]) -> list[np.ndarray]:
    return [w.hashes[lo:hi] for w in words(pa.array(texts, pa.string())) for lo, hi in zip(w.bounds[:-1], w.bounds[1:])]


def statistics(items: DataFrame) -> Statistics:
    """Of the column ``text``; counted by the executors, one row a distinct word comes back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in words(batch.column(0)):
                pairs = np.unique(np.stack([w.row_of().astype(np.uint64), w.hashes], 1), axis=0)
                own, n = np.unique(pairs[:, 1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(n)], ["h", "n"])

    length = F.regexp_count("text", F.lit(WORD))
    n, mean = items.where("text is not null").agg(F.count(F.lit(1)), F.avg(length)).first()
    counts = items.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).toArrow()
    h = counts["h"].to_numpy().view(np.uint64)
    order = np.argsort(h)
    return Statistics(n, max(1.0, float(mean or 0)), h[order], counts["n"].to_numpy()[order])


def _shingle_words(x: np.ndarray) -> np.ndarray:
    """The words of each distinct shingle, one row each."""
    return np.unique(np.lib.stride_tricks.sliding_window_view(x, min(5, len(x))), axis=0) if len(x) else np.zeros((0, 0), x.dtype)


def least_score(impact: np.ndarray, question: np.ndarray, answer: np.ndarray, s: Settings) -> float:
    """A score that no text which meets the overlap rule is under.

    ``question`` and ``answer`` are places in ``impact``.
    """
    sides = [[np.unique(x) for x in _shingle_words(side)] for side in (question, answer)]
    among = np.bincount(np.concatenate([np.zeros(0, np.int64), *sides[0], *sides[1]]), minlength=len(impact))
    shares = [np.sort([float((impact[x] / among[x]).sum()) for x in side]) for side in sides]
    fewest = lambda part, n: int(np.ceil(part * n - 1e-9))
    apart = sum(float(x[: fewest(s.part, len(x))].sum()) for x in shares)
    together = np.sort(np.concatenate(shares))
    return min(apart, float(together[: fewest(s.whole, len(together))].sum()))


def build_index(ids: list, questions: list[str], answers: list[str], known: Statistics, s: Settings) -> Index:
    """Index the items; impacts are divided by the score at which an item counts as retrieved."""
    q, a = _hashes(questions), _hashes(answers)
    columns: list[list[np.ndarray]] = [[np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0)]]
    least = np.full(len(ids), 1e-9)
    own_score = np.full(len(ids), 1e-9)
    for i, (x, y) in enumerate(zip(q, a)):
        own, tf = np.unique(np.concatenate([x, y]), return_counts=True)
        df = known.df[np.searchsorted(known.vocabulary, own)] if len(own) else np.zeros(0)
        idf = np.log(1 + (known.items - df + 0.5) / (df + 0.5))
        impact = idf * tf * (s.k1 + 1) / (tf + s.k1 * (1 - s.b + s.b * (len(x) + len(y)) / known.mean_length))
        least[i] = max(1e-9, least_score(impact, np.searchsorted(own, x), np.searchsorted(own, y), s))
        own_score[i] = max(1e-9, impact.sum())
        for column, part in zip(columns, (own, np.full(len(own), i), impact / least[i])):
            column.append(part)
    word, item, impact = (np.concatenate(c) for c in columns)
    vocabulary, term = np.unique(word, return_inverse=True)
    order = np.lexsort((item, term))
    term, item, impact = term[order], item[order], impact[order]
    starts = lambda key: np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    largest = lambda at: np.maximum.reduceat(impact, at) if len(at) else np.zeros(0)
    key = term * -(-len(ids) // BLOCK) + item // BLOCK
    of_block, of_list = starts(key), starts(term)
    question, answer = ([np.unique(shingles(x)) for x in side] for side in (q, a))
    all_shingles = np.unique(np.concatenate([np.zeros(0, np.uint64), *question, *answer]))
    return Index(
        ids, vocabulary, largest(of_list), np.searchsorted(of_block, np.append(of_list, len(term))), key[of_block], largest(of_block),
        np.append(of_block, len(term)), item.astype(np.int32), impact.astype(np.float32), question, answer, all_shingles, least / own_score,
    )


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All whole numbers of the ranges, and for each the place of its range."""
    n = hi - lo
    place = np.repeat(np.arange(len(n)), n)
    return np.arange(len(place)) - np.repeat(np.cumsum(n) - n, n) + lo[place], place


def _open_blocks(row: np.ndarray, term: np.ndarray, rows: int, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Rows and blocks that may hold an item over the threshold, judged by the lists that can bring one there."""
    order = np.lexsort((index.list_max[term], row))
    row, term = row[order], term[order]
    upto = np.cumsum(index.list_max[term])
    bounds = np.searchsorted(row, np.arange(rows + 1))
    before = np.concatenate([[0.0], upto])[bounds[:-1]]
    idle = upto - before[row] < REACHED  # together they stay under it
    rest = np.bincount(row[idle], index.list_max[term[idle]], rows)
    at, place = _ranges(index.list_first[term[~idle]], index.list_first[term[~idle] + 1])
    pair, back = np.unique(row[~idle][place] * index.blocks + index.entry[at] % index.blocks, return_inverse=True)
    bound = np.bincount(back, index.block_max[at], len(pair)) + rest[pair // index.blocks]
    return np.divmod(pair[bound >= REACHED], index.blocks)


def retrieve(column: pa.Array, index: Index) -> Iterator[tuple[int, int, float, np.ndarray]]:
    """(row, item place, score, words of the text) of each text and item at or over the threshold, row by row."""
    for w in words(column):
        if not len(w.hashes) or not len(index.vocabulary):
            continue
        at = np.minimum(np.searchsorted(index.vocabulary, w.hashes), len(index.vocabulary) - 1)
        known = index.vocabulary[at] == w.hashes
        pairs = np.unique(w.row_of()[known] * len(index.vocabulary) + at[known])
        for row, term, first, rows in _groups(*np.divmod(pairs, len(index.vocabulary)), w.rows, index.blocks):
            for r, i, value in _scored(row, term, rows, index):
                yield w.first + first + r, i, value, w.hashes[w.bounds[first + r] : w.bounds[first + r + 1]]


def _groups(row: np.ndarray, term: np.ndarray, rows: int, blocks: int) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """Rows and words in groups of whole rows, numbered from 0, with the first row and the number of rows: a group has
    ``GROUP`` pairs of a word and a block at most, or one row."""
    bounds = np.searchsorted(row, np.arange(rows + 1))
    at = 0
    while at < rows:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + GROUP // blocks, "right")) - 1)
        own = slice(bounds[at], bounds[to])
        yield row[own] - at, term[own], at, to - at
        at = to


def _scored(row: np.ndarray, term: np.ndarray, rows: int, index: Index) -> Iterator[tuple[int, int, float]]:
    """(row, item place, score) of what is at or over the threshold."""
    if len(row):
        bounds = np.searchsorted(row, np.arange(rows + 1))
        some, block = _open_blocks(row, term, rows, index)
        asked, place = _ranges(bounds[some], bounds[some + 1])  # each open block is asked for all words of its row
        key = term[asked] * index.blocks + block[place]
        e = np.minimum(np.searchsorted(index.entry, key), len(index.entry) - 1)
        hit = index.entry[e] == key
        e, place = e[hit], place[hit]
        stay = np.bincount(place, index.block_max[e], len(some)) >= REACHED
        e, place = e[stay[place]], place[stay[place]]
        posting, of = _ranges(index.first[e], index.first[e + 1])
        scored, back = np.unique(some[place[of]] * len(index.ids) + index.item[posting], return_inverse=True)
        score = np.bincount(back, index.impact[posting], len(scored))
        over = score >= REACHED
        for name, value in zip(scored[over].tolist(), score[over].tolist()):
            yield *divmod(name, len(index.ids)), value


def leaks(column: pa.Array, index: Index, s: Settings) -> dict[tuple[int, int], tuple[float, float, float]]:
    """(row, item place) of every verified leak, with the score and the overlaps of question and answer."""
    out: dict[tuple[int, int], tuple[float, float, float]] = {}
    last, found = -1, index.known
    for row, i, score, text in retrieve(column, index):
        if row != last:
            own = shingles(text)
            at = np.minimum(np.searchsorted(index.known, own), len(index.known) - 1)
            last, found = row, np.unique(own[index.known[at] == own])
        q, a = index.question[i], index.answer[i]
        if not len(found) or not len(q) and not len(a):
            continue
        in_q, in_a = (float(np.isin(x, found).mean()) if len(x) else 1.0 for x in (q, a))
        together = float(np.isin(np.concatenate([q, a]), found).mean())
        if min(in_q, in_a) >= s.part or together >= s.whole:
            out[row, i] = (score * float(index.least[i]), in_q, in_a)
    return out


def split_item(text: str) -> tuple[str, str]:
    """Question and answer of a one-column item: all but its last sentence of five words or more, and the rest."""
    parts = text.split()
    ends = [i + 1 for i, x in enumerate(parts[:-1]) if x[-1] in ".?!" and len(parts) - i - 1 >= 5 and i + 1 >= 5]
    return (" ".join(parts[: ends[-1]]), " ".join(parts[ends[-1] :])) if ends else (text, "")


def build_passes(items: DataFrame, s: Settings = Settings()) -> Iterator[Index]:
    """Indexes of ``items`` (``item_id``, ``text``), shortest first, one a pass."""
    some = items.where(F.col("text").rlike(WORD)).select("item_id", "text", F.regexp_count("text", F.lit(WORD)).alias("n"))
    known = statistics(some)
    held: list[tuple] = []
    size = 0

    def built() -> Index:
        split = [split_item(text) for _, text in held]
        return build_index([i for i, _ in held], [x[0] for x in split], [x[1] for x in split], known, s)

    for r in some.orderBy("n", "text").toLocalIterator():
        if held and size + r["n"] > s.pass_words:
            yield built()
            held, size = [], 0
        held.append((r["item_id"], r["text"]))
        size += r["n"]
    if held:
        yield built()


def find_leaks(docs: DataFrame, items: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One row for each document and item that it leaks: ``doc_id``, ``item_id``,
    ``score`` (relative to the item's own), ``question_overlap``, ``answer_overlap``."""
    kind = items.schema["item_id"].dataType
    schema = f"doc_id long, item_id {kind.simpleString()}, score double, question_overlap double, answer_overlap double"
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    arrow = to_arrow_type(kind)
    passes = build_passes(items, s)
    index, following = next(passes, None), next(passes, None)
    out = None
    scratch = Scratch(docs.sparkSession) if following is not None else None
    while index is not None:
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                found = leaks(batch.column(1), index, s)
                if found:
                    rows, places = zip(*found)
                    ids = pa.array([index.ids[i] for i in places], arrow)
                    numbers = (pa.array(x, pa.float64()) for x in zip(*found.values()))
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), ids, *numbers], ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

        part = source.mapInArrow(run, schema)
        if scratch is not None:  # one index at a time is in memory
            part = scratch.save(part)
            shared.unpersist()
        out = part if out is None else out.unionAll(part)
        index, following = following, next(passes, None) if following is not None else None
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def mark_leaks(docs: DataFrame, items: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``docs`` with ``leaked``, true where a document leaks any item."""
    out, scratch = docs.withColumn("leaked", F.lit(False)), None
    for n, index in enumerate(build_passes(items, s)):
        if n:  # one index at a time is in memory
            scratch = scratch or Scratch(docs.sparkSession)
            out = scratch.save(out)
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def make(shared=shared):
            def work(given):
                leaked = given["leaked"].to_numpy(zero_copy_only=False).astype(bool).copy()
                for row, _ in leaks(given["text"], shared.value, s):
                    leaked[row] = True
                return {"leaked": leaked}

            return work

        out = add_columns(out, {"text": F.col("text"), "leaked": F.col("leaked")}, {"leaked": "boolean"}, make)
    return out
