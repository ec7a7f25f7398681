"""Language-model scores from a log-bilinear model trained by noise-contrastive estimation.

Words are lower-cased runs of bytes other than space and 0x09-0x0D; each text
ends with one end token.  Three passes read all whole texts:

1. counts of every word of the training texts (a shuffled sum; any number of words);
2. symbols: the training texts, word by word, written once.  Symbols are the
   most frequent words, one for each of 256 classes of the other words by their
   last two bytes, and the end;
3. scores.

The model sums the vectors of the ``Settings.context`` symbols before a place,
each weighted for its position, and scores classes of symbols of similar
frequency, and the symbols within a class, by products with their own vectors.
Either level is trained against noise of its own unigram law, and normalised
by matrix products over all its members; a word without a symbol has its
smoothed share of its class of endings.

The model learns from every place of every training text.  The texts are dealt
at random over a few rounds (``Settings.rounds``); in each, every task goes on
from the same model through its own texts, and what the tasks have learned is
averaged, row by row over the tasks that met it, by a shuffle.  The model alone
passes the driver.

The number of words with a symbol grows as the root of the training tokens
(``Settings.words_per_root``).  The model travels to every task: at most
``Settings.most_words`` words, some 80 MB, which is reached at about a billion
tokens; further words share the classes of endings.
The counts of words without a symbol are joined by a shuffle.

Defined results: a null or empty text is the end token alone; repeated rows get
equal scores; without any training row every probability is uniform over the
symbols; columns of the input pass through, except those that are added.
"""

from __future__ import annotations

import copy
import functools
import itertools
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm._arrow import add_columns
from quillon.llm._words import Words, words
from quillon.scratch import Scratch

CLASSES = 256
SMOOTHING = 0.1
PIECE = 1 << 16  # places written at once
PIECES = 16  # that go to a task at once
ROWS = 2048  # rows of a table of the model averaged at once
START_BITS = 18  # of a hash, by which words are found
RUN = 12  # rows of a run that are summed together with those of other runs
BLOCK = 256  # places whose vectors stay in the processor's cache
LOG2_E = np.float32(1 / math.log(2))  # powers of 2 take half the time of those of e


@dataclass(frozen=True)
class Settings:
    """``batch`` to ``most_batch`` places a step, as many as leave a task ``least_steps``; ``windows_per_root`` times
    the root of the training tokens are the least places of a round, of which there are at most ``rounds``."""

    words_per_root: float = 4.0
    most_words: int = 1 << 18
    windows_per_root: float = 256.0
    rounds: int = 8
    context: int = 3
    dimensions: int = 32
    noise: int = 20
    noise_draws: int = 1024
    noise_words: int = 8
    word_draws: int = 32
    noise_block: int = 512
    batch: int = 4096
    most_batch: int = 32768
    least_steps: int = 250
    rate: float = 0.1
    seed: int = 17


def word_class(w: Words) -> np.ndarray:
    """Class of each word by its last two bytes."""
    last = w.data[w.ends - 1].astype(np.int64)
    second = np.where(w.ends - w.starts > 1, w.data[np.maximum(w.ends - 2, 0)].astype(np.int64), 0)
    return (last * 31 + second * 7) % CLASSES


def _sums(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    own, where, back = np.unique(keys, return_index=True, return_inverse=True)
    return own, where, np.bincount(back, counts, len(own)).astype(np.int64)


def word_counts(texts: DataFrame) -> DataFrame:
    """``h``, ``cls`` and ``n`` of every word of the column ``text``; summed in each batch before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for w in words(batch.column(0)):
                own, where, n = np.unique(w.hashes, return_index=True, return_counts=True)
                parts.append((own, word_class(w)[where], n))
            h, c, n = (np.concatenate([p[i] for p in parts]) for i in range(3)) if parts else (np.zeros(0, np.uint64),) * 3
            own, where, total = _sums(h, n)
            yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(c[where].astype(np.int32)), pa.array(total)], ["h", "cls", "n"])

    parts = texts.select("text").mapInArrow(run, "h long, cls int, n long")
    return parts.groupBy("h").agg(F.min("cls").alias("cls"), F.sum("n").alias("n"))


@dataclass
class Lexicon:
    """The words with a symbol, sorted by hash, and what every task needs to know of the rest.

    Symbols are numbered by falling count and cut into classes of ``width``.
    """

    hashes: np.ndarray
    symbol: np.ndarray
    count: np.ndarray
    endings: np.ndarray
    end: int
    law: np.ndarray
    words: int
    distinct: int
    class_words: np.ndarray
    class_distinct: np.ndarray
    texts: int

    @property
    def width(self) -> int:
        return max(1, math.isqrt(len(self.law)))

    def find(self, h: np.ndarray) -> np.ndarray:
        """Index of each hash among the words with a symbol, or -1."""
        if not len(self.hashes):
            return np.full(len(h), -1)
        at = self._starts.take((h >> np.uint64(64 - START_BITS)).view(np.int64))
        there = self._hashes.take(at)
        low = np.flatnonzero(there < h)
        while len(low):
            at[low] += 1
            there[low] = self._hashes.take(at[low])
            low = low[there[low] < h[low]]
        at[(there != h) | (at == len(self.hashes))] = -1
        return at

    @functools.cached_property
    def _starts(self) -> np.ndarray:
        """Where the hashes begin that have each value of the first ``START_BITS`` bits; hashes are spread evenly."""
        return np.searchsorted(self.hashes, np.arange(1 << START_BITS, dtype=np.uint64) << np.uint64(64 - START_BITS))

    @functools.cached_property
    def _hashes(self) -> np.ndarray:
        return np.append(self.hashes, np.uint64((1 << 64) - 1))

    def symbols_of(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per word its index among the words with a symbol, its class of endings and its symbol."""
        at, cls = self.find(w.hashes), word_class(w)
        return at, cls, np.where(at >= 0, self.symbol.take(at, mode="clip") if len(self.symbol) else 0, self.endings.take(cls))

    @property
    def tokens(self) -> int:
        return self.words + self.texts

    def base_log(self, count: np.ndarray | float) -> np.ndarray:
        types = self.distinct + (self.texts > 0)
        return np.log10((count + SMOOTHING) / (self.tokens + SMOOTHING * (types + 1)))

    def class_log_mass(self) -> np.ndarray:
        return np.log10(self.class_words + SMOOTHING * (self.class_distinct + 1))


def lexicon(counts: DataFrame, texts: int, s: Settings) -> Lexicon:
    """Read the most frequent words and the totals of all words from the written counts."""
    totals = counts.groupBy("cls").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    class_words, class_distinct = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for r in totals:
        class_words[r["cls"]], class_distinct[r["cls"]] = r["n"], r["v"]
    n_all, v_all = int(class_words.sum()), int(class_distinct.sum())
    wanted = min(s.most_words, math.ceil(s.words_per_root * math.sqrt(n_all + texts)))
    head = counts.orderBy(F.col("n").desc(), "h").limit(wanted).toArrow()
    h, n, cls = head["h"].to_numpy().view(np.uint64), head["n"].to_numpy(), head["cls"].to_numpy()
    np.subtract.at(class_words, cls, n)
    np.subtract.at(class_distinct, cls, 1)
    law = np.concatenate([n, class_words, [texts]])
    order = np.argsort(-law, kind="stable")
    symbol = np.empty(len(law), np.int64)
    symbol[order] = np.arange(len(law))
    law = (law[order] + 0.5) / (law.sum() + 0.5 * len(law))
    by_hash = np.argsort(h)
    return Lexicon(h[by_hash], symbol[by_hash], n[by_hash], symbol[len(n) : -1], int(symbol[-1]), law, n_all, v_all, class_words, class_distinct, texts)


def laid_out(w: Words, symbol: np.ndarray, end: int, context: int) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all texts, each led by ``context`` ends and closed by one, and where the words and closing ends are."""
    long = np.diff(w.bounds) + 1
    bounds = np.concatenate([[0], np.cumsum(long)])
    at = np.arange(bounds[-1]) + context * (np.repeat(np.arange(w.rows), long) + 1)
    laid = np.full(int(bounds[-1]) + context * w.rows, end)
    is_end = np.zeros(int(bounds[-1]), bool)
    is_end[bounds[1:] - 1] = True
    laid[at[~is_end]] = symbol
    return laid, at


def sequence(w: Words, symbol: np.ndarray, end: int, context: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all places of all texts (words, then the end), those before each (nearest first, ends
    before the first), and the bounds of the texts among the places."""
    laid, at = laid_out(w, symbol, end, context)
    bounds = np.concatenate([[0], np.cumsum(np.diff(w.bounds) + 1)])
    return laid.take(at), np.stack([laid.take(at - j) for j in range(1, context + 1)]).T, bounds


def places(laid: np.ndarray, end: int, context: int) -> np.ndarray:
    """Which symbols of whole texts of ``laid_out`` are words or closing ends: all but the ``context`` ends before a text."""
    is_end = laid == end
    return ~is_end | (np.cumsum(is_end) % (context + 1) == 0)


def symbols(texts: DataFrame, lex: Lexicon, rounds: int, s: Settings) -> DataFrame:
    """``w``: packed symbols of whole texts of the column ``text``, as ``laid_out``, and the ``round`` they are dealt to."""
    shared = texts.sparkSession.sparkContext.broadcast(lex)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.Generator(np.random.PCG64([s.seed, TaskContext.get().partitionId()]))
        own, held = shared.value, [[] for _ in range(rounds)]

        def packed(k: int) -> pa.RecordBatch:
            w, held[k] = np.concatenate(held[k]).astype(np.int32).tobytes(), []
            return pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([w], pa.binary())], ["round", "w"])

        for batch in batches:
            for w in words(batch.column(0)):
                laid, _ = laid_out(w, own.symbols_of(w)[2], own.end, s.context)
                dealt = np.repeat(rng.integers(0, rounds, w.rows), np.diff(w.bounds) + 1 + s.context)
                for k in range(rounds):
                    held[k].append(laid[dealt == k])
                    if sum(map(len, held[k])) >= PIECE:
                        yield packed(k)
        for k in range(rounds):
            if sum(map(len, held[k])):
                yield packed(k)

    return texts.select("text").mapInArrow(run, "round int, w binary")


class LogBilinear:
    """Vectors of symbols as context, weights of positions, and vectors and biases of classes and of symbols in their class."""

    def __init__(self, law: np.ndarray, width: int, s: Settings):
        rng = np.random.Generator(np.random.PCG64(s.seed))
        self.width, self.classes = width, -(-len(law) // width)
        padded = np.zeros(self.classes * width)
        padded[: len(law)] = law
        self.class_law = padded.reshape(-1, width).sum(1)
        self.within = (padded.reshape(-1, width) / self.class_law[:, None]).ravel()
        d = s.dimensions
        self.context = rng.normal(0, 0.1, (len(padded), d)).astype(np.float32)
        self.place = np.repeat(1 / np.arange(1, s.context + 1, dtype=np.float32)[:, None], d, 1)
        self.of_class = rng.normal(0, 0.1, (self.classes, d)).astype(np.float32)
        self.class_bias = np.log(self.class_law).astype(np.float32)
        self.symbol = rng.normal(0, 0.1, (len(padded), d)).astype(np.float32)
        self.bias = np.log(np.maximum(self.within, 1e-38)).astype(np.float32)
        self.bias[len(law) :] = -1e30  # no symbol there

    def forget(self) -> None:
        """Back to the unigram law."""
        self.context[:] = 0

    def log10(self, now: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Normalised log10-probability of each symbol after those before it."""
        return Scorer(self).log10(now, before)


class Scorer:
    """Normalised logs by a model that no longer changes."""

    def __init__(self, m: LogBilinear, block: int = 1024):
        self.m, self.block = m, block
        self.place = np.repeat(m.place[:, None], block, 1)
        self.room = np.empty((2, block, m.context.shape[1]), np.float32)
        space = np.empty(block * max(m.width, m.classes), np.float32)
        self.classes = _Scores(m.of_class, m.class_bias, space)
        self.symbols = [_Scores(m.symbol[lo : lo + m.width], m.bias[lo : lo + m.width], space) for lo in range(0, len(m.symbol), m.width)]

    def log10(self, now: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Normalised log10-probability of each symbol after those before it, by batched matrix products.

        Places are taken class by class, in blocks whose scores stay in the processor's cache.
        """
        out = np.empty(len(now))
        group, member = np.divmod(now, self.m.width)
        order = _order(group)
        group, member, before = group.take(order), member.take(order), [before[:, j].take(order) for j in range(before.shape[1])]
        cuts = np.searchsorted(group, np.arange(self.m.classes + 1))
        for g in np.flatnonzero(np.diff(cuts)):
            for lo in range(cuts[g], cuts[g + 1], self.block):
                some = slice(lo, min(lo + self.block, cuts[g + 1]))
                q = self._summed([x[some] for x in before])
                longest = math.sqrt(np.einsum("td,td->t", q, q).max())
                q *= LOG2_E
                out[some] = self.classes.log2(q, group[some], longest) + self.symbols[g].log2(q, member[some], longest)
        back = np.empty_like(out)
        back[order] = out * math.log10(2)
        return back

    def _summed(self, before: list[np.ndarray]) -> np.ndarray:
        """The vector that predicts what follows, for the symbols before at each distance."""
        n, context = len(before[0]), self.m.context
        q, more = self.room[:, :n]
        context.take(before[0], axis=0, out=q, mode="clip")
        q *= self.place[0, :n]
        for j in range(1, len(before)):
            context.take(before[j], axis=0, out=more, mode="clip")
            more *= self.place[j, :n]
            q += more
        return q


def text_scores(scorer: Scorer, parts: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], at_once: int = 1 << 17) -> np.ndarray:
    """The log10-probability of each text; ``parts`` hold the symbols of whole texts, those before each (nearest first, a row for each distance), and the places of each text.

    Parts are taken together until they have ``at_once`` places: the more there are, the fuller the blocks of each class.
    """
    out, held, places = [], [], 0
    for part in itertools.chain(parts, [None]):
        if held and (part is None or places >= at_once):
            now, before, long = (np.concatenate(x, axis=-1) for x in zip(*held))
            out.append(np.add.reduceat(scorer.log10(now, before.T), np.cumsum(long) - long))
            held, places = [], 0
        if part is not None:
            held.append(part)
            places += len(part[0])
    return np.concatenate([np.zeros(0), *out])


class _Scores:
    """Normalised logs of one level, worked out in ``space``."""

    def __init__(self, vectors: np.ndarray, bias: np.ndarray, space: np.ndarray):
        self.by, self.bias, self.times, self.space = vectors.T, bias * LOG2_E, np.exp(bias), space
        self.longest, self.top = math.sqrt(np.einsum("td,td->t", vectors, vectors).max()), float(np.abs(bias[bias > -1e29]).max())

    def log2(self, q: np.ndarray, chosen: np.ndarray, longest: float) -> np.ndarray:
        """Of ``chosen`` in each row; ``q`` is multiplied by ``LOG2_E``, and its longest row was ``longest`` before."""
        z = np.matmul(q, self.by, out=self.space[: len(q) * len(self.bias)].reshape(len(q), -1))
        own = z[np.arange(len(q)), chosen] + self.bias.take(chosen)
        if longest * self.longest + self.top > 60:  # powers might not fit
            z += self.bias
            z /= LOG2_E
            return own - _log_sum(z) * LOG2_E
        np.exp2(z, out=z)
        return own - np.log2(z @ self.times)


def _log_sum(z: np.ndarray) -> np.ndarray:
    """Log of the sum of exponentials of each row; overwrites ``z``."""
    top = z.max()
    z -= top
    far = z.max(1) < -80 if z.min() < -80 else None  # rows far under the others
    if far is not None and far.any():
        own = z.max(1)
        z -= own[:, None]
        top = top + own
    np.exp(z, out=z)
    return top + np.log(z.sum(1))


def _sigmoid(z: np.ndarray, times: np.ndarray | float = 1) -> np.ndarray:
    """The logistic function, in place, ``times`` a weight, of what was multiplied by ``-LOG2_E``."""
    np.exp2(z, out=z)
    z += 1
    return np.divide(times, z, out=z)


def _order(ids: np.ndarray) -> np.ndarray:
    """A stable order of numbers under 2**32, by their halves."""
    order = np.argsort(ids.astype(np.uint16), kind="stable")
    high = (ids >> 16).astype(np.uint16)
    return order[np.argsort(high[order], kind="stable")] if high.any() else order


def _runs(ids: np.ndarray) -> np.ndarray:
    """Where each number of ordered ``ids`` begins."""
    return np.concatenate([[0], np.flatnonzero(np.diff(ids)) + 1])


def _run_sums(rows: np.ndarray, order: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the rows of each run of ``order``, longer runs first, and which run each sum is of; ``first`` is where runs begin.

    The i-th rows of all runs that have one are added at once; what is over ``RUN`` rows is summed run by run.
    """
    long = np.diff(first, append=len(order))
    capped = np.minimum(long, RUN + 1)
    by = np.argsort((RUN + 1 - capped).astype(np.uint8), kind="stable")
    have = np.cumsum(np.bincount(capped, minlength=RUN + 2)[::-1])[::-1].tolist()  # runs of that many rows at least
    at, end = first[by], (first + long)[by]
    out = rows.take(order.take(at), axis=0)
    for i in range(1, RUN):
        if have[i + 1]:
            out[: have[i + 1]] += rows.take(order.take(at[: have[i + 1]] + i), axis=0)
    ones = np.ones(int(long.max()), rows.dtype)
    for k in range(have[RUN + 1]):
        rest = rows.take(order[at[k] + RUN : end[k]], axis=0)
        out[k] += ones[: len(rest)] @ rest
    return out, by


class Trainer:
    """A model, the law of its noise, and steps scaled by the root of the squares of all gradients so far (Adagrad by rows).

    A class is told apart from ``noise`` times as many drawn from the law of
    classes, a symbol from ``noise_words`` drawn from the law of its class.
    Draws are shared: those of classes by the places of a block, those of
    symbols by the places of a step that have the same class.
    """

    TABLES = ("context", "place", "of_class", "class_bias", "symbol", "bias")

    def __init__(self, law: np.ndarray, width: int, s: Settings):
        self.s, self.m = s, LogBilinear(law, width, s)
        self.squares = {name: np.full(len(getattr(self.m, name)), 1e-2, np.float32) for name in self.TABLES}
        self.upto_class = np.cumsum(self.m.class_law / self.m.class_law.sum())
        upto = np.cumsum(self.m.within.reshape(-1, width), axis=1).ravel()
        self.upto = np.arange(len(upto)) // width + upto  # class number plus the share up to each of its symbols
        self.log_within = (self.m.bias + math.log(s.noise_words)).astype(np.float32)
        self.log_class = np.log(s.noise * self.m.class_law).astype(np.float32)

    def _up(self, name: str, grad: np.ndarray, ids: np.ndarray, rate: float) -> None:
        """Go up ``grad``, whose rows are those of ``ids``; none repeats."""
        weights, seen = getattr(self.m, name), self.squares[name]
        grad = grad.reshape(len(ids), -1)
        squares = seen.take(ids) + np.einsum("td,td->t", grad, grad) / grad.shape[1]
        seen[ids] = squares
        step = grad * (rate / np.sqrt(squares))[:, None]
        step += weights.take(ids, axis=0).reshape(step.shape)
        weights[ids] = step if weights.ndim > 1 else step[:, 0]

    def learn(self, laid: np.ndarray, asked: np.ndarray, rng: np.random.Generator, batch: int, rate: Callable[[int], float]) -> None:
        """Steps of ``batch`` symbols through ``laid``, predicting those ``asked``; ``rate`` is told how many came before."""
        for lo in range(0, len(laid), batch):
            lead = max(0, lo - self.s.context)
            some = asked[lead : lo + batch].copy()
            some[: lo - lead] = False
            if some.any():
                with np.errstate(over="ignore"):  # of powers whose reciprocal is 0
                    self._step(laid[lead : lo + batch], some, rng, rate(lo))

    def _step(self, laid: np.ndarray, asked: np.ndarray, rng: np.random.Generator, rate: float) -> None:
        """One step on both levels; places are taken in the order of their symbols."""
        m, c, d = self.m, self.s.context, self.s.dimensions
        place = np.repeat(m.place[:, None], min(BLOCK, len(laid)), 1)
        given = np.zeros((c + len(laid), d), np.float32)  # led by as many rows of zeros as there are positions
        m.context.take(laid, axis=0, out=given[c:], mode="clip")
        order = _order(laid)
        at = order[asked.take(order)]
        now = laid.take(at)
        q = self._moved([given[c - 1 - j :] for j in range(c)], place, len(laid)).take(at, axis=0)
        group = now // m.width
        pull = self._classes(q, group, rng, rate) + self._symbols(q, now, group, rng, rate)
        of = np.full(len(laid) + c, len(at))  # where each symbol's pull is; the last row is none
        of[at] = np.arange(len(at))
        pulls = np.concatenate([pull, np.zeros((1, d), np.float32)]).take(of, axis=0)
        back = self._moved([pulls[j + 1 :] for j in range(c)], place, len(laid))
        moved = np.stack([np.einsum("td,td->d", pulls[j + 1 : len(laid)], given[c : c + len(laid) - 1 - j]) for j in range(c)])
        self._up("place", moved / math.sqrt(len(at)), np.arange(c), rate)
        met = laid.take(order)
        first = _runs(met)
        total, by = _run_sums(back, order, first)
        self._up("context", total, met[first][by], rate)

    @staticmethod
    def _moved(rows: list[np.ndarray], place: np.ndarray, n: int) -> np.ndarray:
        """The sum of the first ``n`` of each of ``rows``, weighted by its position; ``place`` repeats the weights for a block."""
        out = np.empty((n, rows[0].shape[1]), np.float32)
        part = np.empty(place.shape[1:], np.float32)
        for lo in range(0, n, len(part)):
            here = out[lo : lo + len(part)]
            np.multiply(rows[0][lo : lo + len(here)], place[0, : len(here)], out=here)
            for j in range(1, len(rows)):
                here += np.multiply(rows[j][lo : lo + len(here)], place[j, : len(here)], out=part[: len(here)])
        return out

    def _classes(self, q: np.ndarray, group: np.ndarray, rng: np.random.Generator, rate: float) -> np.ndarray:
        """Step towards the class of each place and away from the noise of its block; what pulls ``q``."""
        m, s, n, d = self.m, self.s, *q.shape
        long = min(s.noise_block, n)
        blocks = -(-n // long)
        draws = max(s.noise, s.noise_draws // blocks)
        drawn = np.minimum(np.searchsorted(self.upto_class, rng.random((blocks, draws)), "right"), m.classes - 1)
        bias = (m.class_bias - self.log_class) * -LOG2_E
        padded = np.zeros((blocks * long, d), np.float32)
        padded[:n] = q
        padded, noise = padded.reshape(blocks, long, d), m.of_class[drawn]
        away = np.matmul(padded, noise.transpose(0, 2, 1) * -LOG2_E)
        away += bias[drawn][:, None]
        _sigmoid(away, np.float32(-s.noise / draws))
        away.reshape(blocks * long, draws)[n:] = 0
        pull = np.matmul(away, noise).reshape(-1, d)[:n]
        own = m.of_class.take(group, axis=0)
        near = 1 - _sigmoid(np.einsum("td,td->t", q, own) * -LOG2_E + bias.take(group))
        own *= near[:, None]
        pull += own
        first = _runs(group)
        ids = np.concatenate([group[first], drawn.ravel()])
        cuts = [*first, n]
        towards = np.stack([near[a:b] @ q[a:b] for a, b in zip(cuts[:-1], cuts[1:])])
        grad = np.concatenate([towards, np.matmul(away.transpose(0, 2, 1), padded).reshape(-1, d)])
        grad_bias = np.concatenate([np.add.reduceat(near, first), np.matmul(np.ones(long, np.float32), away).ravel()])
        order = _order(ids)
        first = _runs(ids[order])
        ids = ids[order][first]
        self._up("of_class", np.add.reduceat(grad[order], first, axis=0), ids, rate)
        self._up("class_bias", np.add.reduceat(grad_bias[order], first), ids, rate)
        return pull

    def _symbols(self, q: np.ndarray, now: np.ndarray, group: np.ndarray, rng: np.random.Generator, rate: float) -> np.ndarray:
        """Step towards the symbol of each place and away from the noise of its class; what pulls ``q``."""
        m, s = self.m, self.s
        bias = (m.bias - self.log_within) * -LOG2_E
        own = m.symbol.take(now, axis=0)
        near = 1 - _sigmoid(np.einsum("td,td->t", q, own) * -LOG2_E + bias.take(now))
        own *= near[:, None]
        starts = _runs(group)
        present = group[starts][:, None]
        drawn = np.searchsorted(self.upto, present + rng.random((len(present), s.word_draws)), "right")
        drawn, times = np.unique(np.minimum(drawn, (present + 1) * m.width - 1), return_counts=True)
        weight = (times * (-s.noise_words / s.word_draws)).astype(np.float32)
        noise, noise_bias = m.symbol.take(drawn, axis=0), bias.take(drawn)
        by = (noise * -LOG2_E).T
        grad, grad_bias, ones = np.zeros_like(noise), np.zeros_like(noise_bias), np.ones(s.noise_block, np.float32)
        bounds, cuts = [*starts, len(q)], np.searchsorted(drawn, [*(present[:, 0] * m.width), m.classes * m.width])
        for begin, end, lo, hi in zip(bounds[:-1], bounds[1:], cuts[:-1], cuts[1:]):
            for a in range(begin, end, s.noise_block):
                b = min(a + s.noise_block, end)
                away = q[a:b] @ by[:, lo:hi]
                away += noise_bias[lo:hi]
                _sigmoid(away, weight[lo:hi])
                own[a:b] += away @ noise[lo:hi]
                grad[lo:hi] += away.T @ q[a:b]
                grad_bias[lo:hi] += ones[: b - a] @ away
        first = _runs(now)
        towards, by = _run_sums(near[:, None] * q, np.arange(len(q)), first)
        towards_bias, ids = np.add.reduceat(near, first)[by], now[first]
        found = np.minimum(np.searchsorted(ids, drawn), len(ids) - 1)
        both = ids[found] == drawn
        row = np.empty(len(by), np.int64)
        row[by] = np.arange(len(by))
        towards[row[found[both]]] += grad[both]
        towards_bias[row[found[both]]] += grad_bias[both]
        ids = np.concatenate([ids[by], drawn[~both]])
        self._up("symbol", np.concatenate([towards, grad[~both]]), ids, rate)
        self._up("bias", np.concatenate([towards_bias, grad_bias[~both]]), ids, rate)
        return own

    def changes(self, start: Trainer) -> Iterator[tuple[str, int, np.ndarray, np.ndarray]]:
        """Table, block, numbers and new rows (weights, then squares) of all that has moved since ``start``, by blocks of ``ROWS``."""
        for name in self.TABLES:
            now, before = (np.concatenate([getattr(t.m, name).reshape(len(t.squares[name]), -1), t.squares[name][:, None]], 1) for t in (self, start))
            moved = np.flatnonzero((now != before).any(1))
            rows = now[moved]
            for block in np.unique(moved // ROWS):
                lo, hi = np.searchsorted(moved, [block * ROWS, (block + 1) * ROWS])
                yield name, int(block), moved[lo:hi], rows[lo:hi]

    def put(self, name: str, ids: np.ndarray, rows: np.ndarray) -> None:
        """Set rows as ``changes`` gives them."""
        weights = getattr(self.m, name)
        weights[ids] = rows[:, :-1] if weights.ndim > 1 else rows[:, 0]
        self.squares[name][ids] = rows[:, -1]


def _falling(s: Settings, done: float) -> float:
    return s.rate * max(0.1, 1 - 0.9 * done)


def train(lex: Lexicon, pieces: Callable[[], Iterator[bytes]], total: int, s: Settings) -> LogBilinear:
    """The model of ``total`` windows at hand, packed rows of a symbol and those before it, nearest first; read anew in every pass."""
    t = Trainer(lex.law, lex.width, s)
    if not total:
        t.m.forget()
        return t.m
    rng = np.random.Generator(np.random.PCG64(s.seed + 1))
    passes, done = max(1, math.ceil(s.least_steps * s.batch / total)), 0
    long = s.context + 1
    for _ in range(passes):
        for piece in pieces():
            laid = rng.permutation(np.frombuffer(piece, np.int32).reshape(-1, long))[:, ::-1].astype(np.int64).ravel()
            asked = np.arange(len(laid)) % long == s.context
            t.learn(laid, asked, rng, s.batch * long, lambda lo: _falling(s, (done + lo / long) / (passes * total)))
            done += len(laid) // long
    return t.m


def _mean(table: pa.Table) -> pa.Table:
    """The mean of each row of one block over the tasks that changed it."""
    name, block = table["name"][0].as_py(), table["block"][0].as_py()
    total, times = None, np.zeros(ROWS, np.float32)
    for ids, rows in zip(table["ids"], table["rows"]):
        ids = np.frombuffer(ids.as_py(), np.int32) - block * ROWS
        rows = np.frombuffer(rows.as_py(), np.float32).reshape(len(ids), -1)
        total = np.zeros((ROWS, rows.shape[1]), np.float32) if total is None else total
        total[ids] += rows
        times[ids] += 1
    ids = np.flatnonzero(times)
    rows = total[ids] / times[ids, None]
    return pa.table({"name": [name], "block": pa.array([block], pa.int32()), "ids": [(ids + block * ROWS).astype(np.int32).tobytes()], "rows": [rows.tobytes()]})


def fit(training: DataFrame, lex: Lexicon, s: Settings, scratch: Scratch) -> LogBilinear:
    """The model of all places of the column ``text`` of ``training``, learned by tasks and averaged after each round."""
    t = Trainer(lex.law, lex.width, s)
    if not lex.tokens:
        t.m.forget()
        return t.m
    rounds = min(s.rounds, math.ceil(lex.tokens / (s.windows_per_root * math.sqrt(lex.tokens))))
    seen = scratch.save(symbols(training, lex, rounds, s), by="round")
    most = max(1, lex.tokens // (s.least_steps * s.batch))  # tasks that each take enough steps
    passes = max(1, math.ceil(s.least_steps * s.batch / lex.tokens))
    for k in range(rounds):
        given = seen.where(F.col("round") == k).select("w").coalesce(most)
        tasks = max(1, given.rdd.getNumPartitions())
        batch = min(max(s.batch, lex.tokens // (s.least_steps * tasks)), max(s.batch, s.most_batch))
        expected = passes * lex.tokens / (rounds * tasks)
        shared = training.sparkSession.sparkContext.broadcast(t)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, k=k, batch=batch, expected=expected) -> Iterator[pa.RecordBatch]:
            start = shared.value
            own, rng, done = copy.deepcopy(start), np.random.Generator(np.random.PCG64([s.seed, k, TaskContext.get().partitionId()])), 0
            for b in [list(batches)] * passes if passes > 1 else [batches]:
                for pieces in b:
                    laid = np.concatenate([np.frombuffer(w.as_py(), np.int32) for w in pieces.column(0)]).astype(np.int64)
                    own.learn(laid, places(laid, lex_end, s.context), rng, batch, lambda lo, done=done: _falling(s, (k + min(1.0, (done + lo) / expected)) / rounds))
                    done += len(laid)
            for name, block, ids, rows in own.changes(start):
                packed = pa.array([ids.astype(np.int32).tobytes()], pa.binary()), pa.array([rows.astype(np.float32).tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([block], pa.int32()), *packed], ["name", "block", "ids", "rows"])

        kind, lex_end = "name string, block int, ids binary, rows binary", lex.end
        learned = scratch.save(given.mapInArrow(run, kind).groupBy("name", "block").applyInArrow(_mean, kind), batch_rows=PIECES)
        for row in learned.toLocalIterator():
            ids = np.frombuffer(row["ids"], np.int32)
            t.put(row["name"], ids, np.frombuffer(row["rows"], np.float32).reshape(len(ids), -1))
        scratch.drop(learned)
        shared.destroy()
    scratch.drop(seen)
    return t.m


def score_texts(docs: DataFrame, learn: Column, s: Settings = Settings()) -> DataFrame:
    """``docs`` with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of ``text``.

    The model and all counts come from the rows where ``learn`` holds.
    """
    scratch = Scratch(docs.sparkSession)
    training = docs.where(learn).select("text")
    counts = scratch.save(word_counts(training))
    lex = lexicon(counts, training.count(), s)
    model = fit(training, lex, s, scratch)
    shared = docs.sparkSession.sparkContext.broadcast((lex, model))

    def make():
        own, model = shared.value
        scorer = Scorer(model)
        base_of = own.base_log(own.count)
        end_base = float(own.base_log(float(own.texts)))

        def work(given):
            rows = len(given["text"])
            out = {k: np.zeros(rows, np.int64) for k in ("n_tokens", "head_known")} | {k: np.zeros(rows) for k in ("head_base", "head_score")}
            rare, rare_class, rare_bounds = [], [], [np.zeros(1, np.int64)]

            def parts():
                for w in words(given["text"]):
                    at, word_cls, symbol = own.symbols_of(w)
                    now, before, bounds = sequence(w, symbol, own.end, s.context)
                    here = slice(w.first, w.first + w.rows)
                    known = at >= 0
                    base = np.where(known, base_of.take(at, mode="clip") if len(base_of) else 0.0, 0.0)

                    def per_row(x, bounds=w.bounds):
                        return np.diff(np.concatenate([[0], np.cumsum(x)])[bounds])

                    out["n_tokens"][here] = np.diff(bounds)
                    out["head_known"][here] = per_row(known.astype(np.int64)) + (own.texts > 0)
                    out["head_base"][here] = per_row(base) + end_base
                    rare.append(w.hashes[~known].view(np.int64))
                    rare_class.append(word_cls[~known].astype(np.int32))
                    rare_bounds.append(rare_bounds[-1][-1] + np.cumsum(per_row((~known).astype(np.int64))))
                    yield now.astype(np.int32), before.T.astype(np.int32), np.diff(bounds)

            out["head_score"] = text_scores(scorer, parts())
            offsets = pa.array(np.concatenate(rare_bounds).astype(np.int32))
            none = np.zeros(0, np.int64)
            out["rare"] = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([none, *rare])))
            out["rare_class"] = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([none.astype(np.int32), *rare_class])))
            return out

        return work

    new = {"n_tokens": "long", "head_known": "long", "head_base": "double", "head_score": "double", "rare": "array<long>", "rare_class": "array<int>"}
    added = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kept = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in added])
    scored = add_columns(docs.select(kept.alias("kept"), "text"), {"text": F.col("text")}, new, make).drop("text")
    scored = scratch.save(scored.withColumn("uid", F.monotonically_increasing_id()))
    return _with_rare_words(scored, counts, lex, s)


def _with_rare_words(scored: DataFrame, counts: DataFrame, lex: Lexicon, s: Settings) -> DataFrame:
    """Add what the words outside the head contribute; their counts come by a shuffled join."""
    mass = F.array(*[F.lit(float(x)) for x in lex.class_log_mass()])
    total = math.log10(lex.tokens + SMOOTHING * (lex.distinct + (lex.texts > 0) + 1))
    rare = scored.select("uid", F.explode(F.arrays_zip("rare", "rare_class")).alias("t")).select("uid", "t.rare", "t.rare_class")
    rare = rare.join(counts.select(F.col("h").alias("rare"), "n").hint("shuffle_hash"), "rare", "left")  # a word is once in counts, and rare: no key is hot
    log = F.log10(F.coalesce("n", F.lit(0)) + SMOOTHING)
    sums = rare.groupBy("uid").agg(
        F.count("n").alias("rare_known"),
        F.sum(log - total).alias("rare_base"),
        F.sum(log - F.element_at(mass, F.col("rare_class") + 1)).alias("rare_score"),
    )
    return scored.drop("rare", "rare_class").join(sums, "uid", "left").select(
        "kept.*",
        "n_tokens",
        (F.col("head_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(lex.tokens).cast("long").alias("train_tokens"),
        (F.col("head_base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        (F.col("head_score") + F.coalesce("rare_score", F.lit(0.0))).alias("score"),
    )
