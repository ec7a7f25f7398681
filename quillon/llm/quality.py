"""Quality classifier by positive-unlabelled learning with a non-negative risk.

Trusted positives are the rows labelled 1; unlabelled web text is any document
of the learning rows.  Rows labelled 0 are used like unlabelled ones.

The class prior is estimated from positives and unlabelled texts alone: wherever
a scorer draws a line, the unlabelled share above it is at least the prior times
the positives' share above it.  A first scorer is fitted on one half of the
sample, and the prior is the smallest ratio of the two shares on the other
half, each moved by its sampling error.

A linear scorer over text statistics then minimises the unbiased risk
``prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))``: when the part in the maximum
falls below zero, the step goes the other way on it.  Scores are calibrated by
the same quantities: prior times positives over unlabelled, in bins of the
linear score, with straight lines between the middles of the bins.

A text is described by the rates of its 256 byte values and of 1024 hashed
byte pairs, both over the whole text, by the mean length of its words and by
the share of its words that are repeats.  The fit reads at most
``Settings.sample`` distinct texts of either kind, drawn by a hash; scores read
every text whole.

Defined results: null and empty texts have all rates 0 and get the score that
the model gives to that; without positives every score is 0.5; repeated rows get
equal scores; labels of null or unknown ``doc_id`` count for nothing; columns of
the input pass through, except ``score``, which is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm._arrow import add_columns, place_of, sampled_texts, text_order
from quillon.llm._words import row_chunks, text_bytes, words

PAIRS = 1024
FEATURES = 256 + PAIRS + 2


@dataclass(frozen=True)
class Settings:
    sample: int = 6000
    batch: int = 512
    steps: int = 800
    rate: float = 0.05
    decay: float = 1e-4
    seed: int = 23


def features(column: pa.Array) -> np.ndarray:
    """One row of statistics for each text."""
    offsets, data = text_bytes(column)
    rows = len(offsets) - 1
    out = np.zeros((rows, FEATURES), np.float32)
    for lo, hi in row_chunks(offsets):
        piece = data[offsets[lo] : offsets[hi]].astype(np.int64)
        size = np.diff(offsets[lo : hi + 1])
        row = np.repeat(np.arange(hi - lo), size)
        out[lo:hi, :256] = np.bincount(row * 256 + piece, minlength=(hi - lo) * 256).reshape(-1, 256)
        if len(piece) > 1:
            same = row[1:] == row[:-1]
            pair = ((piece[:-1] * 256 + piece[1:]) * 0x9E3779B1 >> 12) % PAIRS
            out[lo:hi, 256 : 256 + PAIRS] = np.bincount((row[1:] * PAIRS + pair)[same], minlength=(hi - lo) * PAIRS).reshape(-1, PAIRS)
        out[lo:hi, :-2] /= np.maximum(size, 1)[:, None]
    np.sqrt(out, out=out)
    for w in words(column):
        count = np.diff(w.bounds)
        row = w.row_of()
        here = slice(w.first, w.first + w.rows)
        total = np.bincount(row, w.ends - w.starts, w.rows)
        out[here, -2] = np.log1p(total / np.maximum(count, 1)) / 4
        order = np.lexsort((w.hashes, row))
        repeat = (w.hashes[order][1:] == w.hashes[order][:-1]) & (row[order][1:] == row[order][:-1])
        out[here, -1] = np.bincount(row[order][1:][repeat], minlength=w.rows) / np.maximum(count, 1)
    return out


@dataclass
class Linear:
    """A linear scorer and its calibration; without edges every score is the level."""

    weights: np.ndarray
    bias: float
    edges: np.ndarray
    level: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not len(self.edges):
            return np.full(len(x), float(self.level[0]))
        linear = (x @ self.weights + self.bias).astype(np.float64)
        return np.interp(linear, self.edges, self.level)


def train(positive: np.ndarray, unlabelled: np.ndarray, s: Settings) -> Linear:
    """Estimate the prior, then minimise the non-negative positive-unlabelled risk of the logistic loss by Adam."""
    if not len(positive) or not len(unlabelled):
        return Linear(np.zeros(FEATURES, np.float32), 0.0, np.zeros(0), np.array([0.5]))
    x, y = (np.concatenate([x, np.ones((len(x), 1), np.float32)], 1) for x in (positive, unlabelled))
    prior = estimate_prior(x, y, s)
    start = float(np.log(prior / (1 - prior)))
    theta = _minimise(x, y, prior, np.append(np.zeros(FEATURES), start), s)
    edges, level = _calibrate(x @ theta, y @ theta, prior)
    return Linear(theta[:-1].astype(np.float32), float(theta[-1]), edges, level)


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, s: Settings) -> float:
    """Share of positives among the unlabelled, from the two samples alone; between 0.02 and 0.98."""
    halves = [(x[::2], x[1::2] if len(x) > 1 else x) for x in (positive, unlabelled)]
    theta = _minimise(halves[0][0], halves[1][0], 0.5, np.zeros(positive.shape[1]), s)
    p, u = (np.sort(other @ theta) for _, other in halves)
    lines = np.quantile(p, np.linspace(0, 0.9, 181))
    over_p, over_u = (1 - np.searchsorted(v, lines) / len(v) for v in (p, u))
    err_p, err_u = (np.sqrt(v * (1 - v) / len(of)) + 1 / len(of) for v, of in ((over_p, p), (over_u, u)))
    ratio = (over_u + err_u) / np.maximum(over_p - err_p, 1e-9)
    return float(np.clip(ratio[over_p > 2 * err_p].min(initial=1.0), 0.02, 0.98))


def _calibrate(positive: np.ndarray, unlabelled: np.ndarray, prior: float, bins: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Linear scores and the rising probability of a positive at each.

    In a bin of unlabelled scores the probability is ``prior`` times the
    positives' share over the unlabelled share, made monotone by pooling.
    """
    cuts = np.unique(np.quantile(unlabelled, np.linspace(0, 1, bins + 1)[1:-1]))
    counts = [np.bincount(np.searchsorted(cuts, v), minlength=len(cuts) + 1) for v in (positive, unlabelled)]
    pooled: list[list[float]] = []
    for p, u in zip(counts[0] / len(positive) * prior, counts[1] / len(unlabelled), strict=True):
        pooled.append([p, u, 1])
        while len(pooled) > 1 and pooled[-2][0] * pooled[-1][1] >= pooled[-1][0] * pooled[-2][1]:
            p1, u1, n1 = pooled.pop()
            pooled[-1] = [pooled[-1][0] + p1, pooled[-1][1] + u1, pooled[-1][2] + n1]
    level = np.concatenate([[min(1.0, p / u if u else 1.0)] * n for p, u, n in pooled])
    middle = np.concatenate([[cuts[0]], (cuts[1:] + cuts[:-1]) / 2, [cuts[-1]]]) if len(cuts) else np.zeros(1)
    return middle, level


def _minimise(positive: np.ndarray, unlabelled: np.ndarray, prior: float, theta: np.ndarray, s: Settings) -> np.ndarray:
    """Adam on the non-negative risk of the logistic loss."""
    rng = np.random.Generator(np.random.PCG64(s.seed))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, s.steps + 1):
        p, u = (x[rng.integers(0, len(x), s.batch)] for x in (positive, unlabelled))
        score_p, score_u = p @ theta, u @ theta
        as_negative = np.logaddexp(0, score_u).mean() - prior * np.logaddexp(0, score_p).mean()
        up_p, up_u = (1 / (1 + np.exp(-np.clip(z, -60, 60))) for z in (score_p, score_u))
        negative = (up_u @ u) / len(u) - prior * (up_p @ p) / len(p)
        grad = prior * ((up_p - 1) @ p) / len(p) + negative if as_negative >= 0 else -negative
        grad[:-1] += s.decay * theta[:-1]
        first += 0.1 * (grad - first)
        second += 0.01 * (grad * grad - second)
        theta = theta - s.rate * (1 - 0.9 * step / s.steps) * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return theta


def _sample(texts: DataFrame, rows: int, s: Settings) -> np.ndarray:
    """Features of at most ``rows`` distinct texts, drawn by a hash and ordered by it."""
    some = sampled_texts(texts, [], rows, s.seed, F.col("text"))

    def make():
        return lambda given: {"x": [r.tobytes() for r in features(given["text"])]}

    got = add_columns(some, {"text": F.col("value")}, {"x": "binary"}, make).select("o", "x").collect()
    return np.array([np.frombuffer(r["x"], np.float32) for r in sorted(got, key=lambda r: r["o"])], np.float32).reshape(-1, FEATURES)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, s: Settings = Settings()) -> Linear:
    """Learn from the positives of ``labels`` (``doc_id``, ``quality``) and all documents where ``learn`` holds."""
    learning = docs.where(learn).select("doc_id", "text", text_order(s.seed).alias("hash"))
    positive = labels.where("quality = 1").select("doc_id").distinct()
    hashes = learning.select("doc_id", "hash").join(positive, "doc_id", "left_semi").select("hash").distinct()
    picked = hashes.orderBy(place_of("hash"), "hash").limit(s.sample)  # the texts that the sample takes; no other text is moved
    trusted = learning.join(F.broadcast(picked), "hash", "left_semi")
    return train(_sample(trusted.select("text"), s.sample, s), _sample(learning.select("text"), s.sample, s), s)


def score_quality(docs: DataFrame, labels: DataFrame, learn: Column, s: Settings = Settings()) -> DataFrame:
    """``docs`` with ``score``, the probability that the label is 1."""
    model = fit(docs, labels, learn, s)

    def make():
        return lambda given: {"score": model.scores(features(given["text"]))}

    return add_columns(docs, {"text": F.col("text")}, {"score": "double"}, make)
