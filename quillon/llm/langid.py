"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time, on a bounded
sample: ``Settings.per_language`` distinct texts of each language, of which a
window of ``Settings.window`` characters is read.  It labels every byte of a
text with a distribution over the learned languages; a document's distribution
is the mean over all its bytes.  Whole texts are read, in segments of
``Settings.segment`` bytes that are processed side by side; the states of each
run in over ``Settings.halo`` bytes of the segments before and after it.

Ties between languages go to the one that is first by code point.

Defined results: a text that is null or has no letter is ``und`` with score 0;
without any labelled row every text is ``und``; repeated rows get equal
results; other columns pass through, except ``lang_pred`` and ``score``, which
are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.llm._arrow import add_columns, sampled_texts
from quillon.llm._words import _LOWER, row_chunks, text_bytes

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    per_language: int = 512
    window: int = 1024
    hidden: int = 8
    piece: int = 64
    segment: int = 128
    halo: int = 16
    batch: int = 192
    steps: int = 220
    rate: float = 0.02
    side_by_side: int = 2048
    seed: int = 3


Weights = dict[str, np.ndarray]


def initial(languages: int, hidden: int, rng: np.random.Generator) -> Weights:
    w: Weights = {}
    for d in "fb":
        w[f"x_{d}"] = rng.normal(0, 0.3, (256, 3 * hidden))
        w[f"gates_{d}"] = rng.normal(0, 0.3, (hidden, 2 * hidden))
        w[f"new_{d}"] = rng.normal(0, 0.3, (hidden, hidden))
        w[f"out_{d}"] = rng.normal(0, 0.3, (hidden, languages))
        w[f"bias_{d}"] = np.zeros(3 * hidden)
    w["out_bias"] = np.zeros(languages)
    return {k: v.astype(np.float32) for k, v in w.items()}


def run_direction(w: Weights, d: str, steps: np.ndarray, trace: list | None = None) -> np.ndarray:
    """Hidden states, in the order of ``steps`` (time, sequence), for one direction."""
    hidden = w[f"new_{d}"].shape[0]
    # a sigmoid is a shifted tanh of half its argument: the halves go into the weights
    half_table, half_gates = 0.5 * (w[f"x_{d}"] + w[f"bias_{d}"]), 0.5 * w[f"gates_{d}"]
    gate_in, new_in = np.ascontiguousarray(half_table[:, : 2 * hidden]), np.ascontiguousarray(2 * half_table[:, 2 * hidden :])
    h = np.zeros((steps.shape[1], hidden), np.float32)
    states = np.empty((*steps.shape, hidden), np.float32)
    gates, fresh = np.empty((steps.shape[1], 2 * hidden), np.float32), np.empty_like(h)
    for t, byte in enumerate(steps.astype(np.intp)):
        if trace is not None:
            gates, fresh = np.empty_like(gates), np.empty_like(fresh)
        np.take(gate_in, byte, axis=0, out=gates, mode="clip")
        np.take(new_in, byte, axis=0, out=fresh, mode="clip")
        gates += h @ half_gates
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        update, reset = gates[:, :hidden], gates[:, hidden:]
        fresh += (reset * h) @ w[f"new_{d}"]
        np.tanh(fresh, out=fresh)
        if trace is not None:
            trace.append((byte, h, update, reset, fresh))
        h = h + update * (fresh - h)
        states[t] = h
    return states


def position_probabilities(w: Weights, steps: np.ndarray, traces: dict | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distribution over languages at every position, as (time, language, sequence), and both directions' states."""
    ahead = run_direction(w, "f", steps, None if traces is None else traces.setdefault("f", []))
    back = run_direction(w, "b", steps[::-1], None if traces is None else traces.setdefault("b", []))[::-1]
    logits = np.matmul(w["out_f"].T, ahead.transpose(0, 2, 1))
    logits += np.matmul(w["out_b"].T, back.transpose(0, 2, 1))
    logits += w["out_bias"][:, None]
    logits -= logits.max(1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(1, keepdims=True)
    return logits, ahead, back


def gradients(w: Weights, steps: np.ndarray, label: np.ndarray, real: np.ndarray) -> tuple[Weights, float]:
    """Gradient and mean of the cross-entropy over real positions, by backpropagation through time."""
    traces: dict = {}
    p, ahead, back = position_probabilities(w, steps, traces)
    n = max(1, int(real.sum()))
    p = np.ascontiguousarray(p.transpose(0, 2, 1))
    loss = float(-(np.log(np.take_along_axis(p, np.broadcast_to(label, steps.shape)[..., None], 2)[..., 0] + 1e-9) * real).sum() / n)
    d_logits = p
    d_logits[:, np.arange(len(label)), label] -= 1
    d_logits *= real[..., None] / n
    g: Weights = {"out_bias": d_logits.sum((0, 1))}
    for d, states, d_out in (("f", ahead, d_logits), ("b", back[::-1], d_logits[::-1])):
        g[f"out_{d}"] = np.tensordot(states, d_out, ((0, 1), (0, 1)))
        into = d_out @ w[f"out_{d}"].T
        hidden = states.shape[2]
        g[f"gates_{d}"], g[f"new_{d}"] = np.zeros_like(w[f"gates_{d}"]), np.zeros_like(w[f"new_{d}"])
        d_x = np.zeros((*steps.shape, 3 * hidden), np.float32)
        d_h = np.zeros_like(states[0])
        for t in range(len(steps) - 1, -1, -1):
            _, h, update, reset, fresh = traces[d][t]
            d_h = d_h + into[t]
            d_fresh = d_h * update * (1 - fresh * fresh)
            d_kept = d_fresh @ w[f"new_{d}"].T
            d_gates = np.concatenate([d_h * (fresh - h) * update * (1 - update), d_kept * h * reset * (1 - reset)], 1)
            g[f"new_{d}"] += (reset * h).T @ d_fresh
            g[f"gates_{d}"] += h.T @ d_gates
            d_x[t, :, : 2 * hidden], d_x[t, :, 2 * hidden :] = d_gates, d_fresh
            d_h = d_h * (1 - update) + d_kept * reset + d_gates @ w[f"gates_{d}"].T
        bytes_seen = np.array([x[0] for x in traces[d]]).ravel()
        flat = d_x.reshape(-1, 3 * hidden)
        g[f"bias_{d}"] = flat.sum(0)
        g[f"x_{d}"] = np.zeros_like(w[f"x_{d}"])
        np.add.at(g[f"x_{d}"], bytes_seen, flat)
    return g, loss


def train(texts: list[bytes], labels: list[int], languages: int, s: Settings) -> Weights:
    """Weights after ``s.steps`` steps of Adam over random pieces, drawn evenly by language."""
    rng = np.random.Generator(np.random.PCG64(s.seed))
    w = initial(languages, s.hidden, rng)
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    of = [np.flatnonzero(np.array(labels) == j) for j in range(languages)]
    for step in range(1, s.steps + 1):
        label = rng.integers(0, languages, s.batch)
        steps = np.zeros((s.piece, s.batch), np.uint8)
        for i, j in enumerate(label):
            text = texts[rng.choice(of[j])]
            at = int(rng.integers(0, max(1, len(text) - s.piece // 2)))
            piece = np.frombuffer(text[at : at + s.piece], np.uint8)
            steps[: len(piece), i] = _LOWER[piece]
        g, _ = gradients(w, steps, label, steps > 0)
        rate = s.rate * (1 - 0.9 * step / s.steps)
        for k in w:
            first[k] += 0.1 * (g[k] - first[k])
            second[k] += 0.01 * (g[k] * g[k] - second[k])
            w[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)
    return w


def document_probabilities(w: Weights, offsets: np.ndarray, data: np.ndarray, s: Settings) -> np.ndarray:
    """Mean distribution over the bytes of each text; zeros for an empty one."""
    rows, languages = len(offsets) - 1, len(w["out_bias"])
    total = np.zeros((rows, languages))
    data = _LOWER[data[offsets[0] : offsets[-1]]]
    offsets = offsets - offsets[0]
    length = np.diff(offsets)
    pieces = -(-length // s.segment)
    row = np.repeat(np.arange(rows), pieces)
    start = offsets[row] + (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * s.segment
    end = np.minimum(start + s.segment, offsets[row + 1])
    padded = np.concatenate([np.zeros(s.halo, np.uint8), data, np.zeros(s.segment + s.halo, np.uint8)])
    span = np.arange(-s.halo, s.segment + s.halo)[:, None]
    for lo in range(0, len(row), s.side_by_side):
        here = slice(lo, lo + s.side_by_side)
        a, b = start[here], end[here]
        longest = int((b - a).max()) + 2 * s.halo
        at = a + span[:longest]
        known = (at >= offsets[row[here]]) & (at < offsets[row[here] + 1])
        steps = np.where(known, padded[at + s.halo], np.uint8(0))
        p = position_probabilities(w, steps)[0][s.halo :]
        p *= (at[s.halo :] < b)[:, None]
        np.add.at(total, row[here], p.sum(0).T)
    return total / np.maximum(length, 1)[:, None]


def fit(docs: DataFrame, learn: Column, s: Settings = Settings()) -> tuple[list[str], Weights | None]:
    """Languages and weights learned from the rows of ``docs`` where ``learn`` holds.

    The sample is drawn by a hash of the text, for each language by itself.
    """
    labelled = docs.where(learn & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", "text")
    at = F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - s.window, F.lit(1))) + 1
    rows = sampled_texts(labelled, ["lang"], s.per_language, s.seed, F.substring("text", at.cast("int"), F.lit(s.window))).collect()
    if not rows:
        return [], None
    rows.sort(key=lambda r: (r["lang"], r["o"]))
    languages = sorted({r["lang"] for r in rows})
    return languages, train([r["value"].encode() for r in rows], [languages.index(r["lang"]) for r in rows], len(languages), s)


def identify(docs: DataFrame, learn: Column, s: Settings = Settings()) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the pooled probability of that language.

    Learns from ``text`` and ``lang`` of the rows where ``learn`` holds; a
    prediction reads the text alone.
    """
    languages, weights = fit(docs, learn, s)

    def make():
        names = np.array([*languages, UNKNOWN], dtype=object)

        def work(given):
            offsets, data = text_bytes(given["text"])
            letters = given["letters"].to_numpy(zero_copy_only=False).astype(bool)
            best, score = np.full(len(letters), len(names) - 1), np.zeros(len(letters))
            if weights is not None:
                for lo, hi in row_chunks(offsets):
                    p = document_probabilities(weights, offsets[lo : hi + 1], data, s)
                    best[lo:hi], score[lo:hi] = p.argmax(1), p.max(1)
            best[~letters], score[~letters] = len(names) - 1, 0.0
            return {"lang_pred": names[best], "score": np.clip(score, 0, 1)}

        return work

    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return add_columns(docs, {"text": F.col("text"), "letters": letters}, {"lang_pred": "string", "score": "double"}, make)
