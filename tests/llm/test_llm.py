"""Operators of quillon.llm on small hand-made tables: brute force, round trips, held-out accuracy, awkward rows."""

import collections
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillon.llm import ann, decontam, langid, lm_score, mix, neardup, quality, quotes, shard, token_count
from quillon.llm._arrow import fold, sampled_texts
from quillon.llm._words import shingles, words
from quillon.llm.components import components
from quillon.scratch import Scratch

DOCS = "doc_id long, text string, lang string, source string, n_chars long, uid string, row string"
TEXTS = [None, "", "   \n", "one", "A b\tC d", "é É\x0bx", "$$$ 123", "word " * 3000, "x" * 200_000]


def table(spark, texts, source=None):
    """Documents with clashing column names; the last row is repeated."""
    rows = [(i, t, "en", (source or (lambda i: f"s{i % 3}"))(i), 1, "u", "r") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[-1:], DOCS)


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(i, t, ["en", None, "de"][i % 3], [None, "a", "b"][i % 3], None, "u", "r") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, *rows[:4], (None, "no id at all here", None, None, None, None, None)], DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def prose(rng, vocabulary, n):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def split(text):
    return (text or "").encode().lower().split()


def test_words_match_bytes_split():
    texts = [*TEXTS, "Tab\there", "ÄÖ ü"]
    got = [[bytes(w.data[s:e]) for s, e in zip(w.starts[lo:hi], w.ends[lo:hi])] for w in words(pa.array(texts)) for lo, hi in zip(w.bounds[:-1], w.bounds[1:])]
    assert got == [split(t) for t in texts]
    hashes = {}
    for w in words(pa.array(texts)):
        for s, e, h in zip(w.starts, w.ends, w.hashes):
            assert hashes.setdefault(bytes(w.data[s:e]), h) == h
    assert len(set(hashes.values())) == len(hashes)
    assert len(shingles(np.arange(9, dtype=np.uint64))) == 5 and len(shingles(np.arange(3, dtype=np.uint64))) == 1


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(20)]
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark)).collect()}
    assert got == {x: r for x, r in root.items() if x in got} and all(root[x] == x for x in root if x not in got)


# 1


def test_lm_scores_are_normalised_and_better_than_unigrams(spark):
    rng = random.Random(2)
    two = [[f"a{i}" for i in range(30)], [f"b{i}" for i in range(30)]]
    texts = [prose(rng, two[i % 2], 40) for i in range(400)] + ["never seen zz zz"]
    docs = table(spark, texts).select("doc_id", "text")
    s = lm_score.Settings(words_per_root=0.4, windows_per_root=1000, dimensions=8, batch=512)  # 52 words of 60 have a symbol
    out = {r["doc_id"]: r for r in lm_score.score_texts(docs, fold("doc_id", 10) != 0, s).collect()}
    count = collections.Counter()
    for i, t in enumerate(texts):
        if zlib.crc32(str(i).encode()) % 10:
            for _ in range(1 + (i == len(texts) - 1)):
                count.update([*split(t), None])
    n, v = sum(count.values()), len(count)
    for i, t in enumerate(texts):
        tokens = [*split(t), None]
        assert out[i]["base_score"] == pytest.approx(sum(math.log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in tokens))
        assert (out[i]["n_tokens"], out[i]["n_known"], out[i]["train_tokens"]) == (len(tokens), sum(count[x] > 0 for x in tokens), n)
    held = [r for i, r in out.items() if zlib.crc32(str(i).encode()) % 10 == 0]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) + 0.2 * sum(r["n_tokens"] for r in held)


def test_lm_learns_from_every_place(spark):
    rng = random.Random(2)
    two = [[f"a{i}" for i in range(30)], [f"b{i}" for i in range(30)]]
    texts = [prose(rng, two[i % 2], 40) for i in range(400)] + ["", None]
    docs = table(spark, texts).select("doc_id", "text").repartition(4)
    s = lm_score.Settings(words_per_root=0.4, windows_per_root=0.5, dimensions=8, batch=64, least_steps=60)  # 0.5 / root: one place in 256
    rows = lm_score.score_texts(docs, fold("doc_id", 10) != 0, s).where(fold("doc_id", 10) == 0)
    gain = rows.agg(F.sum("score") - F.sum("base_score"), F.sum("n_tokens")).first()
    assert gain[0] > 0.2 * gain[1]
    lex = lm_score.lexicon(lm_score.word_counts(docs), docs.count(), s)
    dealt = lm_score.symbols(docs, lex, 3, s).collect()
    assert {r["round"] for r in dealt} == {0, 1, 2}
    laid = [np.frombuffer(r["w"], np.int32) for r in dealt]
    got = np.concatenate([x[lm_score.places(x, lex.end, s.context)] for x in laid])
    all_of = np.concatenate([lm_score.sequence(w, lex.symbols_of(w)[2], lex.end, s.context)[0] for w in words(pa.array([*texts, texts[-1]]))])
    assert len(got) == lex.tokens and np.sort(got).tolist() == np.sort(all_of).tolist()


def test_lm_rows_are_averaged_over_the_tasks_that_changed_them():
    s = lm_score.Settings(dimensions=2)
    law = np.arange(30, 0, -1) / 465
    start, a, b = (lm_score.Trainer(law, 7, s) for _ in range(3))
    for t, by, ids in ((a, 1.0, [3, 4]), (b, 3.0, [4, 5])):
        t.m.symbol[ids] += by
        t.squares["symbol"][ids] += by
    packed = [(n, k, i.astype(np.int32).tobytes(), r.astype(np.float32).tobytes()) for t in (a, b) for n, k, i, r in t.changes(start)]
    name, _, ids, rows = (c[0].as_py() for c in lm_score._mean(pa.table([list(x) for x in zip(*packed)], ["name", "block", "ids", "rows"])).columns)
    old = start.m.symbol.copy()
    start.put(name, np.frombuffer(ids, np.int32), np.frombuffer(rows, np.float32).reshape(-1, 3))
    assert np.allclose((start.m.symbol - old)[2:7, 0], [0, 1, 2, 3, 0], atol=1e-6)
    assert np.allclose(start.squares["symbol"][2:7] - 1e-2, [0, 1, 2, 3, 0], atol=1e-6)


def test_log_bilinear_probabilities_add_up_to_one():
    s = lm_score.Settings(dimensions=4)
    law = np.arange(30, 0, -1) / 465
    m = lm_score.LogBilinear(law, 7, s)  # five classes, the last of two
    m.place[:] += 1
    before = np.array([[1, 2, 3], [29, 0, 5]])
    all_of = [m.log10(np.arange(30), np.repeat(b[None], 30, 0)) for b in before]
    assert all(10.0**x @ np.ones(30) == pytest.approx(1, abs=1e-4) for x in all_of)
    m.forget()
    assert np.allclose(10 ** m.log10(np.arange(30), np.zeros((30, 3), int)), law, atol=1e-5)


def test_context_is_of_the_same_text():
    w = next(words(pa.array(["a b", None, "c"])))
    now, before, bounds = lm_score.sequence(w, np.array([5, 6, 7]), 9, 2)
    assert now.tolist() == [5, 6, 9, 9, 7, 9] and bounds.tolist() == [0, 3, 4, 6]
    assert before.tolist() == [[9, 9], [5, 9], [6, 5], [9, 9], [9, 9], [7, 9]]


def test_words_are_found_without_a_search_for_each(monkeypatch):
    rng = np.random.default_rng(3)
    full = (1 << 64) - 1
    near = [5 << 46, (5 << 46) + 1, (5 << 46) + 2, (6 << 46) - 1, 6 << 46]  # the first four share their first bits
    hashes = np.unique(np.array([0, *near, full - 1, *rng.integers(0, full, 500, np.uint64)], np.uint64))
    asked = np.concatenate([hashes, hashes + np.uint64(1), np.array([full, 3, (5 << 46) + 9], np.uint64), rng.integers(0, full, 500, np.uint64)])
    search = np.searchsorted

    def bounded(a, v, *rest):
        assert np.size(v) != len(asked)
        return search(a, v, *rest)

    for own in (hashes, np.append(hashes, np.uint64(full)), hashes[:0]):
        where = {int(x): i for i, x in enumerate(own)}
        lex = lm_score.Lexicon(own, *[np.zeros(len(own), np.int64)] * 2, np.zeros(256, np.int64), 0, np.ones(1), 0, 0, *[np.zeros(256)] * 2, 0)
        monkeypatch.setattr(np, "searchsorted", bounded)
        got = lex.find(asked).tolist()
        monkeypatch.undo()
        assert got == [where.get(int(x), -1) for x in asked]


def test_runs_are_summed_whatever_their_length():
    rng = np.random.default_rng(4)
    long = [1, 40, 1, 12, 13, 2, 11, 300, 1]
    rows = rng.normal(0, 1, (sum(long), 5)).astype(np.float32)
    order = rng.permutation(len(rows))
    first = np.cumsum(long) - long
    got, of = lm_score._run_sums(rows, order, first)
    assert sorted(of.tolist()) == list(range(len(long)))
    for x, k in zip(got, of):
        assert np.allclose(x, rows[order[first[k] : first[k] + long[k]]].astype(float).sum(0), atol=1e-4)


def test_texts_are_scored_together_with_tables_made_once(monkeypatch):
    rng = np.random.default_rng(5)
    law = np.arange(30, 0, -1) / 465
    m = lm_score.LogBilinear(law, 7, lm_score.Settings(dimensions=4))
    parts = [(rng.integers(0, 30, n), rng.integers(0, 30, (n, 3)), np.array([1, n - 1])) for n in (9, 40, 17, 2, 300)]
    want = [x for now, before, long in parts for x in np.add.reduceat(m.log10(now, before), [0, 1])]
    parts = [(now, before.T, long) for now, before, long in parts]
    made, tables = [], lm_score._Scores
    monkeypatch.setattr(lm_score, "_Scores", lambda *a: made.append(1) or tables(*a))
    scorer = lm_score.Scorer(m)
    for at_once in (1, 45, 10_000):
        assert np.allclose(lm_score.text_scores(scorer, iter(parts), at_once), want, atol=1e-5)
    assert len(made) == 1 + m.classes
    assert len(lm_score.text_scores(scorer, iter([]))) == 0


def test_a_step_goes_up_the_plain_gradient():
    s = lm_score.Settings(dimensions=4, noise=3, noise_draws=18, noise_words=2, word_draws=4, noise_block=8)
    law = np.arange(30, 0, -1) / 465
    t = lm_score.Trainer(law, 7, s)
    old, seen = {n: getattr(t.m, n).astype(float) for n in t.TABLES}, {n: x.astype(float) for n, x in t.squares.items()}
    rng = np.random.default_rng(6)
    laid = np.concatenate([[9, 9, 9], rng.integers(0, 30, 20), [9]])
    asked = np.arange(len(laid)) >= 3
    t._step(laid, asked, np.random.default_rng(7), 0.5)
    draw, grad = np.random.default_rng(7), {n: np.zeros_like(x) for n, x in old.items()}
    at = sorted(np.flatnonzero(asked), key=lambda i: (laid[i], i))
    drawn = np.searchsorted(t.upto_class, draw.random((3, 6)), "right").clip(max=t.m.classes - 1)  # 21 places are 3 blocks
    present = sorted({int(laid[i]) // 7 for i in at})
    words_of = {g: np.searchsorted(t.upto, g + x, "right").clip(max=g * 7 + 6) for g, x in zip(present, draw.random((len(present), 4)))}
    pull = {}
    for k, i in enumerate(at):
        g = int(laid[i]) // 7
        q = sum(old["context"][laid[i - 1 - j]] * old["place"][j] for j in range(3))
        pull[i] = np.zeros(4)
        levels = [("of_class", "class_bias", t.log_class, g, drawn[k // 8], 3 / 6), ("symbol", "bias", t.log_within, int(laid[i]), words_of[g], 2 / 4)]
        for vectors, biases, known, own, noise, weight in levels:
            for x, share in [(own, None), *[(int(x), weight) for x in noise]]:
                p = 1 / (1 + math.exp(-(q @ old[vectors][x] + old[biases][x] - known[x])))
                by = 1 - p if share is None else -share * p
                pull[i] += by * old[vectors][x]
                grad[vectors][x] += by * q
                grad[biases][x] += by
    for i in at:
        for j in range(3):
            grad["context"][laid[i - 1 - j]] += pull[i] * old["place"][j]
            grad["place"][j] += pull[i] * old["context"][laid[i - 1 - j]] / math.sqrt(len(at))
    for n in old:
        width = grad[n].reshape(len(grad[n]), -1)
        squares = seen[n] + (width**2).sum(1) / width.shape[1]
        want = old[n].reshape(width.shape) + width * 0.5 / np.sqrt(squares)[:, None]
        assert np.allclose(getattr(t.m, n).reshape(width.shape)[: len(law)], want[: len(law)], rtol=1e-3, atol=1e-4), n


def test_second_word_back_is_used():
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(4000):
        far, near = rng.integers(0, 2), rng.integers(2, 4)
        rows.append((far + 4, near, far, 6))  # what follows depends on the word before the last
    data = np.array(rows, np.int32)
    law = np.bincount(data[:, 0], minlength=8) + 0.5
    lex = lm_score.Lexicon(*[np.zeros(0, np.int64)] * 4, 7, law / law.sum(), 0, 0, *[np.zeros(0)] * 2, 0)
    m = lm_score.train(lex, lambda: iter([data.tobytes()]), len(data), lm_score.Settings(dimensions=8, batch=256))
    assert (10 ** m.log10(data[:, 0].astype(int), data[:, 1:].astype(int))).mean() > 0.9


# 2


def test_quality_finds_held_out_junk_without_negatives(spark):
    rng = random.Random(3)
    vocabulary = [f"w{chr(97 + i % 26)}{i}" for i in range(200)]
    texts = [prose(rng, vocabulary, 60) if i % 5 else " ".join(w + "$$%" for w in prose(rng, vocabulary, 60).split()) for i in range(600)]
    docs = table(spark, texts).select("doc_id", "text")
    labels = spark.createDataFrame([(i, int(i % 5 > 0), 0) for i in range(0, 600, 2)], "doc_id long, quality int, toxic int")
    out = quality.score_quality(docs, labels, fold("doc_id", 5) != 0, quality.Settings(steps=300)).collect()
    held = [r for r in out if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert np.mean([(r["score"] >= 0.3) == (r["doc_id"] % 5 > 0) for r in held]) > 0.95


def test_prior_comes_from_positives_and_unlabelled_alone():
    rng = np.random.default_rng(4)
    for share in (0.3, 0.8):
        positive = rng.normal(2, 1, (3000, 3))
        mixed = np.where(rng.random((6000, 1)) < share, rng.normal(2, 1, (6000, 3)), rng.normal(-2, 1, (6000, 3)))
        got = quality.estimate_prior(*(np.concatenate([x, np.ones((len(x), 1))], 1) for x in (positive, mixed)), quality.Settings(steps=200))
        assert got == pytest.approx(share, abs=0.05)


def test_samples_take_copies_once_and_every_group(spark):
    rows = [("en", "hot text")] * 3000 + [("de", f"text {i}") for i in range(40)] + [("fr", "x"), ("fr", None)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = collections.Counter(r["lang"] for r in sampled_texts(docs, ["lang"], 10, 1, F.col("text")).collect())
    assert got == {"en": 1, "de": 10, "fr": 2}
    assert sampled_texts(docs, [], 10, 1, F.col("text")).count() == 10


# 3


def brute_components(texts):
    sets = [frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if (w := split(t)) else frozenset() for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(texts)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= 75 * len(a | b):
            x, y = sorted((find(i), find(j)))
            root[y] = x
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


@pytest.mark.parametrize("limits", [{}, {"small_bucket": 2, "block": 8}, {"small_bucket": 2, "block_shingles": 500}])
def test_near_duplicates_match_brute_force(spark, limits):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(500)]
    passage = prose(rng, vocabulary, 60).split()
    texts = []
    for base in range(6):
        own = passage + prose(rng, vocabulary, 30 + 8 * base).split()
        for copy in range(12):
            changed = list(own)
            for _ in range(copy // 2):
                changed[rng.randrange(len(changed))] = rng.choice(vocabulary)
            texts.append(" ".join(changed))
    texts += ["a b", "A  b", "", None, "a b c"]
    roots, sizes = brute_components(texts)
    out = neardup.near_duplicates(table(spark, texts), ["doc_id", "uid", "row"], neardup.Settings(**limits)).select("doc_id", "dup.*").collect()
    got = {r["doc_id"]: r for r in out}
    assert len(out) == len(texts) + 1
    assert [got[i]["component_id"] for i in range(len(texts))] == roots
    assert [got[i]["n_shingles"] for i in range(len(texts))] == sizes
    assert all(got[i]["kept"] == (roots[i] == i) for i in got)


def test_large_buckets_link_pairs_of_one_shared_band(spark):
    rng = random.Random(14)
    vocabulary = [f"w{i}" for i in range(5000)]
    texts = [prose(rng, vocabulary, 100) for _ in range(30)]
    sets = {neardup.set_name(own): (text, own) for text, own in zip(texts, neardup.document_sets(pa.array(texts)))}
    first, *_, last = sorted(sets)  # by name, the bucket's lowest and its hub: the first ones tried
    for close in (f"{t} {prose(rng, vocabulary, 8)}" for t, _ in [sets[h] for h in sorted(sets)[10:20]]):
        own = next(neardup.document_sets(pa.array([close])))
        if first < neardup.set_name(own) < last:
            break
    one = next(h for h, (t, _) in sets.items() if close.startswith(t))
    sets[neardup.set_name(own)] = (close, own)
    rows = []
    for i, (h, (_, own)) in enumerate(sets.items()):
        bands = [77, *(1000 * (i + 1) + b for b in range(1, neardup.BANDS))]
        rows.append((h, i, len(own), bytearray(neardup.signature(own).astype(np.uint8).tobytes()), bands))
    classes = spark.createDataFrame(rows, "h long, doc long, n long, sig binary, bands array<long>")
    members = spark.createDataFrame([(h, 77, first) for h in sets], "h long, key long, low long")
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(sets.values())], "doc_id long, text string")
    for limits in ({"block": 16}, {"block": 4}, {"block_shingles": 300}, {}):
        links = neardup._links(members, classes, docs, neardup.Settings(**limits), Scratch(spark))
        found = {(r["a"], r["b"]) for r in links.collect()} if links is not None else set()
        assert found == {tuple(sorted((one, neardup.set_name(own))))}


def test_posterior_bound_keeps_similar_pairs():
    needed = neardup.fewest_matches(neardup.Settings(miss=1e-3))
    assert list(needed) == list(range(16, 257, 16)) and all(m < 0.76 * n for n, m in needed.items()) and needed[256] > 150


# 4


def test_decontamination(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [prose(rng, vocabulary, n) + ". " + prose(rng, vocabulary, 12) + "." for n in (10, 30, 90, 200, 25)] + ["", "two words"]
    texts, truth = [], set()
    for i in range(60):
        body = [prose(rng, vocabulary, 150)]
        if i % 4 == 0:
            k = (i // 4) % 5
            body.insert(rng.randrange(2), items[k].upper() if i % 8 else items[k])
            truth.add((i, k))
        texts.append("\n".join(body))
    texts += [None, "", " ".join("changed" if i == 9 else w for i, w in enumerate(items[2].split()))]
    truth.add((62, 2))
    docs = table(spark, texts)
    bench = spark.createDataFrame([*enumerate(items), (9, None)], "item_id long, text string")
    s = decontam.Settings(pass_words=250)
    assert {(r["doc_id"], r["item_id"]) for r in decontam.find_leaks(docs, bench, s).collect()} == truth
    marked = {r["doc_id"] for r in decontam.mark_leaks(docs, bench, s).where("leaked").collect()}
    assert marked == {i for i, _ in truth}
    assert decontam.find_leaks(docs, bench.limit(0)).count() == 0


def overlap_rule(text, item):
    """Whether a text leaks an item, on sets of words themselves."""

    def grams(x):
        x = split(x)
        return {tuple(x[i : i + 5]) for i in range(max(1, len(x) - 4))} if x else set()

    found, sides = grams(text), [grams(x) for x in decontam.split_item(item)]
    share = [len(x & found) / len(x) if x else 1.0 for x in sides]
    total = sum(map(len, sides))
    return total > 0 and (min(share) >= 0.5 or sum(len(x & found) for x in sides) / total >= 0.75)


def leading(text, part):
    """The words of the first ``part`` of the shingles."""
    own = text.split()
    return " ".join(own[: math.ceil(part * (len(own) - 4)) + 4])


def test_partial_copies_match_a_scan_of_the_rule(spark):
    rng = random.Random(15)
    vocabulary = [f"w{int(rng.paretovariate(0.6))}" for _ in range(3000)]
    items = [prose(rng, vocabulary, rng.randrange(8, 60)) + ". " + prose(rng, vocabulary, rng.randrange(6, 30)) + "." for _ in range(40)]
    texts = []
    for item in items:
        q, a = decontam.split_item(item)
        for part in (0.3, 0.5, 0.7):
            texts.append(" ".join([leading(q, part), leading(a, part), prose(rng, vocabulary, 20)]))
    truth = {(i, k) for i, t in enumerate(texts) for k, item in enumerate(items) if overlap_rule(t, item)}
    assert {(i, i // 3) for i in range(len(texts)) if i % 3} <= truth
    bench = spark.createDataFrame([*enumerate(items)], "item_id long, text string")
    for s in (decontam.Settings(), decontam.Settings(pass_words=500)):
        found = decontam.find_leaks(table(spark, texts), bench, s).collect()
        assert {(r["doc_id"], r["item_id"]) for r in found} == truth


def test_leaks_are_those_of_whole_documents(spark):
    rng = random.Random(17)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [prose(rng, vocabulary, 30) + ". " + prose(rng, vocabulary, 25) + "." for _ in range(10)]
    texts = []
    for item in items:
        q, a = decontam.split_item(item)
        halves = [q.split()[:17], a.split()[:16], q.split()[17:], a.split()[16:]]
        texts.append(" ".join([q, prose(rng, vocabulary, 200), a]))
        texts.append(" ".join([a, prose(rng, vocabulary, 3000), q]))
        texts.append(" ".join(" ".join(x) + " " + prose(rng, vocabulary, 150) for x in halves))
        texts.append(q + " " + prose(rng, vocabulary, 200))
    truth = {(i, k) for i, t in enumerate(texts) for k, item in enumerate(items) if overlap_rule(t, item)}
    assert {(i, i // 4) for i in range(len(texts)) if i % 4 < 3} == truth
    bench = spark.createDataFrame([*enumerate(items)], "item_id long, text string")
    found = decontam.find_leaks(table(spark, texts), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == truth
    marked = decontam.mark_leaks(table(spark, texts), bench).where("leaked").collect()
    assert {r["doc_id"] for r in marked} == {i for i, _ in truth}


def test_thresholds_use_the_whole_test_set(spark):
    rng = random.Random(16)
    items = [prose(rng, [f"w{i}" for i in range(60)], 20) for _ in range(24)]
    bench = spark.createDataFrame([*enumerate(items)], "item_id long, text string")
    sliced, whole = (list(decontam.build_passes(bench, decontam.Settings(pass_words=n))) for n in (160, 480))
    least = {i: x for index in whole for i, x in zip(index.ids, index.least)}
    assert len(sliced) == 3 and len(whole) == 1 and all(x == pytest.approx(least[i]) for index in sliced for i, x in zip(index.ids, index.least))


def test_retrieval_equals_plain_bm25(spark):
    rng = random.Random(6)
    vocabulary = [f"w{int(rng.paretovariate(0.7))}" for _ in range(400)]
    items = [prose(rng, vocabulary, rng.randrange(8, 60)) + ". " + prose(rng, vocabulary, 9) for _ in range(50)] + [prose(rng, vocabulary, 4000)]
    bench = spark.createDataFrame([*enumerate(items)], "item_id long, text string")
    s = decontam.Settings()
    (index,) = decontam.build_passes(bench, s)
    bags = [collections.Counter(split(x)) for x in items]
    df, mean = collections.Counter(x for b in bags for x in b), sum(sum(b.values()) for b in bags) / len(bags)

    def score(text, b):
        idf = lambda x: math.log(1 + (len(bags) - df[x] + 0.5) / (df[x] + 0.5))
        return sum(idf(x) * b[x] * 2.2 / (b[x] + 1.2 * (0.25 + 0.75 * sum(b.values()) / mean)) for x in set(split(text)) if x in b)

    texts = [prose(rng, vocabulary, 100) + " " + leading(items[i], rng.random()) for i in range(50)] + ["", items[50]]
    place = {i: p for p, i in enumerate(index.ids)}
    want = {}
    for r, text in enumerate(texts):
        for i, b in enumerate(bags):
            least = index.least[place[i]] * score(items[i], b)
            if (got := score(text, b)) >= decontam.REACHED * least:
                want[r, place[i]] = got / least
    found = {(r, i): x for r, i, x, _ in decontam.retrieve(pa.array(texts), index)}
    close = {k for k in set(want) ^ set(found) if abs(want.get(k, found.get(k)) - decontam.REACHED) < 1e-5}
    assert set(want) ^ set(found) <= close and len(found) > 40
    assert all(found[k] == pytest.approx(want[k], rel=1e-4) for k in found if k in want)


def test_items_of_any_id_and_no_items(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, None)], "doc_id long, text string")
    bench = spark.createDataFrame([("x-1", "a b c d e f g"), (None, "zz"), ("y", None), ("z", " ")], "item_id string, text string")
    assert [tuple(r)[:2] for r in decontam.find_leaks(docs, bench).collect()] == [(1, "x-1")]


# 5


def test_quotes(spark):
    rows = [
        (1, 0, "user", "Hello there.\n\nHow do I sort a list?"),
        (1, 1, "assistant", "> how do I  sort a list?\n\nUse sorted."),
        (1, 2, "user", ">> How do I sort a list?\n> Use sorted.\nThanks!"),
        (1, 3, "user", "> nobody said this\nWhat?"),
        (1, 4, "assistant", "> Hello there.\nHi."),
        (2, 0, "user", "Use sorted."),
        (2, 1, "user", None),
        (2, None, "user", "> Use sorted."),
        (None, 0, None, ""),
        (2, 1, "user", None),
    ]
    out = quotes.reply_ordered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    got = {(r["conv_id"], r["turn"]): r for r in out if r["conv_id"] == 1}
    assert [(got[1, t]["parent_turn"], got[1, t]["root_turn"]) for t in range(5)] == [(None, 0), (0, 0), (1, 0), (None, 3), (0, 0)]
    assert [got[1, t]["body"] for t in (1, 2, 3)] == ["Use sorted.", "Thanks!", "What?"]
    assert [(got[1, t]["n_quoted"], got[1, t]["n_linked"], got[1, t]["quote_levels"]) for t in range(4)] == [(0, 0, 0), (1, 1, 1), (2, 2, 2), (1, 0, 1)]
    assert [got[1, t]["position"] for t in range(5)] == [0, 1, 2, 4, 3]
    assert sorted(r["position"] for r in out if r["conv_id"] == 2) == [0, 1, 2, 3]
    assert got[1, 1]["chat"] == "<|assistant|>\nUse sorted.\n<|end|>"
    assert len(out) == len(rows)


def brute_quotes(messages):
    """(parent's number, root's number) of each message: earlier messages are tried one by one."""

    def normal(x):
        return " ".join(x.lower().split())

    parent = {}
    for i, (conv, turn, _, text) in enumerate(messages):
        passages, last = [], 0
        for line in (text or "").split("\n"):
            marks = re.match(r"((?:[ \t]*>)*)", line).group(1)
            level = marks.count(">")
            if level and level != last:
                passages.append((level, []))
            if level:
                passages[-1][1].append(line[len(marks) :])
            last = level
        best = []
        for level, lines in passages:
            for keys in ([normal("\n".join(lines))], [normal(x) for x in lines]):
                hits = []
                for j, (c, t, _, other) in enumerate(messages):
                    own = "\n".join(x for x in (other or "").split("\n") if not re.match(r"[ \t]*>", x)).strip()
                    offers = {normal(x) for x in [own, *re.split(r"\n[ \t]*\n", own), *own.split("\n")]}
                    if c == conv and t < turn and any(k and k in offers for k in keys):
                        hits.append((t, -j))
                if hits:
                    if level == 1:
                        best.append(max(hits))
                    break
        if best:
            parent[i] = -max(best)[1]
    root = {}
    for i in range(len(messages)):
        at = i
        while at in parent:
            at = parent[at]
        root[i] = at
    return parent, root


def test_quotes_match_brute_force(spark):
    rng = random.Random(21)
    said = [f"Sentence {i}." for i in range(12)]
    messages = []
    for conv in range(6):
        for k in range(25):
            own = [rng.choice(said) for _ in range(rng.randrange(1, 3))]
            quoted = ["> " * rng.randrange(1, 3) + rng.choice(said) for _ in range(rng.randrange(3))]
            messages.append((conv, k // 2, "user", "\n".join(quoted + own)))  # two at each turn
    parent, root = brute_quotes(messages)
    table = spark.createDataFrame([(*m[:2], str(i), m[3]) for i, m in enumerate(messages)], "conv_id long, turn long, role string, text string").coalesce(1)
    got = {int(r["role"]): r for r in quotes.reply_ordered(table).collect()}
    assert len(got) == len(messages) and len(parent) > 30
    for i, (_, turn, _, _) in enumerate(messages):
        assert got[i]["parent_turn"] == (messages[parent[i]][1] if i in parent else None)
        assert got[i]["root_turn"] == messages[root[i]][1]
    for conv in range(6):
        order = sorted((i for i, m in enumerate(messages) if m[0] == conv), key=lambda i: got[i]["position"])
        assert order == sorted(order, key=lambda i: (messages[root[i]][1], root[i], messages[i][1], i))


def test_two_messages_at_one_turn_stay_in_their_threads(spark):
    rows = [(1, 0, "a", "First."), (1, 1, "b", "Second."), (1, 2, "c", "> First."), (1, 2, "d", "> Second.")]
    got = {r["role"]: r for r in quotes.reply_ordered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert [(got[x]["parent_turn"], got[x]["root_turn"]) for x in "abcd"] == [(None, 0), (None, 1), (0, 0), (1, 1)]


# 6


def test_language_id(spark):
    rng = random.Random(7)
    langs = {"en": ["the", "and", "thing", "with", "other"], "de": ["und", "nicht", "über", "schön", "auch"]}
    names = ["en", "de"]
    rows = [(i, prose(rng, langs[names[i % 2]], 30), names[i % 2]) for i in range(300)] + [(300, "123 !!", "en"), (301, None, "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {r["doc_id"]: r for r in langid.identify(docs, fold("doc_id", 4) != 2, langid.Settings(steps=60, per_language=60)).collect()}
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([out[i]["lang_pred"] == names[i % 2] for i in held]) > 0.97
    assert (out[300]["lang_pred"], out[301]["lang_pred"], out[301]["score"]) == ("und", "und", 0.0)


def test_language_stage_without_labels_rejects_by_letters_alone(spark):
    import corpus_pipeline

    texts = ["plain words", "123 !!", None, "", "é", "ни слова"]
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    assert {r["doc_id"] for r in corpus_pipeline.language_id(spark, docs, "").collect()} == {0, 4, 5}


def test_segments_run_in_over_their_neighbours():
    rng = np.random.default_rng(12)
    w = langid.initial(3, 4, rng)
    texts = [b"", bytes(rng.integers(97, 120, 333, dtype=np.uint8)), b"abc"]
    offsets, data = np.cumsum([0, *map(len, texts)]), np.frombuffer(b"".join(texts), np.uint8)
    whole = langid.document_probabilities(w, offsets, data, langid.Settings(segment=512, halo=24))
    cut = langid.document_probabilities(w, offsets, data, langid.Settings(segment=32, halo=24, side_by_side=3))
    assert np.allclose(whole, cut, atol=2e-3) and not whole[0].any() and whole[1].sum() == pytest.approx(1, abs=1e-4)


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(8)
    w = {k: v.astype(np.float64) for k, v in langid.initial(3, 4, rng).items()}
    steps = rng.integers(1, 256, (6, 5)).astype(np.uint8)
    steps[4:, 0] = 0
    label = rng.integers(0, 3, 5)
    g, _ = langid.gradients({k: v.astype(np.float32) for k, v in w.items()}, steps, label, steps > 0)
    for k in ("gates_f", "new_b", "out_f", "bias_b", "out_bias"):
        at = tuple(int(rng.integers(0, n)) for n in w[k].shape)
        losses = []
        for d in (1e-2, -1e-2):
            moved = {n: v.astype(np.float32).copy() for n, v in w.items()}
            moved[k][at] += d
            losses.append(langid.gradients(moved, steps, label, steps > 0)[1])
        assert g[k][at] == pytest.approx((losses[0] - losses[1]) / 2e-2, abs=3e-3)


# 7


def test_nearest(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(600, 8)).astype(np.float32)
    x[50:60] = x[50]
    rows = [(i, [float(v) for v in x[i]]) for i in range(600)] + [(700, None), (800, [0.0] * 8), (900, [float("nan")] * 8), (1000, [1.0, None] + [0.0] * 6), (1100, [1.0])]
    out = ann.nearest(spark.createDataFrame([*rows, rows[0]], "vec_id long, embedding array<float>"), F.col("vec_id") % 100 == 0, ann.Settings(block=64)).collect()
    got = collections.defaultdict(list)
    for r in sorted(out, key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert sorted(got) == list(range(0, 600, 100))
    hits = 0
    for q, found in got.items():
        d = np.sqrt(((x.astype(np.float64) - x[q]) ** 2).sum(1))
        true = sorted((d[i], i) for i in range(600) if i != q)[:10]
        hits += len({i for _, i in true} & {i for i, _ in found})
        assert len(found) == 10 and all(s == d[i] for i, s in found)
    assert hits >= 54
    few = ann.nearest(spark.createDataFrame(rows[50:54] + [(0, rows[0][1])], "vec_id long, embedding array<double>"), F.col("vec_id") == 0).collect()
    assert [(r["rank"], r["vec_id"]) for r in sorted(few, key=lambda r: r["rank"])] == [(1, 50), (2, 51), (3, 52), (4, 53)]


def test_files_are_added_until_probes_are_found(spark):
    rng = np.random.default_rng(19)
    x = rng.normal(size=(900, 12)).astype(np.float32)
    vectors = spark.createDataFrame([(i, [float(v) for v in x[i]], "e") for i in range(900)], "vec_id long, embedding array<float>, query_id string")
    out = ann.nearest(vectors, F.col("vec_id") % 30 == 0, ann.Settings(visited=1, posted=1, block=256))
    got = collections.defaultdict(set)
    for r in out.collect():
        got[r["query_id"]].add(r["vec_id"])
    hits = 0
    for q, found in got.items():
        d = ((x.astype(np.float64) - x[q]) ** 2).sum(1)
        d[q] = np.inf
        hits += len(found & set(np.argsort(d)[:10].tolist()))
    assert len(got) == 30 and hits >= 270 and out.columns[:4] == ["query_id", "rank", "vec_id", "score"]


def test_the_commonest_length_takes_part(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(5)]) for i in range(60)] + [(100 + i, [rng.gauss(0, 1) for _ in range(9)]) for i in range(40)] + [(200, None), (201, [])]
    out = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 10 == 0).collect()
    assert {r["query_id"] for r in out} == set(range(0, 60, 10)) and all(r["vec_id"] < 60 and 0 < r["visited"] <= r["files"] for r in out)
    for q in range(0, 60, 10):
        near = sorted((math.dist(rows[q][1], v), i) for i, v in rows[:60] if i != q)[:10]
        assert [r["vec_id"] for r in sorted(out, key=lambda r: r["rank"]) if r["query_id"] == q] == [i for _, i in near]


def test_footrule():
    assert ann.footrule(np.array([0, 1, 2]), np.array([[0, 1, 2], [2, 1, 0], [3, 4, 5]]), 6).tolist() == [0, 4, 12]


# 8


def test_sharding(spark, awkward, none):
    out = shard.shuffle_into_shards(awkward, 3)
    rows = out.collect()
    assert out.columns == [*awkward.columns, "shard", "slot"] and len(rows) == awkward.count()
    sizes = collections.Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for j in sizes:
        assert sorted(r["slot"] for r in rows if r["shard"] == j) == list(range(sizes[j]))
    assert shard.shuffle_into_shards(none, 3).count() == 0


def test_communication_matrix():
    drawn = [shard.communication_matrix([5, 1, 8], 3, seed) for seed in range(2000)]
    for m in drawn[:50]:
        assert [sum(r) for r in m] == [5, 1, 8] and sorted(map(sum, zip(*m))) == [4, 5, 5]
    assert np.mean([m[0][0] for m in drawn]) == pytest.approx(5 * 5 / 14, abs=0.08)


def test_inversion_follows_the_hypergeometric_law():
    rng = np.random.Generator(np.random.PCG64(1))
    good, bad, draws = 7, 11, 9
    law = [math.comb(good, k) * math.comb(bad, draws - k) / math.comb(good + bad, draws) for k in range(8)]
    got = np.bincount([shard._by_inversion(rng, good, bad, draws) for _ in range(20000)], minlength=8) / 20000
    assert np.allclose(got, law, atol=0.012)
    assert {shard._by_inversion(rng, 3, 2, 5), shard._by_inversion(rng, 5, 0, 2) + 1, shard._by_inversion(rng, 9, 9, 0) + 3} == {3}
    big = [shard._hypergeometric(rng, 3 * 10**12, 9 * 10**12, 65536) for _ in range(3000)]
    assert np.mean(big) == pytest.approx(16384, abs=8) and np.var(big) == pytest.approx(65536 * 3 / 16, rel=0.1)


# 9


def best_count(scores, word):
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        wide = len(word[end - 1].encode())
        options = [(best[end - 1][0] - token_count.BYTE_PENALTY * wide, best[end - 1][1] - wide)]
        options += [(best[at][0] + scores[word[at:end]], best[at][1] - 1) for at in range(end) if word[at:end] in scores]
        best.append(max(options))
    return -best[-1][1]


def test_token_counts(spark, awkward, none):
    rng = random.Random(10)
    letters = "ab▁é"
    scores = {"".join(rng.choice(letters) for _ in range(rng.randrange(1, 4))): -float(rng.randrange(1, 9)) for _ in range(30)}
    pretokens = sorted({"".join(rng.choice("abécz") for _ in range(rng.randrange(1, 9))) for _ in range(300)})
    pretokens = sorted(token_count.MARK + p for p in pretokens)
    assert token_count.SuffixTrie(scores).counts(pretokens) == {p: best_count(scores, p) for p in pretokens}
    out = token_count.count_tokens(awkward, scores).collect()
    for r in out:
        # the same words as the other operators, but with case kept
        own = (r["text"] or "").encode().split()
        assert r["n_pretokens"] == len(own)
        assert r["n_tokens"] == sum(n * best_count(scores, token_count.MARK + w.decode()) for w, n in collections.Counter(own).items() if len(w) < 1000) or max(map(len, own)) >= 1000
    assert token_count.count_tokens(none, scores).count() == 0


# 10


def test_mixing(spark, none):
    rng = random.Random(11)
    texts = [prose(rng, ["a", "b"], rng.randrange(0, 60)) for _ in range(900)]
    docs = table(spark, texts, lambda i: [None, "a", "b", "c", "d"][min(4, i % 23)])
    rows = mix.pareto_mix(docs, ["doc_id", "source", "uid"]).select("doc_id", "source", "mix.*").collect()
    again = mix.pareto_mix(docs, ["doc_id", "source", "uid"]).select("doc_id", "source", "mix.*").collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    size, taken, target = collections.Counter(), collections.Counter(), {}
    for r in rows:
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["copies"] * r["size"]
        target[r["source"]] = r["target"]
        assert 0 <= r["copies"] <= 2
    weights = dict(zip(["a", "b", "c", "d", None], [3, 1, 2, 3, 1]))
    left, want, free = 1.5 * sum(size.values()), {}, set(size)
    while free:
        level = left / sum(weights[s] for s in free)
        full = {s for s in free if level * weights[s] > 2 * size[s]}
        for s in full or free:
            want[s] = 2 * size[s] if full else level * weights[s]
        left -= sum(want[s] for s in full)
        free -= full or free
    for s in size:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= 60
    assert mix.pareto_mix(none, ["doc_id"]).count() == 0


def test_no_source_meets_in_one_window(spark):
    """Sources at their cap order nothing; of the others one narrow range is ordered."""
    rows = [(i, "w x", "b", "a capped") for i in range(100_000)] + [(200_000 + i, "y " * (1 + i % 40), "b", "big") for i in range(30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    placed = mix.ranked(docs, ["doc_id", "source"], 5, 1.5)
    groups = placed.where("range = cut").groupBy("of").count().collect()
    assert {r["of"] for r in groups} == {"big"} and max(r["count"] for r in groups) <= 100
    copies = mix.pareto_mix(docs, ["source"]).groupBy("source", "mix.copies").count().collect()
    assert [(r["copies"], r["count"]) for r in copies if r["source"] == "a capped"] == [(2, 100_000)]


def test_mix_is_the_pareto_sample(spark):
    rng = random.Random(13)
    texts = [prose(rng, ["a", "b"], int(20 * rng.paretovariate(1.2))) for _ in range(700)]
    docs = table(spark, texts, lambda i: "abc"[min(2, i % 5)])
    rows = mix.pareto_mix(docs, ["doc_id", "source"]).select("doc_id", "source", "mix.*").collect()
    u = {r["doc_id"]: r["u"] for r in docs.select("doc_id", ((F.shiftrightunsigned(F.xxhash64(F.lit(5), "doc_id", "source", "text"), 11).cast("double") + 0.5) * F.lit(2.0**-53)).alias("u")).collect()}
    odds = set()
    for source in "abc":
        own = [r for r in rows if r["source"] == source]
        ratio = own[0]["target"] / own[0]["source_size"]
        rest = (ratio - math.floor(ratio)) * own[0]["source_size"]
        weight = [2 ** (-(math.floor(2 * math.log2(r["size"])) if r["size"] else -1) / 4) for r in own]
        lo, hi = 0.0, 1e9
        for _ in range(200):
            c = (lo + hi) / 2
            lo, hi = (c, hi) if sum(min(1, c * w) * r["size"] for w, r in zip(weight, own)) < rest else (lo, c)
        part = [min(1, lo * w) for w in weight]
        assert sum(p * r["size"] for p, r in zip(part, own)) == pytest.approx(rest, abs=1e-3)
        odds |= {round(p, 6) for p in part}
        rank = {id(r): (1 - p) / p * u[r["doc_id"]] / (1 - u[r["doc_id"]]) for p, r in zip(part, own)} if rest > 1e-6 else {}
        taken, want = 0, set()
        for r in sorted(own, key=lambda r: (rank.get(id(r), 0), r["doc_id"])) if rank else []:
            if taken + r["size"] / 2 <= rest + 1e-6:
                want.add(id(r))
            taken += r["size"]
        off = [r for r in own if (r["copies"] - math.floor(ratio + 1e-12) > 0) != (id(r) in want) and r["size"]]
        assert len(off) <= 1  # the repeated row ties
    assert len(odds) > 4


# awkward rows


def test_awkward_rows_pass_through(spark, awkward, none):
    n = awkward.count()
    labels = spark.createDataFrame([(3, 1, 0), (7, 0, 0), (None, 1, None), (4, None, 1)], "doc_id long, quality int, toxic int")
    learn = fold("doc_id", 5) != 0
    small = lm_score.Settings(words_per_root=0.5, least_steps=2, batch=64)
    assert lm_score.score_texts(awkward, learn, small).where("score is null or base_score is null").count() == 0
    assert lm_score.score_texts(awkward, learn, small).count() == n
    assert lm_score.score_texts(none, learn, small).count() == 0
    s = quality.Settings(steps=20)
    scored = quality.score_quality(awkward, labels, learn, s)
    assert scored.where("score between 0 and 1").count() == n and scored.columns == [*awkward.columns, "score"]
    assert quality.score_quality(none, labels, learn, s).count() == 0
    assert langid.identify(awkward, learn, langid.Settings(steps=3)).count() == n
    assert langid.identify(none, learn).count() == 0
    assert neardup.near_duplicates(awkward, awkward.columns).count() == n
    assert neardup.near_duplicates(none, ["doc_id"]).count() == 0
    items = spark.createDataFrame([(1, "one"), (2, None)], "item_id long, text string")
    assert {r["doc_id"] for r in decontam.find_leaks(awkward, items).collect()} == {3}
    assert mix.pareto_mix(awkward, awkward.columns).count() == n
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.nearest(empty, F.lit(True)).count() == 0
    said = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert quotes.reply_ordered(said).count() == 0
