"""Whitening, centroid clustering and packing against brute force, and on awkward rows."""

import collections
import hashlib
import itertools
import math
import random
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillon.llm import centroids, packing, whiten
from quillon.llm.queries import QUERIES

TABLES = "/root/testdata/sf0.001"
KIND = "vec_id long, embedding array<float>, row string, vec string, label int"


def read(spark, name):
    return spark.read.parquet(f"{TABLES}/{name}.parquet").collect()


def types(df, given):
    assert {c: t for c, t in df.dtypes if c in given} == given


def test_whitening_keeps_its_contract(spark):
    out = QUERIES["op11_whitening"](spark, TABLES)
    types(out, {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"})
    rows = out.collect()
    given = read(spark, "embeddings")
    x = np.floor(64 * np.array([r["embedding"] for r in given], np.float64)).astype(np.int64) + 1000000
    n, total = len(x), x.sum(0)
    y = x - total / n
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1], u[:, ::-1]
    assert len(rows) == 32 * n and {r["component"] for r in rows} == set(range(1, 33)) and {r["n"] for r in rows} == {n}
    w = np.zeros((n, 32))
    place = {r["vec_id"]: i for i, r in enumerate(given)}
    for r in rows:
        w[place[r["vec_id"]], r["component"] - 1] = r["whitened"]
        assert r["explained"] == pytest.approx(e[r["component"] - 1] / e.sum(), rel=1e-9) and r["identity_error"] < 1e-9
    expected = y @ u[:, :32] / np.sqrt(e[:32])
    assert np.allclose(w * np.sign((w * expected).sum(0)), expected, atol=1e-6)
    exact = {r["vec_id"]: sum((n * int(v) - int(t)) ** 2 for v, t in zip(x[i], total)) for i, r in enumerate(given)}
    assert all(r["deviation"] == exact[r["vec_id"]] for r in rows)


def awkward_vectors(spark, dims, rng):
    fine = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(200)]
    rows = [(i, v, "r", "v", 1) for i, v in enumerate(fine)]
    rows += [rows[3], rows[3], (None, fine[0], None, None, None), (200, fine[7], "r", "v", None)]
    bad = [None, [], [None] * dims, [float("nan")] * dims, [float("inf")] + [0.0] * (dims - 1), [1.0] * (dims + 1), [1.0]]
    return spark.createDataFrame([*rows, *[(300 + i, v, "r", "v", 1) for i, v in enumerate(bad)]], KIND).repartition(5), rows


def test_whitening_of_awkward_rows(spark):
    table, rows = awkward_vectors(spark, 7, random.Random(3))
    out = whiten.whiten(table, table.columns, s=whiten.Settings(width=3, block_bytes=1, components=9))
    got = out.collect()
    assert out.columns == [*table.columns, "white"] and collections.Counter(r["vec_id"] for r in got) == collections.Counter(r[0] for r in rows)
    w = np.array([r["white"]["whitened"] for r in got])
    assert w.shape[1] == 7 and np.allclose(np.cov(w.T, bias=True), np.eye(7), atol=1e-9) and got[0]["white"]["identity_error"] < 1e-9
    assert sum(got[0]["white"]["explained"]) == pytest.approx(1)
    assert whiten.whiten(table.limit(0), ["vec_id"]).count() == 0
    flat = spark.createDataFrame([(i, [1.0, 2.0, float(i)]) for i in range(9)], "vec_id long, embedding array<double>")
    assert {len(r["white"]["whitened"]) for r in whiten.whiten(flat, ["vec_id"]).collect()} == {1}
    equal = whiten.whiten(flat.where("vec_id < 1"), ["vec_id"]).collect()
    assert [(r["white"]["whitened"], r["white"]["deviation"]) for r in equal] == [([], 0)]
    huge = spark.createDataFrame([(0, [1e300, 0.0]), (1, [-1e300, 1.0]), (2, [0.0, 5.0])], "vec_id long, embedding array<double>")
    assert [r["white"]["deviation"] for r in whiten.whiten(huge, ["vec_id"]).where("vec_id < 2").collect()] == [None, None]


@pytest.mark.parametrize("width", [1, 2, 5, 64])
def test_tiles_add_up(spark, width):
    x = np.random.default_rng(5).standard_normal((700, 5))
    table = spark.createDataFrame([(r.tolist(),) for r in x], "v array<double>").repartition(3)
    s = whiten.Settings(width=width, most_blocks=9, block_bytes=1)
    assert np.allclose(whiten.tiled_products(table, "v", 5, lambda y: y, s), x.T @ x)


def test_whitening_sums_are_exact():
    fit = whiten.Fit(3, (1 << 62, -7, 4))
    x = np.array([[1 << 61, 5, 1], [-(1 << 61), -9, 2]], np.int64)
    assert whiten._exact_sums(np.array([[1 << 61, -1]] * 9)) == [9 << 61, -9]
    assert fit.deviations(x) == [None, None]
    small = whiten.Fit(4, (9, -7))
    assert small.deviations(np.array([[2, -3]])) == [(4 * 2 - 9) ** 2 + (4 * -3 + 7) ** 2]
    assert small.centred(np.array([[2, -3]]))[0].tolist() == [float(Fraction(-1, 4)), float(Fraction(-5, 4))]


def lloyd(points, names, k, rounds):
    first = sorted(range(len(points)), key=lambda i: (hashlib.sha256(f"3:{names[i]}".encode()).hexdigest() if names[i] is not None else "z", points[i]))[:k]
    c = [list(points[i]) for i in first]
    near = lambda p: min((sum((a - b) ** 2 for a, b in zip(p, q)), j) for j, q in enumerate(c))
    for _ in range(rounds):
        own = collections.defaultdict(list)
        for p in points:
            own[near(p)[1]].append(p)
        for j, some in own.items():
            c[j] = [sum(v) // len(some) for v in zip(*some)]
    return c, [near(p) for p in points]


@pytest.mark.parametrize("dims,k,leaf,block", [(2, 8, 1, 50), (3, 5, 4, 64), (7, 8, 8, 8192), (2, 300, 2, 100)])
def test_clusters_equal_brute_force(spark, dims, k, leaf, block):
    rng = random.Random(dims)
    table, rows = awkward_vectors(spark, dims, rng)
    s = centroids.Settings(clusters=k, rounds=4, dims=dims, scale=8, leaf=leaf, block=block)
    out = centroids.cluster(table, table.columns, s=s)
    got = out.collect()
    points = [tuple(math.floor(8 * np.float32(x).item()) for x in r[1]) for r in rows]
    c, near = lloyd(points, [r[0] for r in rows], k, 4)
    assert out.columns == [*table.columns, "found"]
    assert sorted((r["vec_id"] or -1, r["found"]["cluster"], r["found"]["distance"]) for r in got) == sorted((r[0] or -1, j, d) for r, (d, j) in zip(rows, near))
    inertia = collections.Counter()
    for d, j in near:
        inertia[j] += d
    for r in got:
        f = r["found"]
        assert (f["cluster_inertia"], f["inertia"]) == (inertia[f["cluster"]], sum(inertia.values()))
        assert f["centroid_sha256"] == hashlib.sha256(",".join(map(str, c[f["cluster"]])).encode()).hexdigest()
    assert centroids.cluster(table.limit(0), ["vec_id"], s=s).count() == 0
    assert centroids.cluster(table.where("vec_id is null"), ["vec_id"], s=s).count() == 1


def test_filtering_is_exact_and_prunes():
    rng = np.random.default_rng(8)
    centre = rng.integers(-500, 500, (8, 6))
    points = (centre[rng.integers(0, 8, 5000)] + rng.integers(-9, 9, (5000, 6))).astype(np.int32)
    points[:900] = points[0]  # many copies
    tree, order = centroids.grow(points, 16)
    assert (tree.points == points[order]).all() and sorted(order) == list(range(5000))
    for c in (centre, centre[[0, 0, 1, 2]], rng.integers(-9, 9, (5, 6)) * 2):
        own = centroids.labels(tree, c)
        away = ((tree.points[:, None, :].astype(np.int64) - c) ** 2).sum(2)
        assert (own == away.argmin(1)).all()
        count, sums = centroids.totals(tree, c)
        assert (count == np.bincount(own, minlength=len(c))).all()
        assert all((sums[j] == tree.points[own == j].sum(0)).all() for j in range(len(c)))
    whole = sum(len(places) for _, _, places in centroids.owners(tree, centre))
    assert whole < 500  # nearly all vectors are assigned with their nodes
    big = np.array([[1 << 27, -(1 << 27)]])
    assert centroids.squared(big, -big)[0, 0] == 2 * (1 << 28) ** 2


def test_hilbert_keys_are_one_walk():
    for dims, bits in ((2, 4), (3, 3), (4, 2), (1, 5)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        key = packing.hilbert_key(cells, bits)
        assert sorted(key) == list(range(len(cells)))
        walk = cells[np.argsort(key)]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def tokens_of(text):
    t = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    return [*t.encode(text or "", add_special_tokens=False).ids, 2]


def check_pieces(pieces, expected, length=4096):
    """Pieces as dicts with ``uid``; expected: tokens of each uid."""
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        by_doc[p["uid"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    assert set(by_doc) == set(expected)
    for uid, own in by_doc.items():
        at = 0
        for p in sorted(own, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(expected[uid]) and p["length"] > 0
            ids = np.array(expected[uid][at : at + p["length"]], "<u4").tobytes()
            assert p["ids"] == ids if "ids" in p else p["ids_crc32"] == zlib.crc32(ids)
            at += p["length"]
        assert at == len(expected[uid])
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= length
    assert len(by_sequence) == -(-sum(map(len, expected.values())) // length)


def test_packing_keeps_its_contract(spark):
    out = QUERIES["op13_packing"](spark, TABLES)
    types(out, {c: "bigint" for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")})
    assert set(out.columns) > {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}
    texts = {r["doc_id"]: r["text"] for r in read(spark, "documents")}
    check_pieces([r.asDict() | {"uid": r["doc_id"]} for r in out.collect()], {i: tokens_of(t) for i, t in texts.items()})


def test_packing_of_awkward_rows(spark):
    rng = random.Random(4)
    texts = [None, "", " \t\n", "A'S don't <|endoftext|> x", "é É ß ﬁ z", "́ lone mark", "日本語 テキスト 123", "x" * 3000, "word " * 900, "?!... $$$", "same text"] + ["same text"] * 40
    texts += [" ".join(rng.choice("abcdefghij") * rng.randrange(1, 9) for _ in range(rng.randrange(1, 200))) for _ in range(60)]
    kinds = "doc_id long, text string, row string, ids string, place string, uid long"
    docs = spark.createDataFrame([(None if i == 5 else i, t, "r", "i", "p", i) for i, t in enumerate(texts)], kinds).repartition(4)
    s = packing.Settings(length=64, range_tokens=300)
    out = packing.pack(docs, docs.columns, s=s)
    assert out.columns == [*docs.columns, "piece"]
    pieces = [r["piece"].asDict() | {"uid": r["uid"]} for r in out.collect()]
    check_pieces(pieces, {i: tokens_of(t) for i, t in enumerate(texts)}, 64)
    assert packing.pack(docs.limit(0), ["doc_id"]).count() == 0


def test_neighbours_are_packed_together(spark):
    rng = random.Random(6)
    topics = [[f"{chr(97 + t)}{chr(97 + i)}{chr(98 + i)}" for i in range(20)] for t in range(8)]
    rows = [(i, " ".join(rng.choice(topics[i % 8]) for _ in range(120))) for i in range(400)]
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), ["doc_id"], s=packing.Settings(length=1024))
    mixed = out.groupBy("piece.sequence_id").agg(F.countDistinct(F.col("doc_id") % 8).alias("topics")).agg(F.avg("topics")).first()[0]
    assert mixed < 3  # any order would mix most of the eight
    order = [r["doc_id"] for r in out.select("doc_id", "piece.doc_key", "piece.sequence_id", "piece.offset").orderBy("sequence_id", "offset").collect()]
    keys = [r["doc_key"] for r in out.select("piece.doc_key", "piece.sequence_id", "piece.offset").orderBy("sequence_id", "offset").collect()]
    assert keys == sorted(keys) and set(order) == set(range(400))
