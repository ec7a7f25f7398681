"""Approximate nearest neighbours by a permutation index with pivot inverted files.

Each distinct vector is represented by its ``Settings.prefix`` nearest pivots in
order and posted in the inverted files of the first ``Settings.posted``.  A query
visits the files of its nearest pivots, ranks the entries of each by the
footrule distance between the two orders (a pivot beyond the prefix counts as
standing behind it), and reranks the first by exact Euclidean distance in double
precision.

How many files a query visits is decided by measurement: ``Settings.probes``
queries are answered by brute force over all vectors, and the number of files,
from ``Settings.visited`` on, doubles until the index finds
``Settings.least_recall`` of their neighbours or all files are visited.

Pivots are a sample of 6 times the cube root of the number of distinct vectors, ``Settings.most_pivots``
at most, drawn by a hash; every vector is indexed.  Long files are split into
blocks, and many queries of a file too, so no task holds a whole hot file.
Equal vectors are indexed once, with the ids that a result can need.  A query
that finds fewer neighbours than there are is repeated against all blocks.

Defined results: rows without an id, and vectors that are null, zero, of another
length than the commonest (of equally common ones the longest), or hold a null or
non-finite component take no part;
repeated rows count once; ties go to the smaller id; an empty table gives an
empty result; columns other than ``vec_id`` and ``embedding`` are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.scratch import Scratch


@dataclass(frozen=True)
class Settings:
    neighbours: int = 10
    prefix: int = 96
    posted: int = 8
    visited: int = 12
    probes: int = 32
    least_recall: float = 0.95
    rerank: int = 400
    most_pivots: int = 8192
    block: int = 4096
    seed: int = 29


_QUERY = "query_id long, vec binary, perm binary"
_HIT = "query_id long, score double, ids array<long>"


def usable(vectors: DataFrame) -> DataFrame:
    """Distinct ``vec_id`` and ``embedding`` of the rows that take part."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    nonzero = F.exists("embedding", lambda x: x != 0)
    return vectors.where(F.col("vec_id").isNotNull() & fine & nonzero).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").distinct()


def _matrix(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of the right length as rows, and which rows those are."""
    length = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False))
    right = np.flatnonzero(length == dims)
    flat = column.take(pa.array(right)).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, dims), right


def orders(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The nearest pivots of each row of ``x``, nearest first; ties go to the earlier pivot."""
    d = (pivots * pivots).sum(1) - 2 * (x @ pivots.T)
    if prefix < len(pivots):
        some = np.sort(np.argpartition(d, prefix - 1, axis=1)[:, :prefix], axis=1)
    else:
        some = np.broadcast_to(np.arange(len(pivots)), d.shape)
    return np.take_along_axis(some, np.argsort(np.take_along_axis(d, some, 1), axis=1, kind="stable"), 1).astype(np.int16)  # at most 8192 pivots


def footrule(query: np.ndarray, entries: np.ndarray, pivots: int) -> np.ndarray:
    """Footrule distance between one order and many; pivots beyond a prefix stand at its end."""
    m = len(query)
    place = np.full(pivots, m)
    place[query] = np.arange(m)
    there = place[entries]
    own = np.arange(m)
    unmatched = (m - own).sum() - (m - there).sum(1)  # the query's pivots that an entry lacks
    return np.abs(there - own).sum(1) + unmatched


def search_block(queries: pa.Table, entries: pa.Table, kind: str, dims: int, pivots: int, rerank: int, neighbours: int) -> Iterator[tuple[int, float, object]]:
    """Nearest entries of each query within one block of an inverted file."""
    x, q = (np.frombuffer(b"".join(t.column("vec").to_pylist()), kind).reshape(-1, dims) for t in (entries, queries))
    perm, own = (np.frombuffer(b"".join(t.column("perm").to_pylist()), np.int16).reshape(t.num_rows, -1) for t in (entries, queries))
    ids = entries.column("ids").to_pylist()
    first = np.array([v[0] for v in ids])
    for name, vec, order in zip(queries.column("query_id").to_pylist(), q, own):
        some = np.arange(len(x))
        if len(some) > rerank:
            some = np.argpartition(footrule(order, perm, pivots), rerank - 1)[:rerank]
        d = np.sqrt(((x[some].astype(np.float64) - vec) ** 2).sum(1))
        for i in np.lexsort((first[some], d))[: neighbours + 1]:
            yield name, float(d[i]), ids[some[i]]


def _search(queries: DataFrame, entries: DataFrame, key: list[str], kind: str, dims: int, pivots: int, rerank: int, neighbours: int) -> DataFrame:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        hits = list(search_block(left, right, kind, dims, pivots, rerank, neighbours)) if left.num_rows and right.num_rows else []
        q, d, ids = zip(*hits) if hits else ([], [], [])
        return pa.table([pa.array(q, pa.int64()), pa.array(d, pa.float64()), pa.array(ids, pa.list_(pa.int64()))], ["query_id", "score", "ids"])

    return queries.groupBy(*key).cogroup(entries.groupBy(*key)).applyInArrow(run, _HIT)


def _posted(table: DataFrame, keep: list[str], shared, files: int, prefix: int, schema: str) -> DataFrame:
    """Each row of ``table`` once for each of its first ``files`` pivots, with its order and its vector as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = shared.value
        for batch in batches:
            x, right = _matrix(batch.column("embedding"), pivots.shape[1])
            for lo in range(0, len(x), 2048):
                part = x[lo : lo + 2048]
                perm = orders(part.astype(np.float64), pivots, min(len(pivots), max(prefix, files)))
                n = min(files, perm.shape[1])
                row = np.repeat(np.arange(len(part)), n)
                vec, order = [v.tobytes() for v in part], [p.tobytes() for p in np.ascontiguousarray(perm[:, :prefix])]
                arrays = [batch.column(c).take(pa.array(right[lo + row])) for c in keep]
                arrays += [pa.array([vec[i] for i in row], pa.binary()), pa.array([order[i] for i in row], pa.binary()), pa.array(perm[:, :n].ravel().astype(np.int32))]
                yield pa.RecordBatch.from_arrays(arrays, [*keep, "vec", "perm", "pivot"])

    return table.select(*keep, "embedding").mapInArrow(run, schema)


def furthest(probes: DataFrame, distinct: DataFrame, neighbours: int, dims: int) -> dict[int, tuple[float, int]]:
    """For each of a few queries, by brute force, the distance of its last true neighbour and how many it has."""
    asked = [(r["query_id"], r["embedding"]) for r in probes.collect() if len(r["embedding"]) == dims]
    names, x = np.array([q for q, _ in asked], np.int64), np.array([v for _, v in asked], np.float64).reshape(-1, dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec, right = _matrix(batch.column("embedding"), dims)
            lists = batch.column("ids").take(pa.array(right)).to_pylist()
            out: list[tuple[int, float]] = []
            for name, q in zip(names.tolist(), x):
                d = np.sqrt(((vec.astype(np.float64) - q) ** 2).sum(1))
                near = np.argsort(d, kind="stable")[: neighbours + 1]
                out += [(name, float(d[i])) for i in near for other in lists[i][: neighbours + 1] if other != name]
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in out], pa.int64()), pa.array([d for _, d in out], pa.float64())], ["query_id", "score"])

    best = F.row_number().over(Window.partitionBy("query_id").orderBy("score"))
    near = distinct.select("ids", "embedding").mapInArrow(run, "query_id long, score double").withColumn("r", best).where(F.col("r") <= neighbours)
    return {r["query_id"]: (r["d"], r["n"]) for r in near.groupBy("query_id").agg(F.max("score").alias("d"), F.count(F.lit(1)).alias("n")).collect()}


def nearest(vectors: DataFrame, is_query: Column, s: Settings = Settings()) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of each query's nearest rows, with how many of how many inverted
    files a query ``visited``.

    ``vectors`` has ``vec_id`` and ``embedding``; ``is_query`` is over ``vec_id``.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double, visited int, files int")
    rows = usable(vectors if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else vectors.withColumn("embedding", F.col("embedding").cast("array<double>")))
    w = Window.partitionBy("embedding").orderBy("vec_id")
    few = rows.withColumn("n", F.row_number().over(w)).where(F.col("n") <= s.neighbours + 1)  # limited before the shuffle
    distinct = scratch.save(few.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")))
    shape = distinct.groupBy(F.size("embedding").alias("dims")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    if shape is None:
        return empty
    dims, total = shape["dims"], shape["n"]
    distinct = distinct.where(F.size("embedding") == dims)
    wanted = min(s.most_pivots, math.ceil(6 * total ** (1 / 3)))
    sample = distinct.select("embedding").orderBy(F.xxhash64(F.lit(s.seed), "embedding"), "embedding").limit(wanted).collect()
    kind = "f4" if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else "f8"
    pivots = np.array([r["embedding"] for r in sample], np.float64)
    prefix, visited, posted = (min(x, len(pivots)) for x in (s.prefix, s.visited, s.posted))
    shared = spark.sparkContext.broadcast(pivots)
    entries = scratch.save(_posted(distinct, ["ids"], shared, posted, prefix, "ids array<long>, vec binary, perm binary, pivot int"))
    queries = scratch.save(rows.where(is_query).withColumnRenamed("vec_id", "query_id"))
    sizes = entries.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / s.block).cast("int").alias("x_blocks"))
    key = ["pivot", "xb", "qb"]

    def visit(some: DataFrame, files: int) -> tuple[DataFrame, DataFrame]:
        """The files that queries ask for, and what is found in them."""
        asked = scratch.save(_posted(some, ["query_id"], shared, files, prefix, f"{_QUERY}, pivot int"))
        loads = asked.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / s.block).cast("int").alias("q_blocks"))
        shape = sizes.join(loads, "pivot")
        upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        left = asked.join(shape, "pivot").withColumn("qb", F.pmod(F.xxhash64("query_id"), F.col("q_blocks")).cast("int")).withColumn("xb", upto("x_blocks"))
        right = entries.join(shape, "pivot").withColumn("xb", F.pmod(F.xxhash64("vec"), F.col("x_blocks")).cast("int")).withColumn("qb", upto("q_blocks"))
        return asked, scratch.save(_search(left.select(*key, "query_id", "vec", "perm"), right.select(*key, "vec", "perm", "ids"), key, kind, dims, len(pivots), s.rerank, s.neighbours))

    probes = scratch.save(queries.orderBy(F.xxhash64(F.lit(s.seed), "query_id"), "query_id").limit(s.probes))
    within = furthest(probes, distinct, s.neighbours, dims)
    while within and visited < len(pivots):
        asked, hits = visit(probes, visited)
        right = hits.select("query_id", "score", F.explode("ids").alias("vec_id")).where("query_id <> vec_id").distinct()
        near = Window.partitionBy("query_id").orderBy("score")
        right = right.withColumn("r", F.row_number().over(near)).where(F.col("r") <= s.neighbours)  # a probe has no more that count
        got = [(r["query_id"], r["score"]) for r in right.collect()]
        hit = sum(min(n, sum(q == name and d <= limit for q, d in got)) for name, (limit, n) in within.items())
        scratch.drop(asked, hits)
        if hit >= s.least_recall * sum(n for _, n in within.values()):
            break
        visited = min(2 * visited, len(pivots))
    asked, hits = visit(queries, visited)
    found = hits.select("query_id", "score", F.explode("ids").alias("vec_id")).where("query_id <> vec_id").distinct()
    available = distinct.select(F.explode(F.slice("ids", 1, s.neighbours + 1))).limit(s.neighbours + 1).count() - 1
    enough = found.groupBy("query_id").count().where(F.col("count") >= min(s.neighbours, available)).select("query_id")
    short = scratch.save(asked.select("query_id", "vec", "perm").distinct().join(enough, "query_id", "left_anti"))
    if not short.isEmpty():
        blocks = -(-total // s.block)
        every = short.withColumn("xb", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        whole = entries.select("vec", "perm", "ids").distinct().withColumn("xb", F.pmod(F.xxhash64("vec"), F.lit(blocks)).cast("int"))
        more = _search(every, whole, ["xb"], kind, dims, len(pivots), 1 << 30, s.neighbours)
        found = found.unionAll(more.select("query_id", "score", F.explode("ids").alias("vec_id")).where("query_id <> vec_id")).distinct()
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= s.neighbours)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", F.lit(visited).alias("visited"), F.lit(len(pivots)).alias("files"))
