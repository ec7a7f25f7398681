"""Centroid clustering by filtering kd-trees.

Components become integers, ``floor(scale * x)``, so sums, means and distances
are exact and do not depend on the order of rows or tasks.

Each task cuts its rows into blocks and builds one kd-tree over each.  A node
holds the count of its vectors, their integer sums and their bounding box.  A
round walks the trees from their roots with the centroids still possible for
each node: the centroid nearest to the middle of the box is compared with every
other at the corner of the box that favours the other most, and a centroid that
is strictly further even there is pruned.  A node with one centroid left is
assigned whole, by its count and sums; the vectors of leaves with several are
resolved exactly.  So ties always reach the exact comparison, where the smaller
number wins.

Trees are built once and written to the shared folder.  A round reads them,
sums by centroid in each task, and sends one row a centroid and component to
the shuffle and one row a centroid to the driver.

Defined results: vectors of another length than ``dims``, null vectors and those
with null or non-finite components take no part; integers are held within 2**27
of 0, so that a distance always fits a long.  Repeated rows are vectors of their
own; a null id sorts last among the first centroids, and equal ids go by their
vectors.  With fewer vectors than clusters there are as many clusters as
vectors; an empty table gives an empty result.  Only the columns named in
``keep`` come back, whatever their names.  Inertias beyond a long are null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm._vectors import finite, matrix, packed
from quillon.scratch import Scratch

LIMIT = 2.0**27


@dataclass(frozen=True)
class Settings:
    clusters: int = 8
    rounds: int = 10
    dims: int = 64
    scale: int = 1024
    seed: int = 3
    block: int = 8192
    leaf: int = 32


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    return np.clip(np.floor(x * scale), -LIMIT, LIMIT).astype(np.int32)


@dataclass
class Tree:
    """A kd-tree over points in leaf order; node 0 is the root, and a leaf's children are -1.

    ``span`` has the first and the last place (exclusive) of each node, ``child``
    its children, ``box`` its least and greatest components, ``sums`` its sums.
    """

    points: np.ndarray
    span: np.ndarray
    child: np.ndarray
    box: np.ndarray
    sums: np.ndarray

    FIELDS = {"points": np.int32, "span": np.int32, "child": np.int32, "box": np.int32, "sums": np.int64}

    def pack(self) -> dict[str, bytes]:
        return {name: np.ascontiguousarray(getattr(self, name), kind).tobytes() for name, kind in self.FIELDS.items()}

    @classmethod
    def unpack(cls, given: dict[str, bytes], dims: int) -> Tree:
        shape = {"points": (-1, dims), "span": (-1, 2), "child": (-1, 2), "box": (-1, 2, dims), "sums": (-1, dims)}
        return cls(*[np.frombuffer(given[name], kind).reshape(shape[name]) for name, kind in cls.FIELDS.items()])


def grow(points: np.ndarray, leaf: int) -> tuple[Tree, np.ndarray]:
    """The tree over ``points`` and their order in it.  Nodes are halved at the median of their widest component
    until they have ``leaf`` points or all points are equal."""
    order = np.arange(len(points))
    span, child, box, sums = [(0, len(points))], [], [], []
    at = 0
    while at < len(span):
        lo, hi = span[at]
        own = points[order[lo:hi]]
        box.append((own.min(0), own.max(0)))
        sums.append(own.sum(0, dtype=np.int64))
        wide = box[-1][1].astype(np.int64) - box[-1][0]
        if hi - lo <= leaf or not wide.any():
            child.append((-1, -1))
        else:
            half = (hi - lo) // 2
            order[lo:hi] = order[lo:hi][np.argpartition(own[:, wide.argmax()], half)]
            child.append((len(span), len(span) + 1))
            span += [(lo, lo + half), (lo + half, hi)]
        at += 1
    return Tree(points[order], np.array(span), np.array(child), np.array(box), np.array(sums)), order


def squared(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, a column for each centroid."""
    reach = 2 * max(int(np.abs(points).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if reach * reach * points.shape[1] < 1 << 52:  # every step is a whole number that a double holds
        p, c = points.astype(np.float64), centroids.astype(np.float64)
        return ((p * p).sum(1)[:, None] - 2 * (p @ c.T) + (c * c).sum(1)).astype(np.int64)
    return np.stack([((points - c) ** 2).sum(1) for c in centroids.astype(np.int64)], 1)


def owners(tree: Tree, centroids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Walks the tree level by level.  Gives either whole nodes, as (nodes, centroid of each, no points), or the
    points of unresolved leaves, as (no nodes, centroid of each, places)."""
    none = np.zeros(0, np.int64)
    c = centroids.astype(np.int64)
    front, alive = np.zeros(1, np.int64), np.ones((1, len(c)), bool)
    step = max(1, (1 << 21) // c.size)
    while len(front):
        nearest = np.zeros(len(front), np.int64)
        for lo in range(0, len(front), step):
            part = slice(lo, lo + step)
            low, high = tree.box[front[part], 0].astype(np.int64), tree.box[front[part], 1].astype(np.int64)
            middle = ((low + high)[:, None, :] / 2 - c) ** 2
            best = np.where(alive[part], middle.sum(2), np.inf).argmin(1)
            rival = c[best][:, None, :]
            corner = np.where(c > rival, high[:, None, :], low[:, None, :])
            alive[part] &= ((c - corner) ** 2).sum(2) <= ((rival - corner) ** 2).sum(2)
            nearest[part] = best
        alone = alive.sum(1) == 1
        if alone.any():
            yield front[alone], nearest[alone], none
        leaf = ~alone & (tree.child[front, 0] < 0)
        if leaf.any():
            spans = tree.span[front[leaf]].astype(np.int64)
            size = spans[:, 1] - spans[:, 0]
            places = np.repeat(spans[:, 1] - np.cumsum(size), size) + np.arange(size.sum())
            distance = squared(tree.points[places], c)
            distance[~np.repeat(alive[leaf], size, axis=0)] = np.iinfo(np.int64).max
            yield none, distance.argmin(1), places
        deeper = ~alone & ~leaf
        front, alive = tree.child[front[deeper]].ravel().astype(np.int64), np.repeat(alive[deeper], 2, axis=0)


def totals(tree: Tree, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Count and sums of the vectors of each centroid."""
    k = len(centroids)
    count, sums = np.zeros(k, np.int64), np.zeros(centroids.shape, np.int64)
    for nodes, owner, places in owners(tree, centroids):
        size = np.diff(tree.span[nodes], axis=1).ravel() if len(nodes) else np.ones(len(places), np.int64)
        by = np.argsort(owner, kind="stable")
        own, first = np.unique(owner[by], return_index=True)
        part = tree.sums[nodes[by]] if len(nodes) else tree.points[places[by]].astype(np.int64)
        count[own] += np.add.reduceat(size[by], first)
        sums[own] += np.add.reduceat(part, first, axis=0)
    return count, sums


def labels(tree: Tree, centroids: np.ndarray) -> np.ndarray:
    """The centroid of each point, in tree order."""
    out = np.zeros(len(tree.points), np.int64)
    for nodes, owner, places in owners(tree, centroids):
        for (lo, hi), j in zip(tree.span[nodes].tolist(), owner.tolist()):
            out[lo:hi] = j
        if len(places):
            out[places] = owner
    return out


def plant(rows: DataFrame, s: Settings) -> DataFrame:
    """One row a tree: the rows' structs as ``rows``, in tree order, and the fields of ``Tree`` as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tree_of(names: list[pa.Array], points: list[np.ndarray]) -> pa.RecordBatch:
            tree, order = grow(np.concatenate(points), s.leaf)
            own = pa.concat_arrays(names).take(pa.array(order))
            arrays = [pa.ListArray.from_arrays(pa.array([0, len(order)], pa.int32()), own)] + [pa.array([x], pa.binary()) for x in tree.pack().values()]
            return pa.RecordBatch.from_arrays(arrays, ["rows", *Tree.FIELDS])

        names, points, held = [], [], 0
        for batch in batches:
            x, right = matrix(batch.column(1), s.dims)
            x, own = integers(x, s.scale), batch.column(0).take(pa.array(right))
            while len(x):
                n = min(s.block - held, len(x))
                names.append(own[:n])
                points.append(x[:n])
                x, own, held = x[n:], own[n:], held + n
                if held == s.block:
                    yield tree_of(names, points)
                    names, points, held = [], [], 0
        if held:
            yield tree_of(names, points)

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"rows array<{kind}>, " + ", ".join(f"{name} binary" for name in Tree.FIELDS))


def _trees(batch: pa.RecordBatch, dims: int) -> Iterator[Tree]:
    for i in range(batch.num_rows):
        yield Tree.unpack({name: batch.column(name)[i].as_buffer() for name in Tree.FIELDS}, dims)


def gather(trees: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Count and sums of each centroid that has vectors, over all trees."""
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for batch in batches:
            for tree in _trees(batch, dims):
                n, t = totals(tree, centroids)
                count += n
                sums += t
        own = np.flatnonzero(count)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1) * dims, pa.int32()), pa.array(sums[own].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(count[own]), lists], ["cluster", "n", "sums"])

    part = trees.select(*Tree.FIELDS).mapInArrow(run, "cluster int, n long, sums array<long>")
    whole = lambda c: F.sum(F.col(c).cast("decimal(20,0)"))
    flat = part.select("cluster", "n", F.posexplode("sums").alias("p", "v")).groupBy("cluster", "p").agg(whole("n").alias("n"), whole("v").alias("v"))
    rows = flat.groupBy("cluster").agg(F.max("n").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("p", "v"))), lambda x: x["v"]).alias("v")).collect()
    return {r["cluster"]: (int(r["n"]), [int(v) for v in r["v"]]) for r in rows}


def first_centroids(rows: DataFrame, key: str, s: Settings) -> np.ndarray:
    """The vectors with the smallest SHA-256 of seed and key, by their number at most ``clusters``."""
    name = F.sha2(F.concat(F.lit(f"{s.seed}:"), F.col(f"row.`{key}`").cast("string")), 256)
    some = rows.select("vec", name.alias("h")).orderBy(F.col("h").asc_nulls_last(), "vec").limit(s.clusters).collect()
    return integers(np.array([r["vec"] for r in some], np.float64).reshape(-1, s.dims), s.scale).astype(np.int64)


def cluster(vectors: DataFrame, keep: list[str], key: str = "vec_id", column: str = "embedding", s: Settings = Settings()) -> DataFrame:
    """Columns ``keep`` (with ``key``) of every row that takes part and ``found``, a struct of ``cluster``, ``distance``,
    ``cluster_inertia``, ``inertia`` and ``centroid_sha256``."""
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    rows = packed(vectors, keep, column).where(finite("vec") & (F.size("vec") == s.dims))
    centroids = first_centroids(rows, key, s)
    kind = rows.schema["row"].dataType.simpleString()
    if not len(centroids):
        found = "struct<cluster:int,distance:bigint,cluster_inertia:bigint,inertia:bigint,centroid_sha256:string>"
        return spark.createDataFrame([], f"row {kind}, found {found}").select("row.*", "found")
    trees = scratch.save(plant(rows, s))
    for _ in range(s.rounds):
        for j, (n, sums) in gather(trees, centroids).items():
            centroids[j] = [v // n for v in sums]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, tree in enumerate(_trees(batch, s.dims)):
                own = labels(tree, centroids)
                away = ((tree.points - centroids[own]) ** 2).sum(1)
                yield pa.RecordBatch.from_arrays([batch.column("rows")[i].values, pa.array(own, pa.int32()), pa.array(away)], ["row", "cluster", "distance"])

    done = scratch.save(trees.mapInArrow(label, f"row {kind}, cluster int, distance long"))
    scratch.drop(trees)
    by_cluster = dict(done.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)"))).collect())
    fits = lambda v: F.lit(int(v) if v < 1 << 63 else None).cast("long")
    inertia = F.array(*[fits(by_cluster.get(j, 0)) for j in range(len(centroids))])
    names = F.array(*[F.lit(hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for c in centroids.tolist()])
    found = F.struct("cluster", "distance", F.get(inertia, "cluster").alias("cluster_inertia"), fits(sum(by_cluster.values())).alias("inertia"), F.get(names, "cluster").alias("centroid_sha256"))
    return done.select("row.*", found.alias("found"))


def lloyd_sql(s: Settings = Settings()) -> str:
    """DuckDB SQL for the clusters of ``embeddings``: the same rounds by comparing every vector with every centroid."""
    steps = [
        f"v AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS r, [CAST(floor({s.scale} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS p FROM embeddings"
        f" WHERE len(embedding) = {s.dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY h, p) - 1 AS INTEGER) AS j, p FROM (SELECT p, sha256('{s.seed}:' || vec_id) AS h FROM v ORDER BY h, p LIMIT {s.clusters}))",
    ]
    for i in range(s.rounds + 1):
        steps.append(
            f"a{i} AS MATERIALIZED (SELECT r, arg_min(j, [d, j]) AS j, min(d) AS d FROM (SELECT r, j, CAST(list_sum(list_transform(list_zip(v.p, c.p), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS BIGINT) AS d FROM v, c{i} c) GROUP BY r)"
        )
        if i < s.rounds:
            floor = "CAST((t - ((t % n) + n) % n) // n AS BIGINT)"
            steps.append(
                f"c{i + 1} AS MATERIALIZED (SELECT c.j, coalesce(m.p, c.p) AS p FROM c{i} c LEFT JOIN (SELECT j, list({floor} ORDER BY k) AS p FROM (SELECT j, k, sum(x) AS t, count(*) AS n"
                f" FROM (SELECT a.j, unnest(v.p) AS x, unnest(range(1, {s.dims + 1})) AS k FROM a{i} a JOIN v USING (r)) GROUP BY j, k) GROUP BY j) m ON m.j = c.j)"
            )
    last = s.rounds
    return (
        "WITH " + ",\n".join(steps) + f"\nSELECT v.vec_id, a.j AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.j) AS BIGINT) AS cluster_inertia,"
        f" CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.p, ',')) AS centroid_sha256 FROM a{last} a JOIN v USING (r) JOIN c{last} c ON c.j = a.j"
    )
