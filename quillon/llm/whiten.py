"""Embedding whitening by a tiled covariance.

Components become integers, ``floor(scale * c) + offset``, and all statistics
are over the integers of the fit list, which is every vector that takes part.
Counts and per-dimension sums are exact and gathered in one pass.

The covariance is computed by tiles.  Dimensions are cut into column blocks and
each pair of column blocks is the key of a tile.  A task packs its rows into
row-blocks of bounded size; the centred column blocks of a row-block are
shuffled to the tiles they belong to, where the two blocks of a pair are
multiplied.  The products are summed entry by entry with partial sums before
the shuffle, and only the sums, half a matrix of dimensions, reach the driver,
which assembles them and computes the eigenvectors.  A row-block comes from one
task and has a bounded number of rows, so equal vectors or ids cannot make a
group large.  The covariance of the whitened rows is measured in the same way.

Memory: a pair of column blocks holds ``block_bytes`` at most twice (256 rows at
least), and the driver a matrix of dimensions, which is refused beyond
``most_dims``.  A column block travels once for each column block there is, at
most ``most_blocks`` times up to ``most_blocks * most_width`` dimensions.

Defined results: vectors that are null, empty, or hold a null or non-finite
component take no part; nor do those of another length than the commonest (of
equally common ones the longest).  Integers are held within 2**61 of 0.
Repeated rows and null ids count like any others.  Components whose variance is
not above rounding (all of them where all vectors are equal) are left out.  An
empty table gives an empty result.  Only the columns named in ``keep`` come
back, whatever their names.  ``deviation`` is null where it exceeds a long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm._vectors import finite, lengths, matrix, packed
from quillon.scratch import Scratch

LIMIT = 2.0**61


@dataclass(frozen=True)
class Settings:
    scale: int = 64
    offset: int = 1_000_000
    components: int = 32
    block_bytes: int = 1 << 20
    width: int = 32
    most_blocks: int = 8
    most_width: int = 1024
    most_dims: int = 8192


def integers(x: np.ndarray, s: Settings) -> np.ndarray:
    return np.clip(np.floor(x * s.scale), -LIMIT, LIMIT).astype(np.int64) + s.offset


def _exact_sums(x: np.ndarray) -> list[int]:
    """Column sums of int64 as Python integers: halves are summed on their own, so nothing overflows."""
    high, low = (x >> 31).sum(0).tolist(), (x & 0x7FFFFFFF).sum(0).tolist()
    return [(h << 31) + r for h, r in zip(high, low)]


def sums_by_length(rows: DataFrame, s: Settings) -> DataFrame:
    """``dims``, ``pos``, ``n`` and the exact ``total`` of each dimension, one row for each task and dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[int, list[int]]] = {}
        for batch in batches:
            lists = batch.column(0)
            for d in np.unique(lengths(lists)).tolist():
                x = integers(matrix(lists, d)[0], s)
                n, total = found.get(d, (0, [0] * d))
                found[d] = (n + len(x), [a + b for a, b in zip(total, _exact_sums(x))])
        for d, (n, total) in found.items():
            columns = [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), pa.array(total, pa.decimal128(38, 0))]
            yield pa.RecordBatch.from_arrays(columns, ["dims", "pos", "n", "total"])

    return rows.select("vec").mapInArrow(run, "dims int, pos int, n long, total decimal(38,0)")


@dataclass(frozen=True)
class Fit:
    """The exact mean of the fit list, as an integer and a rest below 1."""

    n: int
    sums: tuple[int, ...]

    @property
    def dims(self) -> int:
        return len(self.sums)

    def shift(self) -> np.ndarray:
        return np.array([total // self.n for total in self.sums], np.int64)

    def rest(self) -> np.ndarray:
        return np.array([float(Fraction(total % self.n, self.n)) for total in self.sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.shift()).astype(np.float64) - self.rest()

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum over dimensions of ``(n * x - sum) ** 2``, exactly; None beyond a long."""
        d, rest = x - self.shift(), [total % self.n for total in self.sums]
        reach = self.n * (int(np.abs(d).max(initial=0)) + 1)
        if reach * reach * self.dims < 1 << 63:
            y = d * self.n - np.array(rest, np.int64)
            return (y * y).sum(1).tolist()
        exact = [sum((self.n * v - r) ** 2 for v, r in zip(row, rest)) for row in d.tolist()]
        return [v if v < 1 << 63 else None for v in exact]


def column_blocks(dims: int, s: Settings) -> list[tuple[int, int]]:
    width = min(max(s.width, -(-dims // s.most_blocks)), s.most_width)
    return [(lo, min(lo + width, dims)) for lo in range(0, dims, width)]


def tiled_products(table: DataFrame, column: str, dims: int, centred: Callable[[np.ndarray], np.ndarray], s: Settings) -> np.ndarray:
    """The sum over all rows of the products of each pair of dimensions, as a full matrix.

    ``centred`` maps vectors of the length ``dims`` to what is multiplied.
    """
    blocks = column_blocks(dims, s)
    tall = max(256, s.block_bytes // (8 * (blocks[0][1] - blocks[0][0])))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        number, waiting, rows = 0, [], 0

        def pieces(y: np.ndarray) -> pa.RecordBatch:
            nonlocal number
            key = (task << 32) + number
            number += 1
            out = []
            for j, (lo, hi) in enumerate(blocks):
                data = np.ascontiguousarray(y[:, lo:hi]).tobytes()
                out += [(key, min(i, j), max(i, j), j > i, data) for i in range(len(blocks))]  # second: the later of the pair
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["row_block", "i", "k", "second", "data"])

        for batch in batches:
            y = centred(matrix(batch.column(0), dims)[0])
            while len(y):
                part, y = y[: tall - rows], y[tall - rows :]
                waiting.append(part)
                rows += len(part)
                if rows == tall:
                    yield pieces(np.concatenate(waiting))
                    waiting, rows = [], 0
        if rows:
            yield pieces(np.concatenate(waiting))

    def multiply(pair: pa.Table) -> pa.Table:
        i, k = pair.column("i")[0].as_py(), pair.column("k")[0].as_py()
        sides = dict(zip(pair.column("second").to_pylist(), pair.column("data").to_pylist()))
        of = lambda second, b: np.frombuffer(sides[second], np.float64).reshape(-1, blocks[b][1] - blocks[b][0])
        left = of(False, i)
        right = left if i == k else of(True, k)
        product = left.T @ right
        values = pa.ListArray.from_arrays(pa.array(range(0, product.size + 1, product.shape[1]), pa.int32()), pa.array(product.ravel()))
        n = len(product)
        return pa.table([pa.array([i] * n, pa.int32()), pa.array([k] * n, pa.int32()), pa.array(range(n), pa.int32()), values], ["i", "k", "r", "entries"])

    cut_up = table.select(column).mapInArrow(cut, "row_block long, i int, k int, second boolean, data binary")
    products = cut_up.groupBy("row_block", "i", "k").applyInArrow(multiply, "i int, k int, r int, entries array<double>")
    entries = products.select("i", "k", "r", F.posexplode("entries").alias("c", "entry"))
    tiles = entries.groupBy("i", "k", "r", "c").agg(F.sum("entry").alias("entry")).toArrow()
    starts = np.array([lo for lo, _ in blocks])
    row = starts[tiles.column("i").to_numpy()] + tiles.column("r").to_numpy()
    col = starts[tiles.column("k").to_numpy()] + tiles.column("c").to_numpy()
    out = np.zeros((dims, dims))
    out[row, col] = out[col, row] = tiles.column("entry").to_numpy()
    return out


def principal(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and unit eigenvectors as columns, of those above rounding; the largest entry of each is positive."""
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    real = int((values > max(values[0], 0) * len(values) * np.finfo(float).eps).sum())
    values, vectors = values[: min(most, real)], vectors[:, : min(most, real)]
    return values, vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])


def whiten(vectors: DataFrame, keep: list[str], column: str = "embedding", s: Settings = Settings()) -> DataFrame:
    """Columns ``keep`` of every row that takes part and ``white``, a struct of ``n``, ``deviation``, ``whitened`` and
    ``explained`` (arrays with one entry a component) and ``identity_error``."""
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    rows = packed(vectors, keep, column).where(finite("vec") & (F.size("vec") > 0))
    row_type = rows.schema["row"].dataType.simpleString()
    partial = scratch.save(sums_by_length(rows, s))
    commonest = partial.where("pos = 0").groupBy("dims").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    if commonest is None:
        white = "struct<n:bigint,deviation:bigint,whitened:array<double>,explained:array<double>,identity_error:double>"
        return spark.createDataFrame([], f"row {row_type}, white {white}").select("row.*", "white")
    dims, n = commonest["dims"], commonest["n"]
    if dims > s.most_dims:
        raise ValueError(f"vectors of {dims} components; the eigenvectors of {s.most_dims} at most are computed on the driver")
    totals = partial.where(F.col("dims") == dims).groupBy("pos").agg(F.sum("total").alias("total")).orderBy("pos").collect()
    scratch.drop(partial)
    fit = Fit(n, tuple(int(r["total"]) for r in totals))
    covariance = tiled_products(rows, "vec", dims, lambda x: fit.centred(integers(x, s)), s) / n
    values, axes = principal(covariance, s.components)
    scaled = axes / np.sqrt(values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, right = matrix(batch.column(1), dims)
            x = integers(x, s)
            w = fit.centred(x) @ scaled
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(right)), pa.array(fit.deviations(x), pa.int64()), lists], ["row", "deviation", "whitened"])

    done = scratch.save(rows.mapInArrow(project, f"row {row_type}, deviation long, whitened array<double>"))
    k = len(values)
    identity_error = 0.0
    if k:
        means = done.select(F.posexplode("whitened").alias("p", "w")).groupBy("p").agg(F.sum("w").alias("w")).orderBy("p").collect()
        mean = np.array([r["w"] for r in means]) / n
        identity_error = float(np.abs(tiled_products(done, "whitened", k, lambda w: w - mean, s) / n - np.eye(k)).max())
    explained = F.array(*[F.lit(float(v)) for v in values / np.trace(covariance)]) if k else F.array().cast("array<double>")
    white = F.struct(F.lit(n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(identity_error).alias("identity_error"))
    return done.select("row.*", white.alias("white"))
