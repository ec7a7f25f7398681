"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

Rows are numbered once and written to the shared folder, in blocks of up to
65536 neighbours.  The driver draws, block by block, how many of its rows each
shard gets: the multivariate hypergeometric law of a uniform permutation cut
into shards whose sizes differ by one at most.  Each block is permuted on its
own, its rows are sent to their shards, and each shard is permuted again, in
ranges of a random key, so that no task holds a whole shard.  Permutations move
row numbers; the rows themselves are exchanged once, at the end.

Defined results: null and empty texts are rows like any other; repeated rows
are dealt one by one; an empty table gives an empty result; columns of the
input keep their names, and only ``shard`` and ``slot`` are replaced.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.scratch import Scratch

BLOCK_BITS = 16
RANGE_ROWS = 4096
NUMPY_LIMIT = 10**9  # above it numpy's generator refuses


def communication_matrix(block_rows: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows that each block sends to each shard, drawn exactly.

    Column sums are the shard sizes, which differ by one at most.
    """
    rng = np.random.Generator(np.random.PCG64(seed))
    total = sum(block_rows)
    room = np.array([total // shards + (j < total % shards) for j in range(shards)], dtype=np.int64)
    drawn = []
    for rows in block_rows:
        row = [0] * shards
        left, rest = rows, int(room.sum())
        for j in range(shards):
            others = rest - int(room[j])
            row[j] = left if not others else _hypergeometric(rng, int(room[j]), others, left)
            left -= row[j]
            rest = others
        room -= np.array(row)
        drawn.append(row)
    return drawn


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """One hypergeometric draw, by numpy's generator where it takes numbers so large."""
    if max(good, bad) < NUMPY_LIMIT:
        return int(rng.hypergeometric(good, bad, draws)) if draws else 0
    return _by_inversion(rng, good, bad, draws)


def _by_inversion(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """One hypergeometric draw for populations of any size.

    Relative probabilities go out from the mode by their exact ratios; beyond 14
    deviations on either side lies less than rounding can show.
    """
    total = good + bad
    least, most = max(0, draws - bad), min(draws, good)
    mode = (draws + 1) * (good + 1) // (total + 2)
    reach = 20 + int(14 * math.sqrt(draws * (good / total) * (bad / total)))
    lo, hi = max(least, mode - reach), min(most, mode + reach)
    k = np.arange(lo, hi, dtype=np.float64)
    up = (good - k) / (k + 1) * (draws - k) / (bad - draws + k + 1)  # chance of k + 1 over that of k
    right = np.cumprod(up[mode - lo :])
    left = np.cumprod(1 / up[: mode - lo][::-1])[::-1]
    law = np.cumsum(np.concatenate([left, [1.0], right]))
    return lo + min(int(np.searchsorted(law, rng.random() * law[-1], "right")), hi - lo)


def shuffle_into_shards(docs: DataFrame, shards: int = 8, seed: int = 11) -> DataFrame:
    """``docs`` with ``shard`` (int, 0 to shards - 1) and ``slot`` (long, gapless from 0 in each shard)."""
    names = [c for c in docs.columns if c not in ("shard", "slot")]
    row = F.struct(*[docs[c].alias(c) for c in names])
    scratch = Scratch(docs.sparkSession)
    kept = scratch.save(docs.select(row.alias("r"), F.monotonically_increasing_id().alias("uid")))
    own = kept.select("uid", F.shiftright("uid", BLOCK_BITS).alias("block"))
    blocks = own.groupBy("block").count().orderBy("block").collect()
    matrix = communication_matrix([b["count"] for b in blocks], shards, seed)
    bounds = [(b["block"], [int(x) for x in np.cumsum(m)]) for b, m in zip(blocks, matrix, strict=True)]
    bounds = docs.sparkSession.createDataFrame(bounds, "block long, upto array<long>")
    local = Window.partitionBy("block").orderBy(F.xxhash64(F.lit(seed), "uid"), "uid")
    total = sum(b["count"] for b in blocks)
    ranges = max(1, -(-total // (shards * RANGE_ROWS)))
    sent = (
        own.withColumn("n", F.row_number().over(local))
        .join(bounds, "block")
        .select("uid", F.size(F.filter("upto", lambda x: x < F.col("n"))).alias("shard"))
        .withColumn("order", F.xxhash64(F.lit(seed + 1), "uid"))
        .withColumn("range", _range_of("order", ranges))
    )
    sent = scratch.save(sent)
    counts = sent.groupBy("shard", "range").count()
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("shard", "range").orderBy("order", "uid")
    placed = sent.withColumn("n", F.row_number().over(within)).join(offsets, ["shard", "range"])
    slots = placed.select("uid", "shard", (F.col("base") + F.col("n") - 1).cast("long").alias("slot"))
    return kept.join(slots, "uid").select("r.*", "shard", "slot")


def _range_of(key: str, ranges: int) -> Column:
    """Which of so many equal ranges of signed 64-bit keys holds the key, in key order."""
    share = (F.col(key).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.least(F.floor(share * ranges).cast("int"), F.lit(ranges - 1))
