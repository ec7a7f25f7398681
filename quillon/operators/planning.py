"""Splits, quotas and seeded picks.  Randomness is an order by a seeded MD5, the same on every engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.operators.store import numbered


def seeded(seed: int, key: Column) -> Column:
    """Hex MD5 of ``seed:key``: an order that looks random and is reproducible."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))


def uniform(seed: int, key: Column) -> Column:
    """A number in [0, 1) from the first 7 hex digits of the seeded hash."""
    return F.conv(F.left(seeded(seed, key), F.lit(7)), 16, 10).cast("double") / F.lit(float(16**7))


def validation_size(n: Column, ratio: float) -> Column:
    """Rows of a stratum of n that go to validation: half-even rounding, kept within 1 and n - 1 from two rows on."""
    raw = F.bround(n * ratio).cast("int")
    return F.when(n <= 1, raw).otherwise(F.greatest(F.lit(1), F.least(raw, n - 1)))


def stratified_split(df: DataFrame, key: str, stratum: str, ratio: float, seed: int) -> DataFrame:
    """``df`` with ``part``, train or val, by stratum; blank strata are ``__unknown__``.

    The rows of a stratum fall into 256 buckets of the seeded hash; only the
    bucket in which the cut lies is ordered row by row.
    """
    hashed = df.withColumn("_s", F.coalesce(F.nullif(F.trim(stratum), F.lit("")), F.lit("__unknown__"))).withColumn("_h", seeded(seed, F.col(key)))
    hashed = hashed.withColumn("_b", F.conv(F.left("_h", F.lit(2)), 16, 10).cast("int"))
    counts = hashed.groupBy("_s", "_b").agg(F.count(F.lit(1)).alias("_c"))
    own = Window.partitionBy("_s")
    before = F.coalesce(F.sum("_c").over(own.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = validation_size(F.sum("_c").over(own), ratio) - before
    cuts = counts.select(F.col("_s").alias("_cs"), F.col("_b").alias("_cb"), "_c", F.greatest(F.lit(0), F.least(F.col("_c"), left)).alias("_take"))
    placed = hashed.join(cuts, (F.col("_s") == F.col("_cs")) & (F.col("_b") == F.col("_cb")))
    split = F.col("_take").between(1, F.col("_c") - 1)
    whole = placed.where(~split).withColumn("part", F.when(F.col("_take") > 0, "val").otherwise("train"))
    rank = F.row_number().over(Window.partitionBy("_s", "_b").orderBy("_h", key))
    cut = placed.where(split).withColumn("part", F.when(rank <= F.col("_take"), "val").otherwise("train"))
    return whole.unionByName(cut).drop("_s", "_h", "_b", "_cs", "_cb", "_c", "_take")


def split_report(parts: DataFrame, ratio: float) -> DataFrame:
    """One row over a table with ``part``: ``total``, ``train``, ``val`` and the ``ratio`` asked for."""
    of = lambda name: F.count_if(F.col("part") == name)
    return parts.agg(F.count(F.lit(1)).alias("total"), of("train").alias("train"), of("val").alias("val")).withColumn("ratio", F.lit(ratio))


def first_rows(df: DataFrame, order: str, n: int) -> DataFrame:
    """The first ``n`` rows in the order of the file; all of them for 0."""
    return df.orderBy(order).limit(n) if n else df


def rows_at(df: DataFrame, order: str, places: list[int]) -> DataFrame:
    """``asked`` and the row at each of a few places (from 0) in the order of a whole number, held within the table."""
    asked = df.sparkSession.createDataFrame([(p,) for p in places], "asked long")
    last = df.agg((F.count(F.lit(1)) - 1).alias("last"))
    wanted = asked.join(F.broadcast(last)).select("asked", F.greatest(F.lit(0), F.least("asked", "last")).alias("_at"))  # one row
    return numbered(df, order, "_n").join(F.broadcast(wanted), F.col("_n") == F.col("_at")).select("asked", *df.columns)


def random_split(df: DataFrame, key: str, ratio: float, seed: int, buckets: int = 256) -> DataFrame:
    """``df`` with ``part``: the first rows in seeded order are val.

    Only the bucket of the hash in which the cut lies is ordered row by row.
    """
    n = df.count()
    k = 0 if n == 0 else (round(n * ratio) if n == 1 else max(1, min(n - 1, round(n * ratio))))
    hashed = df.withColumn("_h", seeded(seed, F.col(key))).withColumn("_b", F.conv(F.left("_h", F.lit(2)), 16, 10).cast("int"))
    left, cut = k, buckets
    for row in hashed.groupBy("_b").count().orderBy("_b").collect():
        if row["count"] > left:
            cut = row["_b"]
            break
        left -= row["count"]
    rank = F.row_number().over(Window.partitionBy("_b").orderBy("_h", key))
    inside = hashed.where(F.col("_b") == cut).withColumn("part", F.when(rank <= left, "val").otherwise("train"))
    outside = hashed.where(F.col("_b") != cut).withColumn("part", F.when(F.col("_b") < cut, "val").otherwise("train"))
    return outside.unionByName(inside).drop("_h", "_b")


def allocate_quota(shares: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """``key`` and ``quota`` by largest remainder, at least 1 each if the total allows; ties go to the later key.

    ``shares`` is a small table of groups in key order.
    """
    everything = Window.partitionBy()
    raw = F.col(weight) * total / F.sum(weight).over(everything)
    floor = F.greatest(F.floor("raw"), F.when(F.lit(total) >= F.count(F.lit(1)).over(everything), 1).otherwise(0)).cast("long")
    base = shares.withColumn("raw", raw).withColumn("base", floor).withColumn("part", F.col("raw") - F.floor("raw"))
    base = base.withColumn("rest", F.lit(total) - F.sum("base").over(everything)).withColumn("groups", F.count(F.lit(1)).over(everything))
    up = F.row_number().over(Window.orderBy(F.col("part").desc(), F.col(key).desc()))
    room = base.withColumn("up", up).withColumn("down", F.row_number().over(Window.orderBy((F.col("base") <= 1), "part", key)))
    quota = (
        F.when(F.col("rest") >= 0, F.col("base") + F.floor(F.col("rest") / F.col("groups")) + (F.col("up") <= F.col("rest") % F.col("groups")).cast("long"))
        .otherwise(F.col("base") - (F.col("down") <= -F.col("rest")).cast("long"))
    )
    return room.select(key, quota.alias("quota"))


def weighted_pick(u: Column, choices: list[tuple[str, float]]) -> Column:
    """The choice in whose share of the total weight a uniform number falls."""
    total, upto, steps = sum(w for _, w in choices), 0.0, []
    for name, w in choices[:-1]:
        upto += w
        steps.append(F.when(u < upto / total, F.lit(name)))
    return F.coalesce(*steps, F.lit(choices[-1][0]))


def expand(df: DataFrame, times: str, at: str = "occurrence") -> DataFrame:
    """Every row as often as its count says, with the occurrence from 0; none for null or less than one."""
    return df.where(F.col(times) > 0).withColumn(at, F.explode(F.sequence(F.lit(0), F.col(times) - 1)))


def cyclic_pick(variants: list[str], at: Column) -> Column:
    """The variant at a position, counting around."""
    return F.get(F.array(*[F.lit(v) for v in variants]), F.pmod(at, F.lit(len(variants))).cast("int"))


def fill_quota(df: DataFrame, group: str, order: str, valid: Column, quota: int) -> DataFrame:
    """The first ``quota`` valid rows of each group; fewer where there are fewer."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(order))
    return df.where(valid).withColumn("rank", rank).where(F.col("rank") <= quota)


def unseen(new: DataFrame, seen: DataFrame, text: str) -> DataFrame:
    """Rows of ``new`` whose text, white space aside, is not in ``seen``."""
    from quillon.functions.text import squeezed

    known = seen.select(squeezed(F.col(text)).alias("_k")).distinct()
    return new.join(known, squeezed(F.col(text)) == F.col("_k"), "left_anti")
