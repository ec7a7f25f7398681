"""Mixing sources to target weights by Pareto order sampling.

Sources, by code point with null last, weigh 3, 1, 2, repeating, and share
150 % of all words; a target stops at twice its source's words, and the excess
goes to the others by weight.  Each document gets the whole copies that its
source's ratio of target to words makes certain.  The rest of the target goes
to a sample of unequal inclusion probabilities, which fall with the root of a
document's size, so that the rest is spread over more documents: by half
octaves of size, ``min(1, c * size ** -0.5)``, with ``c`` such that the words
expected are exactly the rest.  Documents of probability 1 are certain too.

Documents rank by the odds of a uniform number over the odds of their
inclusion and are taken in that order.  The size that is fixed is that of the
sample in words: it ends at the document nearest to the rest of the target.

Certain and impossible documents are not ranked: a source at its cap takes whole
copies alone and orders nothing.  The cut among the others is found from sums
over ranges of the ranking key, so only one range of each source is ordered row
by row and no source meets in one task.  What is
known of sources (one row for each) and of their size classes (at most 130
rows for each) is broadcast up to ``BROADCAST_ROWS`` rows and joined by a
shuffle beyond; the targets themselves are computed in one task over one row a
source.

Defined results: a null text has 0 words and is taken 0 words; a source without
words has target 0; equal rows tie and any of them may be the one taken; an
empty table gives an empty result; only the columns named in ``keep`` come back,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.scratch import Scratch

RANGES = 1024  # for each doubling of the rank
BROADCAST_ROWS = 100_000
WEIGHTS = (3, 1, 2)
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, share: float = 1.5, most: int = 2) -> DataFrame:
    """``source``, ``source_size`` and ``target`` from one row of words a source.

    A target is the smaller of ``most`` times the source's words and its weight
    times a common level, which is the first that the capped sources allow.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.withColumn("w", F.get(F.array(*[F.lit(w) for w in WEIGHTS]), (F.row_number().over(order) - 1) % len(WEIGHTS)))
    everything = Window.partitionBy()
    by_cap = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    upto = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_cap.rowsBetween(0, Window.unboundedFollowing)
    levels = weighed.withColumn("cap", F.col("source_size") * most).withColumn(
        "level",
        (F.sum("source_size").over(everything) * share - F.coalesce(F.sum("cap").over(upto), F.lit(0))) / F.sum("w").over(onward),
    )
    fits = F.when(F.col("level") * F.col("w") <= F.col("cap"), F.col("level"))
    level = F.max(fits).over(everything)  # a source capped too early lowers the level of the rest
    return levels.select("source", "source_size", F.least(F.col("cap").cast("double"), level * F.col("w")).alias("target"))


def pareto_mix(docs: DataFrame, keep: list[str], seed: int = 5, share: float = 1.5) -> DataFrame:
    """Columns ``keep`` of every row of ``docs`` and ``mix``, a struct of
    ``size``, ``source_size``, ``target`` and ``copies`` (0 to 2).

    ``docs`` needs ``doc_id``, ``text`` and ``source``.
    """
    placed = ranked(docs, keep, seed, share)
    at_cut = placed.where(F.col("range") == F.col("cut")).select("uid", "of", "u", "part", "size", "left_over", "base")
    inside = Window.partitionBy("of").orderBy(_pareto_rank("u", "part"), "uid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.col("base") + F.sum("size").over(inside) - F.col("size") / 2
    taken = at_cut.withColumn("in_cut", middle <= F.col("left_over")).where("in_cut").select(F.col("uid").alias("cut_uid"))
    won = F.col("cut").isNull() | (F.col("range") < F.col("cut")) | F.col("cut_uid").isNotNull()
    extra = F.when(F.col("part") <= 0, 0).when(F.col("part") >= 1, 1).when(won, 1).otherwise(0)
    return placed.join(taken, F.col("uid") == F.col("cut_uid"), "left").select(
        "r.*", F.struct("size", "source_size", "target", (F.col("whole") + extra).cast("int").alias("copies")).alias("mix")
    )


def ranked(docs: DataFrame, keep: list[str], seed: int, share: float) -> DataFrame:
    """Every row as ``r`` with what its copies follow from: ``whole``, ``part``, the ``range`` of its rank and the ``cut`` of its
    source, the range in which the sample ends (null where none does)."""
    scratch = Scratch(docs.sparkSession)
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "source", "text"), 11).cast("double") + 0.5) * F.lit(2.0**-53)
    sized = scratch.save(
        docs.select(
            F.struct(*[docs[c].alias(c) for c in keep]).alias("r"),
            F.col("source"),
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            uniform.alias("u"),
            F.monotonically_increasing_id().alias("uid"),
        )
    )
    classes = scratch.save(sized.groupBy("source", _size_class("size").alias("class")).agg(F.sum("size").alias("words")))
    totals = source_targets(classes.groupBy("source").agg(F.sum("words").alias("source_size")), share)
    parts = scratch.save(inclusion(classes, totals))
    scratch.drop(classes)
    known = F.broadcast(parts) if parts.count() <= BROADCAST_ROWS else parts
    same = F.col("source").eqNullSafe(F.col("of")) & (_size_class("size") == F.col("class"))
    rows = sized.join(known, same).drop("source", "class")
    # only documents that chance decides are ranked: what is certain or impossible needs no order
    drawn = F.when((F.col("part") > 0) & (F.col("part") < 1), _range_of(_pareto_rank("u", "part")))
    rows = rows.withColumn("range", drawn)
    sums = rows.where("range is not null").groupBy("of", "range").agg(F.sum("size").alias("words"), F.first("left_over").alias("left_over"))
    before = Window.partitionBy("of").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("base", F.coalesce(F.sum("words").over(before), F.lit(0)))
    cuts = sums.where((F.col("base") <= F.greatest("left_over", F.lit(0.0))) & (F.col("base") + F.col("words") > F.col("left_over"))).groupBy(F.col("of").alias("cut_of"))
    cuts = cuts.agg(F.min(F.struct("range", "base")).alias("m")).select("cut_of", F.col("m.range").alias("cut"), "m.base")
    return rows.join(cuts, F.col("of").eqNullSafe(F.col("cut_of")), "left").drop("cut_of")


def _size_class(size: str) -> Column:
    """Half octaves of size; -1 for no words."""
    return F.when(F.col(size) > 0, F.floor(2 * F.log2(F.col(size)))).otherwise(-1).cast("int")


def inclusion(classes: DataFrame, totals: DataFrame) -> DataFrame:
    """``of`` (source), ``class``, ``source_size``, ``target``, ``whole``, ``part``, the probability of one copy more, and
    ``left_over``, the words of the rest that those of probability 1 leave to the others.

    ``c`` is the largest level at which the classes that stay under 1 take
    what those at 1, which come first, leave of the rest.
    """
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(ratio)
    rest = totals.select(F.col("source").alias("of"), "source_size", "target", whole.alias("whole"), ((ratio - whole) * F.col("source_size")).alias("wanted"))
    rows = classes.join(rest, F.col("source").eqNullSafe(F.col("of"))).drop("source").withColumn("w", F.pow(F.lit(2.0), -F.col("class") / 4))
    order = Window.partitionBy("of").orderBy("class")
    before = F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    onward = F.sum(F.col("w") * F.col("words")).over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rows = rows.withColumn("level", F.when(onward > 0, (F.col("wanted") - before) / onward))
    c = F.max(F.when(F.col("level") * F.col("w") <= 1, F.col("level"))).over(Window.partitionBy("of"))
    part = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(c, F.lit(0.0)) * F.col("w")))
    rows = rows.withColumn("part", part)
    certain = F.coalesce(F.sum(F.when(F.col("part") >= 1, F.col("words"))).over(Window.partitionBy("of")), F.lit(0))
    return rows.select("of", "class", "source_size", "target", "whole", "part", (F.col("wanted") - certain).alias("left_over"))


def _pareto_rank(u: str, part: str) -> Column:
    """Odds of the uniform number over the inclusion odds, for a probability between 0 and 1."""
    return F.col(u) / (1 - F.col(u)) * (1 - F.col(part)) / F.greatest(F.col(part), F.lit(1e-300))


def _range_of(rank: Column) -> Column:
    """The range, in rank order, that holds the rank: so many a doubling, so that no range holds over a thousandth of a source."""
    return F.floor(F.log2(F.greatest(rank, F.lit(1e-300))) * RANGES).cast("int")
