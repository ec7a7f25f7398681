"""Connected components of an edge table by hooking to the smallest neighbour and contracting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node`` and ``root`` (smallest node of its component) from ``a`` and ``b`` (long).

    Nodes without edges are absent; loops and repeated edges are allowed; null
    ends are ignored.  Each round hooks every node to its smallest neighbour,
    shortens the pointers to their roots and keeps the edges between roots, so
    the number of roots at least halves.
    """
    left = scratch.save(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = None
    while True:
        both = left.select("a", "b").unionAll(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("root"))
        parents = _to_roots(scratch.save(parents), scratch)
        labels = parents if labels is None else scratch.save(_moved(labels, parents, "root"))
        near = _moved(_moved(left, parents, "a"), parents, "b").where("a <> b")
        left = scratch.save(near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        if left.isEmpty():
            return labels


def _to_roots(parents: DataFrame, scratch: Scratch) -> DataFrame:
    """Follow pointers until each node points at its root; a turn makes the way four times as short."""
    while True:
        up = lambda n: parents.select(F.col("node").alias(f"at_{n}"), F.col("root").alias(f"next_{n}"))  # noqa: E731, B023
        twice = parents.join(up(1), F.col("root") == F.col("at_1"))
        upper = up(2).join(up(3), F.col("next_2") == F.col("at_3")).select("at_2", F.col("next_3").alias("top"))
        twice = twice.join(upper, F.col("next_1") == F.col("at_2"))
        jumped = scratch.save(twice.select("node", F.col("top").alias("root"), (F.col("top") != F.col("next_1")).alias("moved")))
        scratch.drop(parents)
        parents = jumped
        if parents.where("moved").isEmpty():
            return parents.select("node", "root")


def _moved(table: DataFrame, parents: DataFrame, column: str) -> DataFrame:
    """``table`` with a node column replaced by its root, where it has one."""
    to = parents.select(F.col("node").alias("at"), F.col("root").alias("to"))
    return table.join(to, table[column] == F.col("at"), "left").withColumn(column, F.coalesce("to", table[column])).drop("at", "to")
