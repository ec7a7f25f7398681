"""The corpus pipeline: language ID, near-dedup, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last
return the columns of ``documents``, whatever the names of those that no stage
reads.  Sharding adds ``shard`` and ``slot``, in place of columns of that name.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillon.llm._arrow import fold
from quillon.llm.decontam import mark_leaks
from quillon.llm.langid import UNKNOWN, identify
from quillon.llm.mix import WORD, pareto_mix
from quillon.llm.neardup import near_duplicates
from quillon.llm.shard import shuffle_into_shards
from quillon.scratch import Scratch

SHARDS = 8
READ = ("doc_id", "text", "lang", "source")
LEAST_SCORE = 0.3
_scratch_of: dict[int, list[Scratch]] = {}


def _plain(docs: DataFrame) -> DataFrame:
    """``docs`` with every column that no stage reads under a name that no stage uses."""
    return docs.toDF(*[c if c in READ else f"extra_{i}" for i, c in enumerate(docs.columns)])


def _stage(number: int) -> Callable:
    """Marks a stage.  When it starts, its ``docs`` have been written by the stage before, so
    the intermediate tables of earlier stages are removed; those of the last stage stay.

    A stage sees the columns that it reads and the others under other names, which it gives back."""

    def wrap(work: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
        @functools.wraps(work)
        def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            for earlier in range(number):
                for scratch in _scratch_of.pop(earlier, []):
                    scratch.remove()
            made = len(Scratch.opened)
            plain = _plain(docs)
            out = work(spark, plain, sf_dir)
            new = [c for c in out.columns if c not in plain.columns]
            old = [F.col(c).alias(name) for c, name in zip(plain.columns, docs.columns) if name not in new]
            out = out.select(*old, *new)
            _scratch_of.setdefault(number, []).extend(Scratch.opened[made:])
            return out

        return stage

    return wrap


@_stage(0)
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no language go: those without a letter or text, and those whose best language the network gives
    less than ``LEAST_SCORE``.

    Null texts go, repeated rows fare alike, ties go to the first language; where nothing
    was learned, the letter rule alone decides.  An empty table gives an empty result.
    """
    nothing_learned = (F.col("lang_pred") == UNKNOWN) & F.col("text").rlike(r"\p{L}")
    named = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return identify(docs, fold("doc_id", 4) != 2).where(named | nothing_learned).select(*docs.columns)


@_stage(1)
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: one row with the smallest id.

    The row is picked among the kept ones, which are several only where rows repeat an id.
    Texts that are null or without words are in no group and all stay.
    """
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    out = near_duplicates(rows, ["doc_id", "text_hash"]).where("dup.kept")
    first = out.groupBy("dup.group").agg(F.min(F.struct("doc_id", "text_hash")).alias("one"))
    grouped = first.where("`group` is not null").select(F.col("one.doc_id").alias("id"), F.col("one.text_hash").alias("hash"))
    text_hash = F.xxhash64("text")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (text_hash == F.col("hash"))
    once = Window.partitionBy("doc_id", text_hash).orderBy("doc_id")
    kept = docs.join(grouped, same, "left_semi").withColumn("_n", F.row_number().over(once)).where("_n = 1")
    empty = docs.where(~F.coalesce(F.col("text").rlike(WORD), F.lit(False)))
    return kept.select(*docs.columns).unionAll(empty.select(*docs.columns))


@_stage(2)
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak an item of the benchmark go; null and empty texts leak none, repeated rows fare alike."""
    return mark_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("not leaked").select(*docs.columns)


@_stage(3)
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay as often as the mix takes them: none to two times; a text without words as often as its source's whole copies."""
    mixed = pareto_mix(docs, docs.columns).where("mix.copies > 0")
    return mixed.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col("mix.copies"))).alias("copy")).select(*docs.columns)


@_stage(4)
def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, whatever its text, gets its shard and its slot in it."""
    return shuffle_into_shards(docs, SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language_id),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("sharding", sharding),
]

#: SQL can't express the trained and the random stages; tests hold each stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and reread as the next one's input."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = scratch.save(docs)
    return docs
