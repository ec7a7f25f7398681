"""Distributions, duplicates, examples and lengths of a data set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.functions.text import count_words, let
from quillon.scratch import Scratch


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b, or 0.0 where that is undefined."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    """``field``, ``key`` and ``n`` for several columns in one pass; null is the key ``None``."""
    fields = F.explode(F.array(*[F.struct(F.lit(k).alias("field"), F.coalesce(F.col(k).cast("string"), F.lit("None")).alias("key")) for k in keys]))
    return df.select(fields.alias("f")).groupBy("f.field", "f.key").agg(F.count(F.lit(1)).alias("n"))


def unnested_counts(df: DataFrame, items: str) -> DataFrame:
    """``item`` and ``n`` over all elements of an array column."""
    return df.select(F.explode(items).alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n"))


def share(df: DataFrame, flag: Column) -> DataFrame:
    """``total``, ``hits`` and ``ratio`` of the rows where the flag holds."""
    hits = F.count_if(F.coalesce(flag, F.lit(False)))
    return df.agg(F.count(F.lit(1)).alias("total"), hits.alias("hits"), safe_ratio(hits, F.count(F.lit(1))).alias("ratio"))


def duplicate_groups(df: DataFrame, text: Column, order: str, blank: bool = False) -> DataFrame:
    """``text``, ``n`` and ``first`` (smallest order) of each text that occurs more than once.

    The text is computed once a row and counted by 128-bit hashes with partial
    sums; the texts of groups alone are read again, by the row that comes first.
    """
    scratch = Scratch(df.sparkSession)
    computed = df.select(let(text, lambda t: F.struct(t.alias("text"), F.xxhash64(t).alias("a"), F.xxhash64(F.lit(1), t).alias("b"))).alias("x"), F.col(order).alias("o"))
    keyed = scratch.save(computed.where("x.text is not null" if blank else "x.text <> ''").select("x.*", "o"))
    groups = keyed.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.min("o").alias("first")).where("n > 1")
    named = keyed.select(F.col("a").alias("ka"), F.col("b").alias("kb"), "o", "text")
    found = groups.join(named, (F.col("a") == F.col("ka")) & (F.col("b") == F.col("kb")) & (F.col("o") == F.col("first")))
    return found.groupBy("a", "b", "n", "first").agg(F.min("text").alias("text")).select("text", "n", "first")


def last_of_role(df: DataFrame, conversation: str, turn: str, role: str, wanted: str, text: str) -> DataFrame:
    """``conversation``, ``turn`` and text (``said``) of the last message of a role, and how many it has (``n``); one row a
    conversation, by partial maxima."""
    own = F.col(role) == wanted
    return df.groupBy(conversation).agg(F.max(F.when(own, F.col(turn))).alias("turn"), F.max_by(text, F.when(own, F.col(turn))).alias("said"), F.count_if(F.coalesce(own, F.lit(False))).alias("n"))


def surplus(groups: DataFrame) -> DataFrame:
    """``groups`` and ``surplus`` (copies beyond the first) of a table of duplicate groups."""
    return groups.agg(F.count(F.lit(1)).alias("groups"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus"))


def top_duplicates(groups: DataFrame, k: int) -> DataFrame:
    """The k largest groups; ties go to the one that appears first."""
    return groups.orderBy(F.col("n").desc(), "first").limit(k)


def examples(df: DataFrame, group: str, text: str, order: str, k: int) -> DataFrame:
    """``group``, ``rank`` and ``text`` of the first k distinct non-empty texts of each group, in row order."""
    once = df.where(F.coalesce(F.col(text), F.lit("")) != "").groupBy(group, text).agg(F.min(order).alias("o"))
    ranked = once.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy("o")))
    return ranked.where(F.col("rank") <= k).select(F.col(group).alias("group"), "rank", F.col(text).alias("text"))


def word_lengths(df: DataFrame, text: str, *by: str) -> DataFrame:
    """``n``, ``min_words``, ``max_words`` and ``avg_words`` (one decimal, half to even), 0 for an empty table."""
    words = count_words(F.col(text))
    zero = lambda c: F.coalesce(c, F.lit(0))
    aggs = [F.count(F.lit(1)).alias("n"), zero(F.min(words)).alias("min_words"), zero(F.max(words)).alias("max_words"), F.coalesce(F.bround(F.avg(words), 1), F.lit(0.0)).alias("avg_words")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def shortfall(df: DataFrame, domain: DataFrame, key: str, target: int) -> DataFrame:
    """``key``, ``got`` and ``missing`` for every value of a fixed domain, zero-filled."""
    got = df.groupBy(key).agg(F.count(F.lit(1)).alias("got"))
    return domain.join(got, key, "left").select(key, F.coalesce("got", F.lit(0)).alias("got"), F.greatest(F.lit(target) - F.coalesce("got", F.lit(0)), F.lit(0)).alias("missing"))


def success_rates(df: DataFrame, tool_ok: str, answer_ok: str, *by: str) -> DataFrame:
    """``total``, ``tool_success_rate`` and ``answer_accuracy``, also by columns; null verdicts count as failures."""
    rate = lambda c: safe_ratio(F.count_if(F.coalesce(F.col(c), F.lit(False))), F.count(F.lit(1)))
    aggs = [F.count(F.lit(1)).alias("total"), rate(tool_ok).alias("tool_success_rate"), rate(answer_ok).alias("answer_accuracy")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def total_shortfall(gaps: DataFrame) -> DataFrame:
    """One row over a ``shortfall`` table: ``got`` and ``missing`` over all values."""
    return gaps.agg(F.coalesce(F.sum("got"), F.lit(0)).alias("got"), F.coalesce(F.sum("missing"), F.lit(0)).alias("missing"))


def table_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """``line``: the rows of a small report as padded text, header first; rows keep the order of the columns given."""
    wide = df.agg(*[F.greatest(F.lit(len(c)), F.coalesce(F.max(F.length(F.coalesce(F.col(c).cast("string"), F.lit("None")))), F.lit(0))).alias(c) for c in columns]).first()
    cell = lambda c, name: F.rpad(F.coalesce(c.cast("string"), F.lit("None")), int(wide[name]), " ")
    head = df.sparkSession.range(1).select(F.lit(0).alias("o"), *[cell(F.lit(c), c).alias(c) for c in columns])
    body = df.select(F.lit(1).alias("o"), *[cell(F.col(c), c).alias(c) for c in columns])
    return head.unionByName(body).orderBy("o", *columns).select(F.rtrim(F.concat_ws("  ", *columns)).alias("line"))
