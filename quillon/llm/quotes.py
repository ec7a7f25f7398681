"""Quotation linking: replies joined to the messages that they quote.

Lines that begin with ``>`` marks are quoted; the number of marks is their
level.  Consecutive lines of one level are a quoted passage.  A passage, and
each of its lines, is lower-cased, its white space collapsed, and hashed; the
messages of the same conversation offer the hashes of their own whole text,
paragraphs and lines.  A passage belongs to the latest earlier message that
offers it whole, else to the latest that offers one of its lines; of several at
that turn, to the first stored.  A message's parent is what its outermost
passages (level 1) belong to, the latest if several.

Conversations are put in reply order: threads by the turn of their first
message, and by turn within a thread, without the quoted lines.  Parents are
followed from message to message, so several at one turn stay apart.  Messages
without a ``>`` line are not split into lines unless their conversation holds a
quotation.  No conversation and no passage meets in one task: the latest
earlier message is found within ranges of turns, one row a turn and passage, and
carried over ranges, and positions are counted after a sort by ranges.

Everything is DataFrame operations.

Defined results: a null or empty text is an empty message; a text that is all
quotes has an empty body; repeated rows are messages of their own at one turn,
each with its own position; rows with a null ``conv_id`` form one conversation
and a null ``turn`` stands before all others, quotes nothing and is not quoted;
an empty table gives an empty result; columns other than ``conv_id``, ``turn``,
``role`` and ``text`` are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillon.scratch import Scratch

QUOTED = r"^[ \t]*>"
MARKS = r"^((?:[ \t]*>)+)"
TURNS = 4096


def normal(text: Column) -> Column:
    """Lower case, with white space collapsed and none around."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def _lines(text: str | Column) -> Column:
    return F.split(F.regexp_replace(F.coalesce(text, F.lit("")), "\r\n?", "\n"), "\n")


def body_of(text: str) -> Column:
    """A message without its quoted lines and the blank lines around what is left."""
    own = F.filter(_lines(F.col(text)), lambda x: ~x.rlike(QUOTED))
    plain = ~F.coalesce(F.col(text).rlike(f"(?m){QUOTED}"), F.lit(False))
    return F.when(plain, F.coalesce(text, F.lit(""))).otherwise(F.regexp_replace(F.array_join(own, "\n"), r"^\s+|\s+$", ""))


def quoted_passages(messages: DataFrame) -> DataFrame:
    """``uid``, ``conv``, ``turn``, ``place``, ``level`` and ``lines`` of every quoted passage."""
    some = messages.where(F.col("text").rlike(f"(?m){QUOTED}") & F.col("turn").isNotNull())
    lines = some.select("uid", "conv", "turn", F.posexplode(_lines(F.col("text"))).alias("at", "line"))
    marks = F.regexp_extract("line", MARKS, 1)
    lines = lines.withColumn("level", F.length(F.regexp_replace(marks, "[^>]", ""))).withColumn("line", F.regexp_replace("line", MARKS, ""))
    own = Window.partitionBy("uid").orderBy("at")
    starts = F.when(F.col("level") == F.lag("level").over(own), 0).otherwise(1)
    runs = lines.withColumn("s", starts).withColumn("place", F.sum("s").over(own))
    passages = runs.where("level > 0").groupBy("uid", "conv", "turn", "place", "level")
    return passages.agg(F.array_sort(F.collect_list(F.struct("at", "line"))).alias("lines"))


def _keys_of(whole: Column, lines: Column) -> Column:
    """Hashes of a text and of its lines, as (whole, hash), empty ones left out."""
    one = F.array(F.struct(F.lit(True).alias("whole"), normal(whole).alias("t")))
    each = F.transform(lines, lambda x: F.struct(F.lit(False).alias("whole"), normal(x).alias("t")))
    kept = F.filter(F.concat(one, each), lambda x: F.length(x["t"]) > 0)
    return F.array_distinct(F.transform(kept, lambda x: F.struct(x["whole"].alias("whole"), F.xxhash64(x["t"]).alias("h"), F.crc32(x["t"].cast("binary")).alias("c"))))


def offered(messages: DataFrame) -> DataFrame:
    """``conv``, ``turn``, ``h`` and ``c`` of each message's whole body, paragraphs and lines, with the first ``uid`` that has them."""
    bodies = messages.where(F.col("turn").isNotNull()).select("uid", "conv", "turn", body_of("text").alias("body"))
    pieces = F.concat(F.array("body"), F.split("body", r"\n[ \t]*\n"), F.split("body", "\n"))
    pieces = F.array_distinct(F.filter(F.transform(pieces, normal), lambda x: F.length(x) > 0))
    exploded = bodies.select("uid", "conv", "turn", F.explode(pieces).alias("t"))
    named = exploded.select("uid", "conv", "turn", F.xxhash64("t").alias("h"), F.crc32(F.col("t").cast("binary")).alias("c"))
    return named.groupBy("conv", "turn", "h", "c").agg(F.min("uid").alias("uid"))


def latest_before(asked: DataFrame, offers: DataFrame) -> DataFrame:
    """``conv``, ``h``, ``c``, ``turn`` of ``asked``, once each, with ``found``: turn and negated
    uid of the offer of the hash at the latest smaller turn, or null.

    An as-of join in ranges of ``TURNS`` turns: the latest offer within the
    range, else the latest of the ranges before.  Either side has one row a
    turn and hash, so a range holds ``2 * TURNS`` rows at most.
    """
    kind = "struct<turn: bigint, back: bigint>"  # the largest is the latest turn's first message
    left = asked.select("conv", "h", "c", "turn").distinct().select("conv", "h", "c", "turn", F.lit(None).cast(kind).alias("o"))
    right = offers.select("conv", "h", "c", "turn", F.struct("turn", -F.col("uid")).cast(kind).alias("o"))
    both = left.unionAll(right).withColumn("range", F.floor(F.col("turn") / TURNS))
    order = [F.col("turn"), F.col("o").isNotNull()]
    within = Window.partitionBy("conv", "h", "c", "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("conv", "h", "c").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = both.groupBy("conv", "h", "c", "range").agg(F.max("o").alias("m")).select("conv", "h", "c", "range", F.max("m").over(before).alias("m"))
    near = both.withColumn("w", F.last("o", ignorenulls=True).over(within)).where("o is null")
    on = [near["conv"].eqNullSafe(carried["conv"]), near["h"] == carried["h"], near["c"] == carried["c"], near["range"] == carried["range"]]
    return near.join(carried, on).select(near["conv"], near["h"], near["c"], near["turn"], F.coalesce("w", "m").alias("found"))


def _thread_starts(parents: DataFrame, scratch: Scratch) -> DataFrame:
    """``uid``, ``root`` and ``root_turn`` of every reply (``uid``, ``parent``: turn and negated uid); each jump halves the way to the first message."""
    current = scratch.save(parents.select("uid", (-F.col("parent.back")).alias("root"), F.col("parent.turn").alias("root_turn")))
    while True:
        up = current.select(F.col("uid").alias("up"), F.col("root").alias("above"), F.col("root_turn").alias("above_turn"))
        joined = current.join(up, F.col("root") == F.col("up"), "left")
        moved = scratch.save(joined.select("uid", F.coalesce("above", "root").alias("root"), F.coalesce("above_turn", "root_turn").alias("root_turn"), F.col("above").isNotNull().alias("moved")))
        scratch.drop(current)
        current = moved
        if current.where("moved").isEmpty():
            return current.drop("moved")


def reply_ordered(messages: DataFrame) -> DataFrame:
    """One row a message: ``conv_id``, ``turn``, ``role``, ``body``, ``n_quoted``,
    ``n_linked``, ``quote_levels``, ``parent_turn``, ``root_turn`` and
    ``position`` (from 0, in reply order within the conversation), and ``chat``,
    the body in its role's frame.  ``n_quoted`` counts passages, ``n_linked``
    those that belong to an earlier message."""
    scratch = Scratch(messages.sparkSession)
    kept = scratch.save(messages.select(F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), "role", "text", F.monotonically_increasing_id().alias("uid")))
    passages = scratch.save(quoted_passages(kept))
    if passages.isEmpty():
        quoted = kept.select("conv", "turn", "role", "text", "uid", *[F.lit(0).cast("long").alias(c) for c in ("n_quoted", "n_linked")], F.lit(0).alias("quote_levels"), F.lit(None).cast("long").alias("parent"), F.col("uid").alias("root"), F.col("turn").alias("root_turn"))
    else:
        quoted = _linked(kept, passages, scratch)
    order = ["conv", "root_turn", "root", "turn", "uid"]
    ordered = quoted.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = scratch.save(ordered.withColumn("id", F.monotonically_increasing_id()).withColumn("part", F.shiftright("id", 33)))
    scratch.keep_only(placed)
    parts = placed.groupBy("conv", "part").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("conv").alias("of"), F.col("part").alias("p"), "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    out = placed.join(parts, F.col("conv").eqNullSafe(F.col("of")) & (F.col("part") == F.col("p")))
    body = body_of("text")
    return out.select(
        F.col("conv").alias("conv_id"), "turn", "role", body.alias("body"), "n_quoted", "n_linked", "quote_levels",
        F.col("parent").alias("parent_turn"), "root_turn", (F.col("base") + F.col("id") - F.col("first")).alias("position"),
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), body, F.lit("\n<|end|>")).alias("chat"),
    )


def _linked(kept: DataFrame, passages: DataFrame, scratch: Scratch) -> DataFrame:
    """The messages with what their passages belong to."""
    texts = F.transform("lines", lambda x: x["line"])
    asked = passages.select("uid", "conv", "turn", "place", "level", F.explode(_keys_of(F.array_join(texts, "\n"), texts)).alias("k"))
    asked = asked.select("uid", "conv", "turn", "place", "level", "k.whole", "k.h", "k.c")
    convs = passages.select(F.col("conv").alias("quoting")).distinct()
    offers = offered(kept.join(convs, F.col("conv").eqNullSafe(F.col("quoting")), "left_semi"))
    latest = latest_before(asked, offers)
    on = [asked["conv"].eqNullSafe(latest["conv"]), *[asked[c] == latest[c] for c in ("h", "c", "turn")]]
    found = asked.join(latest, on).select("uid", "place", "level", "whole", "found").groupBy("uid", "place", "level")
    found = found.agg(F.coalesce(F.max(F.when(F.col("whole"), F.col("found"))), F.max("found")).alias("to"))
    found = scratch.save(found)
    parents = found.where("level = 1 and `to` is not null").groupBy("uid").agg(F.max("to").alias("parent"))
    roots = _thread_starts(parents, scratch)
    links = found.groupBy("uid").agg(F.count("to").alias("n_linked"))
    counts = passages.groupBy("uid").agg(F.count(F.lit(1)).alias("n_quoted"), F.max("level").alias("quote_levels"))
    out = kept.join(counts, "uid", "left").join(links, "uid", "left").join(parents.select("uid", F.col("parent.turn").alias("parent")), "uid", "left")
    out = out.join(roots, "uid", "left")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_quoted", "n_linked", "quote_levels")]
    thread = F.when(F.col("root").isNotNull(), F.col("root_turn")).otherwise(F.col("turn"))
    return out.select("conv", "turn", "role", "text", "uid", *zero, "parent", F.coalesce("root", "uid").alias("root"), thread.alias("root_turn"))
