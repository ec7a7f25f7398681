"""Due reminders: the predicate, poll ticks in batch, and a stateful stream that notifies once a window."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quillon.operators.replay import running


def is_due(scheduled: Column, now: Column, lead_minutes: int, active: Column, notified: Column | None = None) -> Column:
    """Whether an active reminder is within its lead time and was not notified within it; nothing fires after its time."""
    start = scheduled - F.expr(f"interval {lead_minutes} minutes")
    fresh = F.lit(True) if notified is None else notified.isNull() | (notified < start)
    return F.coalesce(active & (start <= now) & (now <= scheduled) & fresh, F.lit(False))


def due_at_ticks(events: DataFrame, ticks: DataFrame, key: str, scheduled: str, lead_minutes: int, tick_minutes: int) -> DataFrame:
    """``key``, ``scheduled`` and ``notified_at``, the first tick at which each event is due.

    An interval join turned into an equi-join: ticks lie on a grid, so an event
    can only be due at those of its own lead time.
    """
    step = tick_minutes * 60_000_000
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    start = micros(scheduled) - lead_minutes * 60_000_000
    first = start + F.pmod(-start, F.lit(step))
    slots = events.where(first <= micros(scheduled)).withColumn("_tick", F.explode(F.sequence(first, micros(scheduled), F.lit(step))))
    on = ticks.select(micros("tick").alias("_tick"), "tick")
    return slots.join(on, "_tick").groupBy(key, scheduled).agg(F.min("tick").alias("notified_at"))


def due_at_polls(events: DataFrame, polls: DataFrame, key: str, scheduled: str, lead_minutes: int) -> DataFrame:
    """``key``, ``scheduled`` and ``notified_at``, the first poll at which each event is due; polls come at any times (``tick``).

    An as-of join from the start of each window to the next poll, with the end of
    the window as residual check.  Time is cut into ranges of some 36 minutes:
    the next poll is looked for in the window's own range, and beyond it the first
    poll of the next range that has any is carried over, so neither many polls
    nor many events of one moment meet pair by pair.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    backward = lambda c, tie: (-2 * c + tie)  # noqa: E731  the order of time reversed; a poll at the very start counts
    start = micros(scheduled) - lead_minutes * 60_000_000
    ticks = polls.where("tick is not null").select("tick").distinct()
    rows = ticks.select(backward(micros("tick"), 0).alias("order"), F.col("tick").alias("next_tick"), F.lit(None).cast(events.schema[key].dataType).alias(key), F.lit(None).cast(events.schema[scheduled].dataType).alias(scheduled))
    rows = rows.unionByName(events.where(F.col(scheduled).isNotNull()).select(backward(start, 1).alias("order"), F.lit(None).cast(polls.schema["tick"].dataType).alias("next_tick"), key, scheduled))
    met = running(rows, [], "order", ("next_tick",), bits=32).where(F.col(scheduled).isNotNull() & (micros("next_tick") <= micros(scheduled)))
    return met.select(key, scheduled, F.col("next_tick").alias("notified_at"))


def notify_stream(polls: DataFrame, lead_minutes: int, buckets: int = 4096) -> DataFrame:
    """Stream of notifications from a stream of (``reminder_id``, ``scheduled``, ``now``, ``status``).

    What is kept of a reminder is when it was last notified; a later time set for
    it arms it again.  Polls at which nothing is due change nothing and go first.
    Reminders share state by hash: one state a bucket, as a call and a state for
    each reminder cost far more than its rows.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = dict(zip(*state.get, strict=True)) if state.exists else {}
        rows = pd.concat(frames).sort_values("now_us", kind="stable")
        fired = []
        ids = rows["reminder_id"].tolist() if key[0] >= 0 else [None] * len(rows)  # null ids have a bucket of their own
        for row in zip(ids, rows["scheduled_us"].tolist(), rows["now_us"].tolist(), strict=True):
            reminder, scheduled, now = row
            if reminder not in last or last[reminder] < scheduled - lead:
                fired.append(row)
                last[reminder] = now
        if fired:
            state.update((list(last), list(last.values())))
            yield pd.DataFrame(fired, columns=["reminder_id", "scheduled_us", "now_us"])

    lead = lead_minutes * 60_000_000
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp")).alias(f"{c}_us")
    own = F.col("reminder_id").cast("long")
    bucket = F.when(own.isNull(), -1).otherwise(F.pmod(F.xxhash64(own), F.lit(buckets)))
    rows = polls.where(is_due(F.col("scheduled"), F.col("now"), lead_minutes, F.col("status") == "active"))
    rows = rows.select(own.alias("reminder_id"), micros("scheduled"), micros("now"), bucket.alias("bucket"))
    told = rows.groupBy("bucket").applyInPandasWithState(step, "reminder_id long, scheduled_us long, now_us long", "ids array<long>, lasts array<long>", "append", GroupStateTimeout.NoTimeout)
    return told.select("reminder_id", F.timestamp_micros("scheduled_us").alias("scheduled"), F.timestamp_micros("now_us").alias("notified_at"))


def notify_each(notices: DataFrame, checkpoint: str, tell: Callable[[DataFrame, int], None], every: str | None = None) -> StreamingQuery:
    """Start a stream that hands each batch of notices to ``tell`` with the batch's number.

    A batch may be handed over again after a failure, under the same number.
    Without ``every`` (such as "5 seconds") the stream ends when its input is used up.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return notices.writeStream.foreachBatch(tell).option("checkpointLocation", checkpoint).trigger(**trigger).start()
