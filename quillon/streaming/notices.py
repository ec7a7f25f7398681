"""Streams with state: reminders that fire by timers, and an append that never repeats a row."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
NOTICE = "reminder_id string, scheduled_ms long, notified_ms long"
NAMES = [f.split()[0] for f in NOTICE.split(", ")]
SETTING = T.StructType([T.StructField("scheduled", T.LongType()), T.StructField("since", T.LongType())])


class Notifier(StatefulProcessor):
    """Fires each reminder once a window: the time from its lead before it to itself.

    A row sets a reminder at its event time ``at``: its time, or, where the status
    is not active or the time null, none.  What is set fires at the start of its
    window or when it is set, whichever is later; set after its time it is missed.
    A row that comes later replaces what is set and has not fired; a new time whose
    window begins after the last notice arms the reminder again, any other does
    not.  State are the setting that waits and the last notice; one timer of the
    event time stands at the moment of firing and one ``keep_ms`` after the last
    notice, which then goes.
    """

    def __init__(self, lead_ms: int, keep_ms: int):
        self.lead, self.keep = lead_ms, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getValueState("waiting", SETTING)
        self.last = handle.getValueState("last", "at long")

    def _moment(self, scheduled: int, since: int, last: int | None) -> int | None:
        """When a setting fires, or None if it never does."""
        start = scheduled - self.lead
        moment = max(start, since)
        return moment if moment <= scheduled and (last is None or last < start) else None

    def _read(self) -> tuple[tuple[int, int] | None, int | None]:
        """The setting that waits and the last notice; each call of the state goes to another process, so it is read once a key."""
        waiting, last = self.waiting.get(), self.last.get()
        return (None if waiting is None else (waiting[0], waiting[1])), (None if last is None else last[0])

    def _fired(self, key: tuple, waiting: tuple[int, int] | None, last: int | None, upto: int, fired: list) -> tuple[tuple[int, int] | None, int | None]:
        """What waits and the last notice after the notice, if any, of what waits with its moment not after ``upto``."""
        if waiting is None:
            return None, last
        moment = self._moment(*waiting, last)
        if moment is None:
            return None, last
        if moment > upto:
            return waiting, last
        fired.append((key[0], waiting[0], moment))
        return None, moment

    def _timers(self, waiting: tuple[int, int] | None, last: int | None) -> set[int]:
        """The moment of what waits and the end of the last notice."""
        moment = None if waiting is None else self._moment(*waiting, last)
        return {x for x in (moment, None if last is None else last + self.keep) if x is not None}

    def _write(self, before: tuple, after: tuple) -> None:
        for state, old, new in zip((self.waiting, self.last), before, after, strict=True):
            if new is None and old is not None:
                state.clear()
            elif new != old:
                state.update(new if isinstance(new, tuple) else (new,))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        fired: list[tuple] = []
        before = waiting, last = self._read()
        new = pd.concat(rows).sort_values("at_ms", kind="stable")
        for now, scheduled in zip(new["at_ms"].tolist(), new["scheduled_ms"].tolist(), strict=True):
            waiting, last = self._fired(key, waiting, last, now, fired)
            waiting = None if pd.isna(scheduled) else (int(scheduled), now)
        self._write(before, (waiting, last))
        old, due = self._timers(*before), self._timers(waiting, last)
        for timer in old - due:
            self.handle.deleteTimer(timer)
        for timer in due - old:
            self.handle.registerTimer(timer)
        yield pd.DataFrame(fired, columns=NAMES)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        fired: list[tuple] = []
        now = expiredTimerInfo.getExpiryTimeInMs()
        before = self._read()
        waiting, last = self._fired(key, *before, now, fired)
        if last is not None and last + self.keep <= now:
            last = None
        elif fired:
            self.handle.registerTimer(last + self.keep)
        self._write(before, (waiting, last))
        yield pd.DataFrame(fired, columns=NAMES)

    def close(self) -> None:
        pass


def notices(settings: DataFrame, lead_minutes: int, late: str, keep_days: int = 30) -> DataFrame:
    """Stream of notices of a stream of settings (``reminder_id`` text, ``at``, ``scheduled``, ``status``).

    ``late`` is how long rows may be late; times count in whole milliseconds.
    The result has ``reminder_id``, ``scheduled`` and ``notified_at``.
    """
    processor = Notifier(lead_minutes * 60_000, keep_days * 86_400_000)
    millis = lambda c: F.unix_millis(F.col(c).cast("timestamp"))
    rows = settings.select("reminder_id", "at", millis("at").alias("at_ms"), F.when(F.col("status") == "active", millis("scheduled")).alias("scheduled_ms"))
    fired = rows.withWatermark("at", late).groupBy("reminder_id").transformWithStateInPandas(processor, NOTICE, "Append", "EventTime")
    return fired.select("reminder_id", *[F.timestamp_millis(f"{c}_ms").alias(n) for c, n in (("scheduled", "scheduled"), ("notified", "notified_at"))])


@contextmanager
def rocks(spark: SparkSession) -> Iterator[None]:
    """Streams started within keep their state in RocksDB, which timers need."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def append_once(rows: DataFrame, keys: list[str], at: str, late: str, folder: str) -> StreamingQuery:
    """Append a stream's rows to ``folder``/rows, one of each key, across runs.

    Keys seen within ``late`` of the event time ``at`` are state, kept in
    ``folder``/state with how far the input was read; so a later run reads new
    input alone and never the sink.  A batch writes a folder of its own number and
    replaces it if it is handed over again, so a run that broke off leaves no
    repeat.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/rows/batch={number}")

    once: Callable = rows.withWatermark(at, late).dropDuplicatesWithinWatermark
    return once(keys).writeStream.foreachBatch(write).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
