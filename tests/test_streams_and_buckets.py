"""Streams with state, polls at any times, hash buckets and observed sinks."""

import datetime as dt
import os
import random

import pandas as pd
from pyspark.sql import functions as F

from quillon.sources import buckets, files
from quillon.streaming import due, notices

DAY = dt.datetime(2026, 5, 1)


def at(minutes):
    return DAY + dt.timedelta(minutes=minutes)


def test_first_of_irregular_polls(spark):
    rng = random.Random(4)
    events = [(i, at(rng.randrange(3000))) for i in range(300)] + [(900, None), (901, at(40)), (902, at(40))]
    polls = [at(rng.randrange(0, 3000, 7)) for _ in range(60)] * 2 + [None, at(10), at(1000)]
    out = due.due_at_polls(spark.createDataFrame(events, "k long, t timestamp").repartition(3), spark.createDataFrame([(p,) for p in polls], "tick timestamp"), "k", "t", 30)
    want = {k: min(p for p in polls if p and t - dt.timedelta(minutes=30) <= p <= t) for k, t in events if t and any(p and t - dt.timedelta(minutes=30) <= p <= t for p in polls)}
    assert {r["k"]: r["notified_at"] for r in out.collect()} == want and len(want) > 50
    assert due.due_at_polls(spark.createDataFrame(events, "k long, t timestamp"), spark.createDataFrame([], "tick timestamp"), "k", "t", 30).count() == 0


SETTING = "reminder_id string, at timestamp, scheduled timestamp, status string"


def fired(spark, folder, parts):
    """Notices after each part of the input, run after run on one state."""
    told = []
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, SETTING).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = notices.notices(spark.readStream.schema(SETTING).parquet(f"{folder}/in"), 30, "1 minute", keep_days=1)
        with notices.rocks(spark):
            stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start(f"{folder}/out").awaitTermination()
        every = sorted((r["reminder_id"], r["scheduled"], r["notified_at"]) for r in spark.read.parquet(f"{folder}/out").collect())
        told.append([x for x in every if x not in sum(told, [])])
    return told


def test_notices_by_timers_over_runs(spark, tmp_path):
    first = [
        ("a", at(0), at(100), "active"),  # fires at 70
        ("b", at(0), at(20), "active"),  # set within its window
        ("c", at(50), at(20), "active"),  # too late: missed
        ("d", at(0), at(300), "active"), ("d", at(10), at(300), "cancelled"),
        ("e", at(0), at(200), "active"), ("e", at(60), at(90), "active"),  # set to an earlier time
        ("f", at(0), None, "active"),
        ("g", at(0), at(400), "active"),
        ("z", at(120), at(5000), "active"),  # moves the event time on
    ]
    second = [
        ("a", at(130), at(125), "active"),  # its window began after the last notice, but it has passed
        ("a", at(140), at(300), "active"),  # armed again
        ("b", at(150), at(25), "active"),
        ("g", at(160), at(161), "active"),
        ("z", at(290), at(5000), "active"),
    ]
    told = fired(spark, str(tmp_path), [first, second, [("z", at(3000), None, "active")]])
    assert told[0] == [("a", at(100), at(70)), ("b", at(20), at(0)), ("e", at(90), at(60))]
    assert told[1] == [("a", at(300), at(270)), ("g", at(161), at(160))]
    assert told[2] == []


def test_notifier_calls_python_by_bucket(spark, tmp_path):
    """Runs over one state: a later time arms a reminder again, ids that share a bucket or are null keep apart, and the
    states are those of buckets, not of reminders."""
    schema = "reminder_id long, scheduled timestamp, now timestamp, status string"
    parts = [
        [(i, at(100), at(80), "active") for i in range(300)] + [(0, at(100), at(75), "active"), (500, at(100), at(90), "off"), (501, at(100), at(60), "active"), (None, at(100), at(80), "active"), (2**60 + 1, at(100), at(80), "active")],
        [(0, at(100), at(99), "active"), (1, at(105), at(90), "active"), (2, at(200), at(175), "active"), (2, at(200), at(180), "active"), (None, at(100), at(90), "active"), (500, at(200), at(190), "active")],
    ]
    seen = []
    for rows in parts:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = due.notify_stream(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), 30, buckets=8)
        query = stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start(f"{tmp_path}/out")
        query.awaitTermination()
        assert sum(o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"]) <= 9
        every = {(r["reminder_id"], r["scheduled"], r["notified_at"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
        seen.append(every.difference(*seen))
    assert seen[0] == {(i, at(100), at(80)) for i in [*range(1, 300), None, 2**60 + 1]} | {(0, at(100), at(75))}
    assert seen[1] == {(2, at(200), at(175)), (500, at(200), at(190))}


def test_callback_is_told_of_reminders_that_share_states(spark, tmp_path):
    schema = "reminder_id long, scheduled timestamp, now timestamp, status string"
    spark.createDataFrame([(i, at(100), at(80 + j), "active") for i in range(6000) for j in range(2)], schema).coalesce(1).write.parquet(f"{tmp_path}/in")
    told = []
    stream = due.notify_stream(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), 30)
    query = due.notify_each(stream, f"{tmp_path}/state", lambda batch, n: told.extend(r["reminder_id"] for r in batch.collect()))
    query.awaitTermination()
    assert sorted(told) == list(range(6000))
    assert sum(o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"]) <= 4096


def test_append_once_over_runs(spark, tmp_path):
    folder = str(tmp_path)
    stream = lambda: spark.readStream.schema("k long, t timestamp, v string").parquet(f"{folder}/in")
    seen = []
    for n, keys in enumerate([[1, 2, 2, 3], [3, 4, 1], []]):
        spark.createDataFrame([(k, at(k), f"run{n}") for k in keys], "k long, t timestamp, v string").write.mode("append").parquet(f"{folder}/in")
        notices.append_once(stream(), ["k"], "t", "1 day", folder).awaitTermination()
        seen.append(sorted((r["k"], r["v"]) for r in spark.read.parquet(f"{folder}/rows").collect()))
    assert seen[0] == [(1, "run0"), (2, "run0"), (3, "run0")] and seen[1] == sorted([*seen[0], (4, "run1")]) and seen[2] == seen[1]


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    path = f"{tmp_path}/table"
    buckets.write_buckets(spark.createDataFrame([(i, f"v{i}", None) for i in range(200)], "k long, v string, w string"), path, "k", 16)
    names = lambda: {(d, f) for d in os.listdir(path) if d.startswith("_bucket") for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet")}
    before = names()
    changes = spark.createDataFrame([(5, "new", "w", False), (7, None, None, True), (1000, "added", None, None)], "k long, v string, w string, gone boolean")
    touched = {r[0] for r in changes.select(buckets.bucket_of("k", 16)).collect()}
    assert buckets.upsert(changes, path, "k", 16, gone="gone") == len(touched)
    rows = {r["k"]: (r["v"], r["w"]) for r in buckets.read_buckets(spark, path).collect()}
    assert rows == {i: (f"v{i}", None) for i in range(200) if i != 7} | {5: ("new", "w"), 1000: ("added", None)}
    kept = {x for x in before if x[0] not in {f"_bucket={b}" for b in touched}}
    assert kept <= names() and not (before - kept) & names()
    assert buckets.upsert(changes.limit(0), path, "k", 16, gone="gone") == 0
    every = buckets.read_buckets(spark, path).select("*", F.lit(True).alias("gone"))
    some = every.where(buckets.bucket_of("k", 16) == sorted(touched)[0])
    buckets.upsert(some, path, "k", 16, gone="gone")
    assert len(os.listdir(path)) and buckets.read_buckets(spark, path).where(buckets.bucket_of("k", 16) == sorted(touched)[0]).count() == 0


def test_counts_are_observed_as_rows_pass(spark, tmp_path):
    rows = spark.range(100).select("id", F.when(F.col("id") % 3 == 0, "bad").alias("error"))
    told = files.write_three(rows, "error", f"{tmp_path}/good", f"{tmp_path}/bad", f"{tmp_path}/report")
    assert told == {"total": 100, "kept": 66, "rejected": 34} == files.jsonl(spark, f"{tmp_path}/report", "total long, kept long, rejected long").first().asDict()
    assert spark.read.json(f"{tmp_path}/good").count() == 66 and spark.read.json(f"{tmp_path}/bad").count() == 34


class _Value:
    def __init__(self, calls):
        self.calls, self.value = calls, None

    def _put(self, value):
        self.calls.append("put")
        self.value = value

    def exists(self):
        return self.get() is not None

    def get(self):
        self.calls.append("get")
        return self.value

    def update(self, value):
        self._put(value)

    def clear(self):
        self._put(None)


def test_notifier_reads_state_once_a_key():
    """Each call of the state goes to another process, so their number must not follow the rows of a key."""
    calls, timers = [], set()
    processor = notices.Notifier(30 * 60_000, 86_400_000)
    processor.waiting, processor.last = _Value(calls), _Value(calls)
    processor.handle = type("Handle", (), {"registerTimer": lambda self, t: timers.add(t), "deleteTimer": lambda self, t: timers.discard(t), "listTimers": lambda self: iter(set(timers))})()
    hour = 3_600_000
    rows = pd.DataFrame({"at_ms": [i * hour for i in range(1000)], "scheduled_ms": [i * hour + 600_000 for i in range(1000)]})
    out = pd.concat(processor.handleInputRows(("a",), iter([rows]), None))
    assert out["notified_ms"].tolist() == rows["at_ms"].tolist()[:-1] and timers == {999 * hour, 998 * hour + 86_400_000}
    assert len(calls) <= 8
