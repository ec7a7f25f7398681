"""Requests replayed all at once against a serial store."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quillon.functions.text import STOP_WORDS
from quillon.operators import replay, store

REQUEST = "scope string, request_id long, tool string, reminder_id string, task string, time_text string, time_iso string, new_task string, new_time_text string, new_time_iso string"


def stem(w):
    return w[:-3] if len(w) > 4 and w.endswith("ing") else w[:-2] if len(w) > 3 and w.endswith("ed") else w[:-1] if len(w) > 3 and w.endswith("s") else w


def task_fits(q, t):
    if not q:
        return True
    if not t:
        return False
    q, t = q.strip().lower(), t.strip().lower()
    a, b = ({stem(w) for w in re.findall("[a-z0-9]+", x)} for x in (q, t))
    idle = set(STOP_WORDS)
    return q in t or t in q or bool(a and b and (a - idle <= b - idle if a - idle else a & b))


def time_fits(q, iso, r):
    if not q:
        return True
    near = lambda x: " ".join((x or "").lower().split())
    a, b = near(q), near(r["time_text"])
    return bool(b and (a in b or b in a)) or bool(iso and r["scheduled_time"] and iso[:10] == r["scheduled_time"][:10])


def serial(reminders, requests):
    """The answers one by one: (status, missing, n, id, ids of candidates)."""
    state, out = {}, {}
    for r in reminders:
        state.setdefault(r["scope"], []).append(dict(r))
    for q in sorted(requests, key=lambda q: q["request_id"]):
        own, tool = state.setdefault(q["scope"], []), q["tool"]

        def say(status, missing=None, n=0, one=None, ids=None):
            out[q["request_id"]] = (status, missing, n, one, ids)

        if tool == "create":
            missing = [c for c in ("time_text", "task") if not q[c]] or (["time_text"] if q["time_iso"] is None else [])
            if missing:
                say("missing_fields", missing)
                continue
            rid = f"rem_{max([int(r['reminder_id'].split('_')[1]) for r in own] or [0]) + 1:04d}"
            own.append({"reminder_id": rid, "task": q["task"], "time_text": q["time_text"], "scheduled_time": q["time_iso"], "target": "self", "status": "active"})
            say("success", one=rid)
            continue
        if tool == "update" and not q["new_time_text"] and not q["new_task"]:
            say("missing_fields", ["new_time_text|new_task"])
            continue
        if tool != "query" and not q["reminder_id"] and not q["time_text"] and not q["task"]:
            say("missing_fields", ["reminder_id|time_text|task"])
            continue
        live = [r for r in own if r["status"] == "active"]
        if q["reminder_id"]:
            meant = [r for r in live if r["reminder_id"] == q["reminder_id"]]
        else:
            meant = [r for r in live if r["target"] == "self" and task_fits(q["task"], r["task"]) and time_fits(q["time_text"], q["time_iso"], r)]
        ids = sorted(r["reminder_id"] for r in meant)
        if not meant:
            say("not_found")
        elif tool == "query":
            everything = not (q["reminder_id"] or q["task"] or q["time_text"])
            say("success", n=len(ids), ids=None if everything else ids)
        elif len(meant) > 1:
            say("ambiguous", n=len(ids), ids=ids)
        elif tool == "update" and q["new_time_text"] and q["new_time_iso"] is None:
            say("missing_fields", ["new_time_text"], n=1)
        else:
            r = meant[0]
            say("success", n=1, one=r["reminder_id"])
            if tool == "delete":
                r["status"] = "deleted"
            else:
                if q["new_time_text"]:
                    r["time_text"], r["scheduled_time"] = q["new_time_text"], q["new_time_iso"]
                r["task"] = q["new_task"] or r["task"]
    return out, {(s, r["reminder_id"]): (r["status"], r["task"], r["time_text"], r["scheduled_time"]) for s, own in state.items() for r in own}


TASKS = ["take medicine", "taking medicines", "water plants", "the plant", "walk dog", "dog", "call mom", "do it", "", None]
TIMES = [("at 7", "2026-05-01"), ("7", "2026-05-02"), ("tomorrow", "2026-05-03"), ("some day", None), ("", None), (None, None)]


def drawn(rng, i, scopes):
    time = rng.choice(TIMES)
    new = rng.choice(TIMES)
    tool = rng.choice(["create", "create", "query", "update", "update", "delete"])
    return {
        "scope": rng.choice(scopes), "request_id": 10 * i + 3, "tool": tool, "reminder_id": rng.choice([None, None, "", f"rem_{rng.randrange(1, 9):04d}"]), "task": rng.choice(TASKS),
        "time_text": time[0], "time_iso": time[1] and time[1] + "T09:00:00+08:00", "new_task": rng.choice(TASKS), "new_time_text": new[0], "new_time_iso": new[1] and new[1] + "T09:00:00+08:00",
    }


@pytest.mark.parametrize("seed,scopes", [(1, ["a"]), (2, ["a", "b", "c"])])
def test_replay_equals_one_by_one(spark, seed, scopes):
    rng = random.Random(seed)
    start = [{"scope": s, "reminder_id": f"rem_{i:04d}", "task": rng.choice(TASKS), "time_text": "at 7", "scheduled_time": "2026-05-01T09:00:00+08:00", "target": rng.choice(["self", "self", "other"]), "status": rng.choice(["active", "active", "deleted"])} for s in scopes for i in range(1, 5)]
    requests = [drawn(rng, i, scopes) for i in range(90)]
    kinds = "scope string, " + store.REMINDER
    reminders = spark.createDataFrame([[r.get(c.split()[0]) for c in kinds.split(", ")] for r in start], kinds)
    asked = spark.createDataFrame([list(q.values()) for q in requests], REQUEST).repartition(3)
    answers, after = replay.replay(reminders, asked, "now")
    told, state = serial(start, requests)
    got = {r["request_id"]: (r["status"], r["missing_fields"], r["n"], r["reminder_id"], [c["reminder_id"] for c in r["candidates"]] if r["candidates"] else None) for r in answers.collect()}
    assert got == told
    assert len({v[0] for v in told.values()}) == 4
    assert {(r["scope"], r["reminder_id"]): (r["status"], r["task"], r["time_text"], r["scheduled_time"]) for r in after.collect()} == state


def test_running_values_cross_ranges(spark, monkeypatch):
    monkeypatch.setattr(replay, "RANGE_BITS", 2)
    rows = [("k" if i % 3 else "h", i, "v%d" % i if i % 7 == 1 else None, i) for i in range(60)]
    out = replay.running(spark.createDataFrame(rows, "k string, o long, v string, s long"), ["k"], "o", ("v",), ("s",)).collect()
    for r in out:
        own = [x for x in rows if x[0] == r["k"]]
        upto = [x for x in own if x[1] <= r["o"]]
        assert r["v"] == next((x[2] for x in reversed(upto) if x[2]), None) and r["s"] == sum(x[3] for x in upto)
        assert r["next"] == min((x[1] for x in own if x[1] > r["o"]), default=None)


def test_blocks_hold_what_they_make_up(spark):
    rng = random.Random(9)
    rows = [(a, a + rng.randrange(0, 40)) for a in (rng.randrange(0, 60) for _ in range(40))]
    made = spark.createDataFrame(rows, "a long, b long").select("a", "b", replay._blocks(F.col("a"), F.col("b"), 7).alias("x"))
    around = {r["p"]: {tuple(b) for b in r["x"]} for r in spark.range(100).select(F.col("id").alias("p"), replay._around(F.col("id"), 7).alias("x")).collect()}
    for r in made.collect():
        assert all(len({tuple(b) for b in r["x"]} & around[p]) == (r["a"] <= p < r["b"]) for p in range(100))
        assert len(r["x"]) <= 14


def test_replay_of_nothing(spark):
    none = spark.createDataFrame([], "scope string, " + store.REMINDER)
    answers, after = replay.replay(none, spark.createDataFrame([], REQUEST), "now")
    assert answers.count() == 0 and after.count() == 0


def test_joins_are_not_broadcast(spark):
    """However small the files of the tables look, the driver collects none of them."""
    rows = [("s", i, "create", None, f"task {i % 3}", "t", "2026-05-01T09:00:00+08:00", None, None, None) for i in range(6)] + [("s", 6, "delete", "rem_0001", None, None, None, None, None, None)]
    asked = replay._judged(spark.createDataFrame(rows, REQUEST), spark.createDataFrame([], f"scope string, {store.REMINDER}"))
    made = asked.where("made is not null").select("scope", F.col("made").alias("rid"), (2 * F.col("turn") + 1).alias("moment"), "task", "time_text", F.col("time_iso").alias("scheduled_time"), F.lit("self").alias("target"), F.lit(None).cast("boolean").alias("dead"))
    keys = asked.select("at", "turn", "scope", F.lit("task:task 1").alias("key"), F.lit(True).alias("by_task"), "time_text", "time_iso")
    hits = asked.where("tool = 'delete'").select("scope", "at", F.lit("rem_0001").alias("rid"))
    plan = replay._Store(made, asked, keys, 4, 16).found(hits)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
