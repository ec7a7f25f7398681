"""Answers in normal form and the validator of whole samples, against plain Python."""

import json
import random

from pyspark.sql import functions as F

from quillon.functions.jsonx import variant_of
from quillon.operators import payloads, records
from quillon.operators.quality import ROLES, SCENARIOS


def reminder(v, target):
    out, rid = {}, v.get("reminder_id") or v.get("id")
    if rid:
        out["reminder_id"] = rid if isinstance(rid, str) else json.dumps(rid)
    for k in ("task",):
        if k in v:
            out[k] = v[k]
    if v.get("time_text") is not None:
        out["time_text"] = v["time_text"]
    when = v["scheduled_time"] if "scheduled_time" in v else v.get("time")
    if when is not None:
        out["scheduled_time"] = when
    out["target"] = (v["target"] if "target" in v else target) or "self"
    return out | {k: v[k] for k in ("status", "created_at", "updated_at") if k in v}


def answer(scenario, tool, arguments, payload):
    """(error, content) of an answer."""
    payload, arguments = (x if isinstance(x, dict) else {} for x in (payload, arguments))
    wanted = SCENARIOS[scenario][1]
    status = payload.get("status") if isinstance(payload.get("status"), str) and payload["status"] else wanted
    if status != wanted:
        return "status mismatch", None
    out = {"status": status, "state": "success" if status == "success" else False}
    text = payload.get("message") if isinstance(payload.get("message"), str) and payload["message"].strip() else payloads.MESSAGES.get(status)
    if status == "missing_fields":
        return None, out | {"missing_fields": payload["missing_fields"] if isinstance(payload.get("missing_fields"), list) else [], "message": text}
    if status == "ambiguous":
        some = []
        for c in payload["candidates"] if isinstance(payload.get("candidates"), list) else []:
            if isinstance(c, dict):
                when = next((c[k] for k in ("scheduled_time", "time", "time_text") if k in c), None)
                rid = c.get("reminder_id") or c.get("id")
                some.append(({"reminder_id": rid} if rid else {}) | ({"task": c["task"]} if "task" in c else {}) | ({"scheduled_time": when} if when is not None else {}))
        return None, out | {"candidates": some} | ({"message": text} if "message" in payload else {})
    if status == "not_found":
        return None, out | {"message": text}
    if tool == "query_reminder":
        if not isinstance(payload.get("reminders"), list):
            return "no reminders", None
        return None, out | {"reminders": [reminder(r if isinstance(r, dict) else {}, "self") for r in payload["reminders"]]}
    if tool == "delete_reminder":
        gone = payload.get("deleted_reminder")
        rid = payload.get("reminder_id") or (gone.get("reminder_id") if isinstance(gone, dict) else None)
        return (None, out | {"reminder_id": rid}) if rid else ("no reminder_id", None)
    own = payload.get("reminder")
    target = arguments.get("target") if arguments.get("target") else "self"
    own = reminder(own if isinstance(own, dict) else {}, target)
    rid = payload.get("reminder_id") or own.get("reminder_id")
    return (None, out | {"reminder_id": rid, "reminder": own | {"reminder_id": rid}}) if rid else ("no reminder_id", None)


def test_answers_in_normal_form(spark):
    rng = random.Random(21)
    one = lambda: rng.choice([{}, {k: v for k, v in {"reminder_id": rng.choice(["r1", "", None, 7]), "id": rng.choice(["x", 8]), "task": rng.choice(["a, b: c", None, 3]), "time_text": rng.choice(["t", None]), "scheduled_time": rng.choice(["s", None]), "time": "z", "target": rng.choice(["self", "", None, "mom"]), "status": "active", "created_at": None, "odd": [1]}.items() if rng.random() < 0.6}, "text", None, 5])
    rows = []
    for _ in range(900):
        scenario = rng.choice(list(SCENARIOS))
        payload = {k: v for k, v in {"status": rng.choice([SCENARIOS[scenario][1]] * 6 + ["", None, "odd"]), "reminder_id": rng.choice(["r9", "", None, 4]), "reminder": one(), "reminders": rng.choice([[one(), one()], [], 3]), "deleted_reminder": one(), "candidates": rng.choice([[one(), one(), one()], {}, []]), "missing_fields": rng.choice([["a"], "x", [1, None]]), "message": rng.choice(["hi", " ", None, 'say "x", y'])}.items() if rng.random() < 0.7}
        rows.append((scenario, SCENARIOS[scenario][0], rng.choice(["{}", '{"target": "mom"}', '{"target": ""}', "[1]"]), json.dumps(payload if rng.random() < 0.95 else [1])))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i long, s string, t string, a string, p string").repartition(2)
    got = df.select("i", payloads.normal_answer(F.col("s"), F.col("t"), variant_of(F.col("a")), variant_of(F.col("p"))).alias("x")).collect()
    seen = set()
    for r in got:
        s, t, a, p = rows[r["i"]]
        error, content = answer(s, t, json.loads(a), json.loads(p))
        assert r["x"]["error"] == error, rows[r["i"]]
        if error is None:
            assert json.loads(r["x"]["content"]) == content, rows[r["i"]]
            assert list(json.loads(r["x"]["content"]))[:2] == ["status", "state"] and '":' not in r["x"]["content"].replace('": ', "")
        seen.add(error or r["x"]["status"])
    assert seen == {"success", "missing_fields", "not_found", "ambiguous", "status mismatch", "no reminder_id", "no reminders"}


def fault(sample, scenario, system):
    """The first rule that a sample breaks."""
    ms = sample["messages"]
    if len(ms) < 3:
        return "sample must have at least 3 messages"
    if ms[0].get("role") != "system":
        return "first message must be system"
    if ms[0].get("content") != system:
        return "system prompt does not match"
    if ms[1].get("role") != "user":
        return "second message must be user"
    if not isinstance(ms[1].get("content"), str) or not ms[1]["content"].strip():
        return "user content missing"
    called, told, name, statuses = False, False, None, []
    for i, m in enumerate(ms):
        role = m.get("role")
        if role not in ROLES:
            return f"invalid role: {role}"
        if role == "assistant" and m.get("tool_calls"):
            called = True
            if "content" not in m:
                return "assistant tool call message must include content field"
            if m["content"] is not None:
                return "assistant tool call message content must be null"
            if i + 1 >= len(ms) or ms[i + 1].get("role") != "tool":
                return "assistant.tool_calls must be followed immediately by role=tool"
            if not isinstance(m["tool_calls"], list):
                return "tool_calls must be a non-empty list"
            for c in m["tool_calls"]:
                if c.get("type") != "function":
                    return "tool_call.type must be function"
                f = c.get("function")
                if not isinstance(f, dict):
                    return "tool_call.function must be object"
                if not isinstance(f.get("name"), str) or not f["name"].strip():
                    return "tool_call.function.name missing"
                name = f["name"].strip()
                if not isinstance(f.get("arguments"), str):
                    return "tool_call.function.arguments must be JSON string"
                try:
                    json.loads(f["arguments"])
                except ValueError:
                    return "tool_call.function.arguments must be JSON"
        if role == "tool":
            told = True
            if not isinstance(m.get("content"), str):
                return "tool content must be JSON string"
            try:
                payload = json.loads(m["content"])
            except ValueError:
                return "tool content must be JSON"
            if not isinstance(payload, dict) or "status" not in payload:
                return "tool payload must include status"
            if not isinstance(payload["status"], str) or not payload["status"].strip():
                return "tool payload status must be non-empty string"
            if payload["status"] not in records.STATUSES:
                return "tool payload status must be one of " + ", ".join(sorted(records.STATUSES))
            statuses.append(payload["status"])
    if scenario.startswith("no_tool"):
        return "no_tool scenario must not contain tool_calls or role=tool" if called or told else None
    if not called or not told:
        return "tool scenario must contain assistant.tool_calls and role=tool"
    if scenario in SCENARIOS and name != SCENARIOS[scenario][0]:
        return f"scenario={scenario} expected tool={SCENARIOS[scenario][0]}, got tool={name}"
    if len(statuses) != 1:
        return "tool scenario expects exactly one tool status, got " + ", ".join(statuses)
    return None


def test_first_fault_of_whole_samples(spark):
    rng = random.Random(5)
    some = lambda *x: rng.choice([x[0]] * 12 + list(x))
    rows = []
    for _ in range(1200):
        scenario = rng.choice(["create_success", "query_not_found", "no_tool_chat", "other"])
        call = {"type": some("function", "x", None), "function": some({"name": some("create_reminder", "query_reminder", " ", None), "arguments": some("{}", "{", None, {})}, 3)}
        asked = {"role": "assistant", "content": some(None, "x"), "tool_calls": some([call], [call, call], {"a": 1}, [])}
        if rng.random() < 0.05:
            del asked["content"]
        told = {"role": some("tool", "assistant"), "content": some('{"status": "success"}', '{"status": "odd"}', '{"status": " "}', "{}", "[1]", "{", None, '{"status": 3}')}
        ms = [{"role": some("system", "user"), "content": some("be good", "be")}, {"role": some("user", "tool"), "content": some("hi", " ", None)}]
        ms += [asked, told] if rng.random() < 0.75 else []
        ms += [told] if rng.random() < 0.1 else []
        ms += [{"role": some("assistant", "robot", None), "content": "done"}] if rng.random() < 0.9 else []
        rows.append((scenario, {"messages": ms}))
    df = spark.createDataFrame([(i, s, json.dumps(x)) for i, (s, x) in enumerate(rows)], "i long, s string, x string").repartition(2)
    got = {r["i"]: r["f"] for r in df.select("i", records.first_fault(F.col("x"), F.col("s"), "be good").alias("f")).collect()}
    want = {i: fault(x, s, "be good") for i, (s, x) in enumerate(rows)}
    assert [(rows[i], got[i], want[i]) for i in want if got[i] != want[i]] == []
    assert len(set(want.values())) >= 20
