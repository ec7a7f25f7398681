"""Reminder protocol, tool calls, samples, device states, templates and file shapes on small hand-made rows."""

import json

import pytest
from pyspark.sql import functions as F

from quillon.functions import jsonx, text, timex
from quillon.operators import device, dispatch, planning, profile, records, render, store
from quillon.sources import files
from quillon.streaming import due


def reminders(spark, rows):
    """Active reminders from (id, task, time text, day)."""
    return spark.createDataFrame([(i, t, f"2026-05-{d:02d}T09:00:00+08:00", w, "self", "active", None, None, None) for i, t, w, d in rows], store.REMINDER)


REQUEST = "request_id long, tool string, reminder_id string, task string, time_text string, time_iso string, new_task string, new_time_text string, new_time_iso string"


def ask(spark, *rows):
    """Requests from dictionaries, numbered from 0."""
    names = [f.split()[0] for f in REQUEST.split(", ")]
    return spark.createDataFrame([tuple({"request_id": i, **r}.get(n) for n in names) for i, r in enumerate(rows)], REQUEST)


HELD = [("rem_0001", "Take medicine", "tomorrow morning", 27), ("rem_0002", "play basketball", "tonight", 26), ("rem_0003", "taking the medicines", "friday", 29), ("rem_0004", "", "friday", 29), ("rem_0005", "xy", "", 30)]


def matched(query, task):
    """The task rule on plain texts: one holds the other, or stems agree."""
    q, t = query.strip().lower(), (task or "").strip().lower()

    def stem(w):
        for end, least in (("ing", 4), ("ed", 3), ("s", 3)):
            if len(w) > least and w.endswith(end):
                return w[: -len(end)]
        return w

    import re

    a, b = ({stem(w) for w in re.findall("[a-z0-9]+", x)} for x in (q, t))
    meant = a - set(text.STOP_WORDS)
    return bool(task) and (q in t or t in q or bool(a and b) and (meant <= b - set(text.STOP_WORDS) if meant else bool(a & b)))


def test_candidates_equal_the_rule_on_every_pair(spark):
    asked = ["medicine", "taking medicines", "PLAY", "basket", "x", "xyz", "the", "zz", "take the medicine now", "do play", "é"]
    rows = [{"tool": "query", "task": q} for q in asked]
    got = {(r["request_id"], r["reminder_id"]) for r in store.candidates(ask(spark, *rows), reminders(spark, HELD)).collect()}
    assert got == {(i, r) for i, q in enumerate(asked) for r, t, *_ in HELD if matched(q, t)}


def test_answers_of_the_protocol(spark):
    rows = [
        {"tool": "query", "task": "basketball"},
        {"tool": "query"},
        {"tool": "query", "task": "nothing of the kind"},
        {"tool": "delete"},
        {"tool": "delete", "task": "medicine"},
        {"tool": "delete", "reminder_id": "rem_0002"},
        {"tool": "update", "task": "basketball"},
        {"tool": "update", "new_task": "n"},
        {"tool": "update", "task": "basketball", "new_time_text": "some day"},
        {"tool": "update", "task": "basketball", "new_task": "n", "new_time_text": "friday", "new_time_iso": "2026-05-29T09:00:00+08:00"},
        {"tool": "query", "time_text": "Friday"},
        {"tool": "query", "time_text": "?", "time_iso": "2026-05-26T23:00:00+08:00"},
        {"tool": "delete", "reminder_id": "rem_9999"},
    ]
    requests, held = ask(spark, *rows), reminders(spark, HELD)
    out = {r["request_id"]: r for r in store.answers(requests, held).collect()}
    want = ["success", "success", "not_found", "missing_fields", "ambiguous", "success", "missing_fields", "missing_fields", "missing_fields", "success", "success", "success", "not_found"]
    assert [out[i]["status"] for i in range(len(rows))] == want
    assert [out[i]["n"] for i in (0, 1, 4, 10, 11)] == [1, 5, 2, 2, 1]
    assert out[3]["missing_fields"] == ["reminder_id|time_text|task"] and out[6]["missing_fields"] == ["new_time_text|new_task"] and out[8]["missing_fields"] == ["new_time_text"]
    assert [c["reminder_id"] for c in out[4]["candidates"]] == ["rem_0001", "rem_0003"] and out[4]["reminder_id"] is None
    after = {r["reminder_id"]: r for r in store.applied(held, requests, store.answers(requests, held), "now").collect()}
    assert after["rem_0002"]["status"] == "deleted" and after["rem_0002"]["task"] == "play basketball"  # the delete came first
    assert after["rem_0001"]["updated_at"] is None


def test_created_ids_go_on_from_the_largest(spark):
    rows = [(1 << 17, "b", "t", "x"), (3, "a", "t", "x"), (5, "", "t", "x"), (7, "c", "t", None)]
    asked = spark.createDataFrame(rows, "request_id long, task string, time_text string, time_iso string")
    snapshot, results = store.create(reminders(spark, [("rem_0041", "x", "", 1), ("bad", "y", "", 1)]), asked, "now")
    got = {r["request_id"]: (r["status"], r["reminder_id"], r["missing_fields"]) for r in results.collect()}
    assert got == {3: ("success", "rem_0042", []), 1 << 17: ("success", "rem_0043", []), 5: ("missing_fields", None, ["task"]), 7: ("missing_fields", None, ["time_text"])}
    assert snapshot.count() == 4


def test_calls_that_cannot_run(spark):
    rows = [("a", "nope", "{}"), ("b", None, None), ("c", "create_reminder", "{"), ("d", "create_reminder", "[]"), ("e", "create_reminder", '{"task": "x", "time_text": null}'), ("f", "delete_reminder", '{"when": 1}'), ("g", "query_reminder", None)]
    judged = dispatch.judged_calls(spark.createDataFrame(rows, "call_id string, name string, arguments string"), dispatch.registry(spark))
    got = {r["call_id"]: json.loads(r["payload"]) if r["payload"] else None for r in judged.collect()}
    assert [got[k]["message"] for k in "abcdf"] == ["Unknown tool: nope", "Unknown tool: None", "Malformed JSON in tool arguments.", "Invalid tool arguments: no object", "Invalid tool arguments: unexpected when"]
    assert got["e"] == {"state": False, "status": "missing_fields", "message": "Missing required field(s): time_text", "missing_fields": ["time_text"]}
    assert got["g"] is None


def sample(spark, *rows):
    return spark.createDataFrame([(i, s, m) for i, (s, m) in enumerate(rows)], f"id long, scenario string, messages array<{records.MESSAGE}>")


def message(role, content=None, call=None):
    return (role, content, *(("c1", call, "{}") if call else (None, None, None)))


def test_normal_samples(spark):
    call = message("assistant", "hm", "query_reminder")
    told = message("tool", '{"status": "odd", "message": 3, "reminders": [1], "reminder_id": "r"}')
    rows = [("query_not_found", [message("user", "u"), call, message("assistant", "end")]), ("query_success", [call, told]), ("no_tool_x", [message("user", "u")]), ("query_success", []), ("query_success", None)]
    out = {r["id"]: r for r in records.normalised(sample(spark, *rows)).collect()}
    assert [m["role"] for m in out[0]["messages"]] == ["user", "assistant", "tool", "assistant"] and out[0]["messages"][1]["content"] is None
    assert json.loads(out[0]["messages"][2]["content"]) == {"state": False, "status": "not_found"} and out[0]["messages"][2]["call_id"] == "c1"
    assert json.loads(out[1]["messages"][1]["content"]) == {"state": "success", "status": "success", "reminders": [1], "reminder_id": "r"} and len(out[1]["messages"]) == 2
    assert (out[2]["error"], out[2]["selected_tool"], len(out[2]["messages"])) == (None, None, 1)
    assert out[3]["error"] == "tool scenario missing assistant tool_calls message" and out[4]["error"] == "sample.messages must be a list"


def test_cleaned_samples(spark):
    call = message("assistant", "hm", "create_reminder")
    told = message("tool", '{"status": "success", "reminder": {"id": "r1"}}')
    rows = [("create_success", [call, told]), ("create_success", [call]), ("chat", [call]), ("chat", [message("user", "u")]), ("query_success", [call, told]), ("create_success", None)]
    cleaned = records.cleaned(sample(spark, *rows))
    out = {r["id"]: r for r in cleaned.collect()}
    assert [out[i]["error"] for i in range(6)] == [None, "tool scenario missing assistant/tool message", "no_tool scenario contains tool messages", None, "tool mismatch", "messages must be list"]
    assert out[0]["changed"] and json.loads(out[0]["messages"][1]["content"])["reminder_id"] == "r1" and out[0]["messages"][0]["content"] is None
    assert records.clean_report(cleaned).first().asDict() == {"total": 6, "kept": 2, "changed": 1, "rejected": 4}


def test_device_state_is_carried_on(spark):
    rows = [("d", 1, True, "monitor_control", {"action": "switch_channel", "channel": "4"}, []), ("d", 2, True, "set_volume", {"level": "max"}, []), ("d", 3, True, "set_volume", {}, ["level"]), ("d", 4, False, None, {}, None), ("d", 5, True, "dance", {}, [])]
    commands = spark.createDataFrame(rows, "dev string, n int, matched boolean, intent string, slots map<string,string>, missing_slots array<string>")
    whole = device.fold_state(commands, "dev", ["n"]).first()["state"]
    half = device.fold_state(commands.where("n <= 2"), "dev", ["n"])
    rest = device.fold_state(commands.where("n > 2"), "dev", ["n"], half).first()["state"]
    assert whole == rest
    assert (whole["monitor_channel"], whole["monitor_mode"], whole["volume"], whole["brightness"], whole["applied"], whole["last_action"]) == (4, "live", 100, 60, 2, "Unsupported parsed intent: dance.")
    said = [device.fold_state(commands.where(f"n <= {k}"), "dev", ["n"]).first()["state"]["last_action"] for k in (2, 3, 4)]
    assert said == ["Volume set to 100%.", "Missing required slots: level", "No supported device-control intent detected."]


def test_offline_words(spark):
    rows = [("Open it.", True, "unlock", {}, 1, False), ("开门。", True, "unlock", {}, 2, True), (None, True, "set_volume", {"level": "0"}, 0, True), ("{scene_text} {wallpaper_type} {time_range}", True, "x", {"scene": "back_yard", "wallpaper_type": "solid_color"}, 3, False), (None, False, None, {}, 1, False)]
    df = spark.createDataFrame(rows, "t string, m boolean, i string, s map<string,string>, o int, z boolean")
    said = [r[0] for r in df.select(render.offline_utterance(*map(F.col, "tmisoz"))).collect()]
    assert said == ["Please, open it.", "开门，现在就弄。", "把音量设为静音。", "back yard solid color today", "Please handle this."]


def test_json_in_texts(spark):
    texts = ['{"a": 1}', 'x {"a": NaN} y', "```json\n{\"a\": 2}\n``` {", "{", None, "[1]", '{"a": 1} {"b": 2}']
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", jsonx.extracted(F.col("t")).alias("x"), jsonx.all_objects(F.col("t")).alias("l")).orderBy("i").collect()
    assert [r["x"]["object"] for r in rows] == ['{"a": 1}', '{"a": NaN}', '{"a": 2}', None, None, None, None]
    assert [r["x"]["error"] for r in rows] == [None, None, None, "malformed JSON object", "empty output", "no JSON object", "malformed JSON object"]
    assert [len(r["l"]) for r in rows] == [1, 0, 1, 0, 0, 0, 0]
    got = F.create_map(F.lit("z"), F.lit("1"), F.lit("b"), F.lit(" X  y"))
    wanted = F.create_map(F.lit("z"), F.lit("2"), F.lit("b"), F.lit("x y"), F.lit("a"), F.lit("q"), F.lit("n"), F.lit(None))
    assert spark.range(1).select(jsonx.compare_arguments(wanted, got)).first()[0] == (3, 1, ["mismatch:z", "missing:a"])


def test_clock_grammar(spark):
    cases = {"8:15 PM": 1215, "8.15pm": 1215, "at 9 in the evening": 1260, "7am": 420, "12 am": 0, "12:30": 750, "8:15 p.m.": 495, "at 8, then 7pm": 1140, "25": None, "at 25": 60, "word": None, "": None}
    df = spark.createDataFrame([(k,) for k in cases], "p string")
    assert {r["p"]: r["m"] for r in df.select("p", timex.clock_minutes(F.col("p")).alias("m")).collect()} == cases


def test_lines_are_numbered_across_splits(spark, tmp_path):
    (tmp_path / "a.txt").write_text("".join(f"{i} {'x' * (i % 50)}\n" if i % 5 else "\n" for i in range(1, 3000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = files.numbered_lines(spark, str(tmp_path / "a.txt")).select("line", F.split_part("raw", F.lit(" "), F.lit(1)).cast("int").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r["line"], r["n"]) for r in got) == [(i, i) for i in range(1, 3000) if i % 5]


def test_settings_and_snapshots(spark, tmp_path):
    (tmp_path / "s.env").write_text('﻿# note\nA="x y"\n\nexport B = 2\nbroken\n', encoding="utf-8")
    assert files.settings_file(str(tmp_path / "s.env")) == {"A": "x y", "B": "2"}
    assert files.pick_setting(None, " ", " v ", "w") == "v" and files.pick_setting() is None
    files.write_snapshot(spark.range(2), str(tmp_path / "t"), 1)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        files.write_snapshot(spark.range(3), str(tmp_path / "t"), 1)
    with pytest.raises(ValueError, match="repeated"):
        files.write_keyed(spark.createDataFrame([(1, "a"), (1, None)], "k int, v string"), str(tmp_path / "k"), "k", {"v": "d"})


def test_strata_are_cut_exactly(spark):
    rows = spark.range(5000).select("id", F.when(F.col("id") % 10 < 8, "hot").when(F.col("id") % 10 == 8, "cold").otherwise(" ").alias("s"))
    out = planning.stratified_split(rows, "id", "s", 0.1, 3)
    assert {(r["s"], r["part"]): r["count"] for r in out.groupBy("s", "part").count().collect()} == {("hot", "val"): 400, ("hot", "train"): 3600, ("cold", "val"): 50, ("cold", "train"): 450, (" ", "val"): 50, (" ", "train"): 450}
    ranked = {r["id"] for r in out.where("part = 'val' and s = 'hot'").collect()}
    order = [r["id"] for r in rows.where("s = 'hot'").orderBy(planning.seeded(3, F.col("id")), "id").limit(400).collect()]
    assert ranked == set(order)
    assert planning.stratified_split(rows.limit(0), "id", "s", 0.1, 3).count() == 0
    assert planning.split_report(out, 0.1).first().asDict() == {"total": 5000, "train": 4500, "val": 500, "ratio": 0.1}


def test_small_reports(spark):
    gaps = spark.createDataFrame([("a", 3, 2), ("b", 0, 5)], "k string, got int, missing int")
    assert tuple(profile.total_shortfall(gaps).first()) == (3, 7)
    assert [r["line"] for r in profile.table_text(gaps, ["k", "got"]).collect()] == ["k  got", "a  3", "b  0"]
    rates = profile.success_rates(spark.createDataFrame([(True, None), (False, True)], "t boolean, a boolean"), "t", "a")
    assert tuple(rates.first()) == (2, 0.5, 0.5)


def test_repeated_batches_are_told_once(spark, tmp_path):
    rows = spark.range(5).select(F.col("id").alias("reminder_id"), F.lit("2026-05-26 12:00:00").cast("timestamp").alias("scheduled"), F.lit("2026-05-26 11:50:00").cast("timestamp").alias("now"), F.lit("active").alias("status"))
    rows.write.parquet(str(tmp_path / "in"))
    told = []
    stream = due.notify_stream(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), 30)
    due.notify_each(stream, str(tmp_path / "state"), lambda batch, at: told.extend(r["reminder_id"] for r in batch.collect())).awaitTermination()
    due.notify_each(stream, str(tmp_path / "state"), lambda batch, at: told.extend(r["reminder_id"] for r in batch.collect())).awaitTermination()
    assert sorted(told) == [0, 1, 2, 3, 4]


def test_many_copies_are_answered_by_groups(spark):
    """As many requests that say the same as reminders that do: counted without 400 million pairs."""
    n = 20000
    ids = spark.range(n)
    null = F.lit(None).cast("string")
    held = ids.select(F.format_string("rem_%05d", "id").alias("reminder_id"), F.lit("water plants").alias("task"), F.lit("2026-05-01T09:00:00+08:00").alias("scheduled_time"), F.lit("slot 1").alias("time_text"), F.lit("self").alias("target"), F.lit("active").alias("status"), *[null.alias(c) for c in ("created_at", "updated_at", "notified_at")])
    one = F.when(F.col("id") == 7, "rem_00007")
    asked = ids.select(F.col("id").alias("request_id"), F.when(F.col("id") == 7, "delete").otherwise("query").alias("tool"), one.alias("reminder_id"), F.lit("the plant").alias("task"), F.lit("SLOT  1").alias("time_text"), null.alias("time_iso"), *[null.alias(c) for c in ("new_task", "new_time_text", "new_time_iso")])
    out = store.answers(asked, held, listed=False)
    assert "candidates" not in out.columns
    assert sorted(out.groupBy("tool", "status", "n", "reminder_id").count().collect()) == [("delete", "success", 1, "rem_00007", 1), ("query", "success", n, None, n - 1)]
    after = store.applied(held, asked, out, "now")
    assert [tuple(r) for r in after.where("status = 'deleted'").select("reminder_id", "updated_at").collect()] == [("rem_00007", "now")]
    pairs = store.candidates(asked.where("request_id < 600"), held)
    assert pairs.count() == pairs.select(F.struct("*")).distinct().count() == 599 * n + 1


def test_tasks_of_pairs_follow_their_number(spark, monkeypatch):
    monkeypatch.setattr(store, "PAIRS", 1000)
    rows = [(f"rem_{i}", "water plants", None, None, "self", "active", None, None, None) for i in range(600)]
    asked = spark.range(100).select(F.col("id").alias("request_id"), *[F.lit(v).cast("string").alias(c) for c, v in (("reminder_id", None), ("task", "plants"), ("time_text", None), ("time_iso", None))])
    pairs = store.candidates(asked, spark.createDataFrame(rows, store.REMINDER))
    assert pairs.rdd.getNumPartitions() == 61
    assert pairs.distinct().count() == pairs.count() == 60000
