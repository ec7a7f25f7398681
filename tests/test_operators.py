"""Operators on small hand-made tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quillon.functions import intent, jsonx, text, timex
from quillon.operators import device, evaluation, planning, profile, quality, store
from quillon.sources import files
from quillon.streaming import due


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("query", "task", "fits"),
    [
        ("playing basketball", "play basketball", True),
        ("basketball", "play basketball with Tom", True),
        ("play tennis", "play basketball", False),
        ("", "anything", True),
        ("call", None, False),
        (None, None, True),
        ("take the pills", "take my pill", True),
    ],
)
def test_task_matches(spark, query, task, fits):
    assert one(spark, text.task_matches(F.lit(query).cast("string"), F.lit(task).cast("string"))) is fits


def test_empty_stored_time_does_not_match_every_query(spark):
    lit = lambda x: F.lit(x).cast("string")
    assert one(spark, text.time_matches(lit("tomorrow"), lit(""), lit(None), lit(None))) is False
    assert one(spark, text.time_matches(lit("x"), lit("y"), lit("2026-05-27T01:00:00+08:00"), lit("2026-05-27T23:00:00+08:00"))) is True


def test_words_and_spaces(spark):
    assert one(spark, text.count_words(F.lit("  a b\tc　d "))) == 4
    assert one(spark, text.count_words(F.lit(None).cast("string"))) == 0
    assert one(spark, text.squeezed(F.lit("\t A\n b "))) == "a b"
    assert one(spark, text.has_cjk(F.lit("x中"))) is True


@pytest.mark.parametrize(
    ("said", "found"),
    [("Please take another dose.", "take another dose"), ("Do not take another dose.", None), ("never, take another dose; take another dose", "take another dose"), ("", None)],
)
def test_forbidden(spark, said, found):
    assert one(spark, text.first_forbidden(F.lit(said), ["stop now", "take another dose"], ["do not", "never"])) == found


@pytest.mark.parametrize(
    ("phrase", "expected"),
    [("tomorrow afternoon", dt.datetime(2026, 5, 27, 12)), ("this Tuesday 9am", dt.datetime(2026, 5, 27, 9)), ("next Tuesday at 9", dt.datetime(2026, 6, 2, 9)), ("20:30", dt.datetime(2026, 5, 26, 20, 30)), ("", None)],
)
def test_resolve_time(spark, phrase, expected):
    assert one(spark, timex.resolve_time(F.lit(phrase), F.lit("2026-05-26 11:50:06").cast("timestamp_ntz"))) == expected


def test_device_label(spark):
    label = one(spark, intent.device_label(F.lit("把音量调到 230")))
    assert label["slots"] == {"adjustment": "set", "level": "100"} and label["confidence"] == 0.9
    assert one(spark, intent.device_label(F.lit("切换到 3 通道看车库画面")))["slots"] == {"action": "switch_channel", "channel": "3", "scene": "车库"}
    assert one(spark, intent.device_label(F.lit(None).cast("string")))["intent"] is None


@pytest.mark.parametrize(
    ("raw", "name"),
    [
        ('{"tool_calls": [{"function": {"name": "a", "arguments": "{\\"k\\": 1}"}}]}', "a"),
        ("<think></think><function=b><parameter=k>\n1\n</parameter></function>", "b"),
        ('<tool_call>{"name": "c", "arguments": {"k": "1"}}</tool_call>', "c"),
        ("<function=d></function>", None),
        ("plain", None),
        ("", None),
    ],
)
def test_tool_call(spark, raw, name):
    call = one(spark, jsonx.tool_call(F.lit(raw)))
    assert (call and call["name"]) == name
    assert call is None or call["arguments"] == {"k": "1"}


def test_strict_json(spark):
    df = spark.createDataFrame([('{"a": NaN}',), ('{"a":1} x',), ("[1]",), ("3",), (None,)], "t string")
    assert [r[0] for r in df.select(jsonx.strict_kind(F.col("t"))).collect()] == ["object", "invalid", "array", "scalar", "invalid"]
    two = spark.createDataFrame([('x {"a":1} u {"b":2} y',)], "t string")
    assert two.select(jsonx.extract_object(F.col("t"))).first()[0] is None


def test_compare_arguments(spark):
    m = lambda d: F.create_map(*[F.lit(x) for kv in d.items() for x in kv]) if d else F.create_map().cast("map<string,string>")
    got = one(spark, jsonx.compare_arguments(m({"task": " Buy  milk", "time": "noon", "x": "1"}), m({"task": "buy milk", "time": "night"})))
    assert (got["checked"], got["ok"], got["notes"]) == (3, 1, ["mismatch:time", "missing:x"])


def test_splits_are_disjoint_and_whole(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2] if i < 10 else None) for i in range(11)], "id long, s string")
    parts = planning.stratified_split(df, "id", "s", 0.3, 1)
    assert parts.count() == 11 and parts.where("part = 'val'").count() == 4
    assert planning.random_split(df, "id", 0.3, 1).where("part = 'val'").count() == 3
    assert planning.random_split(df.limit(0), "id", 0.3, 1).count() == 0


@pytest.mark.parametrize("total", [3, 10, 298, 1000])
def test_quota_sums(spark, total):
    df = spark.createDataFrame([(i, w) for i, w in enumerate([100, 50, 1, 1])], "k int, w long")
    got = [r["quota"] for r in planning.allocate_quota(df, "k", "w", total).orderBy("k").collect()]
    assert sum(got) == total and (total < 4 or min(got) >= 1)


def test_profile_on_empty_table(spark):
    empty = spark.createDataFrame([], "text string, id long")
    assert profile.word_lengths(empty, "text").first().asDict() == {"n": 0, "min_words": 0, "max_words": 0, "avg_words": 0.0}
    assert profile.share(empty, F.lit(True)).first()["ratio"] == 0.0
    assert profile.surplus(profile.duplicate_groups(empty, F.col("text"), "id")).first()["surplus"] == 0


NOW = "2026-05-26T12:00:00+08:00"


def reminders(spark):
    rows = [("rem_0001", "play basketball", "2026-05-27T09:00:00+08:00", "tomorrow"), ("rem_0002", "play football", "2026-05-27T10:00:00+08:00", "tomorrow"), ("odd", "buy milk", None, "")]
    return spark.createDataFrame([(*r, "self", "active", NOW, NOW, None) for r in rows], store.REMINDER)


def test_store_protocol(spark):
    held = reminders(spark)
    asked = spark.createDataFrame([(1, None, "basketball", None, None), (2, None, None, "tomorrow", None), (3, None, "swimming", None, None), (4, "odd", "x", None, None)], "request_id long, reminder_id string, task string, time_text string, time_iso string")
    results = store.outcome(store.candidates(asked, held), asked)
    assert {r["request_id"]: (r["status"], r["reminder_id"]) for r in results.collect()} == {1: ("success", "rem_0001"), 2: ("ambiguous", None), 3: ("not_found", None), 4: ("success", "odd")}
    after = store.delete(held, results, NOW)
    assert {r["reminder_id"] for r in store.active(after).collect()} == {"rem_0002"}
    diff = store.snapshot_diff(held, after, "reminder_id", ["task", "status"]).first()
    assert (diff["created_count"], diff["deleted_count"], diff["changed_count"]) == (0, 0, 2)
    same = store.snapshot_diff(held, held, "reminder_id", ["task", "status"]).first()
    assert sum(same) == 0


def test_create_and_update(spark):
    asked = spark.createDataFrame([(1, "walk", "noon", "2026-05-27T12:00:00+08:00"), (2, "", "noon", "2026-05-27T12:00:00+08:00"), (3, "run", "sometime", None)], "request_id long, task string, time_text string, time_iso string")
    after, results = store.create(reminders(spark), asked, NOW)
    got = {r["request_id"]: (r["status"], r["missing_fields"], r["reminder_id"]) for r in results.collect()}
    assert got == {1: ("success", [], "rem_0003"), 2: ("missing_fields", ["task"], None), 3: ("missing_fields", ["time_text"], None)}
    assert after.count() == 4
    changes = spark.createDataFrame([("odd", "buy bread", None, None)], "reminder_id string, new_task string, new_time_text string, new_time_iso string")
    assert store.update(after, changes, NOW).where("reminder_id = 'odd'").first()["task"] == "buy bread"


def test_judges(spark):
    z = F.lit(0)
    lit = lambda x: F.lit(x).cast("string")
    judge = lambda e, t, s, b=0, a=0, c=0: one(spark, evaluation.judge_tool(lit(e), lit(t), lit(s), F.lit(b), F.lit(a), z, z, F.lit(c)))
    assert judge("success", "create", "success", 2, 3) == "ok"
    assert judge("success", "delete", "success", 2, 2) != "ok"
    assert judge("no_tool", None, None) == "ok"
    assert judge("not_found", "query", "not_found", c=1) == "changed storage"
    assert judge("success", "query", None) == "status: none for success"
    assert one(spark, evaluation.judge_answer(lit("ambiguous"), lit("Which one?"))) is True


def test_conversation_rules(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (2, 0, "user", "u"), (3, 0, "system", "s"), (3, 1, "user", " "), (3, 2, "robot", "x")]
    got = {r["conv_id"]: r["reason"] for r in quality.first_failure(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got == {1: "ok", 2: "under 3 messages", 3: "user message is blank"}


def test_levels(spark):
    rows = [(1, i, "set_volume", a, v) for i, (a, v) in enumerate([("set", "max"), ("down", None), ("set", "6.0"), ("set", "-5"), ("down", None)])]
    got = device.fold_levels(spark.createDataFrame(rows, "d int, i int, intent string, adjustment string, level string"), "d", ["i"]).first()
    assert (got["volume"], got["brightness"], got["applied"]) == (0, 60, 5)


def test_due(spark):
    t = lambda s: F.lit(s).cast("timestamp_ntz")
    at = lambda now, seen=None: one(spark, due.is_due(t("2026-01-01 10:00:00"), t(now), 30, F.lit(True), t(seen)))
    assert [at("2026-01-01 09:29:59"), at("2026-01-01 09:30:00"), at("2026-01-01 10:00:00"), at("2026-01-01 10:00:01")] == [False, True, True, False]
    assert at("2026-01-01 09:40:00", "2026-01-01 09:35:00") is False
    assert at("2026-01-01 09:40:00", "2026-01-01 08:00:00") is True


def test_sources(spark, tmp_path):
    lines = tmp_path / "a.jsonl"
    lines.write_text('{"a": 1}\n\n[2]\nbroken\n')
    good, bad = files.quarantined(files.numbered_lines(spark, str(lines)))
    assert [r["line"] for r in good.collect()] == [1]
    assert sorted((r["line"], r["error"]) for r in bad.collect()) == [(3, "expected JSON object"), (4, "malformed JSON")]
    with pytest.raises(Exception, match="expected JSON object"):
        files.strict_objects(files.numbered_lines(spark, str(lines))).collect()
    seeds = tmp_path / "seed.md"
    seeds.write_text("﻿| tool | scenario | seed | number | outcome | notes |\n|---|---|---|---|---|---|\n| create | c1 | hi | 3 | success | n |\n| short |\n", encoding="utf-8")
    assert [tuple(r) for r in files.seed_table(spark, str(seeds)).collect()] == [("create", "c1", "hi", 3, "success", "n")]
    (tmp_path / "arr").mkdir()
    (tmp_path / "arr/x.json").write_text('[{"id": 1}, {"id": 2}]')
    (tmp_path / "arr/y.json").write_text("{broken")
    assert sorted(r["id"] for r in files.json_array(spark, str(tmp_path / "arr"), "id long").collect()) == [1, 2]
    case = tmp_path / "cases/c7"
    case.mkdir(parents=True)
    (case / "input.json").write_text('{"prompt":\n "p"}')
    assert tuple(files.case_files(spark, str(tmp_path / "cases"), "input.json", "prompt string").first()) == ("c7", "p")
    files.write_jsonl(good, str(tmp_path / "out"), order="line")
    assert files.jsonl(spark, str(tmp_path / "out"), "line long, raw string").count() == 1


def test_kinds_of_nothing(spark):
    rows = spark.createDataFrame([(0, None), (1, "{}")], "i int, t string").select("i", jsonx.strict_kind(F.col("t")).alias("k")).collect()
    assert {r["i"]: r["k"] for r in rows} == {0: "invalid", 1: "object"}


def test_dispatch_keeps_order(spark):
    from quillon.operators import cases

    rows = [(1, 0, "query", "walk", None), (1, 1, "create", "Walk dog", None), (1, 2, "query", "walk", None), (1, 3, "create", "walk cat", None), (1, 4, "delete", "walk", None), (1, 5, "update", "cat", "Feed cat"), (1, 6, "delete", "feed cat", None), (1, 7, "delete", "feed cat", None), (2, 0, "create", "", None)]
    got = {(r["conv_id"], r["seq"]): r["status"] for r in cases.dispatch(spark.createDataFrame(rows, "conv_id long, seq long, tool string, task string, new_task string")).collect()}
    assert [got[1, i] for i in range(8)] == ["not_found", "success", "success", "success", "ambiguous", "success", "success", "not_found"]
    assert got[2, 0] == "missing_fields"


def test_starting_reminders(spark):
    from quillon.operators import cases

    gold = "struct<task:string,time_text:string,locator_task:string,locator_time_text:string>"
    rows = [(1, "delete", "success", "basketball_day", (None, None, "call mum", "tonight at 8 PM")), (2, "create", "no_tool", "x", (None, None, None, None))]
    out = cases.starting_reminders(spark.createDataFrame(rows, f"case_id int, tool string, expected_outcome string, scenario string, gold {gold}"), "2026-05-26 11:50:06", "+08:00").orderBy("case_id", "place").collect()
    assert [(r["case_id"], r["reminder_id"], r["scheduled_time"]) for r in out] == [
        (1, "rem_0001", "2026-05-26T20:00:00+08:00"),
        (1, "rem_d001", "2026-05-27T09:00:00+08:00"),
        (1, "rem_d002", "2026-05-26T21:00:00+08:00"),
        (1, "rem_basketball", "2026-05-27T16:00:00+08:00"),
        (2, "rem_d001", "2026-05-27T09:00:00+08:00"),
        (2, "rem_d002", "2026-05-26T21:00:00+08:00"),
    ]
    assert out[0]["created_at"] == "2026-05-24T10:50:06+08:00"
