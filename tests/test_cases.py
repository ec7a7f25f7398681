"""Merged replies, variations and expectations on awkward input."""

from pyspark.sql import functions as F

from quillon.operators import cases, evaluation, planning, profile

GOLD = "task string, time_text string, locator_task string, locator_time_text string, new_task string, new_time_text string"


def merged(spark, reply, **planned):
    plan = tuple(planned.get(f.split()[0]) for f in GOLD.split(", "))
    df = spark.createDataFrame([(reply, plan)], f"reply string, plan struct<{GOLD.replace(' ', ':').replace(',:', ',')}>")
    return df.select(cases.merged_gold(F.col("reply"), F.col("plan")).alias("m")).first()["m"]


def test_merged_gold(spark):
    assert merged(spark, None)["error"] == "no JSON object" and merged(spark, "[1]")["error"] == "no JSON object" and merged(spark, "")["error"] == "no JSON object"
    assert merged(spark, '{"prompt": null}')["error"] == "missing prompt" and merged(spark, '{"prompt": "  "}')["error"] == "missing prompt"
    m = merged(spark, '```json\n{"prompt": " a\\n b ", "task": 5, "new_task": " x ", "gold": {"time_text": null, "new_task": "", "locator_task": "y"}}\n```', task="t", time_text="at 7", locator_time_text="kept")
    assert (m["error"], m["prompt"]) == (None, "a b")
    assert m["gold"].asDict() == {"task": None, "time_text": None, "locator_task": "y", "locator_time_text": "kept", "new_task": "x", "new_time_text": None, "target": "self"}
    assert merged(spark, '{"prompt": 7}', task="t")["prompt"] == "7"
    assert merged(spark, '{"prompt": "p", "gold": null}', task="t")["gold"]["task"] == "t"


def test_expectations(spark):
    rows = [("success", "delete"), ("success", None), ("not_found", "query"), ("no_tool", "create"), (None, "create"), ("success", "chat")]
    out = [r["x"] for r in spark.createDataFrame(rows, "e string, t string").coalesce(1).select(evaluation.expectation(F.col("e"), F.col("t"), F.lit("s")).alias("x")).collect()]
    assert [x["should_call_tool"] for x in out] == [True, False, True, False, False, False]
    assert [x["state_change"] for x in out] == ["delete_or_cancel_one", "no_change", "no_change", "no_change", "unknown", "no_change"]
    assert [len(x["diff_assertions"]) for x in out] == [2, 1, 2, 2, 1, 1] and out[2]["diff_assertions"][1] == "tool_result.status == 'not_found'"


def test_variations_go_round(spark):
    df = spark.range(6).select(cases.variation(F.lit("ambiguous"), F.lit("x_missing_task"), F.col("id"), F.lit("seed"), ["a", "b", "c"], ["p", "q"]).alias("v"))
    out = [r["v"] for r in df.coalesce(1).collect()]
    assert {x["style"] for x in out[:3]} == {"a", "b", "c"} and out[0]["style"] == out[3]["style"] and out[0]["complexity"] != out[1]["complexity"]
    assert all(x["avoid"].endswith("the prompt must not mention the task; leave the target reminder underspecified") for x in out)


def test_rows_at_and_last_of_role(spark):
    df = spark.createDataFrame([(i * 3, f"t{i}") for i in range(10)], "k long, t string").repartition(3)
    assert {(r["asked"], r["t"]) for r in planning.rows_at(df, "k", [0, 4, 99, -1]).collect()} == {(0, "t0"), (4, "t4"), (99, "t9"), (-1, "t0")}
    assert planning.rows_at(df.limit(0), "k", [0]).count() == 0
    turns = spark.createDataFrame([("c", 1, "user", "a"), ("c", 2, "tool", "b"), ("c", 3, "user", None), ("d", 1, None, "x")], "c string, n int, r string, t string")
    assert {tuple(r) for r in profile.last_of_role(turns, "c", "n", "r", "user", "t").collect()} == {("c", 3, None, 2), ("d", None, None, 0)}
