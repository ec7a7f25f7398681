"""Gold, judges and metrics of tool-use evaluations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions.text import has_any
from quillon.operators.profile import safe_ratio

TOOLS = ["create", "query", "update", "delete"]

# Phrases that an answer must hold, by expected outcome.
ANSWER_WORDS = {
    "success": ["done", "created", "updated", "deleted", "scheduled", "found", "cancelled", "canceled"],
    "missing_fields": ["what", "which", "when", "missing", "need"],
    "ambiguous": ["which one", "choose", "select", "multiple"],
    "not_found": ["not found", "no matching", "couldn't find", "cannot find"],
}
# What a case should do to the snapshot, by tool.
STATE_CHANGE = {"create": "create_one", "query": "no_change", "update": "update_one", "delete": "delete_or_cancel_one"}


def tool_name(tool: Column) -> Column:
    """``create`` to ``create_reminder`` and so on; null for others."""
    return F.when(tool.isin(*TOOLS), F.concat(tool, F.lit("_reminder")))


def judge_tool(expected: Column, tool: Column, status: Column, before: Column, after: Column, created: Column, deleted: Column, changed: Column) -> Column:
    """``ok``, or why the tool's status or its effect on the snapshot is wrong."""
    touched = (created != 0) | (deleted != 0) | (changed != 0)
    said = F.coalesce(status, F.lit("none"))
    return (
        F.when((expected == "no_tool") & status.isNotNull(), F.concat(F.lit("unexpected call: "), said))
        .when((expected != "no_tool") & ~status.eqNullSafe(expected), F.concat(F.lit("status: "), said, F.lit(" for "), expected))
        .when((expected != "success") & touched, F.lit("changed storage"))
        .when((expected == "success") & (tool == "create") & (after != before + 1), F.lit("no reminder more"))
        .when((expected == "success") & (tool == "delete") & (after != before - 1), F.lit("no reminder less"))
        .when((expected == "success") & (tool == "update") & (changed < 1), F.lit("nothing updated"))
        .when((expected == "success") & (tool == "query") & touched, F.lit("changed storage"))
        .otherwise("ok")
    )


def judge_answer(expected: Column, text: Column) -> Column:
    """Whether an answer has a phrase of the expected outcome; any text for no_tool; true for other outcomes."""
    lower = F.lower(F.coalesce(text, F.lit("")))
    out = F.when(expected == "no_tool", F.trim(lower) != "")
    for outcome, words in ANSWER_WORDS.items():
        out = out.when(expected == outcome, has_any(lower, words))
    return out.otherwise(True)


def state_change(expected: Column, tool: Column) -> Column:
    """What a case should do to the snapshot."""
    quiet = expected.isin("missing_fields", "ambiguous", "not_found", "no_tool")
    own = F.element_at(F.create_map(*[F.lit(x) for kv in STATE_CHANGE.items() for x in kv]), F.coalesce(tool, F.lit("")))
    return F.when(expected == "success", F.coalesce(own, F.lit("no_change"))).when(quiet, F.lit("no_change")).otherwise("unknown")


# What must hold between the snapshots of a case, by tool of a success, else by outcome.
SUCCESS_ASSERTIONS = {
    "create": ["after_active_count == before_active_count + 1", "new reminder.task == gold.task", "new reminder.target == 'self'", "new reminder.scheduled_time == resolve(gold.time_text, run_now)"],
    "query": ["after_state == before_state", "tool_result.status == 'success'", "tool_result.count >= 1"],
    "update": [
        "after_active_count == before_active_count", "exactly_one_existing_reminder_changed", "changed reminder matches gold.locator_task/time before update",
        "changed reminder contains gold.new_task and/or resolve(gold.new_time_text, run_now) after update",
    ],
    "delete": ["after_active_count == before_active_count - 1 OR target reminder.status in ['cancelled','deleted']", "deleted/cancelled reminder matches gold.locator_task/time_text"],
}
NOTHING_CHANGES = "after_state == before_state"
NO_CALL = "no tool call should be emitted"
BY_HAND = "manual review required"


def diff_assertions(expected: Column, tool: Column) -> Column:
    """The assertions of a case, in order."""
    texts = lambda *x: F.array(*[F.lit(t) for t in x])
    own = F.coalesce(*[F.when(tool == name, texts(*lines)) for name, lines in SUCCESS_ASSERTIONS.items()], texts(NOTHING_CHANGES))
    told = F.array(F.lit(NOTHING_CHANGES), F.concat(F.lit("tool_result.status == '"), expected, F.lit("'")))
    return (
        F.when(expected == "success", own)
        .when(expected.isin("missing_fields", "ambiguous", "not_found"), told)
        .when(expected == "no_tool", texts(NO_CALL, NOTHING_CHANGES))
        .otherwise(texts(BY_HAND))
    )


def expectation(expected: Column, tool: Column, scenario: Column) -> Column:
    """What a case expects: whether a tool is called and which, its status, the change of the snapshot and its assertions."""
    should = (expected != "no_tool") & tool.isin(*TOOLS)
    return F.struct(
        F.coalesce(should, F.lit(False)).alias("should_call_tool"), tool_name(tool).alias("expected_tool"), expected.alias("expected_status"),
        state_change(expected, tool).alias("state_change"), scenario.alias("scenario"), diff_assertions(expected, tool).alias("diff_assertions"),
    )


def expected_arguments(action: Column, gold: dict[str, Column]) -> Column:
    """Map of the arguments that a gold asks for; updates and deletes take the locators as task and time."""
    locates = action.isin("update", "delete")
    pairs = {
        "target": F.coalesce(gold["target"], F.lit("self")),
        "task": F.when(locates, gold["locator_task"]).otherwise(gold["task"]),
        "time_text": F.when(locates, gold["locator_time_text"]).otherwise(gold["time_text"]),
        "new_task": F.when(action == "update", gold["new_task"]),
        "new_time_text": F.when(action == "update", gold["new_time_text"]),
    }
    whole = F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), v)])
    return F.when(action.isin(*TOOLS), F.map_filter(whole, lambda _, v: v.isNotNull())).otherwise(F.create_map().cast("map<string,string>"))


def call_metrics(df: DataFrame) -> DataFrame:
    """Rates over ``should_call``, ``called``, ``name_ok``, ``json_ok``, ``arg_ok`` and ``arg_checked``."""
    n = F.count(F.lit(1))
    share = lambda c: safe_ratio(F.count_if(c), n)
    return df.agg(
        n.alias("total"),
        share(F.col("should_call") == F.col("called")).alias("call_accuracy"),
        share(F.col("name_ok")).alias("name_accuracy"),
        share(F.col("json_ok")).alias("json_rate"),
        safe_ratio(F.sum("arg_ok"), F.sum("arg_checked")).alias("arg_match_rate"),
        safe_ratio(F.count_if(F.expr("name_ok and should_call")), F.count_if(F.expr("should_call"))).alias("recall"),
        safe_ratio(F.count_if(F.expr("name_ok and should_call")), F.count_if(F.expr("called"))).alias("precision"),
        safe_ratio(F.count_if(F.expr("not should_call and not called")), F.greatest(F.count_if(F.expr("not should_call")), F.lit(1))).alias("no_tool_accuracy"),
    )
