"""Structure of conversations: first failing rule, and cleaning with quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROLES = ["system", "user", "assistant", "tool"]

# Tool and status that each scenario must show.
SCENARIOS = {
    "create_success": ("create_reminder", "success"),
    "create_missing_task": ("create_reminder", "missing_fields"),
    "create_missing_time": ("create_reminder", "missing_fields"),
    "query_success": ("query_reminder", "success"),
    "query_not_found": ("query_reminder", "not_found"),
    "query_vague_memory": ("query_reminder", "success"),
    "update_success": ("update_reminder", "success"),
    "update_ambiguous": ("update_reminder", "ambiguous"),
    "update_missing": ("update_reminder", "missing_fields"),
    "delete_success": ("delete_reminder", "success"),
    "delete_ambiguous": ("delete_reminder", "ambiguous"),
    "delete_missing": ("delete_reminder", "missing_fields"),
}
# What an answer says where it says nothing.
MESSAGES = {"missing_fields": "Missing required field(s).", "not_found": "No matching reminder found.", "error": "Tool execution error."}


def neighbours(df: DataFrame, conversation: str, turn: str, role: str) -> DataFrame:
    """``df`` with ``next_role`` and ``previous_role`` in turn order."""
    own = Window.partitionBy(conversation).orderBy(turn)
    return df.withColumn("next_role", F.lead(role).over(own)).withColumn("previous_role", F.lag(role).over(own))


def first_failure(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conversation`` and ``reason``, the first failing structural rule or ``ok``."""
    at = F.struct(turn, role, text)
    first, n = F.min(at), F.count(F.lit(1))
    second = F.min(F.when(F.col("_n") == 2, F.struct(role, text)))
    ranked = df.withColumn("_n", F.row_number().over(Window.partitionBy(conversation).orderBy(turn)))
    odd = F.min(F.when(~F.coalesce(F.col(role).isin(*ROLES), F.lit(False)), F.coalesce(role, F.lit("null"))))
    judged = ranked.groupBy(conversation).agg(n.alias("n"), first.alias("one"), second.alias("two"), odd.alias("odd"))
    reason = (
        F.when(F.col("n") < 3, "under 3 messages")
        .when(~F.col(f"one.{role}").eqNullSafe(F.lit("system")), "first message is not system")
        .when(~F.col(f"two.{role}").eqNullSafe(F.lit("user")), "second message is not user")
        .when(F.trim(F.coalesce(f"two.{text}", F.lit(""))) == "", "user message is blank")
        .when(F.col("odd").isNotNull(), F.concat(F.lit("invalid role: "), "odd"))
        .otherwise("ok")
    )
    return judged.select(conversation, reason.alias("reason"))


def reasons(df: DataFrame) -> DataFrame:
    """Histogram of a ``reason`` column."""
    return df.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def expected_of(scenario: Column, i: int) -> Column:
    return F.element_at(F.create_map(*[x for k, v in SCENARIOS.items() for x in (F.lit(k), F.lit(v[i]))]), F.coalesce(scenario, F.lit("")))


def clean_payload(scenario: Column, tool: Column, payload: Column, kind: Column) -> Column:
    """``(error, status, is_success, reminder_id, message)`` of a tool's JSON answer; ``error`` is null where it can be kept.

    A blank status is the scenario's; any other than the scenario's is an error,
    as is a success without the id that it must name.
    """
    field = lambda p: F.get_json_object(payload, p)
    wanted = expected_of(scenario, 1)
    status = F.coalesce(F.nullif(field("$.status"), F.lit("")), wanted, F.lit("error"))
    reminder = F.nullif(F.coalesce(field("$.reminder_id"), F.when(tool == "delete_reminder", field("$.deleted_reminder.reminder_id")).otherwise(F.coalesce(field("$.reminder.reminder_id"), field("$.reminder.id")))), F.lit(""))
    needs_id = (status == "success") & tool.isin("create_reminder", "update_reminder", "delete_reminder")
    error = (
        F.when(kind != "object", F.lit("payload is no object"))
        .when(expected_of(scenario, 0).isNull(), F.lit("tool message outside a tool scenario"))
        .when(~tool.eqNullSafe(expected_of(scenario, 0)), F.lit("tool mismatch"))
        .when(status != wanted, F.lit("status mismatch"))
        .when(needs_id & reminder.isNull(), F.lit("no reminder_id"))
        .when((status == "success") & (tool == "query_reminder") & ~F.coalesce(F.startswith(field("$.reminders"), F.lit("[")), F.lit(False)), F.lit("no reminders"))
    )
    default = F.element_at(F.create_map(*[F.lit(x) for kv in MESSAGES.items() for x in kv]), status)
    message = F.when(status.isin(*MESSAGES), F.coalesce(F.when(F.trim(field("$.message")) != "", field("$.message")), default))
    return F.struct(error.alias("error"), status.alias("status"), (status == "success").alias("is_success"), F.when(status == "success", reminder).alias("reminder_id"), message.alias("message"))
