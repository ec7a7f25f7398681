"""Tool calls against the registry: the error of a call that cannot run, and requests for those that can."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions.jsonx import strict_kind
from quillon.scratch import SHUFFLED

# The tools, the arguments that each takes and those that it needs.
REGISTRY = [
    ("create_reminder", ["time_text", "task", "target"], ["time_text", "task"]),
    ("query_reminder", ["time_text", "task", "target"], []),
    ("update_reminder", ["reminder_id", "time_text", "task", "new_time_text", "new_task", "target"], []),
    ("delete_reminder", ["reminder_id", "time_text", "task", "target"], []),
]
ARGUMENTS = "map<string,string>"


def registry(spark: SparkSession) -> DataFrame:
    """``tool``, ``takes`` and ``needs``: one row a tool."""
    return spark.createDataFrame(REGISTRY, "tool string, takes array<string>, needs array<string>")


def judged_calls(calls: DataFrame, tools: DataFrame) -> DataFrame:
    """``calls`` (``call_id``, ``name``, ``arguments`` as JSON text) with ``args`` and ``payload``.

    ``payload`` is the JSON answer to a call that cannot run, or null: unknown
    tool, malformed arguments, arguments that are no object, missing fields (in
    the order of the tool's needs), arguments that the tool does not take.
    Null arguments count as none; a blank string or null value is missing.
    """
    known = calls.join(F.broadcast(tools), F.col("name") == F.col("tool"), "left")  # one row a tool
    raw = F.coalesce("arguments", F.lit("{}"))
    kind = strict_kind(raw)
    known = known.withColumn("kind", kind).withColumn("args", F.when(F.col("kind") == "object", F.from_json(raw, ARGUMENTS)))
    args = F.coalesce("args", F.create_map().cast(ARGUMENTS))
    missing = F.filter("needs", lambda k: F.coalesce(F.element_at(args, k), F.lit("")) == "")
    extra = F.array_except(F.map_keys(args), F.col("takes"))
    said = lambda status, *text: error_payload(F.lit(status), F.concat(*text))
    listed = F.array_join(missing, ", ")
    # The texts of errors.
    payload = (
        F.when(F.col("tool").isNull(), said("error", F.lit("Unknown tool: "), F.coalesce("name", F.lit("None"))))
        .when(F.col("kind") == "invalid", said("error", F.lit("Malformed JSON in tool arguments.")))
        .when(F.col("kind") != "object", said("error", F.lit("Invalid tool arguments: no object")))
        .when(F.size(missing) > 0, error_payload(F.lit("missing_fields"), F.concat(F.lit("Missing required field(s): "), listed), missing))
        .when(F.size(extra) > 0, said("error", F.lit("Invalid tool arguments: unexpected "), F.array_join(extra, ", ")))
    )
    return known.withColumn("payload", payload).drop("tool", "takes", "needs", "kind")


def error_payload(status: Column, message: Column, missing: Column | None = None) -> Column:
    """JSON of an answer that says what went wrong."""
    fields = [F.lit(False).alias("state"), status.alias("status"), message.alias("message")]
    return F.to_json(F.struct(*fields, *([missing.alias("missing_fields")] if missing is not None else [])))


def requests_of(calls: DataFrame, iso: Column, *keep: str) -> DataFrame:
    """The calls of ``judged_calls`` that can run, as requests for the store, with the columns ``keep``; ``iso`` resolves the
    column ``said`` to a time."""
    runs = calls.where("payload is null")
    arg = lambda k: F.element_at("args", F.lit(k))
    names = ["reminder_id", "task", "time_text", "new_task", "new_time_text"]
    out = runs.select(F.col("call_id").alias("request_id"), F.regexp_replace("name", "_reminder$", "").alias("tool"), *keep, *[arg(k).alias(k) for k in names])
    for k in ("time", "new_time"):
        out = out.withColumn("said", F.col(f"{k}_text")).withColumn(f"{k}_iso", iso)
    return out.drop("said")


def tool_messages(calls: DataFrame, results: DataFrame) -> DataFrame:
    """One tool message a call: ``call_id``, ``name`` and ``content``, the error's or the store's answer as JSON."""
    found = results.select(
        F.col("request_id").alias("call_id"),
        F.to_json(F.struct((F.col("status") == "success").alias("state"), "status", "missing_fields", "reminder_id", F.col("candidates").alias("reminders"))).alias("answer"),
    )
    return calls.join(found.hint(SHUFFLED), "call_id", "left").select("call_id", F.coalesce("name", F.lit("unknown")).alias("name"), F.coalesce("payload", "answer").alias("content"))
