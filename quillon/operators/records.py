"""Whole chat samples, one row each: the contract of tool scenarios and their normal form.

A sample has ``scenario`` and ``messages``, an array of structs with ``role``,
``content``, ``call_id``, ``call_name`` and ``call_arguments``; the last three
are those of the message's first tool call, or null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillon.functions.jsonx import canonical, strict_kind, variant_of
from quillon.functions.text import let, strip
from quillon.functions.variants import field, is_a, members, text_of, truthy
from quillon.operators.payloads import normal_answer
from quillon.operators.quality import ROLES, expected_of

MESSAGE = "struct<role:string,content:string,call_id:string,call_name:string,call_arguments:string>"
# The statuses that a tool may answer with, and the scenario's words that choose one where it gives none.
STATUSES = ["success", "missing_fields", "not_found", "ambiguous", "error"]
FALLBACKS = [("missing", "missing_fields"), ("ambiguous", "ambiguous"), ("not_found", "not_found")]


def samples(turns: DataFrame, key: str, turn: str, scenario: str) -> DataFrame:
    """``key``, ``scenario`` and ``messages`` in turn order, from one row a message with the fields of ``MESSAGE``.

    A conversation is one sample, so its messages meet in one row.
    """
    fields = [f.split(":")[0] for f in MESSAGE[7:-1].split(",")]
    rows = turns.groupBy(key).agg(F.min(scenario).alias("scenario"), F.array_sort(F.collect_list(F.struct(F.col(turn).alias("at"), F.struct(*fields).alias("m")))).alias("ms"))
    return rows.select(key, "scenario", F.transform("ms", lambda x: x["m"]).cast(f"array<{MESSAGE}>").alias("messages"))


def _is_call(m: Column) -> Column:
    return F.coalesce((m["role"] == "assistant") & m["call_name"].isNotNull(), F.lit(False))


def _is_tool(m: Column) -> Column:
    return F.coalesce(m["role"] == "tool", F.lit(False))


def first_call(messages: Column) -> Column:
    """The first message with a tool call, or null."""
    return F.get(F.filter(messages, _is_call), F.lit(0))


def last_message(messages: Column) -> Column:
    """The last message, or null."""
    return F.try_element_at(messages, F.lit(-1))


def user_message(messages: Column) -> Column:
    """The message behind the first, or null."""
    return F.get(messages, F.lit(1))


def _silent(m: Column) -> Column:
    """A message with a call, without its content."""
    return F.when(_is_call(m), m.withField("content", F.lit(None).cast("string"))).otherwise(m)


def cleaned(rows: DataFrame) -> DataFrame:
    """``rows`` with ``messages`` cleaned, ``error`` (why a sample must go, or null) and ``changed``.

    The last call and the last tool message count.  A tool scenario needs both,
    and its tool; any other must have neither.  The tool's content becomes that
    of ``payloads.normal_answer`` where the two differ as values (the order of
    keys does not count); ``changed`` tells whether it did.
    """
    rows = rows.withColumn("_call", F.try_element_at(F.filter("messages", _is_call), F.lit(-1)))
    rows = rows.withColumn("_tool", F.try_element_at(F.filter("messages", _is_tool), F.lit(-1)))
    arguments = F.coalesce("_call.call_arguments", F.lit("{}"))
    content = F.coalesce("_tool.content", F.lit("{}"))
    rows = rows.withColumn("_kinds", F.struct(strict_kind(arguments).alias("arguments"), strict_kind(content).alias("content")))
    rows = rows.withColumn("_payload", variant_of(F.when(F.col("_kinds.content") != "invalid", content)))
    answer = normal_answer(F.col("scenario"), F.col("_call.call_name"), variant_of(F.when(F.col("_kinds.arguments") == "object", arguments)), F.col("_payload"))
    rows = rows.withColumn("_answer", answer)
    wanted = expected_of(F.col("scenario"), 0)
    # The texts of the first three reasons.
    error = (
        F.when(F.col("messages").isNull(), "messages must be list")
        .when(wanted.isNull(), F.when(F.col("_call").isNotNull() | F.col("_tool").isNotNull(), "no_tool scenario contains tool messages"))
        .when(F.col("_call").isNull() | F.col("_tool").isNull(), "tool scenario missing assistant/tool message")
        .when(~F.col("_call.call_name").eqNullSafe(wanted), "tool mismatch")
        .when(F.col("_kinds.arguments") == "invalid", "malformed arguments")
        .when(F.col("_kinds.content") == "invalid", "malformed payload")
        .when(F.col("_payload").isNull(), "payload repeats a key")
        .otherwise(F.col("_answer.error"))
    )
    rows = rows.withColumn("error", error)
    differs = ~canonical(variant_of(F.col("_answer.content"))).eqNullSafe(canonical(F.col("_payload")))
    rows = rows.withColumn("changed", F.coalesce(F.col("error").isNull() & wanted.isNotNull() & differs, F.lit(False)))
    fixed = lambda m: F.when(F.col("changed") & _is_tool(m) & m.eqNullSafe(F.col("_tool")), m.withField("content", F.col("_answer.content"))).otherwise(m)
    return rows.withColumn("messages", F.transform("messages", lambda m: _silent(fixed(m)))).drop("_call", "_tool", "_kinds", "_payload", "_answer")


def clean_report(rows: DataFrame) -> DataFrame:
    """One row of counts over ``cleaned`` samples: ``total``, ``kept``, ``changed`` and ``rejected``."""
    kept = F.col("error").isNull()
    return rows.agg(F.count(F.lit(1)).alias("total"), F.count_if(kept).alias("kept"), F.count_if(kept & F.col("changed")).alias("changed"), F.count_if(~kept).alias("rejected"))


def first_fault(sample: Column, scenario: Column, system: str) -> Column:
    """Why a whole sample, a JSON object with ``messages``, is not valid, or null.

    A fold over the messages, each with the one behind it, keeps the first rule
    that fails and what was seen so far: a call, a tool's answer, the tool called
    last, the statuses answered.  Rules are those of the head (three messages, the
    system's text ``system``, a user who says something), of every message (its
    role; of a call: content given and null, the tool's answer right behind, calls
    well formed with arguments that are JSON; of an answer: JSON text with a known
    status) and of the whole (calls and answers as the scenario has them, its
    tool, one status).
    """
    return let(F.struct(members(field(variant_of(sample), "messages")).alias("m"), scenario.alias("s")), lambda x: _fault(x["m"], x["s"], system))


def _fault(messages: Column, scenario: Column, system: str) -> Column:
    # The texts of all reasons below.
    null = F.lit(None).cast("string")
    role = lambda m: text_of(field(m, "role"))

    def call_fault(c: Column) -> Column:
        f = field(c, "function")
        arguments = text_of(field(f, "arguments"))
        return (
            F.when(~text_of(field(c, "type")).eqNullSafe(F.lit("function")), "tool_call.type must be function")
            .when(~is_a(f, "OBJECT"), "tool_call.function must be object")
            .when(F.coalesce(strip(text_of(field(f, "name"))), F.lit("")) == "", "tool_call.function.name missing")
            .when(arguments.isNull(), "tool_call.function.arguments must be JSON string")
            .when(strict_kind(arguments) == "invalid", "tool_call.function.arguments must be JSON")
        )

    def fault(m: Column, following: Column, calls: Column, called: Column, status: Column) -> Column:
        content = field(m, "content")
        of_call = (
            F.when(content.isNull(), "assistant tool call message must include content field")
            .when(~F.is_variant_null(content), "assistant tool call message content must be null")
            .when(~role(following).eqNullSafe(F.lit("tool")), "assistant.tool_calls must be followed immediately by role=tool")
            .when(~is_a(calls, "ARRAY"), "tool_calls must be a non-empty list")
            .otherwise(F.get(F.array_compact(F.transform(members(calls), call_fault)), F.lit(0)))
        )
        stated = field(variant_of(text_of(content)), "status")
        of_answer = (
            F.when(text_of(content).isNull(), "tool content must be JSON string")
            .when(strict_kind(text_of(content)) == "invalid", "tool content must be JSON")
            .when(stated.isNull(), "tool payload must include status")
            .when(F.coalesce(strip(status), F.lit("")) == "", "tool payload status must be non-empty string")
            .when(~status.isin(*STATUSES), "tool payload status must be one of " + ", ".join(sorted(STATUSES)))
        )
        unknown = F.when(~F.coalesce(role(m).isin(*ROLES), F.lit(False)), F.concat(F.lit("invalid role: "), F.coalesce(role(m), F.lit("None"))))
        return F.coalesce(unknown, F.when(called, of_call), F.when(role(m) == "tool", of_answer))

    def seen(m: Column, following: Column) -> Column:
        calls = field(m, "tool_calls")
        called = F.coalesce(role(m) == "assistant", F.lit(False)) & truthy(calls)
        status = F.when(role(m) == "tool", text_of(field(variant_of(text_of(field(m, "content"))), "status")))
        name = F.when(called, strip(text_of(field(field(F.try_element_at(members(calls), F.lit(-1)), "function"), "name"))))
        return F.struct(fault(m, following, calls, called, status).alias("fault"), called.alias("called"), F.coalesce(role(m) == "tool", F.lit(False)).alias("told"), name.alias("name"), status.alias("status"))

    def whole(steps: Column) -> Column:
        start = F.struct(null.alias("fault"), F.lit(False).alias("called"), F.lit(False).alias("told"), null.alias("name"), F.array().cast("array<string>").alias("statuses"))
        put = lambda state, x: F.struct(
            F.coalesce(state["fault"], x["fault"]).alias("fault"), (state["called"] | x["called"]).alias("called"), (state["told"] | x["told"]).alias("told"),
            F.coalesce(x["name"], state["name"]).alias("name"), F.when(x["told"], F.array_append(state["statuses"], x["status"])).otherwise(state["statuses"]).alias("statuses"),
        )
        wanted = expected_of(scenario, 0)
        end = lambda z: (
            F.when(z["fault"].isNotNull(), z["fault"])
            .when(F.startswith(scenario, F.lit("no_tool")), F.when(z["called"] | z["told"], "no_tool scenario must not contain tool_calls or role=tool"))
            .when(~(z["called"] & z["told"]), "tool scenario must contain assistant.tool_calls and role=tool")
            .when(wanted.isNotNull() & ~z["name"].eqNullSafe(wanted), F.concat(F.lit("scenario="), scenario, F.lit(" expected tool="), wanted, F.lit(", got tool="), F.coalesce(z["name"], F.lit("None"))))
            .when(F.size(z["statuses"]) != 1, F.concat(F.lit("tool scenario expects exactly one tool status, got "), F.array_join(z["statuses"], ", ")))
        )
        return F.aggregate(steps, start, put, end)

    first, second = F.get(messages, F.lit(0)), F.get(messages, F.lit(1))
    said = text_of(field(second, "content"))
    following = F.concat(F.slice(messages, F.lit(2), F.greatest(F.size(messages) - 1, F.lit(0))), F.array(F.lit(None).cast("variant")))
    return (
        F.when(messages.isNull(), "messages must be list")
        .when(F.size(messages) < 3, "sample must have at least 3 messages")
        .when(~role(first).eqNullSafe(F.lit("system")), "first message must be system")
        .when(~text_of(field(first, "content")).eqNullSafe(F.lit(system)), "system prompt does not match")
        .when(~role(second).eqNullSafe(F.lit("user")), "second message must be user")
        .when(F.coalesce(strip(said), F.lit("")) == "", "user content missing")
        .otherwise(whole(F.zip_with(messages, following, seen)))
    )


def fallback_status(scenario: Column) -> Column:
    """The status that a scenario's name asks for."""
    return F.coalesce(*[F.when(F.contains(scenario, F.lit(word)), F.lit(status)) for word, status in FALLBACKS], F.lit("success"))


def normal_payload(payload: Column, fallback: Column) -> Column:
    """JSON of a tool's answer with ``state`` and ``status`` first and, of its own fields, those of the right type."""
    kind = lambda n: F.schema_of_variant(F.try_variant_get(F.try_parse_json(payload), f"$.{n}", "variant"))
    raw = lambda n: F.get_json_object(payload, f"$.{n}")
    quoted = lambda c: F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1)
    status = F.when((kind("status") == "STRING") & raw("status").isin(*STATUSES), raw("status")).otherwise(fallback)
    pieces = [F.concat(F.lit('"state":'), F.when(status == "success", '"success"').otherwise("false")), F.concat(F.lit('"status":'), quoted(status))]
    shapes = [("message", "STRING"), ("missing_fields", "ARRAY"), ("candidates", "ARRAY"), ("reminder", "OBJECT"), ("reminders", "ARRAY"), ("reminder_id", "STRING")]
    for name, shape in shapes:
        value = quoted(raw(name)) if shape == "STRING" else raw(name)
        pieces.append(F.when(F.startswith(kind(name), F.lit(shape)), F.concat(F.lit(f'"{name}":'), value)))
    return F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*pieces)), ","), F.lit("}"))


def normalised(rows: DataFrame) -> DataFrame:
    """``rows`` with ``messages`` in normal form, ``selected_tool`` and ``error``.

    The first call decides.  Its answer follows it: a tool message that stands
    there is replaced, else one is inserted.  A message with a call has no
    content.  A scenario that begins with ``no_tool`` is left as it is.
    """
    at = F.array_position(F.transform("messages", _is_call), True)
    rows = rows.withColumn("_at", F.when(F.col("messages").isNotNull(), at).otherwise(0))
    following = F.get("messages", F.col("_at"))
    answered = _is_tool(following)
    needs = ~F.startswith("scenario", F.lit("no_tool"))
    # The texts of the reasons.
    error = F.when(F.col("messages").isNull(), "sample.messages must be a list").when(needs & (F.col("_at") == 0), "tool scenario missing assistant tool_calls message")
    call = first_call(F.col("messages"))
    given = F.when(answered & F.startswith(F.ltrim(following["content"]), F.lit("{")), following["content"]).otherwise(F.lit("{}"))
    text = normal_payload(given, fallback_status(F.col("scenario")))
    null = F.lit(None).cast("string")
    tool = F.struct(F.lit("tool").alias("role"), text.alias("content"), call["call_id"].alias("call_id"), null.alias("call_name"), null.alias("call_arguments")).cast(MESSAGE)
    plain = F.transform("messages", _silent)
    n = F.size("messages")
    rest = F.slice(plain, F.col("_at") + F.when(answered, 2).otherwise(1), F.greatest(n - F.col("_at"), F.lit(0)))
    placed = F.concat(F.slice(plain, F.lit(1), F.col("_at")), F.array(tool), rest)
    out = F.when(needs & (F.col("_at") > 0), placed).otherwise(plain)
    return rows.select(*[c for c in rows.columns if c not in ("messages", "_at")], out.alias("messages"), call["call_name"].alias("selected_tool"), error.alias("error"))
