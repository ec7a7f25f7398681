"""The normal form of a tool's JSON answer, by tool and status."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillon.functions.jsonx import spaced
from quillon.functions.text import let, strip
from quillon.functions.variants import field, is_a, json_array, json_object, members, quoted, text_of, there, truthy
from quillon.operators.quality import expected_of

# What an answer says where it says nothing.
MESSAGES = {"missing_fields": "Missing required field(s).", "not_found": "No matching reminder found.", "error": "Tool execution error.", "ambiguous": "Multiple reminders match."}


def _raw(v: Column) -> Column:
    """JSON text of a value that is there."""
    return F.when(v.isNotNull(), F.to_json(v))


def _first_id(v: Column) -> Column:
    """``reminder_id``, else ``id``, as a value; null where neither says anything."""
    own, other = field(v, "reminder_id"), field(v, "id")
    return F.when(truthy(own), own).when(truthy(other), other)


def _as_text(v: Column) -> Column:
    """JSON string of a value: a text as it is, any other by its JSON text."""
    return F.when(v.isNotNull(), F.when(is_a(v, "STRING"), F.to_json(v)).otherwise(quoted(F.to_json(v))))


def _either(v: Column, *keys: str) -> Column:
    """JSON text of the first key that is there at all, null if its value is null."""
    value = F.coalesce(*[field(v, k) for k in keys])
    return F.when(there(value), F.to_json(value))


def normal_reminder(v: Column, target: Column, reminder_id: Column | None = None) -> Column:
    """JSON of a reminder: its id as text (or the JSON text ``reminder_id``, which goes last where it has none of its own), its
    task, times, target (else ``target``, a JSON text) and status; the time may stand under ``time``."""
    own = _as_text(_first_id(v))
    stated = field(v, "target")
    put = own if reminder_id is None else F.when(own.isNotNull(), reminder_id)
    last = F.lit(None).cast("string") if reminder_id is None else F.when(own.isNull(), reminder_id)
    return json_object(
        ("reminder_id", put),
        ("task", _raw(field(v, "task"))),
        ("time_text", _either(v, "time_text")),
        ("scheduled_time", _either(v, "scheduled_time", "time")),
        ("target", F.when(stated.isNull(), target).when(truthy(stated), F.to_json(stated)).otherwise('"self"')),
        *[(k, _raw(field(v, k))) for k in ("status", "created_at", "updated_at")],
        ("reminder_id", last),
    )


def normal_candidate(v: Column) -> Column:
    """JSON of a candidate: id, task and time; the time may stand under ``time`` or ``time_text``."""
    return json_object(("reminder_id", _raw(_first_id(v))), ("task", _raw(field(v, "task"))), ("scheduled_time", _either(v, "scheduled_time", "time", "time_text")))


def normal_answer(scenario: Column, tool: Column, arguments: Column, payload: Column) -> Column:
    """``(error, status, content)`` of a tool's answer in a scenario.

    ``arguments`` and ``payload`` are variants; one that is no object counts as
    empty.  ``content`` is JSON text with a space behind commas and colons: status
    and state first, then what the tool gives for that status.  ``error`` says why
    there is none: a status that is not the scenario's, an id that a change must
    name, the list that a query must give, an unknown tool or status.
    """
    given = let(F.struct(payload.alias("p"), arguments.alias("a"), scenario.alias("s"), tool.alias("t")), lambda x: _judged(x["s"], x["t"], x["a"], x["p"]))
    return let(given, lambda g: F.struct(g["error"].alias("error"), g["status"].alias("status"), F.when(g["error"].isNull(), spaced(g["content"])).alias("content")))


def _judged(scenario: Column, tool: Column, arguments: Column, payload: Column) -> Column:
    wanted = expected_of(scenario, 1)
    said = F.nullif(text_of(field(payload, "status")), F.lit(""))
    target = field(arguments, "target")
    fallback = F.coalesce(F.when(target.isNotNull(), F.when(truthy(target), _as_text(target)).otherwise('"self"')), F.lit('"self"'))

    def shaped(status: Column) -> Column:
        one = field(payload, "reminder")
        one = F.when(is_a(one, "OBJECT"), one)
        named, deleted = field(payload, "reminder_id"), field(field(payload, "deleted_reminder"), "reminder_id")
        changed = F.coalesce(F.when(truthy(named), F.to_json(named)), _as_text(_first_id(one)))
        gone = F.coalesce(F.when(truthy(named), F.to_json(named)), F.when(truthy(deleted), F.to_json(deleted)))
        rows = members(field(payload, "reminders"))
        lacking, options = members(field(payload, "missing_fields")), members(field(payload, "candidates"))
        none = F.lit(None).cast("string")
        own = text_of(field(payload, "message"))
        message = lambda kind: quoted(F.when(strip(own) != "", own).otherwise(MESSAGES[kind]))
        changes = tool.isin("create_reminder", "update_reminder")
        success = status == "success"
        identity = F.when(changes, changed).when(tool == "delete_reminder", gone)
        picked = F.transform(F.filter(options, lambda c: is_a(c, "OBJECT")), normal_candidate)
        head = [("status", quoted(status)), ("state", F.when(success, '"success"').otherwise("false"))]
        content = (
            F.when(success & changes, json_object(*head, ("reminder_id", identity), ("reminder", normal_reminder(one, fallback, identity))))
            .when(success & (tool == "delete_reminder"), json_object(*head, ("reminder_id", identity)))
            .when(success, json_object(*head, ("reminders", json_array(F.transform(rows, lambda r: normal_reminder(F.when(is_a(r, "OBJECT"), r), F.lit('"self"')))))))
            .when(status == "missing_fields", json_object(*head, ("missing_fields", F.coalesce(json_array(F.transform(lacking, lambda x: F.to_json(x))), F.lit("[]"))), ("message", message("missing_fields"))))
            .when(status == "ambiguous", json_object(*head, ("candidates", F.coalesce(json_array(picked), F.lit("[]"))), ("message", F.when(field(payload, "message").isNotNull(), message("ambiguous")))))
            .when(status == "not_found", json_object(*head, ("message", message("not_found"))))
            .when(status == "error", json_object(*head, ("message", message("error"))))
        )
        error = (
            F.when(wanted.isNotNull() & (status != wanted), F.lit("status mismatch"))
            .when(success & (changes | (tool == "delete_reminder")) & identity.isNull(), F.lit("no reminder_id"))
            .when(success & (tool == "query_reminder") & rows.isNull(), F.lit("no reminders"))
            .when(success & ~F.coalesce(changes | tool.isin("query_reminder", "delete_reminder"), F.lit(False)), F.lit("unknown tool"))
            .when(content.isNull(), F.lit("unknown status"))
        )
        return F.struct(F.coalesce(error, none).alias("error"), status.alias("status"), content.alias("content"))

    return let(F.coalesce(said, wanted, F.lit("error")), shaped)
