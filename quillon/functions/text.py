"""String expressions.  All are native columns; null in, null out unless stated."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"(?U)\s+"
EDGES = r"(?U)^\s+|\s+$"

# Words that carry no meaning of their own in a task.
STOP_WORDS = ["play", "do", "go", "have", "take", "make", "the", "a", "an", "my"]


def let(x: Column, use: Callable[[Column], Column]) -> Column:
    """``use(x)`` with ``x`` computed once a row, however often it is used."""
    return F.get(F.transform(F.array(x), use), F.lit(0))


def strip(x: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(x, EDGES, "")


def single_spaced(x: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return strip(F.regexp_replace(x, SPACE, " "))


def squeezed(x: Column) -> Column:
    """``single_spaced`` in lower case."""
    return single_spaced(F.lower(x))


def normal_phrase(x: Column) -> Column:
    """``squeezed`` with full-width commas as commas; null counts as empty."""
    return squeezed(F.translate(F.coalesce(x, F.lit("")), "，", ","))


def compact(x: Column) -> Column:
    """Stripped, without any ASCII space; null counts as empty."""
    return F.replace(strip(F.coalesce(x, F.lit(""))), F.lit(" "), F.lit(""))


def has_any(x: Column, words: list[str]) -> Column:
    """Whether any of the words is a substring."""
    out = F.lit(False)
    for w in words:
        out = out | F.contains(x, F.lit(w))
    return out


def count_words(x: Column) -> Column:
    """Number of runs of non-space characters; null counts as empty."""
    return F.regexp_count(F.coalesce(x, F.lit("")), F.lit(r"(?U)\S+"))


def blank_to_null(x: Column) -> Column:
    """Null for a blank text, else the text as it is."""
    return F.when(strip(x) != "", x)


def with_fallback(x: Column, default: str) -> Column:
    """The text as it is, or the default where it is null or blank."""
    return F.coalesce(blank_to_null(x), F.lit(default))


def has_cjk(x: Column) -> Column:
    """Whether any character lies in U+4E00 to U+9FFF."""
    return x.rlike(r"[一-鿿]")


def without_fences(x: Column) -> Column:
    """Without a leading ```lang line and a trailing ``` mark."""
    return strip(F.regexp_replace(F.regexp_replace(strip(x), r"(?i)^```(?:json)?\s*", ""), r"\s*```$", ""))


def base_url(x: Column) -> Column:
    """Without trailing slashes and a trailing /chat/completions."""
    return F.regexp_replace(F.regexp_replace(strip(x), "/+$", ""), "/chat/completions$", "")


def first_set(*x: Column) -> Column:
    """The first value that is neither null nor blank, stripped."""
    return F.coalesce(*[F.nullif(strip(c), F.lit("")) for c in x])


def called_name(x: Column) -> Column:
    """The first ``"name": "..."`` of lower-case letters and underscores, or null."""
    return F.nullif(F.regexp_extract(x, r'"name"\s*:\s*"([a-z_]+)"', 1), F.lit(""))


def stems(x: Column) -> Column:
    """Words of [a-z0-9], each without one ending: ing over 4 letters, else ed or s over 3."""
    return F.transform(
        F.regexp_extract_all(F.lower(x), F.lit("([a-z0-9]+)"), F.lit(1)),
        lambda t: F.when((F.length(t) > 4) & F.endswith(t, F.lit("ing")), F.substring(t, F.lit(1), F.length(t) - 3))
        .when((F.length(t) > 3) & F.endswith(t, F.lit("ed")), F.substring(t, F.lit(1), F.length(t) - 2))
        .when((F.length(t) > 3) & F.endswith(t, F.lit("s")), F.substring(t, F.lit(1), F.length(t) - 1))
        .otherwise(t),
    )


def stems_match(query: Column, task: Column) -> Column:
    """Whether the query's meaningful stems are all in the task's; without any, whether any stem is shared."""
    stop = F.array(*[F.lit(w) for w in STOP_WORDS])
    q, t = stems(query), stems(task)
    wanted = F.array_except(q, stop)
    subset = F.size(F.array_except(wanted, F.array_except(t, stop))) == 0
    return (F.size(q) > 0) & (F.size(t) > 0) & F.when(F.size(wanted) > 0, subset).otherwise(F.arrays_overlap(q, t))


def task_matches(query: Column, task: Column) -> Column:
    """Fuzzy task predicate: an empty query matches all, a missing task nothing; else either contains the other, or stems match."""
    q, t = strip(F.lower(query)), strip(F.lower(task))
    near = F.contains(t, q) | F.contains(q, t) | stems_match(q, t)
    return F.when(F.coalesce(query, F.lit("")) == "", True).when(F.coalesce(task, F.lit("")) == "", False).otherwise(near)


def time_matches(query: Column, text: Column, query_iso: Column, iso: Column) -> Column:
    """Fuzzy time predicate: an empty query matches all; else either text contains the other, or the wall-clock dates agree.

    A stored text that is empty is compared by date alone.
    """
    q, t = squeezed(query), squeezed(text)
    near = (t != "") & (F.contains(t, q) | F.contains(q, t))
    same_day = F.substring(query_iso, 1, 10) == F.substring(iso, 1, 10)
    return F.when(F.coalesce(query, F.lit("")) == "", True).otherwise(F.coalesce(near, F.lit(False)) | F.coalesce(same_day, F.lit(False)))


def first_forbidden(x: Column, patterns: list[str], negations: list[str]) -> Column:
    """The first pattern, in list order, that occurs without a negation right before it; null if none.

    The 30 characters before an occurrence are stripped, trailing punctuation is
    dropped, and the rest is negated if it ends with a negation.
    """
    stop = F.array(*[F.lit(n) for n in negations])

    def affirmed(lower: Column, p: str) -> Column:
        pieces = F.split(lower, rf"\Q{p}\E")
        # the 30 characters before an occurrence reach back over short pieces: the tail is carried from piece to piece
        tails = F.aggregate(
            F.slice(pieces, F.lit(1), F.size(pieces) - 1),
            F.struct(F.lit("").alias("tail"), F.lit(False).alias("hit")),
            lambda acc, piece: F.struct(
                F.concat(F.right(F.concat(acc["tail"], piece), F.lit(30)), F.lit(p)).alias("tail"),
                (acc["hit"] | ~F.exists(stop, lambda n: F.endswith(F.regexp_replace(strip(F.right(F.concat(acc["tail"], piece), F.lit(30))), "[.,!?;: ]+$", ""), n))).alias("hit"),
            ),
        )
        return F.contains(lower, F.lit(p)) & tails["hit"]

    return let(strip(F.lower(x)), lambda lower: F.coalesce(*[F.when(affirmed(lower, p), F.lit(p)) for p in patterns]))


def chat_text(role: Column, content: Column) -> Column:
    """A message between its role's tags, null content as empty."""
    tag = F.upper(role)
    return F.concat(F.lit("<"), tag, F.lit(">\n"), F.coalesce(content, F.lit("")), F.lit("\n</"), tag, F.lit(">"))


def chat_sample(tools: Column, messages: Column) -> Column:
    """A whole sample as text: its tools, then each message between tags; null content as empty.

    ``messages`` is an array of structs with ``role``, ``content`` and ``call``
    (JSON of the tool calls, or null).  A message with calls and a tool's answer
    are written as the JSON of the message.
    """

    def written(m: Column) -> Column:
        tag = F.when(F.coalesce(m["call"], F.lit("")) != "", F.lit("ASSISTANT_TOOL_CALL")).otherwise(F.upper(m["role"]))
        call = F.concat(F.lit('{"role": "assistant", "content": null, "tool_calls": '), m["call"], F.lit("}"))
        tool = F.to_json(F.struct(m["role"].alias("role"), m["content"].alias("content")))
        body = F.when(tag == "ASSISTANT_TOOL_CALL", call).when(tag == "TOOL", tool).otherwise(F.coalesce(m["content"], F.lit("")))
        return F.concat(F.lit("<"), tag, F.lit(">\n"), body, F.lit("\n</"), tag, F.lit(">"))

    return F.array_join(F.concat(F.array(F.concat(F.lit("<TOOLS>"), tools, F.lit("</TOOLS>"))), F.transform(messages, written)), "\n")
