"""JSON in free text, as native columns.

Spark's parsers accept text behind a value and reject ``NaN``, so what is strict
JSON is decided by reducing the text: each string becomes an empty one and each
number or literal a zero, and then the innermost arrays and objects that are
well formed become zeros too, level by level.  A text is JSON if one value is
left.  No step looks back into a string, as strings go first.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillon.functions.text import let, strip

# The grammar of calls in a model's text.
FENCE = r"(?s)```(?:json)?\s*(\{.*?\})\s*```"
XML_CALL = r"(?s)<function=([^>\s]+)>(.*?)</function>"
XML_ARG = r"(?s)<parameter=([^>\s]+)>\s*(.*?)\s*</parameter>"
TAGGED_XML_CALL = r"(?s)<tool_call>\s*<function=([^>\s]+)>\s*(.*?)\s*</function>\s*</tool_call>"
TAGGED_CALL = r"(?s)<tool_call>\s*(\{.*?\})\s*</tool_call>"
# The keys that a device label must have.
LABEL_KEYS = ["matched", "capability_id", "capability", "intent", "slots", "missing_slots", "confidence"]


# The grammar of JSON; quantifiers never give back, so long texts need no deep stack.
STRING = r'"[^"\\\x00-\x1f]*+(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})[^"\\\x00-\x1f]*+)*+"'
SCALAR = r"-?(?:Infinity|(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][+-]?[0-9]++)?+)|true|false|null|NaN"
_VALUE = r'(?:0|"")'
CLOSED = rf'\[(?:{_VALUE}(?:,{_VALUE})*+)?+\]|\{{(?:"":{_VALUE}(?:,"":{_VALUE})*+)?+\}}'


def _reduced(x: Column) -> Column:
    """What is left of a text: ``0`` or ``""`` if it is one JSON value."""
    flat = F.regexp_replace(F.regexp_replace(x, STRING, '""'), SCALAR, "0")
    flat = F.regexp_replace(flat, r"[ \t\n\r]+", "")
    depth = lambda t: F.sequence(F.lit(1), F.greatest(F.lit(1), F.regexp_count(t, F.lit(r"[\[{]"))))
    state = lambda left, settled: F.struct(left.alias("left"), settled.alias("settled"))

    def step(acc: Column) -> Column:
        return let(F.regexp_replace(acc["left"], CLOSED, "0"), lambda left: state(left, left == acc["left"]))

    # a level that changes nothing is the last; those after it do not look at the text
    return let(flat, lambda t: F.aggregate(depth(t), state(t, F.lit(False)), lambda acc, _: F.when(acc["settled"], acc).otherwise(step(acc)), lambda acc: acc["left"]))


def strict_kind(x: Column) -> Column:
    """``object``, ``array``, ``scalar`` or ``invalid``; null is invalid."""
    first = F.regexp_extract(x, r"^[ \t\n\r]*([\[{])?", 1)
    kind = F.when(first == "{", "object").when(first == "[", "array").otherwise("scalar")
    return F.when(F.coalesce(_reduced(x), F.lit("")).isin("0", '""'), kind).otherwise("invalid")


def outside_strings(x: Column, change) -> Column:
    """JSON text with ``change`` applied to each stretch between its strings."""
    between, strings = F.split(x, STRING), F.regexp_extract_all(x, F.lit(STRING), F.lit(0))
    return F.array_join(F.zip_with(between, strings, lambda o, v: F.concat(change(o), F.coalesce(v, F.lit("")))), "")


def plain_json(x: Column) -> Column:
    """JSON text with null for ``NaN`` and infinities, which Spark's parsers refuse."""
    odd = F.contains(x, F.lit("NaN")) | F.contains(x, F.lit("Infinity"))
    return F.when(odd, outside_strings(x, lambda o: F.regexp_replace(o, r"NaN|-?Infinity", "null"))).otherwise(x)


def variant_of(x: Column) -> Column:
    """The value of a strict JSON text as a variant, else null; of an object that repeats a key, null."""
    return F.try_parse_json(plain_json(x))


def canonical(v: Column) -> Column:
    """Text of a variant by which equal values are equal: keys sorted, numbers without idle zeros, true and false as 1 and 0."""
    number = lambda o: F.regexp_replace(F.regexp_replace(o, r"(\.[0-9]*?)0+(?![0-9])", "$1"), r"\.(?![0-9])", "")
    plain = lambda o: F.regexp_replace(F.regexp_replace(number(o), r"\btrue\b", "1"), r"\bfalse\b", "0")
    return outside_strings(F.to_json(v), plain)


def spaced(x: Column) -> Column:
    """Compact JSON text with a space behind each comma and colon."""
    return outside_strings(x, lambda o: F.regexp_replace(o, "([,:])", "$1 "))


def _first_strict(*candidates: Column) -> Column:
    """The first text that is a strict JSON object."""
    return F.coalesce(*[let(c, _object) for c in candidates])


def widest_object(x: Column) -> Column:
    """From the first brace to the last, or null."""
    return F.nullif(F.regexp_extract(x, r"(?s)\{.*\}", 0), F.lit(""))


def extract_object(x: Column, fenced: bool = False) -> Column:
    """JSON object in a text: the text itself, else (if asked) a fenced block, else the widest braces; null if none parses."""
    block = [F.nullif(F.regexp_extract(x, FENCE, 1), F.lit(""))] if fenced else []
    return F.when(F.contains(x, F.lit("{")), _first_strict(strip(x), *block, widest_object(x)))


def _object(x: Column) -> Column:
    """The text if it is a strict JSON object, else null."""
    return F.when(strict_kind(x) == "object", x)


def extracted(x: Column, fenced: bool = True) -> Column:
    """``(object, error)``: the object in a text, or why there is none."""
    found = extract_object(x, fenced)
    error = F.when(F.coalesce(F.trim(x), F.lit("")) == "", "empty output").when(~F.contains(x, F.lit("{")), "no JSON object").when(found.isNull(), "malformed JSON object")
    return F.struct(found.alias("object"), error.alias("error"))


def _elements(array: Column) -> Column:
    """The objects among the elements of a JSON array, as texts."""
    items = F.try_variant_get(variant_of(array), "$", "array<variant>")
    objects = F.filter(items, lambda v: F.startswith(F.schema_of_variant(v), F.lit("OBJECT")))
    raw = F.filter(F.from_json(array, "array<string>"), lambda t: F.startswith(t, F.lit("{")))  # where an object repeats a key
    return F.coalesce(F.transform(objects, lambda v: F.to_json(v)), raw, F.array().cast("array<string>"))


def all_objects(x: Column) -> Column:
    """The JSON objects of a text: of a whole or bracketed array, a single one, or one a line; in order, strict ones only."""
    own = strip(x)
    cut = F.when(F.startswith(own, F.lit("```")), F.regexp_replace(F.regexp_replace(own, r"^```(?:json)?\s*", ""), r"\s*```$", "")).otherwise(own)
    none = F.array().cast("array<string>")

    def found(t: Column) -> Column:
        bracketed = F.regexp_extract(t, r"(?s)\[.*\]", 0)
        lines = F.transform(F.split(t, "\n"), strip)
        alone = F.filter(lines, lambda y: F.startswith(y, F.lit("{")) & F.endswith(y, F.lit("}")) & (strict_kind(y) == "object"))
        kind, inner = strict_kind(t), strict_kind(bracketed)
        return F.when(kind == "array", _elements(t)).when(kind == "object", F.array(t)).when(inner == "array", _elements(bracketed)).otherwise(alone)

    return F.coalesce(let(cut, found), none)


def before_end_tag(x: Column) -> Column:
    """The text before the end of an assistant's turn."""
    return F.substring_index(x, "</ASSISTANT>", 1)


def xml_call(x: Column, bare: bool = False, pattern: str = XML_CALL) -> Column:
    """``(name, arguments)`` of a ``<function=...>`` call; later values of a name win; ``bare`` allows no parameter."""
    name = F.nullif(F.trim(F.regexp_extract(x, pattern, 1)), F.lit(""))
    body = F.regexp_extract(x, pattern, 2)
    keys, values = (F.regexp_extract_all(body, F.lit(XML_ARG), F.lit(i)) for i in (1, 2))
    n = F.size(keys)
    pairs = F.arrays_zip(keys.alias("k"), values.alias("v"), F.sequence(F.lit(1), F.greatest(n, F.lit(1))).alias("i"))
    last = F.filter(pairs, lambda p: (p["i"] <= n) & (F.size(F.filter(pairs, lambda o: (o["k"] == p["k"]) & (o["i"] > p["i"]))) == 0))
    arguments = F.map_from_arrays(F.transform(last, lambda p: p["k"]), F.transform(last, lambda p: p["v"]))
    found = name.isNotNull() & ((n > 0) | F.lit(bare))
    return F.when(found, F.struct(name.alias("name"), arguments.alias("arguments")))


def json_call(x: Column) -> Column:
    """``(name, arguments)`` of an object with ``name`` and ``arguments``, also below ``function``."""
    return let(x, _json_call)


def _json_call(x: Column) -> Column:
    name = F.coalesce(F.get_json_object(x, "$.function.name"), F.get_json_object(x, "$.name"))
    raw = F.coalesce(F.get_json_object(x, "$.function.arguments"), F.get_json_object(x, "$.arguments"))
    arguments = F.from_json(F.coalesce(raw, F.lit("{}")), "map<string,string>")
    return F.when(F.trim(name) != "", F.struct(F.trim(name).alias("name"), F.coalesce(arguments, F.from_json(F.lit("{}"), "map<string,string>")).alias("arguments")))


def tool_call(x: Column, bare: bool = False, xml: bool = True) -> Column:
    """``(name, arguments)`` that a model's output calls, or null: first its ``tool_calls``, then an XML-like call (unless
    ``xml`` is off), then a tagged one."""

    def stages(x: Column) -> Column:
        calls = [_listed_call(x), xml_call(x, bare), _tagged_call(x)]
        return F.coalesce(*[c for i, c in enumerate(calls) if xml or i != 1])

    return let(x, stages)


def _listed_call(text: Column) -> Column:
    """The first of the ``tool_calls`` of the object in a text; only a text that names them is parsed."""
    named = F.when(F.contains(text, F.lit('"tool_calls"')), text)
    return json_call(F.get_json_object(extract_object(named), "$.tool_calls[0]"))


def _tagged_call(text: Column) -> Column:
    tagged = F.nullif(F.regexp_extract(text, TAGGED_CALL, 1), F.lit(""))
    return json_call(let(tagged, _object))


def message_call(message: Column) -> Column:
    """``(name, arguments)`` that an API message calls: its own ``tool_calls`` first, then what its content holds.

    Content is a text or a list of parts, whose texts are joined by lines; an
    XML-like call must stand in its tag and may have no parameter.
    """
    own = F.get_json_object(message, "$.tool_calls[0]")
    raw = F.get_json_object(message, "$.content")
    parts = F.from_json(raw, "array<struct<text:string>>")
    joined = F.array_join(F.transform(parts, lambda p: F.coalesce(p["text"], F.lit(""))), "\n")
    text = F.when(F.startswith(F.trim(raw), F.lit("[")) & parts.isNotNull(), joined).otherwise(F.coalesce(raw, F.lit("")))
    said = let(text, lambda t: F.coalesce(_listed_call(t), xml_call(t, True, TAGGED_XML_CALL), _tagged_call(t)))
    return F.coalesce(json_call(own), said)


def response_text(response: Column) -> Column:
    """The first readable text of a recorded model response: a chat choice's message or text, ``output_text``, or output blocks."""
    field = lambda p: F.nullif(F.get_json_object(response, p), F.lit(""))
    blocks = F.from_json(field("$.output"), "array<struct<content:array<struct<text:string>>>>")
    texts = F.flatten(F.transform(blocks, lambda b: F.transform(F.coalesce(b["content"], F.array().cast("array<struct<text:string>>")), lambda c: c["text"])))
    joined = F.nullif(F.array_join(F.filter(texts, lambda t: F.coalesce(t, F.lit("")) != ""), "\n"), F.lit(""))
    return F.coalesce(field("$.choices[0].message.content"), field("$.choices[0].text"), field("$.output_text"), joined)


def intent_label(x: Column) -> Column:
    """A device label read from a model's output, or null where one of its keys is absent (a null value is not).

    ``slots`` that are no object become an empty one and ``missing_slots`` that
    are no list an empty list; both stay JSON texts.
    """
    return let(extract_object(before_end_tag(x), fenced=True), _label)


def _label(o: Column) -> Column:
    keys = F.json_object_keys(o)
    there = F.size(F.array_except(F.array(*[F.lit(k) for k in LABEL_KEYS]), keys)) == 0
    field = lambda k: F.get_json_object(o, f"$.{k}")
    like = lambda k, mark, other: F.when(F.startswith(field(k), F.lit(mark)), field(k)).otherwise(other)
    falsy = F.coalesce(field("matched"), F.lit("")).isin("", "false", "0", "0.0", "[]", "{}")
    return F.when(
        there,
        F.struct(
            (~falsy).alias("matched"), field("capability_id").cast("int").alias("capability_id"), field("capability").alias("capability"), field("intent").alias("intent"),
            like("slots", "{", "{}").alias("slots"), like("missing_slots", "[", "[]").alias("missing_slots"), field("confidence").cast("double").alias("confidence"),
        ),
    )


def compare_arguments(expected: Column, got: Column) -> Column:
    """``(checked, ok, notes)`` of maps of text: each expected key that is not null, in order, is missing, a mismatch or right.

    Texts compare squeezed.
    """
    from quillon.functions.text import squeezed

    asked = F.filter(F.map_entries(expected), lambda e: e["value"].isNotNull())
    value = lambda e: F.element_at(got, e["key"])
    judged = F.transform(
        asked,
        lambda e: F.when(value(e).isNull(), F.concat(F.lit("missing:"), e["key"])).when(squeezed(value(e)) != squeezed(e["value"]), F.concat(F.lit("mismatch:"), e["key"])),
    )
    notes = F.array_compact(judged)
    return F.struct(F.size(asked).alias("checked"), (F.size(asked) - F.size(notes)).alias("ok"), notes.alias("notes"))


def compare_values(expected: Column, got: Column) -> Column:
    """``(checked, ok, notes)`` of two JSON objects: each expected key whose value is not null, in order, is missing, a
    mismatch or right.

    Two texts compare squeezed; any other values, numbers, lists and objects
    included, as values: 1 is 1.0, keys have no order, a text is no number.
    ``got`` that is no object has no key; null where ``expected`` is none.
    """
    from quillon.functions.text import squeezed

    values = lambda x: F.from_json(plain_json(x), "map<string,variant>")
    text = lambda v: F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))
    said = lambda v: F.coalesce(F.concat(F.lit("text:"), squeezed(text(v))), canonical(v))

    def judged(asked: Column, own: Column) -> Column:
        there = lambda e: F.map_contains_key(own, e["key"])
        same = lambda e: said(e["value"]) == said(F.element_at(own, e["key"]))
        notes = F.array_compact(F.transform(asked, lambda e: F.when(~there(e), F.concat(F.lit("missing:"), e["key"])).when(~same(e), F.concat(F.lit("mismatch:"), e["key"]))))
        return let(notes, lambda n: F.struct(F.size(asked).alias("checked"), (F.size(asked) - F.size(n)).alias("ok"), n.alias("notes")))

    asked = F.filter(F.map_entries(values(F.when(strict_kind(expected) == "object", expected))), lambda e: ~F.is_variant_null(e["value"]))
    own = F.coalesce(values(F.when(strict_kind(got) == "object", got)), F.from_json(F.lit("{}"), "map<string,variant>"))
    return let(F.struct(asked.alias("a"), own.alias("o")), lambda x: F.when(x["a"].isNotNull(), judged(x["a"], x["o"])))
