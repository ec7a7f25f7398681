"""Strict JSON by native columns against Python's parser."""

import json
import random
import time

from pyspark.sql import functions as F

from quillon.functions import jsonx

TEXTS = [
    None, "", " ", "{}", "[]", '{"a": 1}', '{"a": 1} x', '{"a": 1}{}', "[1, 2", "[1 2]", "[1,]", "{,}", '{"a"}', '{"a":}', "{a: 1}", "NaN", "[NaN, -Infinity, Infinity]", "-NaN", "nul", "null", "truefalse", "01", "-0", "1.", ".5",
    "1e5", "1E+5", "1e", "--1", '"x"', '"x" "y"', '"""', '"a\\qb"', '"a\\u12G4"', '"\\u12aF\\n\\"\\\\"', '"tab\there"', '"nul\x00"', '"a\nb"', '{"a": "}{]["}', '{"": {"": [[], {}]}}', "﻿{}", " {}", " \t\r\n{ } \n", "[" * 60 + "]" * 60,
    "[" * 60 + "]" * 59, '{"a": 1, "a": 2}', '{"x": "NaN"}', "[0]0", "0[0]", '""0', '{"a":1]', "[1}", '{"a":{"b":[1,{"c":"d"}]}}', '["' + "x" * 50_000 + '"]', "[" + ",".join(["1"] * 3000) + "]", "{'a': 1}", '{"a": tru}', "\x0b1", '"\\ud83d"', '"\x7f"', "0x1", "1_0",
]


def kind_of(text):
    try:
        value = json.loads(text)
    except (TypeError, ValueError):
        return "invalid"
    return {dict: "object", list: "array"}.get(type(value), "scalar")


def test_strict_kind_equals_the_parser(spark):
    rng = random.Random(12)
    alphabet = ['{', '}', '[', ']', ',', ':', '"a"', '"', "1", "0", "-", ".", "e", "null", " ", "\\", "true", "NaN", '"\\n"']
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 8))) for _ in range(3000)]
    whole = lambda d: rng.choice([1, "x,y", None, True, 2.5]) if not d or rng.random() < 0.3 else [whole(d - 1) for _ in range(rng.randrange(3))] if rng.random() < 0.5 else {f"k{i}": whole(d - 1) for i in range(rng.randrange(3))}
    good = [json.dumps(whole(4)) for _ in range(300)]
    texts += good + [t[: rng.randrange(len(t) + 1)] + rng.choice(alphabet) + t[rng.randrange(len(t) + 1) :] for t in good]
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, t string").repartition(2)
    df = rows.select("i", jsonx.strict_kind(F.col("t")).alias("k"))
    assert "Python" not in df._jdf.queryExecution().toString() and "Arrow" not in df._jdf.queryExecution().toString()
    got = {r["i"]: r["k"] for r in df.collect()}
    assert [(t, got[i]) for i, t in enumerate(texts) if got[i] != kind_of(t)] == []


def first_object(text, fenced):
    import re

    stages = [text.strip(), *([m.group(1) if (m := re.search(jsonx.FENCE, text)) else ""] if fenced else []), text[max(text.find("{"), 0) : text.rfind("}") + 1]]
    return next((s for s in stages if kind_of(s) == "object"), None)


def test_objects_in_text(spark):
    texts = ["so: {\"a\": 1} done", "{\"a\": 1}", "```json\n{\"a\": {\"b\": 2}}\n``` and {x}", "{bad} {\"a\": 1}", "no", "", " {\"a\": [NaN]} ", "} {", "a {\"k\": \"}\"} b"]
    lists = ["[{\"b\": 1, \"a\": \"x, y: z\"}, 3, \"{}\", {}]", "```json\n[{\"a\": 1}]\n```", "x [{\"a\": NaN}] y", "{\"a\": 1}\nno\n {\"b\": 2} \n{bad}", "[1, 2]", "{\"a\": 1}", "none", "[{\"a\": 1, \"a\": 2}]"]
    want = [[{"b": 1, "a": "x, y: z"}, {}], [{"a": 1}], [{"a": None}], [{"a": 1}, {"b": 2}], [], [{"a": 1}], [], [{"a": 2}]]
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, t string").select("i", *[jsonx.extract_object(F.col("t"), f).alias(f"f{int(f)}") for f in (False, True)]).collect()
    for r in rows:
        assert r["f0"] == first_object(texts[r["i"]], False) and r["f1"] == first_object(texts[r["i"]], True)
    found = spark.createDataFrame([*enumerate(lists), (99, None)], "i long, t string").select("i", jsonx.all_objects(F.col("t")).alias("o")).collect()
    assert {r["i"]: [json.loads(x) for x in r["o"]] for r in found} == dict(enumerate(want)) | {99: []}


def compared(expected, got):
    norm = lambda v: " ".join(str(v).strip().lower().split())
    notes, checked = [], 0
    for k, v in expected.items():
        if v is not None:
            checked += 1
            if k not in got:
                notes.append(f"missing:{k}")
            elif not (norm(v) == norm(got[k]) if isinstance(v, str) and isinstance(got[k], str) else v == got[k]):
                notes.append(f"mismatch:{k}")
    return checked, checked - len(notes), notes


def test_typed_comparison(spark):
    rng = random.Random(3)
    values = [1, 1.0, 1.5, 150, 1e2, 100, 0.10, 0.1, -2, "1", "A  b", "a b ", "x", True, False, None, [1, 2], [1.0, 2.0], [2, 1], {"a": 1, "b": [True]}, {"b": [1], "a": 1.0}, {}, [], "", {"a": {"c": "1.0, true"}}, {"a": {"c": "1, 1"}}, "1.0"]
    pairs = [({"v": a, "w": 1, "z.z": rng.choice(values)}, {"v": b, "z.z": rng.choice(values)} | ({"w": 1} if rng.random() < 0.5 else {})) for a in values for b in values]
    rows = spark.createDataFrame([(i, json.dumps(a), json.dumps(b)) for i, (a, b) in enumerate(pairs)], "i long, a string, b string")
    for r in rows.select("i", jsonx.compare_values(F.col("a"), F.col("b")).alias("c")).collect():
        assert tuple(r["c"]) == compared(*pairs[r["i"]]), pairs[r["i"]]
    odd = spark.createDataFrame([(None, "{}"), ("[1]", "{}"), ('{"a": 1}', None), ('{"a": 1}', "oops")], "a string, b string").select(jsonx.compare_values(F.col("a"), F.col("b")).alias("c")).collect()
    assert [r["c"] and tuple(r["c"]) for r in odd] == [None, None, (1, 0, ["missing:a"]), (1, 0, ["missing:a"])]


def test_long_arrays_take_time_in_line_with_their_length(spark):
    """Levels that change nothing are not repeated for every bracket of a text."""
    body = ", ".join(f'{{"event_id": {i}, "tags": [[{i}]]}}' for i in range(20000))
    texts = [f"[{body}]", f"[{body}, {{", f"[{body}]]", "[" * 40 + "]" * 40, "[" * 40 + "]" * 39]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(2)
    began = time.monotonic()
    kinds = rows.select("i", jsonx.strict_kind(F.col("t")).alias("k")).collect()
    assert [r["k"] for r in sorted(kinds)] == ["array", "invalid", "invalid", "array", "invalid"]
    assert time.monotonic() - began < 60
