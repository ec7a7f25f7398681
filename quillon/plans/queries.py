"""Registered queries over the driver's tables, each with its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions import intent, jsonx, text, timex
from quillon.operators import cases, device, evaluation, planning, profile, quality, render, store
from quillon.streaming import due, notices

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL."""

    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


WORDS = r"len(regexp_extract_all(coalesce(text, ''), '\S+'))"
SQUEEZED = r"trim(regexp_replace(lower(text), '\s+', ' ', 'g'))"


# --- distributions, lengths, duplicates, examples -------------------------------------------------


@query(f"SELECT role, count(*) AS n, min({WORDS}) AS min_words, max({WORDS}) AS max_words, round_even(avg({WORDS}), 1) AS avg_words FROM conversations GROUP BY role")
def conv_profile(spark, d):
    return profile.word_lengths(_t(spark, d, "conversations"), "text", "role")


@query("SELECT field, coalesce(key, 'None') AS key, count(*) AS n FROM (SELECT unnest(['lang', 'source']) AS field, unnest([lang, source]) AS key FROM documents) GROUP BY ALL")
def field_distributions(spark, d):
    return profile.count_by(_t(spark, d, "documents"), "lang", "source")


@query("SELECT 'role' AS field, coalesce(role, 'None') AS key, count(*) AS n FROM conversations GROUP BY ALL")
def role_distribution(spark, d):
    return profile.count_by(_t(spark, d, "conversations"), "role")


@query(
    "SELECT lang, quality, toxic, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents JOIN labels USING (doc_id) GROUP BY GROUPING SETS ((lang), (quality, toxic), ())"
)
def grouping_sets_profile(spark, d):
    both = _t(spark, d, "documents").join(_t(spark, d, "labels"), "doc_id")
    sets = both.groupingSets([["lang"], ["quality", "toxic"], []], "lang", "quality", "toxic")
    return sets.agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


@query("SELECT count(*) AS total, count(*) FILTER (quality = 0) AS hits, CASE WHEN count(*) = 0 THEN 0.0 ELSE count(*) FILTER (quality = 0) / count(*)::DOUBLE END AS ratio FROM labels")
def negative_ratio(spark, d):
    return profile.share(_t(spark, d, "labels"), F.col("quality") == 0)


@query(
    "SELECT s.source, count(l.doc_id) AS got, greatest(100 - count(l.doc_id), 0) AS missing FROM (SELECT DISTINCT source FROM documents) s LEFT JOIN (SELECT source, doc_id FROM documents JOIN labels USING (doc_id)) l USING (source) GROUP BY ALL"
)
def label_shortfall(spark, d):
    docs = _t(spark, d, "documents")
    return profile.shortfall(docs.join(_t(spark, d, "labels").select("doc_id"), "doc_id"), docs.select("source").distinct(), "source", 100)


@query(r"SELECT word AS item, count(*) AS n FROM (SELECT unnest(regexp_extract_all(props, '[a-z]+|\d+')) AS word FROM events) GROUP BY ALL")
def unnested_items(spark, d):
    items = F.regexp_extract_all("props", F.lit(r"([a-z]+|\d+)"), F.lit(1))
    return profile.unnested_counts(_t(spark, d, "events").withColumn("items", items), "items")


_DUPS = f"SELECT {SQUEEZED} AS text, count(*) AS n, min(doc_id) AS first FROM documents WHERE {SQUEEZED} <> '' GROUP BY 1 HAVING count(*) > 1"


@query(_DUPS)
def duplicate_texts(spark, d):
    return profile.duplicate_groups(_t(spark, d, "documents"), text.squeezed(F.col("text")), "doc_id")


@query(f"SELECT count(*) AS groups, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus FROM ({_DUPS})")
def duplicate_count(spark, d):
    return profile.surplus(duplicate_texts(spark, d))


@query(f"{_DUPS} ORDER BY n DESC, first LIMIT 10")
def top_duplicates(spark, d):
    return profile.top_duplicates(duplicate_texts(spark, d), 10)


@query(
    "SELECT source AS \"group\", rank, text FROM (SELECT source, text, row_number() OVER (PARTITION BY source ORDER BY o) AS rank FROM (SELECT source, text, min(doc_id) AS o FROM documents WHERE text <> '' GROUP BY ALL)) WHERE rank <= 3"
)
def examples_per_group(spark, d):
    return profile.examples(_t(spark, d, "documents"), "source", "text", "doc_id", 3)


@query(f"SELECT lang, count(*) AS n, min({WORDS}) AS min_words, max({WORDS}) AS max_words, round_even(avg({WORDS}), 1) AS avg_words FROM documents GROUP BY lang")
def length_profile(spark, d):
    return profile.word_lengths(_t(spark, d, "documents"), "text", "lang")


@query(f"SELECT conv_id, turn, {WORDS} AS words, {WORDS} BETWEEN 5 AND 100 AS fits FROM conversations")
def length_bounds(spark, d):
    words = text.count_words(F.col("text"))
    return _t(spark, d, "conversations").select("conv_id", "turn", words.alias("words"), words.between(5, 100).alias("fits"))


# --- splits, quotas, picks ------------------------------------------------------------------------

_SIZE = "CASE WHEN n <= 1 THEN CAST(round_even(n * 0.1, 0) AS BIGINT) ELSE greatest(1, least(CAST(round_even(n * 0.1, 0) AS BIGINT), n - 1)) END"


@query(
    f"SELECT doc_id, source, CASE WHEN r <= {_SIZE} THEN 'val' ELSE 'train' END AS part FROM (SELECT doc_id, source, count(*) OVER (PARTITION BY source) AS n, row_number() OVER (PARTITION BY source ORDER BY md5('42:' || doc_id), doc_id) AS r FROM documents)"
)
def stratified_split(spark, d):
    return planning.stratified_split(_t(spark, d, "documents").select("doc_id", "source"), "doc_id", "source", 0.1, 42)


@query(f"SELECT doc_id, CASE WHEN r <= {_SIZE} THEN 'val' ELSE 'train' END AS part FROM (SELECT doc_id, count(*) OVER () AS n, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS r FROM documents)")
def random_split(spark, d):
    return planning.random_split(_t(spark, d, "documents").select("doc_id"), "doc_id", 0.1, 42)


@query(
    f"SELECT count(*) AS total, count(*) FILTER (r > {_SIZE}) AS train, count(*) FILTER (r <= {_SIZE}) AS val, 0.1::DOUBLE AS ratio FROM (SELECT doc_id, count(*) OVER (PARTITION BY source) AS n, row_number() OVER (PARTITION BY source ORDER BY md5('42:' || doc_id), doc_id) AS r FROM documents)"
)
def split_report(spark, d):
    return planning.split_report(stratified_split(spark, d), 0.1)


@query(
    """WITH g AS (SELECT lang, count(*) AS w FROM documents GROUP BY lang), r AS (SELECT lang, w * 1000 / (sum(w) OVER ())::DOUBLE AS raw FROM g),
b AS (SELECT lang, raw, greatest(floor(raw)::BIGINT, CASE WHEN 1000 >= count(*) OVER () THEN 1 ELSE 0 END) AS base FROM r),
x AS (SELECT lang, base, 1000 - sum(base) OVER () AS rest, row_number() OVER (ORDER BY raw - floor(raw) DESC, lang DESC) AS up FROM b)
SELECT lang, CAST(base + CASE WHEN up <= rest THEN 1 ELSE 0 END AS BIGINT) AS quota FROM x"""
)
def quota_allocation(spark, d):
    groups = _t(spark, d, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("w"))
    return planning.allocate_quota(groups, "lang", "w", 1000)


_U = "(('0x' || left(md5('9:' || event_id), 7))::BIGINT / 268435456.0::DOUBLE)"


@query(f"SELECT event_id, CASE WHEN {_U} < 0.5 / 1.1 THEN 'a' WHEN {_U} < 0.8 / 1.1 THEN 'b' ELSE 'c' END AS pick FROM events")
def weighted_pick(spark, d):
    pick = planning.weighted_pick(planning.uniform(9, F.col("event_id")), [("a", 0.5), ("b", 0.3), ("c", 0.3)])
    return _t(spark, d, "events").select("event_id", pick.alias("pick"))


@query(
    "SELECT n_name, occurrence, ['short', 'polite', 'direct'][occurrence % 3 + 1] AS style, printf('bench_prompt_%05d', n_nationkey * 10 + occurrence) AS id FROM (SELECT n_name, n_nationkey, unnest(range(n_regionkey + 1)) AS occurrence FROM nation)"
)
def seed_expand(spark, d):
    rows = planning.expand(_t(spark, d, "nation").withColumn("number", F.col("n_regionkey") + 1), "number")
    ident = F.format_string("bench_prompt_%05d", F.col("n_nationkey") * 10 + F.col("occurrence"))
    return rows.select("n_name", F.col("occurrence").cast("long").alias("occurrence"), planning.cyclic_pick(["short", "polite", "direct"], F.col("occurrence")).alias("style"), ident.alias("id"))


@query(f"SELECT source, doc_id, rank FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rank FROM documents WHERE {WORDS} >= 50) WHERE rank <= 20")
def quota_fill(spark, d):
    filled = planning.fill_quota(_t(spark, d, "documents"), "source", "doc_id", text.count_words(F.col("text")) >= 50, 20)
    return filled.select("source", "doc_id", "rank")


@query("SELECT doc_id FROM documents ORDER BY md5('7:' || doc_id), doc_id LIMIT 1")
def debug_pick(spark, d):
    return _t(spark, d, "documents").select("doc_id").orderBy(planning.seeded(7, F.col("doc_id")), "doc_id").limit(1)


@query(f"SELECT doc_id FROM documents WHERE {SQUEEZED} NOT IN (SELECT {SQUEEZED} FROM benchmark)")
def unseen_texts(spark, d):
    return planning.unseen(_t(spark, d, "documents"), _t(spark, d, "benchmark"), "text").select("doc_id")


@query("SELECT 'documents' AS origin, doc_id AS id, text FROM documents UNION ALL SELECT 'benchmark', item_id, text FROM benchmark")
def append_samples(spark, d):
    docs = _t(spark, d, "documents").select(F.lit("documents").alias("origin"), F.col("doc_id").alias("id"), "text")
    return docs.unionByName(_t(spark, d, "benchmark").select(F.lit("benchmark").alias("origin"), F.col("item_id").alias("id"), "text"))


# --- conversations --------------------------------------------------------------------------------


@query(
    "SELECT conv_id, turn, role, lead(role) OVER w AS next_role, lag(role) OVER w AS previous_role FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)"
)
def adjacent_roles(spark, d):
    return quality.neighbours(_t(spark, d, "conversations"), "conv_id", "turn", "role").drop("text")


_FAIL = """SELECT conv_id, CASE WHEN count(*) < 3 THEN 'under 3 messages' WHEN first(role ORDER BY turn) <> 'system' THEN 'first message is not system'
WHEN coalesce(max(role) FILTER (n = 2), '') <> 'user' THEN 'second message is not user' WHEN trim(coalesce(max(text) FILTER (n = 2), '')) = '' THEN 'user message is blank' ELSE 'ok' END AS reason
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations) GROUP BY conv_id"""


@query(_FAIL)
def conv_validate(spark, d):
    return quality.first_failure(_t(spark, d, "conversations"))


@query(f"SELECT reason, count(*) AS n FROM ({_FAIL}) GROUP BY reason")
def failure_reasons(spark, d):
    return quality.reasons(conv_validate(spark, d))


@query("SELECT conv_id, arg_max(text, turn) FILTER (role = 'assistant') AS last_text, arg_min(text, turn) FILTER (role = 'assistant') AS first_text FROM conversations GROUP BY conv_id")
def last_answer(spark, d):
    said = F.when(F.col("role") == "assistant", F.col("turn"))
    return _t(spark, d, "conversations").groupBy("conv_id").agg(F.max_by("text", said).alias("last_text"), F.min_by("text", said).alias("first_text"))


@query(
    "SELECT conv_id, turn, coalesce(len(list(turn) OVER w), 0) AS context, CAST(coalesce(list_sum(list(length(text)) OVER w), 0) AS BIGINT) AS chars FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)"
)
def recent_context(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(-20, -1)
    chars = F.coalesce(F.sum(F.length("text")).over(w), F.lit(0))
    return _t(spark, d, "conversations").select("conv_id", "turn", F.size(F.collect_list("turn").over(w)).cast("long").alias("context"), chars.alias("chars"))


@query(
    "SELECT conv_id, string_agg('<' || upper(role) || '>' || chr(10) || coalesce(text, '') || chr(10) || '</' || upper(role) || '>', chr(10) ORDER BY turn) AS sample FROM conversations GROUP BY conv_id"
)
def serialize_chat(spark, d):
    said = _t(spark, d, "conversations").select("conv_id", "turn", text.chat_text(F.col("role"), F.col("text")).alias("t"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("turn", "t"))), lambda x: x["t"])
    return said.groupBy("conv_id").agg(F.array_join(parts, "\n").alias("sample"))


_ANSWERS = {k: " OR ".join("contains(lower(coalesce(text, '')), '" + w.replace("'", "''") + "')" for w in v) for k, v in evaluation.ANSWER_WORDS.items()}


@query(
    "SELECT conv_id, turn, expected, CASE expected "
    + " ".join(f"WHEN '{k}' THEN ({v})" for k, v in _ANSWERS.items())
    + " WHEN 'no_tool' THEN trim(coalesce(text, '')) <> '' ELSE true END AS ok FROM (SELECT *, ['success', 'missing_fields', 'ambiguous', 'not_found', 'no_tool', 'other'][conv_id % 6 + 1] AS expected FROM conversations WHERE role = 'assistant')"
)
def judge_answer(spark, d):
    outcomes = F.array(*[F.lit(x) for x in ["success", "missing_fields", "ambiguous", "not_found", "no_tool", "other"]])
    said = _t(spark, d, "conversations").where("role = 'assistant'").withColumn("expected", F.get(outcomes, (F.col("conv_id") % 6).cast("int")))
    return said.select("conv_id", "turn", "expected", evaluation.judge_answer(F.col("expected"), F.col("text")).alias("ok"))


# --- predicates and lookups -----------------------------------------------------------------------


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority LIKE '1%'")
def active_filter(spark, d):
    return _t(spark, d, "orders").where((F.col("o_orderstatus") == "O") & F.startswith("o_orderpriority", F.lit("1"))).select("o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey = 7")
def point_lookup(spark, d):
    return _t(spark, d, "orders").where("o_orderkey = 7").select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT n_name, coalesce(r_name, 'unknown') AS scene FROM nation LEFT JOIN (SELECT * FROM region WHERE r_regionkey < 3) ON n_regionkey = r_regionkey")
def dim_lookup(spark, d):
    dim = _t(spark, d, "region").where("r_regionkey < 3")
    return _t(spark, d, "nation").join(dim, F.col("n_regionkey") == F.col("r_regionkey"), "left").select("n_name", F.coalesce("r_name", F.lit("unknown")).alias("scene"))


_STEM = "CASE WHEN len(t) > 4 AND ends_with(t, 'ing') THEN left(t, len(t) - 3) WHEN len(t) > 3 AND ends_with(t, 'ed') THEN left(t, len(t) - 2) WHEN len(t) > 3 AND ends_with(t, 's') THEN left(t, len(t) - 1) ELSE t END"
_STOPS = str(text.STOP_WORDS)


def _content(column: str) -> str:
    return f"list_filter(list_transform(regexp_extract_all(lower({column}), '[a-z0-9]+'), lambda t: {_STEM}), lambda t: NOT list_contains({_STOPS}, t))"


@query(
    f"WITH q AS (SELECT r_regionkey AS q_key, {_content('r_name')} AS q FROM region UNION ALL SELECT 100 + n_nationkey, {_content('n_name')} FROM nation), t AS (SELECT c_custkey AS t_key, {_content('c_mktsegment || chr(32) || c_name || chr(32) || n_name || chr(32) || r_name')} AS t FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) SELECT q_key, t_key FROM q JOIN t ON len(q) > 0 AND list_has_all(t, q)"
)
def token_subset_match(spark, d):
    region, nation = _t(spark, d, "region"), _t(spark, d, "nation")
    asked = region.select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("q")).unionAll(nation.select((F.col("n_nationkey") + 100).alias("k"), "n_name"))
    tasks = _t(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    tasks = tasks.select("c_custkey", F.concat_ws(" ", "c_mktsegment", "c_name", "n_name", "r_name").alias("task"))
    return store.stem_candidates(asked, tasks, "k", "q", "c_custkey", "task")


_ASKED = "CASE p_partkey % 4 WHEN 0 THEN 'the red widgets' WHEN 1 THEN 'small' WHEN 2 THEN '' ELSE 'do ' || p_name || ' now' END"


@query(f"SELECT p_partkey, q = '' OR contains(p_name, q) OR contains(q, p_name) OR (len({_content('q')}) > 0 AND list_has_all({_content('p_name')}, {_content('q')})) AS matches FROM (SELECT p_partkey, p_name, {_ASKED} AS q FROM part)")
def fuzzy_task(spark, d):
    part = F.col("p_partkey") % 4
    asked = F.when(part == 0, "the red widgets").when(part == 1, "small").when(part == 2, "").otherwise(F.concat(F.lit("do "), F.col("p_name"), F.lit(" now")))
    return _t(spark, d, "part").select("p_partkey", text.task_matches(asked, F.col("p_name")).alias("matches"))


_SLOT = "CASE event_id % 4 WHEN 0 THEN 'tomorrow' WHEN 1 THEN 'at ' || event_type WHEN 2 THEN '' ELSE 'some day' END"


@query(f"SELECT event_id, q = '' OR contains('at ' || event_type || ' tomorrow', q) OR strftime(ts, '%d') = lpad((1 + event_id % 28)::VARCHAR, 2, '0') AS matches FROM (SELECT *, {_SLOT} AS q FROM events)")
def fuzzy_time(spark, d):
    part, day = F.col("event_id") % 4, F.format_string("2024-01-%02dT08:00:00+00:00", 1 + F.col("event_id") % 28)
    asked = F.when(part == 0, "tomorrow").when(part == 1, F.concat(F.lit("at "), "event_type")).when(part == 2, "").otherwise("some day")
    stored = F.concat(F.lit("At "), F.col("event_type"), F.lit("  tomorrow"))
    return _t(spark, d, "events").select("event_id", text.time_matches(asked, stored, day, timex.iso_with_offset(F.col("ts"), "+00:00")).alias("matches"))


@query(
    "SELECT c_custkey AS request_id, CASE WHEN n = 0 THEN 'not_found' WHEN n > 1 THEN 'ambiguous' ELSE 'success' END AS status, n, CASE WHEN n = 1 THEN k END AS reminder_id FROM (SELECT c_custkey, count(o_orderkey) AS n, min(o_orderkey) AS k FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') ON c_custkey = o_custkey GROUP BY 1)"
)
def ambiguity_protocol(spark, d):
    matches = _t(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("request_id"), F.col("o_orderkey").alias("reminder_id"))
    return store.outcome(matches, _t(spark, d, "customer").select(F.col("c_custkey").alias("request_id")))


@query("SELECT CAST(max(CAST(split_part(s_name, '#', 2) AS INT)) + 1 AS INT) AS next_number, printf('rem_%04d', max(CAST(split_part(s_name, '#', 2) AS INT)) + 1) AS next_id FROM supplier")
def next_id(spark, d):
    return store.next_number(_t(spark, d, "supplier"), "s_name", "#")


_AFTER = "SELECT CASE WHEN o_orderkey % 11 = 0 THEN o_orderkey + 100000000 ELSE o_orderkey END AS o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 7 <> 0"
_DIFF = f"count(*) FILTER (b.o_orderkey IS NULL) AS created_count, count(*) FILTER (a.o_orderkey IS NULL) AS deleted_count, count(*) FILTER (a.o_orderkey = b.o_orderkey AND (a.o_orderstatus IS DISTINCT FROM b.o_orderstatus OR a.o_totalprice IS DISTINCT FROM b.o_totalprice)) AS changed_count FROM orders b FULL JOIN ({_AFTER}) a ON a.o_orderkey = b.o_orderkey"


def _after(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    kept = orders.where(key % 7 != 0)
    return kept.select(F.when(key % 11 == 0, key + 100000000).otherwise(key).alias("o_orderkey"), "o_custkey", F.when(key % 5 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"), "o_totalprice")


@query(f"SELECT {_DIFF}")
def snapshot_diff(spark, d):
    orders = _t(spark, d, "orders")
    return store.snapshot_diff(orders, _after(orders), "o_orderkey", ["o_orderstatus", "o_totalprice"])


@query(
    f"WITH x AS (SELECT coalesce(b.o_custkey, a.o_custkey) AS o_custkey, {_DIFF} GROUP BY 1) SELECT o_custkey, CASE WHEN o_custkey % 3 = 0 THEN CASE WHEN changed_count < 1 THEN 'nothing updated' ELSE 'ok' END WHEN o_custkey % 3 = 1 THEN CASE WHEN created_count + deleted_count + changed_count <> 0 THEN 'changed storage' ELSE 'ok' END ELSE 'status: not_found for ambiguous' END AS verdict FROM x"
)
def judge_tool_success(spark, d):
    orders = _t(spark, d, "orders")
    x = store.snapshot_diff(orders, _after(orders), "o_orderkey", ["o_orderstatus", "o_totalprice"], "o_custkey")
    part = F.col("o_custkey") % 3
    expected = F.when(part < 2, "success").otherwise("ambiguous")
    tool = F.when(part == 0, "update").otherwise("query")
    status = F.when(part < 2, "success").otherwise("not_found")
    zero = F.lit(0)
    return x.select("o_custkey", evaluation.judge_tool(expected, tool, status, zero, zero, F.col("created_count"), F.col("deleted_count"), F.col("changed_count")).alias("verdict"))


# --- JSON, tool calls, metrics --------------------------------------------------------------------


@query(
    "SELECT event_id, k, CASE WHEN k IS NULL THEN 'missing:k' WHEN k <> CAST(event_id % 100 AS VARCHAR) THEN 'mismatch:k' ELSE '' END AS notes, CASE WHEN k = CAST(event_id % 100 AS VARCHAR) THEN 1 ELSE 0 END AS ok FROM (SELECT event_id, json_extract_string(props, '$.k') AS k FROM events)"
)
def props_compare(spark, d):
    got = F.from_json("props", "map<string,string>")
    c = jsonx.compare_arguments(F.create_map(F.lit("k"), (F.col("event_id") % 100).cast("string")), got)
    rows = _t(spark, d, "events").select("event_id", F.element_at(got, F.lit("k")).alias("k"), c.alias("c"))
    return rows.select("event_id", "k", F.array_join("c.notes", ",").alias("notes"), "c.ok")


@query("SELECT event_id, CASE WHEN event_id % 4 = 3 THEN NULL ELSE json_extract_string(props, '$.k') END AS k FROM events")
def json_extract_layers(spark, d):
    part, props = F.col("event_id") % 4, F.col("props")
    raw = F.when(part == 0, props).when(part == 1, F.concat(F.lit("Sure:\n```json\n"), props, F.lit("\n```\ndone"))).when(part == 2, F.concat(F.lit("I call "), props, F.lit(" now"))).otherwise(F.concat(F.lit("two "), props, F.lit(" and "), props))
    rows = _t(spark, d, "events").select("event_id", jsonx.extract_object(raw, fenced=True).alias("o"))
    return rows.select("event_id", F.get_json_object("o", "$.k").alias("k"))


@query(
    "SELECT event_id, CASE event_id % 4 WHEN 3 THEN NULL ELSE event_type END AS name, CASE event_id % 4 WHEN 3 THEN NULL ELSE json_extract_string(props, '$.k') END AS k FROM events"
)
def tool_call_parse(spark, d):
    part, name = F.col("event_id") % 4, F.col("event_type")
    k = F.get_json_object("props", "$.k")
    listed = F.concat(F.lit('{"tool_calls": [{"type": "function", "function": {"name": "'), name, F.lit('", "arguments": "{\\"k\\": \\"'), k, F.lit('\\"}"}}]}'))
    xml = F.concat(F.lit("<think>x</think>\n<function="), name, F.lit(">\n<parameter=k>\n"), k, F.lit("\n</parameter>\n</function>"))
    tagged = F.concat(F.lit('<tool_call>{"name": "'), name, F.lit('", "arguments": '), F.col("props"), F.lit("}</tool_call>"))
    raw = F.when(part == 0, listed).when(part == 1, xml).when(part == 2, tagged).otherwise(F.lit("no call"))
    rows = _t(spark, d, "events").select("event_id", jsonx.tool_call(raw).alias("c"))
    return rows.select("event_id", F.col("c.name").alias("name"), F.element_at("c.arguments", F.lit("k")).alias("k"))


@query(
    """WITH p AS (SELECT event_id % 3 <> 0 AS should_call, value > 50 AS called, value > 50 AND event_id % 5 <> 0 AS name_ok, event_id % 4 <> 0 AS json_ok, event_id % 3 AS arg_checked, CASE WHEN value > 50 THEN event_id % 3 ELSE 0 END AS arg_ok FROM events)
SELECT count(*) AS total, count(*) FILTER (should_call = called) / count(*)::DOUBLE AS call_accuracy, count(*) FILTER (name_ok) / count(*)::DOUBLE AS name_accuracy, count(*) FILTER (json_ok) / count(*)::DOUBLE AS json_rate, sum(arg_ok)::DOUBLE / sum(arg_checked)::DOUBLE AS arg_match_rate,
count(*) FILTER (name_ok AND should_call) / (count(*) FILTER (should_call))::DOUBLE AS recall, count(*) FILTER (name_ok AND should_call) / (count(*) FILTER (called))::DOUBLE AS precision, count(*) FILTER (NOT should_call AND NOT called) / greatest(count(*) FILTER (NOT should_call), 1)::DOUBLE AS no_tool_accuracy FROM p"""
)
def eval_metrics(spark, d):
    i, called = F.col("event_id"), F.col("value") > 50
    return evaluation.call_metrics(
        _t(spark, d, "events").select(
            (i % 3 != 0).alias("should_call"), called.alias("called"), (called & (i % 5 != 0)).alias("name_ok"), (i % 4 != 0).alias("json_ok"), (i % 3).alias("arg_checked"), F.when(called, i % 3).otherwise(0).alias("arg_ok")
        )
    )


@query(
    """SELECT event_id, CASE WHEN event_id % 5 = 4 THEN 'payload is no object' WHEN event_id % 5 = 3 THEN 'status mismatch' WHEN event_id % 5 = 2 THEN 'no reminder_id' WHEN event_id % 5 = 1 THEN 'tool mismatch' END AS error FROM events"""
)
def clean_quarantine(spark, d):
    part, i = F.col("event_id") % 5, F.col("event_id").cast("string")
    good = F.concat(F.lit('{"status": "success", "reminder": {"id": "rem_'), i, F.lit('"}}'))
    payload = F.when(part == 4, F.concat(good, F.lit(" trailing"))).when(part == 3, F.lit('{"status": "not_found"}')).when(part == 2, F.lit('{"status": "", "reminder": {}}')).otherwise(good)
    tool = F.when(part == 1, "delete_reminder").otherwise("create_reminder")
    rows = _t(spark, d, "events").select("event_id", payload.alias("p"), tool.alias("t"))
    cleaned = quality.clean_payload(F.lit("create_success"), F.col("t"), F.col("p"), jsonx.strict_kind(F.col("p")))
    return rows.select("event_id", cleaned["error"].alias("error"))


_TOOL_OF = "['create', 'query', 'update', 'delete', 'chat'][event_id % 5 + 1]"
_OUTCOME_OF = "['success', 'missing_fields', 'ambiguous', 'not_found', 'no_tool', 'odd', 'success'][event_id % 7 + 1]"


@query(
    f"""WITH c AS (SELECT event_id, event_type, {_TOOL_OF} AS tool, {_OUTCOME_OF} AS expected FROM events)
SELECT event_id, CASE WHEN tool <> 'chat' AND expected <> 'no_tool' THEN true ELSE false END AS calls, CASE WHEN expected = 'success' THEN CASE tool WHEN 'create' THEN 'create_one' WHEN 'update' THEN 'update_one' WHEN 'delete' THEN 'delete_or_cancel_one' ELSE 'no_change' END WHEN expected = 'odd' THEN 'unknown' ELSE 'no_change' END AS change,
CASE WHEN expected = 'success' THEN CASE tool WHEN 'create' THEN 4 WHEN 'query' THEN 3 WHEN 'update' THEN 4 WHEN 'delete' THEN 2 ELSE 1 END WHEN expected = 'odd' THEN 1 ELSE 2 END::INT AS assertions,
CASE WHEN expected = 'success' THEN CASE tool WHEN 'create' THEN 'after_active_count == before_active_count + 1' WHEN 'update' THEN 'after_active_count == before_active_count' WHEN 'delete' THEN 'after_active_count == before_active_count - 1 OR target reminder.status in [''cancelled'',''deleted'']' ELSE 'after_state == before_state' END
WHEN expected = 'odd' THEN 'manual review required' WHEN expected = 'no_tool' THEN 'no tool call should be emitted' ELSE 'after_state == before_state' END AS first,
CASE tool WHEN 'create' THEN 'target=self,task=' || event_type WHEN 'query' THEN 'target=self,task=' || event_type WHEN 'update' THEN 'new_task=x,target=self,task=the ' || event_type || ',time_text=tomorrow' WHEN 'delete' THEN 'target=self,task=the ' || event_type ELSE '' END AS arguments FROM c"""
)
def case_expectations(spark, d):
    """What each case expects: a call, the change, its assertions, and the arguments by name and value."""
    k, e = F.col("event_id"), F.col("event_type")
    tool = planning.cyclic_pick([*evaluation.TOOLS, "chat"], k % 5)
    expected = planning.cyclic_pick(["success", "missing_fields", "ambiguous", "not_found", "no_tool", "odd", "success"], k % 7)
    null = F.lit(None).cast("string")
    gold = {"target": null, "task": e, "time_text": null, "locator_task": F.concat(F.lit("the "), e), "locator_time_text": F.when(tool == "update", "tomorrow"), "new_task": F.lit("x"), "new_time_text": null}
    x = evaluation.expectation(expected, tool, F.lit("s"))
    pairs = F.transform(F.array_sort(F.map_entries(evaluation.expected_arguments(tool, gold))), lambda p: F.concat(p["key"], F.lit("="), p["value"]))
    rows = _t(spark, d, "events").select("event_id", x.alias("x"), F.array_join(pairs, ",").alias("arguments"))
    return rows.select("event_id", F.col("x.should_call_tool").alias("calls"), F.col("x.state_change").alias("change"), F.size("x.diff_assertions").alias("assertions"), F.get("x.diff_assertions", F.lit(0)).alias("first"), "arguments")


@query(
    """SELECT event_id, CASE WHEN event_id % 9 = 0 THEN 'no JSON object' WHEN event_id % 9 = 1 THEN 'missing prompt' END AS error, CASE WHEN event_id % 9 > 1 THEN 'Say ' || event_type || ' now' END AS prompt,
CASE WHEN event_id % 9 > 1 THEN CASE event_id % 9 WHEN 2 THEN event_type WHEN 3 THEN NULL WHEN 4 THEN NULL WHEN 5 THEN 'below ' || event_id WHEN 6 THEN NULL WHEN 7 THEN event_type ELSE 'planned ' || event_id END END AS task, CASE WHEN event_id % 9 > 1 THEN 'at 7' END AS time_text, CASE WHEN event_id % 9 > 1 THEN 'self' END AS target FROM events"""
)
def gold_merge(spark, d):
    """Models' replies over planned golds: fields absent, said, blank, null, and said again below."""
    k, e = F.col("event_id"), F.col("event_type")
    put = lambda *x: F.concat(*[F.lit(v) if isinstance(v, str) else v.cast("string") for v in x])
    head = put('{"prompt": " Say  ', e, ' now"')
    replies = [
        put("so: ", e), put('{"prompt": " ", "task": "', e, '"}'), put("```json\n", head, ', "task": " ', e, ' "}\n```'), put(head, ', "task": null}'), put(head, ', "task": " "}'),
        put(head, ', "task": "', e, '", "gold": {"task": "below ', k, '", "time_text": " ", "target": "mom"}}'), put(head, ', "gold": {"task": null, "time_text": 3}}'), put(head, ', "task": "', e, '", "gold": {"task": ""}}'), put(head, ', "gold": [1]}'),
    ]
    null = F.lit(None).cast("string")
    planned = F.struct(put("planned ", k).alias("task"), F.lit("at 7").alias("time_text"), *[null.alias(n) for n in cases.SAID[2:]])
    rows = _t(spark, d, "events").select("event_id", cases.merged_gold(F.get(F.array(*replies), (k % 9).cast("int")), planned).alias("m"))
    return rows.select("event_id", "m.error", "m.prompt", "m.gold.task", "m.gold.time_text", "m.gold.target")


_PLACE = "(('0x' || left(md5('{0}:' || {1}), 7))::BIGINT / 268435456.0::DOUBLE)"
_OLD, _NEW, _MEDICAL, _OTHER = (_PLACE.format(7, f"event_id || '{n}'") for n in ("old", "new", "medical", "other"))


@query(
    f"""WITH e AS (SELECT event_id, event_id // 7 AS o, ['create_missing_task', 'update_task_change', 'no_tool_chat', 'create_missing_time', 'query_medicine', 'delete_ambiguous', 'other'][event_id % 7 + 1] AS s, ['missing_fields', 'success', 'no_tool', 'missing_fields', 'success', 'ambiguous', 'success'][event_id % 7 + 1] AS x FROM events)
SELECT event_id, ['plain', 'polite', 'short'][(o + floor({_PLACE.format(8, 'event_id')} * 3)::BIGINT) % 3 + 1] AS style, ['one clause', 'two clauses'][(o + floor({_PLACE.format(9, 'event_id')} * 2)::BIGINT) % 2 + 1] AS complexity,
'do not copy the seed sentence; do not output assistant wording; do not create near-duplicates' || CASE WHEN x = 'no_tool' THEN '; do not ask to create, query, update, or delete reminders' ELSE '' END || CASE WHEN contains(s, 'missing_task') THEN '; the prompt must not mention the task' ELSE '' END || CASE WHEN contains(s, 'missing_time') THEN '; the prompt must not mention the time/date/daypart' ELSE '' END || CASE WHEN x = 'ambiguous' THEN '; leave the target reminder underspecified' ELSE '' END AS avoid,
CASE WHEN contains(s, 'task_change') THEN 'change from ''' || ['walk', 'plants'][(o + floor({_OLD} * 2)::BIGINT) % 2 + 1] || ''' to ''' || ['umbrella', 'phone', 'papers'][(o + floor({_NEW} * 3)::BIGINT + 3) % 3 + 1] || ''''
WHEN contains(s, 'medicine') THEN ['pills', 'vitamins'][(o + floor({_MEDICAL} * 2)::BIGINT) % 2 + 1] WHEN x = 'no_tool' THEN 'weather' ELSE ['laundry', 'stove', 'cat'][(o + floor({_OTHER} * 3)::BIGINT) % 3 + 1] END AS topic,
CASE WHEN contains(s, 'missing_time') THEN 'no_time' ELSE ['clock', 'daypart'][(o + floor({_PLACE.format(16, 'event_id')} * 2)::BIGINT) % 2 + 1] END AS time_style FROM e"""
)
def variations(spark, d):
    """Style, complexity, topic and time of every occurrence of a seed, and what it must avoid."""
    k, o = F.col("event_id"), F.floor(F.col("event_id") / 7)
    scenario = planning.cyclic_pick(["create_missing_task", "update_task_change", "no_tool_chat", "create_missing_time", "query_medicine", "delete_ambiguous", "other"], k % 7)
    expected = planning.cyclic_pick(["missing_fields", "success", "no_tool", "missing_fields", "success", "ambiguous", "success"], k % 7)
    tool = F.when(expected == "no_tool", "no_tool").otherwise("create")
    pools = {"old": ["walk", "plants"], "new": ["umbrella", "phone", "papers"], "medical": ["pills", "vitamins"], "no_tool": ["weather"], "other": ["laundry", "stove", "cat"]}
    one = cases.variation(expected, scenario, o, k, ["plain", "polite", "short"], ["one clause", "two clauses"])
    two = cases.topic_profile(scenario, tool, o, k, pools, [("medical", ["medicine"]), ("old|new", ["task_change"])], ["clock", "daypart"])
    return _t(spark, d, "events").select(k, one.alias("v"), two.alias("p")).select("event_id", "v.style", "v.complexity", "v.avoid", "p.topic", "p.time_style")


def _affirmed(word: str) -> str:
    tail = f"regexp_replace(regexp_replace(right(regexp_replace(array_to_string(s[1:i], '{word}'), '^\\s+', ''), 30), '^\\s+|\\s+$', '', 'g'), '[.,!?;: ]+$', '')"
    return f"(SELECT count(*) FROM (SELECT string_split(x, '{word}') AS s), range(1, len(string_split(x, '{word}'))) r(i) WHERE NOT ({tail} LIKE '%do not' OR {tail} LIKE '%never'))"


@query(
    f"""WITH t AS (SELECT doc_id, regexp_replace(lower(CASE doc_id % 4 WHEN 0 THEN coalesce(text, '') || ' Do not, stupid' WHEN 1 THEN 'never stupid. you stupid. ' || coalesce(text, '') WHEN 2 THEN 'you never: SCUM' ELSE text END), '^\\s+|\\s+$', '', 'g') AS x FROM documents)
SELECT doc_id, CASE WHEN {_affirmed('scum')} > 0 THEN 'scum' WHEN {_affirmed('stupid')} > 0 THEN 'stupid' END AS found FROM t""".replace("\\\\", "\\")
)
def forbidden_scan(spark, d):
    """Forbidden phrases that are not negated, in texts with and without negations."""
    part, own = F.col("doc_id") % 4, F.coalesce("text", F.lit(""))
    said = F.when(part == 0, F.concat(own, F.lit(" Do not, stupid"))).when(part == 1, F.concat(F.lit("never stupid. you stupid. "), own)).when(part == 2, "you never: SCUM").otherwise(F.col("text"))
    return _t(spark, d, "documents").select("doc_id", text.first_forbidden(said, ["scum", "stupid"], ["do not", "never"]).alias("found"))


_CASE = "SELECT n_nationkey AS case_id, ['create', 'query', 'update', 'delete'][n_nationkey % 4 + 1] AS tool, ['success', 'ambiguous', 'not_found', 'missing_fields', 'no_tool'][n_nationkey % 5 + 1] AS expected, n_name FROM nation"


def _cases(spark, d):
    pick = lambda words: F.get(F.array(*[F.lit(w) for w in words]), F.col("n_nationkey") % len(words))
    tool, expected = pick(["create", "query", "update", "delete"]), pick(["success", "ambiguous", "not_found", "missing_fields", "no_tool"])
    rows = _t(spark, d, "nation").select(F.col("n_nationkey").alias("case_id"), tool.alias("tool"), expected.alias("expected_outcome"), F.lit("plain").alias("scenario"), F.lower("n_name").alias("task"))
    gold = cases.planned_gold(F.col("tool"), F.col("scenario"), F.col("expected_outcome"), F.col("case_id"), F.col("task"), F.lit("tomorrow"), F.lit("other"), F.lit("tonight"))
    return rows.withColumn("gold", gold)


@query(
    f"""SELECT case_id, tool AS action, CASE WHEN tool = 'create' OR tool = 'query' OR tool = 'delete' THEN lower(n_name) END AS task,
CASE WHEN tool = 'create' THEN 'tomorrow' WHEN tool = 'query' AND case_id % 2 = 0 THEN 'tomorrow' WHEN tool = 'delete' AND (case_id % 2 = 0 OR expected = 'success') THEN 'tomorrow' END AS time_text,
CASE WHEN tool = 'delete' OR (tool = 'update' AND expected IN ('success', 'ambiguous', 'not_found')) THEN lower(n_name) END AS locator_task,
CASE WHEN tool = 'update' AND expected IN ('success', 'ambiguous', 'not_found') THEN 'tonight' END AS new_time_text, expected <> 'no_tool' AS should_call_tool FROM ({_CASE})"""
)
def gold_plan(spark, d):
    return _cases(spark, d).select("case_id", "gold.action", "gold.task", "gold.time_text", "gold.locator_task", "gold.new_time_text", "gold.should_call_tool")


@query(
    f"""WITH c AS ({_CASE}), s AS (SELECT case_id, 'rem_0001' AS reminder_id, lower(n_name) AS task, CASE WHEN tool = 'query' AND case_id % 2 = 1 THEN 'tomorrow at 4:00 PM' ELSE 'tomorrow' END AS time_text FROM c WHERE expected = 'success' AND tool <> 'create'
UNION ALL SELECT case_id, 'rem_0001', lower(n_name), 'tomorrow morning' FROM c WHERE expected = 'ambiguous' UNION ALL SELECT case_id, 'rem_0002', lower(n_name), 'tomorrow evening' FROM c WHERE expected = 'ambiguous'
UNION ALL SELECT case_id, 'rem_d001', 'water the orchids', 'tomorrow morning' FROM c UNION ALL SELECT case_id, 'rem_d002', 'charge the phone', 'tonight at 9:00 PM' FROM c)
SELECT *, CASE time_text WHEN 'tomorrow at 4:00 PM' THEN '2026-05-27T16:00:00' WHEN 'tomorrow evening' THEN '2026-05-27T19:00:00' WHEN 'tonight at 9:00 PM' THEN '2026-05-26T21:00:00' ELSE '2026-05-27T09:00:00' END || '+08:00' AS scheduled_time,
'self' AS target, 'active' AS status, '2026-05-24T10:50:06+08:00' AS created_at, '2026-05-25T11:50:06+08:00' AS updated_at, (row_number() OVER (PARTITION BY case_id ORDER BY reminder_id) - 1)::INT AS place FROM s"""
)
def initial_state(spark, d):
    """The reminders that each case starts with, whole."""
    return cases.starting_reminders(_cases(spark, d), "2026-05-26 11:50:06", "+08:00")


@query(f"SELECT case_id, CASE WHEN case_id % 3 = 0 THEN 0 ELSE 1 END::BIGINT AS reminders, CASE WHEN case_id % 3 = 0 THEN 'missing initialized reminders' END AS failure FROM ({_CASE})")
def case_state_join(spark, d):
    held = _cases(spark, d).where("case_id % 3 <> 0").select("case_id")
    return cases.with_state(_cases(spark, d).select("case_id"), held)


@query("SELECT event_id, event_type AS said FROM events")
def clean_utterances(spark, d):
    part, x = F.col("event_id") % 4, F.col("event_type")
    raw = F.when(part == 0, F.concat(F.lit('```json\n{"utterance": "'), x, F.lit('"}\n```'))).when(part == 1, F.concat(F.lit(' "User: '), x, F.lit(' "'))).when(part == 2, F.concat(F.lit("utterance:  "), x)).otherwise(x)
    return _t(spark, d, "events").select("event_id", cases.clean_generated(raw).alias("said"))


@query("SELECT event_id, round, stopped FROM (SELECT event_id, event_id % 5 AS round, max(event_id % 5) OVER (PARTITION BY user_id) > 3 AS stopped FROM events) WHERE round <= 3")
def bounded_rounds(spark, d):
    calls = _t(spark, d, "events").select("event_id", F.col("user_id").alias("conv_id"), (F.col("event_id") % 5).alias("round"))
    return cases.bounded_rounds(calls).select("event_id", "round", "stopped")


_HIT = "lambda x: contains(x, e.event_type) OR contains(e.event_type, x)"
_HITS = f"len(list_filter(held, {_HIT}))"


@query(
    f"""WITH RECURSIVE e AS (SELECT user_id, event_id, lower(event_type) AS event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
s AS (SELECT user_id, 0::BIGINT AS n, NULL::BIGINT AS seq, CAST([] AS VARCHAR[]) AS held, NULL::VARCHAR AS status FROM (SELECT DISTINCT user_id FROM events)
UNION ALL SELECT s.user_id, e.n, e.event_id, CASE WHEN e.event_id % 4 = 0 THEN list_append(held, e.event_type) WHEN e.event_id % 4 = 2 AND {_HITS} = 1 THEN list_transform(held, lambda x: CASE WHEN contains(x, e.event_type) OR contains(e.event_type, x) THEN 'other' ELSE x END)
WHEN e.event_id % 4 = 3 AND {_HITS} = 1 THEN list_filter(held, lambda x: NOT (contains(x, e.event_type) OR contains(e.event_type, x))) ELSE held END,
CASE WHEN e.event_id % 4 = 0 THEN 'success' WHEN {_HITS} = 0 THEN 'not_found' WHEN e.event_id % 4 > 1 AND {_HITS} > 1 THEN 'ambiguous' ELSE 'success' END FROM s JOIN e ON e.user_id = s.user_id AND e.n = s.n + 1)
SELECT user_id::BIGINT AS conv_id, seq, status FROM s WHERE n > 0"""
)
def dispatch_calls(spark, d):
    """Replays tool calls made of the events, one conversation a user."""
    pick = F.get(F.array(*[F.lit(x) for x in evaluation.TOOLS]), (F.col("event_id") % 4).cast("int"))
    calls = _t(spark, d, "events").select(F.col("user_id").cast("long").alias("conv_id"), F.col("event_id").alias("seq"), pick.alias("tool"), F.col("event_type").alias("task"), F.lit("other").alias("new_task"))
    return cases.dispatch(calls)


# --- time, intents, devices, due windows ----------------------------------------------------------

_NOW = "date_trunc('second', ts)"
_CLOCKS = [  # phrase, days ahead, minutes of the day; both in SQL
    ("'tonight at 8:' || lpad((event_id % 60)::VARCHAR, 2, '0') || ' PM'", "0", "20 * 60 + event_id % 60"),
    ("'today at ' || (1 + event_id % 11) || '.30pm'", "0", "(13 + event_id % 11) * 60 + 30"),
    ("'next ' || dayname(d + (event_id % 7)::INT) || ' at 12 am'", "CASE WHEN event_id % 7 = 0 THEN 7 ELSE event_id % 7 END", "0"),
    ("'tomorrow morning'", "1", "540"),
    ("'tomorrow'", "1", "540"),
    ("'this ' || dayname(d + (event_id % 7)::INT) || ' evening'", "event_id % 7", "19 * 60"),
    ("'after breakfast tomorrow'", "1", "540"),
    ("'before dinner tonight'", "0", "20 * 60"),
    ("'day after tomorrow at 7am'", "2", "420"),
    ("(1 + event_id % 12) || ' a.m.'", "0", "540"),
    ("'at ' || (1 + event_id % 11) || ' in the evening'", "0", "(13 + event_id % 11) * 60"),
    ("'yesterday at 6:15'", "0", "375"),
]
_PHRASE_OF = "CASE event_id % 12 " + " ".join(f"WHEN {i} THEN {p}" for i, (p, _, _) in enumerate(_CLOCKS)) + " END"
_DAYS_OF, _MINUTES_OF = ("CASE event_id % 12 " + " ".join(f"WHEN {i} THEN {c[k]}" for i, c in enumerate(_CLOCKS)) + " END" for k in (1, 2))


@query(
    f"""WITH e AS (SELECT event_id, {_NOW} AS now, CAST(ts AS DATE) AS d FROM events), p AS (SELECT *, d + ({_DAYS_OF})::INT + to_minutes(({_MINUTES_OF})::BIGINT) AS due FROM e)
SELECT event_id, strftime(CASE WHEN due > now OR event_id % 12 = 11 THEN due ELSE due + INTERVAL 1 DAY END, '%Y-%m-%dT%H:%M:%S') || '+08:00' AS resolved FROM p"""
)
def resolve_time(spark, d):
    """Phrases built from the events, read at each event's own time."""
    k, day = F.col("event_id"), F.to_date("ts")
    text_of = lambda *x: F.concat(*[F.lit(v) if isinstance(v, str) else v.cast("string") for v in x])
    name = F.date_format(F.date_add(day, (k % 7).cast("int")), "EEEE")
    phrases = [
        text_of("tonight at 8:", F.lpad((k % 60).cast("string"), 2, "0"), " PM"), text_of("today at ", 1 + k % 11, ".30pm"), text_of("next ", name, " at 12 am"), F.lit("tomorrow morning"), F.lit("tomorrow"), text_of("this ", name, " evening"),
        F.lit("after breakfast tomorrow"), F.lit("before dinner tonight"), F.lit("day after tomorrow at 7am"), text_of(1 + k % 12, " a.m."), text_of("at ", 1 + k % 11, " in the evening"), F.lit("yesterday at 6:15"),
    ]
    phrase = F.get(F.array(*phrases), (k % 12).cast("int"))
    now = F.date_trunc("second", "ts").cast("timestamp_ntz")
    return _t(spark, d, "events").select("event_id", timex.iso_with_offset(timex.resolve_time(phrase, now), "+08:00").alias("resolved"))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN ts ELSE ts - INTERVAL 6 HOUR END AS now FROM (SELECT event_id, date_trunc('second', ts) AS ts FROM events)")
def clock_texts(spark, d):
    """Times of a clock as text, without an offset or with another one."""
    iso = timex.iso_with_offset(F.col("ts"), "")
    text_now = F.when(F.col("event_id") % 2 == 0, iso).otherwise(F.concat(iso, F.lit("+08:00")))
    return _t(spark, d, "events").select("event_id", timex.read_now(text_now, "+02:00").alias("now"))


# Fixed values of the checks below: commands, one for each rule and some of their slots, with what they mean.
_COMMANDS = [
    ("联系一下物业", 1, "call_manager", ""),
    ("给妈妈打电话", 2, "call_contact", ""),
    ("接听电话", 3, "answer_call", ""),
    ("帮我远程开门", 4, "unlock", ""),
    ("拒接这个来电", 5, "end_or_reject_call", ""),
    ("更换壁纸", 6, "change_wallpaper", "wallpaper_type"),
    ("开启勿扰模式", 7, "set_dnd", ""),
    ("音量调到{}", 8, "set_volume", ""),
    ("屏幕亮度调到{}", 9, "set_brightness", ""),
    ("打开安防", 10, "set_security_mode", ""),
    ("查询昨天的告警记录", 11, "query_alarm_records", ""),
    ("切换到{}通道", 12, "monitor_control", ""),
    ("查看未读短信", 13, "view_messages", ""),
    ("今天天气怎么样{}", None, None, ""),
]
_OF = lambda i: "CASE event_id % 14 " + " ".join(f"WHEN {k} THEN {'NULL' if c[i] is None else repr(c[i])}" for k, c in enumerate(_COMMANDS)) + " END"


@query(
    f"SELECT event_id, ({_OF(1)})::INT AS capability_id, {_OF(2)} AS intent, {_OF(3)} AS missing, CASE WHEN event_id % 14 IN (7, 8) THEN least(event_id % 150, 100)::INT END AS level, CASE WHEN event_id % 14 = 11 THEN (event_id % 150)::INT END AS channel, CASE WHEN event_id % 14 = 6 OR event_id % 14 = 9 THEN true END AS enabled FROM events"
)
def intent_rules(spark, d):
    """Device commands with numbers built from the events."""
    k = F.col("event_id")
    said = F.replace(F.get(F.array(*[F.lit(c[0]) for c in _COMMANDS]), (k % 14).cast("int")), F.lit("{}"), (k % 150).cast("string"))
    rows = _t(spark, d, "events").select("event_id", intent.device_label(said).alias("l"))
    typed = intent.typed_slots(F.col("l.slots"))
    return rows.select("event_id", "l.capability_id", "l.intent", F.array_join("l.missing_slots", ",").alias("missing"), *[typed[c].alias(c) for c in ("level", "channel", "enabled")])


@query(
    """WITH RECURSIVE e AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n, event_id FROM events),
s AS (SELECT user_id, 0::BIGINT AS n, 50 AS volume, 60 AS brightness FROM (SELECT DISTINCT user_id FROM events)
UNION ALL SELECT s.user_id, e.n, CASE WHEN event_id % 2 = 0 THEN CASE event_id % 10 WHEN 0 THEN 100 WHEN 2 THEN 0 WHEN 4 THEN greatest(0, volume - 10) ELSE least(100, volume + 10) END ELSE volume END,
CASE WHEN event_id % 2 = 1 THEN CASE event_id % 10 WHEN 1 THEN 100 WHEN 3 THEN greatest(0, brightness - 10) ELSE least(100, brightness + 10) END ELSE brightness END FROM s JOIN e ON e.user_id = s.user_id AND e.n = s.n + 1)
SELECT user_id, volume, brightness, n AS applied FROM s QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC) = 1"""
)
def device_fold(spark, d):
    part = F.col("event_id") % 10
    commands = _t(spark, d, "events").select(
        "user_id", "ts", "event_id",
        F.when(part % 2 == 0, "set_volume").otherwise("set_brightness").alias("intent"),
        F.when(part.isin(3, 4), "down").when(part > 4, "up").otherwise("set").alias("adjustment"),
        F.when(part.isin(0, 1), "max").when(part == 2, "min").alias("level"),
    )
    return device.fold_levels(commands, "user_id", ["ts", "event_id"])


@query("SELECT event_id FROM events WHERE value > 20 AND ts - INTERVAL 30 MINUTE <= TIMESTAMP '2024-01-10 12:00:00' AND TIMESTAMP '2024-01-10 12:00:00' <= ts")
def due_window(spark, d):
    now = F.lit("2024-01-10 12:00:00").cast("timestamp_ntz")
    return _t(spark, d, "events").where(due.is_due(F.col("ts"), now, 30, F.col("value") > 20)).select("event_id")


@query(
    "SELECT event_id, ts, min(tick) AS notified_at FROM events JOIN (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 10 MINUTE)) AS tick) ON tick BETWEEN ts - INTERVAL 30 MINUTE AND ts GROUP BY ALL"
)
def due_ticks(spark, d):
    ticks = spark.sql("SELECT explode(sequence(TIMESTAMP_NTZ '2024-01-01 00:00:00', TIMESTAMP_NTZ '2024-01-31 00:00:00', INTERVAL 10 MINUTES)) AS tick")
    return due.due_at_ticks(_t(spark, d, "events"), ticks, "event_id", "ts", 30, 10)


@query("SELECT event_id AS reminder_id, ts AS scheduled, ts - INTERVAL 10 MINUTE AS notified_at FROM events")
def due_stream(spark, d):
    """Runs the stateful notifier over the events as a stream, to its end, and returns what it fired."""
    import uuid

    from quillon.scratch import shared_folder

    schema = _t(spark, d, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{d}/events.parque[t]")
    when = F.col("ts").cast("timestamp")
    polls = events.select(F.col("event_id").alias("reminder_id"), when.alias("scheduled"), F.explode(F.array(when - F.expr("interval 10 minutes"), when)).alias("now"), F.lit("active").alias("status"))
    name, folder = f"due_{uuid.uuid4().hex}", f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    sink = due.notify_stream(polls, 30).writeStream.format("parquet").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True)
    sink.queryName(name).start(f"{folder}/out").awaitTermination()
    fired = spark.read.schema("reminder_id long, scheduled timestamp, notified_at timestamp").parquet(f"{folder}/out")
    return fired.select("reminder_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("scheduled", "notified_at")])


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def notifier_batches(spark, d):
    """A callback sink that is told of every due reminder once, batch by batch, and writes what it was told."""
    import uuid

    from quillon.scratch import shared_folder

    folder = f"{shared_folder(spark)}/notify-{uuid.uuid4().hex}"
    events = spark.readStream.schema(_t(spark, d, "events").schema).parquet(f"{d}/events.parque[t]")
    when = F.col("ts").cast("timestamp")
    polls = events.select(F.col("event_id").alias("reminder_id"), when.alias("scheduled"), when.alias("now"), F.lit("active").alias("status"))
    due.notify_each(due.notify_stream(polls, 30), f"{folder}/state", lambda batch, at: batch.write.mode("overwrite").parquet(f"{folder}/out/batch={at}")).awaitTermination()
    told = spark.read.parquet(f"{folder}/out")
    return told.join(_t(spark, d, "events"), F.col("reminder_id") == F.col("event_id")).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "SELECT event_id, ts, min(tick) AS notified_at FROM events JOIN (SELECT DISTINCT ts + to_seconds(event_id % 50) AS tick FROM events WHERE event_type = 'view') ON tick BETWEEN ts - INTERVAL 30 MINUTE AND ts GROUP BY ALL"
)
def due_polls(spark, d):
    """The first of irregular polls at which each event is due."""
    events = _t(spark, d, "events")
    polls = events.where("event_type = 'view'").select((F.col("ts") + F.make_dt_interval(secs=F.col("event_id") % 50)).alias("tick"))
    return due.due_at_polls(events, polls, "event_id", "ts", 30)


@query(
    """WITH RECURSIVE b AS (SELECT user_id, date_trunc('millisecond', ts) AS t, event_id, CASE WHEN event_type <> 'error' THEN date_trunc('millisecond', ts) + to_minutes((event_id * 37) % 1500 - 10) END AS s FROM events),
e AS (SELECT user_id, t, s, row_number() OVER (PARTITION BY user_id ORDER BY over, t, event_id) AS n FROM (SELECT *, 0 AS over FROM b UNION ALL SELECT DISTINCT user_id, (SELECT max(t) FROM b) - INTERVAL 10 MINUTE, 0, NULL::TIMESTAMP, 1 FROM b)),
r AS (SELECT user_id, 0::BIGINT AS n, NULL::TIMESTAMP AS s, NULL::TIMESTAMP AS since, NULL::TIMESTAMP AS last, NULL::TIMESTAMP AS scheduled, NULL::TIMESTAMP AS fired FROM (SELECT DISTINCT user_id FROM b)
UNION ALL SELECT user_id, n, s, t, coalesce(fired, last), CASE WHEN fired IS NOT NULL THEN w END, fired
FROM (SELECT e.user_id, e.n, e.s, e.t, r.last, r.s AS w, CASE WHEN r.s IS NOT NULL AND greatest(r.s - INTERVAL 30 MINUTE, r.since) <= least(r.s, e.t) AND (r.last IS NULL OR r.last < r.s - INTERVAL 30 MINUTE) THEN greatest(r.s - INTERVAL 30 MINUTE, r.since) END AS fired FROM r JOIN e ON e.user_id = r.user_id AND e.n = r.n + 1))
SELECT user_id::VARCHAR AS reminder_id, scheduled, fired AS notified_at FROM r WHERE fired IS NOT NULL"""
)
def timed_notices(spark, d):
    """A stream of settings, cancelled and set anew, of which timers make notices."""
    import uuid

    from quillon.scratch import shared_folder

    at = F.date_trunc("millisecond", F.col("ts").cast("timestamp"))
    events = spark.readStream.schema(_t(spark, d, "events").schema).parquet(f"{d}/events.parque[t]")
    later = F.make_dt_interval(mins=(F.col("event_id") * 37) % 1500 - 10)
    settings = events.select(F.col("user_id").cast("string").alias("reminder_id"), at.alias("at"), (at + later).alias("scheduled"), F.when(F.col("event_type") == "error", "cancelled").otherwise("active").alias("status"))
    folder = f"{shared_folder(spark)}/timed-{uuid.uuid4().hex}"
    with notices.rocks(spark):
        sink = notices.notices(settings, 30, "10 minutes").writeStream.format("parquet").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True)
        sink.start(f"{folder}/out").awaitTermination()
    fired = spark.read.schema("reminder_id string, scheduled timestamp, notified_at timestamp").parquet(f"{folder}/out")
    return fired.select("reminder_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("scheduled", "notified_at")])


@query("SELECT event_id, 1::BIGINT AS n FROM events")
def stream_append(spark, d):
    """Two runs that append a stream with copies, the second with all of the first again: one row of each is kept."""
    import uuid

    from quillon.scratch import shared_folder

    folder = f"{shared_folder(spark)}/append-{uuid.uuid4().hex}"
    events = _t(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    twice = lambda df: df.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy")).drop("copy")
    for part in (twice(events.where("event_id % 3 <> 0")), twice(events)):
        part.write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{folder}/in")
        notices.append_once(stream, ["event_id"], "ts", "60 days", folder).awaitTermination()
    return spark.read.parquet(f"{folder}/rows").groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    """WITH e AS (SELECT event_id, date_trunc('second', ts) AS now FROM events)
SELECT event_id, CASE event_id % 12 WHEN 0 THEN date_trunc('minute', now) - INTERVAL 40 DAY WHEN 1 THEN date_trunc('minute', now) + INTERVAL 3 HOUR WHEN 2 THEN now + to_days((event_id % 25)::INT) WHEN 3 THEN date_trunc('day', now) + INTERVAL 9 HOUR WHEN 4 THEN date_trunc('day', now) + INTERVAL 45 HOUR WHEN 5 THEN date_trunc('day', now) + INTERVAL 32 HOUR + INTERVAL 30 MINUTE
WHEN 6 THEN date_trunc('day', now) + to_days(((event_id % 7)::INT)) + INTERVAL 19 HOUR WHEN 10 THEN now + INTERVAL 100 DAY WHEN 11 THEN date_trunc('day', now) + INTERVAL 12 MINUTE END AS at FROM e"""
)
def free_times(spark, d):
    """Dates and clocks in words and figures, read at each event's time; some unreadable."""
    k, now = F.col("event_id"), F.date_trunc("second", "ts").cast("timestamp_ntz")
    on = lambda days, shape: F.date_format(now + F.make_dt_interval(days=days), shape)
    number = lambda n: F.lit(n)
    three = F.date_format(now + F.expr("interval 3 hours"), "MMMM d, yyyy 'at' h:mm a")
    phrases = [
        F.concat(F.lit("on "), on(number(-40), "yyyy-MM-dd HH:mm")), F.concat(F.lit("Around "), three), F.concat(F.lit("the "), on(k % 25, "d"), F.lit("th of "), on(k % 25, "MMM"), F.lit(" please")), F.concat(on(number(0), "M/d/yyyy"), F.lit(" 9am")), F.lit("Tomorrow"), F.lit("tomorrow at 8:30"),
        F.concat(on(k % 7, "EEEE"), F.lit(" 7 p.m.")), F.lit("no idea"), F.lit("Feb 30"), F.lit("today"), F.concat(on(number(100), "yyyy-MM-dd'T'HH:mm:ss")), F.lit("today 12:12 am"),
    ]
    return _t(spark, d, "events").select("event_id", timex.free_time(F.get(F.array(*phrases), (k % 12).cast("int")), now).alias("at"))


@query(
    """SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN ' ' || event_type END AS kept, CASE WHEN event_id % 4 = 0 THEN 'none' ELSE ' ' || event_type END AS filled, event_id % 3 = 1 AS cjk, '{"k": ' || event_id || '}' AS bare,
'http://' || event_type || '/v1' AS url, CASE WHEN event_id % 4 = 0 THEN 'b' ELSE event_type END AS first, CASE WHEN event_id % 2 = 0 THEN event_type || '_tool' END AS called FROM events"""
)
def text_forms(spark, d):
    """Small normal forms: blanks, fences, addresses, the first text that says something, the name in a broken call."""
    k, e = F.col("event_id"), F.col("event_type")
    put = lambda *x: F.concat(*[F.lit(v) if isinstance(v, str) else v.cast("string") for v in x])
    spaced = F.when(k % 4 == 0, " \t ").otherwise(put(" ", e))
    fenced = F.when(k % 3 == 0, put("```json\n{\"k\": ", k, "}\n```")).when(k % 3 == 1, put(" ```\n{\"k\": ", k, "}```  ")).otherwise(put("{\"k\": ", k, "}"))
    url = F.when(k % 3 == 0, put(" http://", e, "/v1/ ")).when(k % 3 == 1, put("http://", e, "/v1/chat/completions")).otherwise(put("http://", e, "/v1//"))
    broken = F.when(k % 2 == 0, put('{"arguments": {, "name" : "', e, '_tool", "name": "other"')).otherwise(put('{"name": "', F.upper(e), '"'))
    return _t(spark, d, "events").select(
        "event_id", text.blank_to_null(spaced).alias("kept"), text.with_fallback(spaced, "none").alias("filled"), text.has_cjk(F.when(k % 3 == 1, put(e, "提醒")).otherwise(put(e, "é あ"))).alias("cjk"),
        text.without_fences(fenced).alias("bare"), text.base_url(url).alias("url"), text.first_set(F.lit(None).cast("string"), spaced, F.lit(" b ")).alias("first"), text.called_name(broken).alias("called"),
    )


@query("SELECT CASE WHEN event_id % 3 = 0 THEN '' ELSE event_type END AS text, count(*) AS n, min(event_id) AS first FROM events GROUP BY 1 HAVING count(*) > 1")
def blank_duplicates(spark, d):
    """Groups of equal texts, blank ones included."""
    said = F.when(F.col("event_id") % 3 == 0, "  ").otherwise(F.concat(F.lit(" "), F.upper("event_type")))
    return profile.duplicate_groups(_t(spark, d, "events"), text.squeezed(said), "event_id", blank=True)


@query(
    """SELECT event_id, CASE event_id % 6 WHEN 0 THEN '好的，已经为您设置提醒：' || event_type || '。' WHEN 1 THEN '好的，我来帮您处理。还缺少这些信息：task。' WHEN 2 THEN '我找到了多个匹配的提醒，您想操作哪一个？' WHEN 3 THEN '我没有找到匹配的提醒，您要不要换个条件试试？' WHEN 4 THEN '好的，已完成。' ELSE '抱歉，刚才处理时出了点问题，我们再试一次。' END AS said FROM events"""
)
def default_answers(spark, d):
    """Fixed replies by tool and status."""
    k = F.col("event_id") % 6
    tool = F.when(k == 0, "create_reminder").when(k == 4, "other").otherwise("delete_reminder")
    status = planning.cyclic_pick(["success", "missing_fields", "ambiguous", "not_found", "success", "odd"], k)
    return _t(spark, d, "events").select("event_id", cases.default_answer(tool, status, F.col("event_type"), F.lit("task")).alias("said"))


@query(
    "SELECT event_id, round(greatest(0.75, least(1.05, 0.75 + (1.05 - 0.75) * (('0x' || left(md5('7:' || event_id), 7))::BIGINT / 268435456.0::DOUBLE))), 9) AS temperature FROM events"
)
def temperatures(spark, d):
    """Sampling temperatures between bounds, drawn by key."""
    return _t(spark, d, "events").select("event_id", F.round(render.temperature(F.col("event_id")), 9).alias("temperature"))


@query(
    "SELECT conv_id, max(turn) FILTER (role = 'user') AS turn, arg_max(text, turn) FILTER (role = 'user') AS said, count(*) FILTER (role = 'user') AS n FROM conversations GROUP BY conv_id"
)
def last_by_role(spark, d):
    """The last message of one role in each conversation, without ordering a conversation."""
    return profile.last_of_role(_t(spark, d, "conversations"), "conv_id", "turn", "role", "user", "text")


@query(
    "WITH n AS (SELECT count(*) AS n FROM documents), r AS (SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) - 1 AS place FROM documents) SELECT asked, doc_id, coalesce(contains(text, 'the'), false) AS has_a, coalesce(contains(text, '@'), false) AS has_b FROM (SELECT unnest([0, 17, 1000000000, -5]) AS asked) JOIN n ON true JOIN r ON place = greatest(0, least(asked, n - 1))"
)
def picked_rows(spark, d):
    """Single rows by their place, held within the table, with the marks that they contain."""
    docs = _t(spark, d, "documents").select("doc_id", "text")
    return planning.rows_at(docs, "doc_id", [0, 17, 1_000_000_000, -5]).select("asked", "doc_id", *[F.coalesce(F.contains("text", F.lit(m)), F.lit(False)).alias(n) for n, m in (("has_a", "the"), ("has_b", "@"))])
