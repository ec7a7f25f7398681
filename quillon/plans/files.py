"""Queries that write the file shapes in use and read them back, with their SQL.

Each run writes below its own folder in the shared folder of the session.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quillon.functions.text import strip
from quillon.operators import cases, profile
from quillon.plans.queries import _t, query
from quillon.scratch import shared_folder
from quillon.sources import buckets, files

_EVENT = "event_id long, event_type string, value double"


def _folder(spark) -> str:
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


def _events(spark, d):
    return _t(spark, d, "events").select("event_id", "event_type", "value")


def _write_lines(lines, folder: str) -> str:
    """One line a row, in the order of the column ``o``."""
    lines.orderBy("o").select("value").write.text(f"{folder}/lines")
    return f"{folder}/lines"


def _mixed_lines(spark, d):
    """An object, a blank line, a broken line or an array, by event."""
    k = F.col("event_id")
    good = F.to_json(F.struct("event_id", "event_type", "value"))
    value = F.when(k % 4 == 0, good).when(k % 4 == 1, "  ").when(k % 4 == 2, '{"event_id": 1').otherwise("[1]")
    return _t(spark, d, "events").select(k.alias("o"), value.alias("value"))


@query("SELECT event_id, event_type, value FROM events")
def jsonl_round_trip(spark, d):
    path = _folder(spark)
    files.write_jsonl(_events(spark, d), path, order="event_id")
    return files.jsonl(spark, path, _EVENT)


@query("SELECT count(*) AS rows FROM events")
def line_count(spark, d):
    path = _folder(spark)
    files.write_jsonl(_events(spark, d), path)
    return files.row_count(spark, path).agg(F.sum("rows").alias("rows"))


@query("SELECT event_type, count(*) AS n FROM events WHERE event_id % 4 = 0 GROUP BY 1")
def skip_malformed(spark, d):
    path = _write_lines(_mixed_lines(spark, d), _folder(spark))
    return files.jsonl(spark, path, _EVENT, "DROPMALFORMED").where("event_id is not null and event_type is not null").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "SELECT (event_id + 1)::INT AS line, CASE WHEN event_id % 4 = 2 THEN 'malformed JSON' WHEN event_id % 4 = 3 THEN 'expected JSON object' END AS error FROM events WHERE event_id % 4 <> 1"
)
def quarantine_scan(spark, d):
    """Every line of one file with its number, and why it is rejected."""
    folder = _folder(spark)
    _mixed_lines(spark, d).coalesce(1).sortWithinPartitions("o").select("value").write.text(folder)
    good, bad = files.quarantined(files.numbered_lines(spark, folder))
    return good.select("line", F.lit(None).cast("string").alias("error")).unionByName(bad.select("line", "error"))


@query("SELECT (event_id // 2 + 1)::INT AS line, event_id FROM events WHERE event_id % 2 = 0")
def strict_scan(spark, d):
    """Numbered objects of one file; any other line would raise with its place."""
    folder = _folder(spark)
    rows = _events(spark, d).where("event_id % 2 = 0").coalesce(1).sortWithinPartitions("event_id")
    rows.select(F.to_json(F.struct("*")).alias("value")).write.text(folder)
    return files.strict_objects(files.numbered_lines(spark, folder)).select("line", F.get_json_object("raw", "$.event_id").cast("long").alias("event_id"))


@query("SELECT event_id, event_type FROM events WHERE (event_id % 97) % 3 = 0")
def json_array_scan(spark, d):
    """Arrays, one a file; broken and blank files give no rows."""
    folder = _folder(spark)
    part = F.col("event_id") % 97
    arrays = _events(spark, d).groupBy(part.alias("part")).agg(F.array_join(F.collect_list(F.to_json(F.struct("event_id", "event_type"))), ", ").alias("body"))
    kind = F.col("part") % 3
    text = F.when(kind == 0, F.concat(F.lit("["), F.col("body"), F.lit("]"))).when(kind == 1, F.concat(F.lit("["), F.col("body"), F.lit(", {"))).otherwise(" ")
    arrays.select(text.alias("value"), "part").repartition(16, "part").write.partitionBy("part").text(folder)
    return files.json_array(spark, f"{folder}/*", "event_id long, event_type string").select("event_id", "event_type")


@query("SELECT 'create' AS tool, lower(n_name) AS utterance, CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE n_nationkey::INT END AS number FROM nation WHERE n_nationkey % 7 <> 0")
def seed_table(spark, d):
    """A Markdown table with a byte-order mark, header, rule, short rows and counts that are no numbers."""
    folder, k = _folder(spark), F.col("n_nationkey")
    number = F.when(k % 5 == 0, "many").otherwise(k.cast("string"))
    row = F.concat(F.lit("| create | plain | "), F.lower("n_name"), F.lit(" | "), number, F.lit(" | success | x |"))
    rows = _t(spark, d, "nation").select((k + 2).alias("o"), F.when(k % 7 == 0, "| too | short |").otherwise(row).alias("value"))
    head = spark.createDataFrame([(0, "﻿| tool | scenario | utterance | number | expected | notes |"), (1, "|---|---|---|---|---|---|")], "o long, value string")
    head.unionByName(rows).coalesce(1).sortWithinPartitions("o").select("value").write.text(folder)
    return files.seed_table(spark, folder).select("tool", "utterance", "number")


@query("SELECT n_nationkey::VARCHAR AS case_id, n_name AS task, CASE WHEN n_nationkey % 3 = 0 THEN 'missing initialized reminders' END AS failure FROM nation")
def case_folders(spark, d):
    """One folder a case, some without stored state: those fail with a reason."""
    folder = _folder(spark)
    rows = _t(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("case_id"), F.col("n_name").alias("task"))
    for name, part in (("input", rows), ("state", rows.where("cast(case_id as int) % 3 <> 0"))):
        files.write_cases(part.withColumn("at", F.col("case_id")).select("at", "task", F.concat(F.lit("case-"), "case_id").alias("case_id")), f"{folder}/{name}")
    read = lambda name: files.case_files(spark, f"{folder}/{name}", "*.json", "at string, task string").withColumn("case_id", F.regexp_extract("case_id", r"case-(\d+)$", 1))
    return cases.with_state(read("input"), read("state")).select("case_id", "task", "failure")


@query("SELECT count(*) AS total, count(*) FILTER (event_id % 4 = 0) AS kept, count(*) FILTER (event_id % 4 > 1) AS rejected, (SELECT count(DISTINCT event_type) FROM events WHERE event_id % 4 = 0) AS kinds FROM events WHERE event_id % 4 <> 1")
def three_way_sink(spark, d):
    """Kept rows, rejects and a report, written from one plan and read back."""
    folder = _folder(spark)
    rows = _mixed_lines(spark, d).where(strip(F.col("value")) != "").select("value", F.when(~F.startswith("value", F.lit("{")) | ~F.endswith("value", F.lit("}")), "bad").alias("error"))
    files.write_three(rows, "error", f"{folder}/good", f"{folder}/bad", f"{folder}/report")
    report = files.jsonl(spark, f"{folder}/report", "total long, kept long, rejected long")
    kinds = files.jsonl(spark, f"{folder}/good", "value string").agg(F.countDistinct(F.get_json_object("value", "$.event_type")).alias("kinds"))
    return report.join(F.broadcast(kinds))  # one row each


@query("SELECT DISTINCT event_type AS said FROM events UNION SELECT DISTINCT event_type || ' again' FROM events")
def appended_utterances(spark, d):
    """Three runs that append only what no earlier run wrote."""
    path = _folder(spark)
    said = _t(spark, d, "events").select(F.col("event_type").alias("said")).distinct()
    again = said.select(F.concat("said", F.lit("  again")).alias("said"))
    for batch in (said, said.unionByName(again), again):
        files.append_new(batch, path, "said")
    return files.jsonl(spark, path, "said string").select(F.regexp_replace("said", " +", " ").alias("said"))


@query("SELECT n_nationkey, n_name, CASE WHEN n_nationkey % 3 = 0 THEN 'active' ELSE 'done' END AS status FROM nation")
def keyed_table(spark, d):
    """A relational table with defaults and a checked key, then a second version of a snapshot."""
    folder = _folder(spark)
    rows = _t(spark, d, "nation").select("n_nationkey", "n_name", F.when(F.col("n_nationkey") % 3 != 0, "done").alias("status"))
    files.write_keyed(rows, f"{folder}/table", "n_nationkey", {"status": "active"})
    files.write_snapshot(spark.read.parquet(f"{folder}/table").limit(1), folder, 1)
    files.write_snapshot(spark.read.parquet(f"{folder}/table"), folder, 2)
    return files.read_snapshot(spark, folder, 2)


@query(
    """SELECT p_partkey, CASE WHEN p_partkey % 97 = 0 THEN 'renamed' ELSE p_name END AS p_name, p_size FROM part WHERE p_partkey % 101 <> 0
UNION ALL SELECT 10000000 + s_suppkey, s_name, 0 FROM supplier"""
)
def keyed_upsert(spark, d):
    """A keyed table in hash buckets after changes, new rows and deletes, which rewrite the buckets that they touch."""
    path = f"{_folder(spark)}/table"
    parts = _t(spark, d, "part").select("p_partkey", "p_name", "p_size")
    buckets.write_buckets(parts, path, "p_partkey", 16)
    k = F.col("p_partkey")
    changed = parts.where((k % 97 == 0) | (k % 101 == 0)).withColumn("p_name", F.lit("renamed")).withColumn("gone", k % 101 == 0)
    new = _t(spark, d, "supplier").select((10000000 + F.col("s_suppkey")).alias("p_partkey"), F.col("s_name").alias("p_name"), F.lit(0).alias("p_size"), F.lit(False).alias("gone"))
    buckets.upsert(changed.unionByName(new), path, "p_partkey", 16, gone="gone")
    return buckets.read_buckets(spark, path)


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def raw_and_stats(spark, d):
    """Samples, their raw texts and counts by kind, written beside each other."""
    folder = _folder(spark)
    rows = _events(spark, d).withColumn("raw", F.to_json(F.struct("event_id", "value")))
    observed = files.write_with_raw(rows, f"{folder}/samples", "raw", f"{folder}/stats", "event_type")
    if files.row_count(spark, f"{folder}/samples.raw").agg(F.sum("rows")).first()[0] != observed:
        raise ValueError("the raw texts are not whole")
    return files.jsonl(spark, f"{folder}/stats", "event_type string, n long")


@query("SELECT unnest(['key    n', 'hello  ' || (SELECT count(*) FROM nation), 'x      ' || (SELECT count(*) FROM region)]) AS line")
def report_lines(spark, d):
    """A small report as padded text."""
    counts = [_t(spark, d, n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("key"), "n") for n, k in (("nation", "hello"), ("region", "x"))]
    return profile.table_text(counts[0].unionByName(counts[1]), ["key", "n"])
