"""Readers and writers of the file shapes in use."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillon.functions.jsonx import strict_kind
from quillon.functions.text import squeezed, strip
from quillon.scratch import Scratch


def jsonl(spark: SparkSession, path: str, schema: StructType | str, mode: str = "FAILFAST") -> DataFrame:
    """JSON lines with a fixed schema; blank lines are skipped, malformed ones fail (or are dropped with DROPMALFORMED)."""
    return spark.read.schema(schema).option("mode", mode).json(path)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``path``, ``line`` (from 1) and ``raw`` of every non-blank line.

    Files are read split by split: the lines of each split are counted, and a
    line's number is the sum of the splits before it plus its place in its own.
    """
    place = F.monotonically_increasing_id()  # goes up by one from line to line of a split
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), place.alias("id"), "value")
    counts = lines.groupBy("path", "start").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = counts.select(F.col("path").alias("of"), F.col("start").alias("at"), "first", before.alias("base"))
    placed = lines.where(strip(F.col("value")) != "").join(bases, (F.col("path") == F.col("of")) & (F.col("start") == F.col("at")))
    return placed.select("path", (F.col("base") + F.col("id") - F.col("first") + 1).cast("int").alias("line"), F.col("value").alias("raw"))


def row_count(spark: SparkSession, path: str) -> DataFrame:
    """``path`` and ``rows``: the non-blank lines of every file."""
    lines = spark.read.text(path).where(strip(F.col("value")) != "")
    return lines.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("rows"))


def quarantined(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines that are JSON objects, and the others with an ``error``."""
    judged = lines.withColumn("kind", strict_kind(F.col("raw")))
    error = F.when(F.col("kind") == "invalid", "malformed JSON").otherwise("expected JSON object")
    return judged.where("kind = 'object'").drop("kind"), judged.where("kind <> 'object'").select("path", "line", error.alias("error"), "raw")


def strict_objects(lines: DataFrame) -> DataFrame:
    """The lines, all of which must be JSON objects; the first other one raises with its place."""
    where = F.concat("path", F.lit(":"), F.col("line").cast("string"), F.lit(": expected JSON object"))
    checked = F.when(strict_kind(F.col("raw")) == "object", F.col("raw")).otherwise(F.raise_error(where).cast("string"))
    return lines.select("path", "line", checked.alias("raw"))


def json_array(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Rows of JSON-array files; files that are blank, corrupt or hold no array give none."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    good = whole.where(strict_kind(F.col("value")) == "array")
    element = schema.simpleString() if isinstance(schema, StructType) else f"struct<{', '.join(':'.join(f.split()) for f in schema.split(', '))}>"
    return good.select("path", F.explode(F.from_json("value", f"array<{element}>")).alias("r")).select("path", "r.*")


def seed_table(spark: SparkSession, path: str) -> DataFrame:
    """``tool``, ``scenario``, ``utterance``, ``number``, ``expected_outcome`` and ``notes`` of a Markdown pipe table.

    A byte-order mark, the header, the rule and rows of under six cells are left out.
    """
    line = F.trim(F.regexp_replace("value", "﻿", ""))
    cells = F.transform(F.split(F.regexp_replace(line, r"^\||\|$", ""), r"\|"), lambda c: F.trim(c))
    rows = spark.read.text(path).where(F.startswith(line, F.lit("|"))).select(cells.alias("c")).where(F.size("c") >= 6)
    rows = rows.where(~F.col("c")[0].isin("tool") & ~F.startswith(F.col("c")[0], F.lit("--")))
    names = ["tool", "scenario", "utterance", "number", "expected_outcome", "notes"]
    return rows.select(*[F.col("c")[i].alias(n) for i, n in enumerate(names)]).withColumn("number", F.expr("try_cast(number as int)"))


def case_files(spark: SparkSession, root: str, name: str, schema: StructType | str) -> DataFrame:
    """One row a case folder: ``case_id``, from the folder's name, and the file's object."""
    rows = spark.read.schema(schema).option("multiLine", True).json(f"{root}/*/{name}")
    return rows.select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("case_id"), "*")


def write_jsonl(df: DataFrame, path: str, append: bool = False, order: str | None = None) -> None:
    """JSON lines, in order if asked."""
    (df.orderBy(order) if order else df).write.mode("append" if append else "overwrite").json(path)


def write_cases(df: DataFrame, path: str) -> None:
    """One folder a case."""
    df.write.mode("overwrite").partitionBy("case_id").json(path)


def write_three(df: DataFrame, error: str, good: str, rejects: str, report: str) -> dict[str, int]:
    """Kept rows, rejected rows and one row of counts, which are also returned.

    The rows are computed once, into a table in the shared folder; the counts are
    observed as they pass, and the two outputs read that table.
    """
    counts = Observation()
    scratch = Scratch(df.sparkSession)
    kept = F.col(error).isNull()
    held = scratch.save(df.observe(counts, F.count(F.lit(1)).alias("total"), F.count_if(kept).alias("kept"), F.count(error).alias("rejected")))
    held.where(kept).drop(error).write.mode("overwrite").json(good)
    held.where(~kept).write.mode("overwrite").json(rejects)
    told = counts.get
    df.sparkSession.createDataFrame([told], "total long, kept long, rejected long").write.mode("overwrite").json(report)
    scratch.remove()
    return told


def write_snapshot(df: DataFrame, root: str, version: int) -> str:
    """Write a table as a new version below ``root`` and return its path; an earlier version is never overwritten."""
    path = f"{root.rstrip('/')}/v{version:06d}"
    df.write.mode("errorifexists").parquet(path)
    return path


def read_snapshot(spark: SparkSession, root: str, version: int) -> DataFrame:
    """A version that ``write_snapshot`` wrote."""
    return spark.read.parquet(f"{root.rstrip('/')}/v{version:06d}")


def write_keyed(df: DataFrame, path: str, key: str, defaults: dict[str, str]) -> None:
    """A relational table: null columns get their defaults; a null or repeated key fails the write."""
    rows = df.select(*[F.coalesce(F.col(c), F.lit(defaults[c])).alias(c) if c in defaults else F.col(c) for c in df.columns])
    bad = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col(key).isNull() | (F.col("n") > 1)).limit(1).collect()
    if bad:
        raise ValueError(f"{key} {bad[0][key]!r} is null or repeated")
    rows.write.mode("overwrite").parquet(path)


def write_with_raw(df: DataFrame, path: str, raw: str, stats: str, by: str) -> int:
    """Samples without their raw text, the raw texts beside them, and one row of counts for each value of ``by``; returns
    the number of rows, observed as they pass."""
    rows = Observation()
    scratch = Scratch(df.sparkSession)
    held = scratch.save(df.observe(rows, F.count(F.lit(1)).alias("rows")))
    held.drop(raw).write.mode("overwrite").json(path)
    held.select(raw).write.mode("overwrite").json(f"{path}.raw")
    held.groupBy(by).agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").json(stats)
    scratch.remove()
    return rows.get["rows"]


def append_new(df: DataFrame, path: str, key: str) -> None:
    """Append the rows whose ``key`` (white space aside) no earlier run wrote, one of each."""
    spark = df.sparkSession
    once = df.withColumn("_k", squeezed(F.col(key))).dropDuplicates(["_k"])
    try:
        seen = spark.read.schema(df.schema).json(path).select(squeezed(F.col(key)).alias("_k")).distinct()
        once = once.join(seen, "_k", "left_anti")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # the first run has no file yet
            raise
    once.drop("_k").write.mode("append").json(path)


def settings_file(path: str) -> dict[str, str]:
    """``KEY=value`` lines of a small settings file: a byte-order mark, comments, blank lines and quotes are left out."""
    out = {}
    with open(path, encoding="utf-8-sig") as f:
        for line in f:
            name, found, value = line.strip().partition("=")
            if found and not name.startswith("#"):
                out[name.strip().removeprefix("export ").strip()] = value.strip().strip("\"'")
    return out


def yaml_settings(path: str) -> dict[str, object]:
    """The mapping of a YAML file; empty for an empty file."""
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("PyYAML is needed to read YAML settings") from e
    with open(path, encoding="utf-8") as f:
        found = yaml.safe_load(f) or {}
    if not isinstance(found, dict):
        raise ValueError(f"{path} holds no mapping")
    return found


def pick_setting(*values: str | None) -> str | None:
    """The first value that is not blank, stripped."""
    return next((v.strip() for v in values if v is not None and v.strip()), None)


def prompt_text(spark: SparkSession, path: str) -> str:
    """A small text file as one string."""
    return spark.read.text(path, wholetext=True).first()[0]
