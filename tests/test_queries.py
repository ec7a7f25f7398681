"""Every registered query of the base library against its SQL on the smallest tables."""

import datetime
import decimal
import math
import os
from pathlib import Path

import duckdb
import pytest

from quillon.plans.all import ORACLE_SQL, QUERIES

TABLES = os.environ.get("QUILLON_TABLES", "/root/testdata/sf0.001")


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    return v.isoformat() if isinstance(v, datetime.datetime) else v


def in_order(rows):
    return sorted((tuple(map(plain, r)) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(TABLES).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, TABLES)
    columns = sorted(got.columns)
    asked = duck.execute(ORACLE_SQL[name])
    names = [x[0] for x in asked.description]
    assert sorted(names) == columns
    assert in_order([[r[c] for c in columns] for r in got.collect()]) == in_order([[r[names.index(c)] for c in columns] for r in asked.fetchall()])


def test_stream_fires_once_for_each_event(spark):
    out = QUERIES["due_stream"](spark, TABLES)
    n = spark.read.parquet(f"{TABLES}/events.parquet").count()
    assert out.count() == out.select("reminder_id").distinct().count() == n


def test_messages_are_read_once(spark):
    """The status of a message is not read anew for every call that gets it."""
    plan = QUERIES["run_calls"](spark, TABLES)._jdf.queryExecution().optimizedPlan().toString()
    assert "get_json_object" not in plan


def test_snapshot_answers_once(spark):
    """What requests did is written once, not answered again for updates and for deletes."""
    plan = QUERIES["mutated_snapshot"](spark, TABLES)._jdf.queryExecution().optimizedPlan().toString()
    assert "everything" not in plan
