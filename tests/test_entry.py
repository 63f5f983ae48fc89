"""Driver contract: entry(), and every registered query against its oracle SQL."""

from __future__ import annotations

import importlib.util
import os
import sys

import duckdb
import pytest

import __spark_entry__ as E
from wattlake.plans import registry

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check_oracle import TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[0] == "metering_point_id"
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(registry.queries()) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("gone", ["corpus_pipeline", "wattlake.llm"])
def test_entry_without_the_training_data_queries(monkeypatch, gone):
    monkeypatch.setitem(sys.modules, gone, None)
    if gone == "wattlake.llm":
        monkeypatch.delitem(sys.modules, "corpus_pipeline", raising=False)
    spec = importlib.util.spec_from_file_location("entry_alone", E.__file__)
    alone = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(alone)
    assert set(alone.queries()) == set(registry.queries())
    assert set(alone.oracle_sql()) == set(registry.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows_of(df.columns, rows) == rows_of(cols, res.fetchall())


@pytest.mark.parametrize("name", ["upsert_readings", "normalize_responses", "meter_data_stage", "load_plan"])
def test_queries_ignore_session_time_zone(spark, duck, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = E.queries()[name](spark, SF)
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    res = duck.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert rows_of(df.columns, rows) == rows_of(cols, res.fetchall())
