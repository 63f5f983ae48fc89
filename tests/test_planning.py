"""Load windows, chunks and ingestion state (cases of the source system's tests)."""

from __future__ import annotations

import datetime as dt

import pytest

from wattlake.operators.planning import chunk_windows, load_plan, load_windows
from wattlake.operators.state import (
    advance_state,
    chunk_outcomes,
    init_state,
    lookup_state,
    read_state,
    write_state,
)
from wattlake.schema import STATE

D = dt.date
TODAY = D(2025, 11, 27)


def _meters(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "metering_point_id string")


def _state(spark, rows):
    return spark.createDataFrame(rows, STATE)


def _chunks(spark, start, end, days):
    w = spark.createDataFrame([("m", start, end)], "metering_point_id string, date_from date, date_to date")
    return [(r.chunk_from, r.chunk_to) for r in chunk_windows(w, days).orderBy("chunk_from").collect()]


def test_window_without_state_backfills(spark):
    w = load_windows(_meters(spark, "m"), None, TODAY).first()
    assert (w.date_from, w.date_to) == (TODAY - dt.timedelta(days=1095), TODAY)
    w = load_windows(_meters(spark, "m"), _state(spark, []), TODAY, backfill_days=90).first()
    assert w.date_from == TODAY - dt.timedelta(days=90)


def test_window_with_state_overlaps_seven_days(spark):
    st = _state(spark, [("m", D(2025, 11, 20)), ("n", None)])
    got = {r.metering_point_id: r.date_from for r in load_windows(_meters(spark, "m", "n"), st, TODAY).collect()}
    assert got == {"m": D(2025, 11, 13), "n": TODAY - dt.timedelta(days=1095)}


def test_chunks_one_month(spark):
    assert _chunks(spark, D(2025, 11, 1), D(2025, 11, 30), 90) == [(D(2025, 11, 1), D(2025, 11, 30))]


def test_chunks_year_by_95_days(spark):
    chunks = _chunks(spark, D(2025, 1, 1), D(2025, 12, 31), 95)
    assert len(chunks) == 4
    assert chunks[0][0] == D(2025, 1, 1) and chunks[-1][1] == D(2025, 12, 31)
    for (a, b), (c, _) in zip(chunks, chunks[1:]):
        assert c == b + dt.timedelta(days=1) and (b - a).days == 94


def test_chunks_exact_and_one_over(spark):
    assert _chunks(spark, D(2025, 1, 1), D(2025, 3, 31), 90) == [(D(2025, 1, 1), D(2025, 3, 31))]
    assert _chunks(spark, D(2025, 1, 1), D(2025, 4, 1), 90) == [
        (D(2025, 1, 1), D(2025, 3, 31)),
        (D(2025, 4, 1), D(2025, 4, 1)),
    ]


def test_inverted_window_gives_no_chunk(spark):
    assert _chunks(spark, D(2025, 2, 1), D(2025, 1, 1), 90) == []
    assert _chunks(spark, D(2025, 1, 1), D(2025, 1, 1), 90) == [(D(2025, 1, 1), D(2025, 1, 1))]


def test_chunk_days_must_be_positive(spark):
    w = spark.createDataFrame([("m", D(2025, 1, 1), D(2025, 1, 2))], "metering_point_id string, date_from date, date_to date")
    with pytest.raises(ValueError):
        chunk_windows(w, 0)


def _landed(spark, rows):
    return spark.createDataFrame(
        rows, "metering_point_id string, chunk_from date, chunk_to date, parsed boolean"
    )


def test_state_unchanged_when_all_chunks_fail(spark):
    st = _state(spark, [("m", D(2024, 1, 1))])
    plan = load_plan(_meters(spark, "m"), st, TODAY, chunk_days=30)
    new = advance_state(st, chunk_outcomes(plan, _landed(spark, [])))
    assert [(r.metering_point_id, r.last_ingestion_date) for r in new.collect()] == [("m", D(2024, 1, 1))]


def test_one_update_when_chunks_succeed(spark):
    plan = load_plan(_meters(spark, "m"), None, D(2025, 3, 31), backfill_days=89, chunk_days=30)
    chunks = plan.collect()
    assert len(chunks) == 3
    landed = _landed(spark, [("m", c.chunk_from, c.chunk_to, True) for c in chunks])
    new = advance_state(None, chunk_outcomes(plan, landed)).collect()
    assert [(r.metering_point_id, r.last_ingestion_date) for r in new] == [("m", D(2025, 3, 31))]


def test_any_chunk_advances_unless_strict(spark):
    plan = load_plan(_meters(spark, "m"), None, D(2025, 3, 31), backfill_days=89, chunk_days=30)
    c = plan.orderBy("chunk_from").collect()
    landed = _landed(spark, [("m", c[0].chunk_from, c[0].chunk_to, False), ("m", c[2].chunk_from, c[2].chunk_to, True)])
    outcomes = chunk_outcomes(plan, landed)
    assert sorted(r.outcome for r in outcomes.collect()) == ["missing", "ok", "unparsable"]
    assert advance_state(None, outcomes).count() == 1
    assert advance_state(None, outcomes, strict=True).count() == 0


def test_two_meters_two_updates_and_others_kept(spark):
    st = _state(spark, [("m", D(2025, 11, 1)), ("x", D(2020, 1, 1))])
    plan = load_plan(_meters(spark, "m", "n"), st, TODAY)
    landed = _landed(spark, [(r.metering_point_id, r.chunk_from, r.chunk_to, True) for r in plan.collect()])
    new = {r.metering_point_id: r.last_ingestion_date for r in advance_state(st, chunk_outcomes(plan, landed)).collect()}
    assert new == {"m": TODAY, "n": TODAY, "x": D(2020, 1, 1)}


def test_state_versions_round_trip(spark, tmp_path):
    root = str(tmp_path / "state")
    assert read_state(spark, root) is None
    init_state(spark, root)
    assert read_state(spark, root).count() == 0
    v = write_state(spark, _state(spark, [("m", D(2025, 1, 1))]), root)
    assert v == 1
    st = read_state(spark, root)
    assert lookup_state(st, "m").first().last_ingestion_date == D(2025, 1, 1)
    assert lookup_state(st, "zz").count() == 0


def test_write_plan_round_trip(spark, tmp_path):
    from wattlake.plans.ingest import write_plan

    plan = load_plan(_meters(spark, "m"), None, D(2025, 3, 31), backfill_days=89, chunk_days=30)
    write_plan(plan, str(tmp_path / "plan"))
    back = spark.read.parquet(str(tmp_path / "plan"))
    assert sorted(back.collect()) == sorted(plan.collect())
