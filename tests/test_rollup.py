"""Day-level rollup: views served from it equal the views over readings."""

from __future__ import annotations

import datetime as dt
import math

import pytest

from tests.conftest import UTC, reading
from wattlake.operators import rollup as R
from wattlake.operators import views as V
from wattlake.operators.upsert import upsert_readings, upsert_readings_days


def _rows(df, places=9):
    out = []
    for r in df.collect():
        out.append(tuple(round(v, places) if isinstance(v, float) and not math.isnan(v) else v for v in r))
    return sorted(out, key=repr)


def _fixture(make_readings):
    rows = []
    for day, values in [
        (dt.date(2025, 1, 30), [1.0, 2.0, None]),
        (dt.date(2025, 1, 31), [0.0, -1.0]),
        (dt.date(2025, 2, 1), [4.0]),
        (dt.date(2025, 4, 2), [None]),
        (dt.date(2025, 4, 3), [3.0, 5.0, 7.0]),
    ]:
        for i, v in enumerate(values):
            ts = dt.datetime.combine(day, dt.time(i), tzinfo=UTC)
            rows.append(reading("m", ts, v))
            rows.append(reading("n", ts, None if v is None else v * 2))
    return make_readings(rows)


def test_views_from_rollup_equal_views_from_readings(spark, make_readings, tmp_path):
    lake, roll = str(tmp_path / "lake"), str(tmp_path / "rollup")
    readings = _fixture(make_readings)
    upsert_readings(spark, readings, lake)
    R.refresh_rollup(spark, lake, roll)
    rollup = R.read_rollup(spark, roll)
    staged = V.stage(readings)
    cleaned = V.clean(staged)
    daily = V.daily_consumption(cleaned)
    assert _rows(R.daily_from_rollup(rollup)) == _rows(daily)
    assert _rows(R.variability_from_rollup(rollup)) == _rows(V.load_variability(cleaned))
    assert _rows(R.missing_from_rollup(rollup)) == _rows(V.missing_data_summary(staged))
    assert _rows(R.monthly_from_rollup(rollup)) == _rows(V.monthly_consumption(cleaned))
    assert _rows(V.daily_quality_flags(R.daily_from_rollup(rollup))) == _rows(V.daily_quality_flags(daily))


def test_refresh_only_touched_days(spark, make_readings, tmp_path):
    lake, roll = str(tmp_path / "lake"), str(tmp_path / "rollup")
    upsert_readings(spark, _fixture(make_readings), lake)
    R.refresh_rollup(spark, lake, roll)
    correction = make_readings([reading("m", dt.datetime(2025, 4, 3, 0, tzinfo=UTC), 30.0)])
    n, days = upsert_readings_days(spark, correction, lake)
    assert (n, days) == (1, [dt.date(2025, 4, 3)])
    R.refresh_rollup(spark, lake, roll, days)
    got = {
        (r.metering_point_id, r.reading_date): r.total_kwh
        for r in R.daily_from_rollup(R.read_rollup(spark, roll)).collect()
    }
    assert got[("m", dt.date(2025, 4, 3))] == 42.0
    assert got[("m", dt.date(2025, 1, 30))] == 3.0
    R.refresh_rollup(spark, lake, roll, [])  # nothing touched, nothing written
    assert R.read_rollup(spark, roll).count() == 10


def test_hourly_profile_adds_up_over_days_and_follows_a_reload(spark, make_readings, tmp_path):
    lake, roll = str(tmp_path / "lake"), str(tmp_path / "rollup")
    upsert_readings(spark, _fixture(make_readings), lake)
    R.refresh_rollup(spark, lake, roll)
    week = [dt.datetime(2025, 1, 30, 1, tzinfo=UTC) + dt.timedelta(days=7 * n) for n in range(3)]  # a Thursday's hour
    _, days = upsert_readings_days(spark, make_readings([reading("m", t, 10.0 * n) for n, t in enumerate(week)]), lake)
    R.refresh_rollup(spark, lake, roll, days)
    profile = R.hourly_from_rollup(R.read_rollup(spark, roll))
    wanted = V.hourly_profile(V.clean(V.stage(R.read_readings(spark, lake))))
    assert profile.dtypes == wanted.dtypes and _rows(profile) == _rows(wanted)
    assert [r.avg_kwh for r in profile.where("metering_point_id = 'm' AND reading_hour = 1 AND reading_weekday = 4").collect()] == [(0 + 10 + 20 + 5) / 4]


def test_a_rollup_without_hours_is_not_taken_for_an_empty_one(spark, make_readings, tmp_path):
    lake, roll = str(tmp_path / "lake"), str(tmp_path / "rollup")
    upsert_readings(spark, _fixture(make_readings), lake)
    R.refresh_rollup(spark, lake, f"{roll}-new")
    R.read_rollup(spark, f"{roll}-new").drop("hour_kwh", "hour_counts").write.partitionBy("reading_date").parquet(roll)
    assert R.daily_from_rollup(R.read_rollup(spark, roll)).count() > 0
    with pytest.raises(Exception, match="refresh_rollup"):
        R.hourly_from_rollup(R.read_rollup(spark, roll)).collect()
