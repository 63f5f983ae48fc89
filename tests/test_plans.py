"""Plan regression tests: the scale properties the design relies on."""

from __future__ import annotations

import datetime as dt
import json
import re

import pytest

from tests.conftest import UTC, reading
from wattlake.operators import metadata as M
from wattlake.operators import views as V
from wattlake.operators.normalize import normalize_responses
from wattlake.operators.upsert import upsert_readings
from wattlake.schema import METADATA_SOURCE
from wattlake.sources.lake import read_readings


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def lake_readings(spark, make_readings, tmp_path):
    base = dt.datetime(2025, 1, 1, tzinfo=UTC)
    rows = [reading(m, base + dt.timedelta(hours=h), float(h % 5)) for m in ("a", "b") for h in range(72)]
    root = str(tmp_path / "lake")
    upsert_readings(spark, make_readings(rows), root)
    return read_readings(spark, root)


def test_daily_over_lake_one_shuffle_pushed_filters_narrow_read(lake_readings):
    plan = _plan(V.daily_consumption(V.clean(V.stage(lake_readings))))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "partial_sum" in plan  # map-side aggregate before the shuffle
    assert "GreaterThanOrEqual(consumption_value,0.0)" in plan
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert sorted(c.split(":")[0] for c in read.split(",")) == ["consumption_value", "metering_point_id"]


def test_hourly_profile_reads_only_needed_columns(lake_readings):
    plan = _plan(V.hourly_profile(V.clean(V.stage(lake_readings))))
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "quality" not in read and "ingestion" not in read and "unit" not in read


def test_flags_use_one_window_for_lag_and_lead(lake_readings):
    plan = _plan(V.daily_quality_flags(V.daily_consumption(V.clean(V.stage(lake_readings)))))
    assert len(re.findall(r"\bWindow \[", plan)) == 1
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2


def test_enriched_join_is_left_to_measured_sizes(spark, lake_readings):
    """Building the view starts no job; once it runs, the small metadata side is broadcast from its measured size."""
    meta = M.build_metadata(M.normalize_listing(spark.createDataFrame([("a", {"name": "A"}, 0)], METADATA_SOURCE)))
    tracker = spark.sparkContext.statusTracker()
    daily = V.daily_consumption(V.clean(V.stage(lake_readings)))
    before = len(tracker.getJobIdsForGroup(None))
    joined = V.meter_metadata_enriched(daily, meta)
    assert len(tracker.getJobIdsForGroup(None)) == before
    joined.collect()
    plan = _plan(joined)
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan


def test_normaliser_adds_no_shuffle(spark):
    doc = {"result": [{"success": True, "MyEnergyData_MarketDocument": {"TimeSeries": []}}]}
    docs = spark.createDataFrame([(json.dumps(doc),)], "value string")
    readings, _ = normalize_responses(docs)
    assert "Exchange" not in _plan(readings)
