"""Lake writes, upserts and reads (the source system's cases and derived ones)."""

from __future__ import annotations

import datetime as dt
import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.conftest import UTC, reading
from wattlake.operators.upsert import dedup_latest, migrate_lake, upsert_readings
from wattlake.schema import READING_COLUMNS
from wattlake.sources.lake import detect_layout, read_lake, read_readings

T0 = dt.datetime(2025, 1, 1, 10, tzinfo=UTC)


def _files(root):
    return sorted(glob.glob(f"{root}/**/*.parquet", recursive=True))


@pytest.fixture
def lake(tmp_path):
    return str(tmp_path / "lake")


def test_empty_batch_writes_nothing(spark, make_readings, lake):
    assert upsert_readings(spark, make_readings([]), lake, layout="meter_day") == 0
    assert not os.path.exists(lake)


def test_meter_day_layout_and_file_schema(spark, make_readings, lake):
    upsert_readings(
        spark,
        make_readings([reading("mp1", T0, 0.5), reading("mp1", T0 + dt.timedelta(hours=1), 0.6)]),
        lake,
        layout="meter_day",
    )
    files = _files(lake)
    assert len(files) == 1
    assert f"{os.sep}metering_point=mp1{os.sep}date=2025-01-01{os.sep}" in files[0]
    assert pq.read_schema(files[0]).names == READING_COLUMNS
    table = pq.read_table(files[0])
    assert table.num_rows == 2
    assert table.column("timestamp").to_pylist() == sorted(table.column("timestamp").to_pylist())
    assert detect_layout(spark, lake) == "meter_day"


@pytest.mark.parametrize("layout", ["meter_day", "day"])
def test_two_days_two_partitions(spark, make_readings, lake, layout):
    rows = [reading("mp1", T0, 0.5), reading("mp1", T0 + dt.timedelta(days=1), 0.6)]
    upsert_readings(spark, make_readings(rows), lake, layout=layout)
    got = {(r.date, r.consumption_value) for r in read_lake(spark, lake).collect()}
    assert got == {(dt.date(2025, 1, 1), 0.5), (dt.date(2025, 1, 2), 0.6)}
    assert len({os.path.dirname(f) for f in _files(lake)}) == 2


def test_two_meters_two_partitions(spark, make_readings, lake):
    upsert_readings(spark, make_readings([reading("a", T0, 1.0), reading("b", T0, 2.0)]), lake, layout="meter_day")
    assert len({os.path.dirname(f) for f in _files(lake)}) == 2


@pytest.mark.parametrize("layout", ["meter_day", "day"])
def test_upsert_replaces_same_timestamp(spark, make_readings, lake, layout):
    upsert_readings(spark, make_readings([reading("mp1", T0, 0.5)]), lake, layout=layout)
    upsert_readings(spark, make_readings([reading("mp1", T0, 0.6)]), lake)
    rows = read_lake(spark, lake).collect()
    assert [(r.metering_point_id, r.consumption_value) for r in rows] == [("mp1", 0.6)]


def test_duplicates_inside_one_batch_are_kept(spark, make_readings, lake):
    upsert_readings(spark, make_readings([reading("mp1", T0, 0.5)]), lake)
    upsert_readings(spark, make_readings([reading("mp1", T0, 0.6), reading("mp1", T0, 0.7)]), lake)
    assert sorted(r.consumption_value for r in read_lake(spark, lake).collect()) == [0.6, 0.7]


def test_day_layout_keeps_other_meters_of_touched_day(spark, make_readings, lake):
    upsert_readings(spark, make_readings([reading("a", T0, 1.0), reading("b", T0, 2.0)]), lake, layout="day")
    upsert_readings(spark, make_readings([reading("a", T0, 5.0), reading("a", T0 + dt.timedelta(hours=1), 6.0)]), lake)
    got = sorted((r.metering_point_id, r.consumption_value) for r in read_lake(spark, lake).collect())
    assert got == [("a", 5.0), ("a", 6.0), ("b", 2.0)]


def test_untouched_partitions_are_not_rewritten(spark, make_readings, lake):
    upsert_readings(
        spark, make_readings([reading("a", T0, 1.0), reading("b", T0, 2.0)]), lake, layout="meter_day"
    )
    before = {f: os.path.getmtime(f) for f in _files(lake) if "metering_point=b" in f}
    upsert_readings(spark, make_readings([reading("a", T0, 3.0)]), lake)
    after = {f: os.path.getmtime(f) for f in _files(lake) if "metering_point=b" in f}
    assert before == after


def test_nan_stored_as_null_and_null_keys_dropped(spark, make_readings, lake):
    rows = [reading("a", T0, float("nan")), reading(None, T0, 1.0), reading("a", None, 1.0)]
    upsert_readings(spark, make_readings(rows), lake)
    got = read_lake(spark, lake).collect()
    assert len(got) == 1 and got[0].consumption_value is None


def test_numeric_looking_ids_stay_strings(spark, make_readings, lake):
    upsert_readings(spark, make_readings([reading("0012", T0, 1.0)]), lake, layout="meter_day")
    df = read_readings(spark, lake)
    assert dict(df.dtypes)["metering_point_id"] == "string"
    assert df.first().metering_point_id == "0012"


def test_missing_root_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_lake(spark, str(tmp_path / "missing-data"))
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        read_lake(spark, str(tmp_path / "empty"))


def test_read_prunes_partitions(spark, make_readings, lake):
    rows = [reading("a", T0 + dt.timedelta(days=d), float(d)) for d in range(5)]
    rows += [reading("b", T0, 9.0)]
    upsert_readings(spark, make_readings(rows), lake, layout="meter_day")
    df = read_readings(spark, lake, date_from="2025-01-02", date_to="2025-01-03").where(
        F.col("metering_point_id") == "a"
    )
    assert sorted(r.consumption_value for r in df.collect()) == [1.0, 2.0]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "metering_point" in plan and "date" in plan


def test_reads_lake_written_by_pandas(spark, tmp_path):
    # Nanosecond, tz-aware timestamps as pandas writes them.
    import pandas as pd

    part = tmp_path / "lake" / "metering_point=m1" / "date=2025-01-01"
    part.mkdir(parents=True)
    pdf = pd.DataFrame(
        {
            "metering_point_id": ["m1"],
            "timestamp": pd.to_datetime(["2025-01-01T00:00:00Z"]),
            "consumption_value": [1.5],
            "quality": ["A"],
            "unit": ["kWh"],
            "ingestion_timestamp": pd.to_datetime(["2025-01-02T00:00:00Z"]),
            "ingestion_date": [dt.date(2025, 1, 2)],
        }
    )
    pdf.to_parquet(part / "consumption_data.parquet", engine="pyarrow", index=False)
    row = read_readings(spark, str(tmp_path / "lake"), nanos=True).first()
    assert row.consumption_value == 1.5 and row.metering_point_id == "m1"
    assert row.timestamp.astimezone(UTC) == dt.datetime(2025, 1, 1, tzinfo=UTC)


def test_dedup_latest(spark, make_readings):
    early = dt.datetime(2025, 1, 2, tzinfo=UTC)
    late = dt.datetime(2025, 1, 3, tzinfo=UTC)
    df = make_readings([reading("a", T0, 1.0, ingested=early), reading("a", T0, 2.0, ingested=late)])
    assert [r.consumption_value for r in dedup_latest(df).collect()] == [2.0]


def test_meter_frame_filter_prunes_dynamically(spark, make_readings, lake):
    rows = [reading(m, T0, 1.0) for m in ("a", "b", "c")]
    upsert_readings(spark, make_readings(rows), lake, layout="meter_day")
    meta = spark.createDataFrame([("a", "x"), ("b", "Home"), ("c", "y")], "metering_point_id string, location string")
    wanted = meta.where(F.col("location") == "Home").select("metering_point_id")
    df = read_readings(spark, lake, meters=wanted)
    assert [r.metering_point_id for r in df.collect()] == ["b"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()


def test_view_date_filter_prunes_partitions(spark, make_readings, lake):
    from wattlake.operators import views as V

    rows = [reading("a", T0 + dt.timedelta(days=d, hours=h), 1.0) for d in range(4) for h in (0, 23)]
    upsert_readings(spark, make_readings(rows), lake)
    daily = V.daily_consumption(V.clean(V.stage(read_readings(spark, lake))))
    one = daily.where(F.col("reading_date") == F.lit("2025-01-02").cast("date"))
    assert [(r.reading_date, r.reading_count) for r in one.collect()] == [(dt.date(2025, 1, 2), 2)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "2025-01-02" in plan
    # Above a LAG/LEAD window the filter must not prune the window's input.
    flags = V.daily_quality_flags(daily).where(F.col("reading_date") == F.lit("2025-01-02").cast("date"))
    assert flags.count() == 1
    optimized = flags._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.index("Filter") < optimized.index("Window")


def test_folders_named_by_another_offset(spark, tmp_path):
    """2031-05-06T23:30Z filed under the next day: reported on its UTC day, refused for upserts, mended by a copy."""
    late = dt.datetime(2031, 5, 6, 23, 30, tzinfo=dt.timezone.utc)
    row = (late, 2.5, "ok", "kWh", late, late.date(), "m9")
    schema = "timestamp timestamp, consumption_value double, quality string, unit string, ingestion_timestamp timestamp, ingestion_date date, metering_point_id string"
    rows = spark.createDataFrame([row], schema)
    root, copy = str(tmp_path / "lake"), str(tmp_path / "copy")
    rows.write.option("compression", "snappy").parquet(f"{root}/metering_point=m9/date=2031-05-07")
    read = read_readings(spark, root, dt.date(2031, 5, 6), dt.date(2031, 5, 6))
    assert [r.date for r in read.collect()] == [dt.date(2031, 5, 6)]
    assert read_readings(spark, root, dt.date(2031, 5, 7)).count() == 0
    with pytest.raises(ValueError, match="migrate_lake"):
        upsert_readings(spark, rows, root)
    migrate_lake(spark, root, copy)
    upsert_readings(spark, rows, copy)
    assert read_readings(spark, copy).count() == 1
