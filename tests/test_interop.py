"""A lake written the source system's way (pandas, nanoseconds, one file per
meter and day) reads back through wattlake with the same daily totals DuckDB
computes from the same files."""

from __future__ import annotations

import os

import duckdb
import pandas as pd
import pytest

from wattlake.operators import views as V
from wattlake.sources.lake import read_readings

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def _write_pandas_lake(root):
    ev = pd.read_parquet(f"{SF}/events.parquet")
    ev["metering_point_id"] = ev["user_id"].astype(str)
    # Frames built from Python datetimes hold nanoseconds, as upstream.
    ev["timestamp"] = pd.to_datetime(ev["ts"]).dt.tz_localize("UTC").astype("datetime64[ns, UTC]")
    ev["consumption_value"] = ev["value"].where(ev["event_type"] != "error")
    ev["quality"] = ev["event_type"]
    ev["unit"] = "kWh"
    ev["ingestion_timestamp"] = pd.Series(pd.Timestamp("2024-02-01", tz="UTC"), index=ev.index).astype(
        "datetime64[ns, UTC]"
    )
    ev["ingestion_date"] = pd.Timestamp("2024-02-01").date()
    ev["day"] = ev["timestamp"].dt.date
    cols = ["metering_point_id", "timestamp", "consumption_value", "quality", "unit", "ingestion_timestamp", "ingestion_date"]
    for (mp, day), group in ev.groupby(["metering_point_id", "day"]):
        folder = os.path.join(root, f"metering_point={mp}", f"date={day}")
        os.makedirs(folder, exist_ok=True)
        group.sort_values("timestamp")[cols].to_parquet(
            os.path.join(folder, "consumption_data.parquet"), engine="pyarrow", index=False
        )


def test_pandas_written_lake_daily_totals(spark, tmp_path):
    from wattlake.sources.lake import detect_nanos

    root = str(tmp_path / "lake")
    _write_pandas_lake(root)
    assert detect_nanos(spark, root)
    readings = read_readings(spark, root)  # nanoseconds detected from a footer
    daily = V.daily_consumption(V.clean(V.stage(readings)))
    got = sorted((r.metering_point_id, r.reading_date, round(r.total_kwh, 6), r.reading_count) for r in daily.collect())
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    want = con.execute(
        f"""
        SELECT metering_point_id, CAST(timezone('UTC', "timestamp") AS DATE) AS reading_date,
               round(SUM(consumption_value), 6) AS total_kwh, COUNT(*) AS reading_count
        FROM read_parquet('{root}/metering_point=*/date=*/consumption_data.parquet')
        WHERE consumption_value IS NOT NULL AND consumption_value >= 0
        GROUP BY ALL
        """
    ).fetchall()
    assert got == sorted(want)
    assert len(got) > 100


def test_upsert_into_pandas_lake_needs_migration(spark, make_readings, tmp_path):
    import datetime as dt

    from tests.conftest import UTC, reading
    from wattlake.operators.upsert import migrate_lake, upsert_readings

    root, new_root = str(tmp_path / "lake"), str(tmp_path / "migrated")
    _write_pandas_lake(root)
    batch = make_readings([reading("7", dt.datetime(2024, 1, 3, 5, tzinfo=UTC), 99.0)])
    with pytest.raises(ValueError):
        upsert_readings(spark, batch, root)
    migrate_lake(spark, root, new_root, layout="day")  # and move to the scalable layout
    from wattlake.sources.lake import detect_layout

    assert detect_layout(spark, new_root) == "day"
    with pytest.raises(ValueError):
        upsert_readings(spark, batch, new_root, layout="meter_day")
    before = read_readings(spark, root).count()
    assert read_readings(spark, new_root).count() == before
    upsert_readings(spark, batch, new_root)
    assert read_readings(spark, new_root).count() in (before, before + 1)
    assert 99.0 in [r.consumption_value for r in read_readings(spark, new_root, meters=["7"]).collect()]
