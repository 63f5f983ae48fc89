"""Session helpers: shared scratch folder, temporary settings restored."""

from __future__ import annotations

import datetime as dt

from tests.conftest import UTC, reading
from wattlake.operators.upsert import upsert_readings
from wattlake.session import checkpoint_root, checkpointed, scratch_path


def test_scratch_folders_are_unique_under_the_checkpoint_root(spark):
    root = checkpoint_root(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root) and b.startswith(root)


def test_checkpointed_frame_keeps_rows_and_cuts_lineage(spark):
    df = spark.range(100).selectExpr("id", "id * 2 AS twice")
    cut = checkpointed(df)
    assert cut.count() == 100
    assert "Range" not in cut._jdf.queryExecution().optimizedPlan().toString()


def test_lake_write_restores_session_settings(spark, make_readings, tmp_path):
    key = "spark.sql.parquet.outputTimestampType"
    spark.conf.set(key, "INT96")
    try:
        rows = make_readings([reading("m", dt.datetime(2025, 1, 1, tzinfo=UTC), 1.0)])
        upsert_readings(spark, rows, str(tmp_path / "lake"), layout="meter_day")
        assert spark.conf.get(key) == "INT96"
        assert spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true"
    finally:
        spark.conf.set(key, "TIMESTAMP_MICROS")
