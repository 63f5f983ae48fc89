"""Lake manifest, bucket layout, units and day rules."""

import datetime as dt
import os
import threading

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import UTC, reading
from wattlake.operators.upsert import adopt_lake, migrate_lake, upsert_readings
from wattlake.operators.views import clean, daily_consumption, stage
from wattlake.session import session_conf
from wattlake.sources.lake import bucket_of, read_lake, read_readings
from wattlake.sources.manifest import Manifest, change_manifest, claim_manifest, inspect_lake, read_manifest

DAYS = [dt.datetime(2031, 5, 1, tzinfo=UTC) + dt.timedelta(days=n) for n in range(6)]


def files(root):
    return {os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def fleet(make_readings, meters, days=DAYS, value=1.0):
    return make_readings([reading(m, day + dt.timedelta(hours=h), value) for m in meters for day in days for h in (0, 23)])


def pruned(df):
    """The partition filters of the plan's first scan."""
    with session_conf(df.sparkSession, {"spark.sql.maxMetadataStringLength": "2000"}):
        plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]


def test_backfill_of_one_meter_rewrites_its_buckets_only(spark, make_readings, tmp_path):
    root = str(tmp_path / "lake")
    old = [f"m{i}" for i in range(60)]
    upsert_readings(spark, fleet(make_readings, old), root, buckets=8)
    assert read_manifest(spark, root) == Manifest("bucket", 8)
    before = files(root)
    k = spark.range(1).select(bucket_of(F.lit("new"), 8)).first()[0]
    upsert_readings(spark, fleet(make_readings, ["new"]), root)
    replaced = before - files(root)
    assert replaced == {f for f in before if f"bucket={k}/" in f}
    assert 0 < len(replaced) <= len(before) / 4
    lake = read_lake(spark, root)
    assert lake.count() == 61 * 12
    assert not [d for d in os.listdir(root) if d.startswith("metering_point=")]
    assert lake.where(bucket_of(F.col("metering_point"), 8) != F.col("bucket")).isEmpty()


def test_a_batch_keeps_other_meters_of_its_buckets(spark, make_readings, tmp_path):
    root = str(tmp_path / "lake")
    upsert_readings(spark, fleet(make_readings, ["a", "b", "c"]), root, buckets=1)
    upsert_readings(spark, fleet(make_readings, ["b"], DAYS[:2], 5.0), root)
    got = {(r.metering_point_id, r.consumption_value): r.n for r in read_readings(spark, root).groupBy("metering_point_id", "consumption_value").agg(F.count("*").alias("n")).collect()}
    assert got == {("a", 1.0): 12, ("b", 1.0): 8, ("b", 5.0): 4, ("c", 1.0): 12}


def test_a_meter_filter_opens_one_bucket_of_each_day(spark, make_readings, tmp_path):
    root = str(tmp_path / "lake")
    upsert_readings(spark, fleet(make_readings, [f"m{i}" for i in range(40)]), root, buckets=4)
    df = read_readings(spark, root, meters=["m7"], date_from=DAYS[1].date(), date_to=DAYS[2].date())
    k = spark.range(1).select(bucket_of(F.lit("m7"), 4)).first()[0]
    filters = pruned(df)
    assert "bucket#" in filters and f" = {k})" in filters and "date#" in filters, filters
    assert df.count() == 4
    by_frame = read_readings(spark, root, meters=spark.createDataFrame([("m7",), ("m8",)], "m string"))
    assert by_frame.count() == 24


@pytest.mark.parametrize("layout", ["bucket", "day", "meter_day"])
def test_a_date_filter_on_a_view_prunes_folders_in_every_layout(spark, make_readings, tmp_path, layout):
    root = str(tmp_path / layout)
    upsert_readings(spark, fleet(make_readings, ["a", "b"]), root, layout=layout)
    view = daily_consumption(clean(stage(read_readings(spark, root)))).where(F.col("reading_date") >= F.lit(DAYS[4].date()))
    filters = pruned(view)
    assert "date#" in filters and ">=" in filters
    assert view.count() == 4


def test_of_two_writers_one_names_the_layout(spark, tmp_path):
    root, got = str(tmp_path / "lake"), []
    wanted = [Manifest("bucket", n) for n in (2, 3, 4, 5)]
    threads = [threading.Thread(target=lambda m=m: got.append(claim_manifest(spark, root, m))) for m in wanted]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(set(got)) == 1 and got[0] in wanted
    change_manifest(spark, root, Manifest("bucket", got[0].buckets, unit="nanos"))
    assert read_manifest(spark, root).unit == "nanos"


def test_an_existing_lake_keeps_its_buckets(spark, make_readings, tmp_path):
    root = str(tmp_path / "lake")
    upsert_readings(spark, fleet(make_readings, ["a"]), root, buckets=2)
    with pytest.raises(ValueError, match="2 buckets"):
        upsert_readings(spark, fleet(make_readings, ["a"]), root, buckets=4)
    with pytest.raises(ValueError, match="layout bucket"):
        upsert_readings(spark, fleet(make_readings, ["a"]), root, layout="day")


def foreign(root, meter, day, unit, shift_hours=0):
    """A file as another writer leaves it, its folder named by the day at an offset."""
    folder = f"{root}/metering_point={meter}/date={(day + dt.timedelta(hours=shift_hours)).date()}"
    os.makedirs(folder, exist_ok=True)
    at = pd.Series([day], dtype="datetime64[ns, UTC]")
    pd.DataFrame(
        {"metering_point_id": [meter], "timestamp": at, "consumption_value": [1.5], "quality": ["A"], "unit": ["kWh"], "ingestion_timestamp": at, "ingestion_date": [day.date()]}
    ).to_parquet(f"{folder}/data.parquet", coerce_timestamps=unit, version="2.6")


def test_mixed_units_are_refused_and_the_session_is_left_alone(spark, tmp_path):
    root, name = str(tmp_path / "lake"), "spark.sql.legacy.parquet.nanosAsLong"
    spark.conf.unset(name)
    foreign(root, "a", DAYS[0], "us")
    foreign(root, "b", DAYS[1], "us")
    assert inspect_lake(spark, root) == Manifest("meter_day", day_rule="offset", unit="micros")
    assert read_readings(spark, root).count() == 2
    assert spark.conf.get(name) == "false"
    foreign(root, "c", DAYS[2], None)
    with pytest.raises(ValueError, match="units"):
        read_readings(spark, root)
    assert spark.conf.get(name) == "false"


def test_nanosecond_lakes_migrate_into_buckets(spark, tmp_path):
    root, new = str(tmp_path / "lake"), str(tmp_path / "new")
    foreign(root, "a", DAYS[0], None)
    foreign(root, "b", DAYS[1] + dt.timedelta(hours=23), None, shift_hours=2)
    migrate_lake(spark, root, new)
    assert read_manifest(spark, new).layout == "bucket"
    got = {(r.metering_point_id, r.date) for r in read_lake(spark, new).collect()}
    assert got == {("a", DAYS[0].date()), ("b", DAYS[1].date())}


def test_adopted_lakes_are_pruned_where_folders_name_utc_days(spark, tmp_path):
    plain, shifted = str(tmp_path / "plain"), str(tmp_path / "shifted")
    for i, day in enumerate(DAYS):
        foreign(plain, f"m{i}", day, "us")
        foreign(shifted, f"m{i}", day + dt.timedelta(hours=23), "us", shift_hours=2)
    assert adopt_lake(spark, plain) == Manifest("meter_day", day_rule="utc")
    assert adopt_lake(spark, shifted).day_rule == "offset"
    wanted = F.col("date") >= F.lit(DAYS[4].date())
    assert ">=" in pruned(read_readings(spark, plain).where(wanted))
    for root in (plain, shifted):
        assert {r.date for r in read_readings(spark, root).where(wanted).collect()} == {DAYS[4].date(), DAYS[5].date()}


def test_mixed_folders_are_refused(spark, make_readings, tmp_path):
    root = str(tmp_path / "lake")
    foreign(root, "a", DAYS[0], "us")
    os.makedirs(f"{root}/date=2031-05-01")
    with pytest.raises(ValueError, match="mixes folders"):
        read_readings(spark, root)
