"""The reporting schema: views by name, equal to the DataFrame views."""

import uuid

import pytest

from tests.conftest import reading
from tests.test_manifest import DAYS, fleet, pruned
from wattlake.operators.upsert import upsert_readings
from wattlake.operators.views import build_views
from wattlake.plans.reporting import VIEW_SQL, create_reporting, drop_reporting, refresh_reporting
from wattlake.sources.lake import read_readings


@pytest.fixture
def lake(spark, make_readings, tmp_path):
    root = str(tmp_path / "lake")
    rows = [reading(m, d, v) for m in ("0012", "b") for d, v in zip(DAYS, (1.0, 0.0, 2.0, None, -1.0, 0.0))]
    upsert_readings(spark, make_readings(rows), root, buckets=2)
    return root


def listing(spark):
    rows = [("0012", {"name": "Cellar", "floor": "-1"}, 0), ("c", {}, 1)]
    return spark.createDataFrame(rows, "metering_point_id string, attributes map<string,string>, position long")


def test_views_equal_the_dataframe_views(spark, lake, tmp_path):
    schema = f"r{uuid.uuid4().hex[:8]}"
    for _ in range(2):  # built, dropped and built again
        made = create_reporting(spark, lake, listing(spark), schema, str(tmp_path / "db"))
    assert made[:2] == ["readings", "meter_metadata"] and set(made[2:]) == set(VIEW_SQL)
    frames = build_views(read_readings(spark, lake), spark.table(f"{schema}.meter_metadata"))
    for name in VIEW_SQL:
        view, frame = spark.table(f"{schema}.{name}"), frames[name]
        assert [(c, t) for c, t in view.dtypes] == [(c, t) for c, t in frame.dtypes], name
        assert view.exceptAll(frame).isEmpty() and frame.exceptAll(view).isEmpty(), name
    assert [r.metering_point_id for r in spark.table(f"{schema}.meter_metadata").collect()] == ["0012", "c"]
    filters = pruned(spark.sql(f"SELECT * FROM {schema}.daily_consumption WHERE reading_date >= DATE '{DAYS[4].date()}'"))
    assert "date#" in filters and ">=" in filters
    drop_reporting(spark, schema)
    assert spark.sql(f"SHOW TABLES IN {schema}").count() == 0
    assert read_readings(spark, lake).count() == 12


def test_later_upserts_show_after_a_refresh(spark, lake, make_readings, tmp_path):
    schema = f"r{uuid.uuid4().hex[:8]}"
    made = create_reporting(spark, lake, None, schema, str(tmp_path / "db"))
    assert "meter_metadata_enriched" not in made
    upsert_readings(spark, fleet(make_readings, ["new"]), lake)
    refresh_reporting(spark, schema)
    assert spark.sql(f"SELECT count(DISTINCT metering_point_id) FROM {schema}.daily_consumption").first()[0] == 3


def test_lakes_whose_folders_are_no_utc_days_are_refused(spark, make_readings, tmp_path):
    root = str(tmp_path / "lake")
    with pytest.raises(FileNotFoundError):
        create_reporting(spark, root)
    upsert_readings(spark, fleet(make_readings, ["a"]), root, layout="meter_day")
    with pytest.raises(ValueError, match="migrate_lake"):
        create_reporting(spark, root)


def test_view_totals_leaves_no_temp_views(spark):
    from wattlake.plans import registry

    out = registry.QUERIES["view_totals"](spark, "/root/testdata/sf0.001")
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("vt_")]
    assert out.first()["meter_days"] > 0
