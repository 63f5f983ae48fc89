"""The reporting schema: catalog objects over a lake, defined in SQL.

``create_reporting`` puts an external table over the lake's path, the metadata
table and the views into one schema (``reporting`` by default), in the order in
which they build on each other, after dropping what is there of an earlier run.
Other sessions of the same catalog then query them by name, without Python.  A
date filter on any view reaches the lake's day folders, as ``reading_date`` is
the folder key; so the lake must name UTC days (its manifest says so).

The table's file list is read once a session; ``refresh_reporting`` makes a later
upsert's files known.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattlake.operators import metadata as meta_ops
from wattlake.plans.catalog import VIEW_ORDER
from wattlake.schema import EXPECTED_READINGS_PER_DAY, lake_schema
from wattlake.sources.manifest import lake_manifest

SCHEMA = "reporting"
TABLE = "readings"
METADATA_TABLE = "meter_metadata"

VIEW_SQL = {
    "meter_data_stage": """
        SELECT metering_point_id, at AS reading_ts_utc, date AS reading_date,
               CAST(hour(at) AS BIGINT) AS reading_hour, CAST(weekday(at) + 1 AS BIGINT) AS reading_weekday,
               date_format(at, 'EEEE') AS reading_weekday_label,
               CAST(month(at) AS BIGINT) AS reading_month, CAST(year(at) AS BIGINT) AS reading_year,
               consumption_value, quality, unit, ingestion_timestamp, ingestion_date
        FROM (SELECT *, timestampadd(MICROSECOND, unix_micros(timestamp), TIMESTAMP_NTZ'1970-01-01 00:00:00') AS at FROM {schema}.readings)""",
    "meter_data_clean": """
        SELECT * FROM {schema}.meter_data_stage WHERE consumption_value IS NOT NULL AND consumption_value >= 0""",
    "daily_consumption": """
        SELECT metering_point_id, reading_date, sum(consumption_value) AS total_kwh, avg(consumption_value) AS avg_kwh,
               min(consumption_value) AS min_kwh, max(consumption_value) AS max_kwh, count(*) AS reading_count
        FROM {schema}.meter_data_clean GROUP BY ALL""",
    "monthly_consumption": """
        WITH months AS (
            SELECT metering_point_id, trunc(reading_date, 'MONTH') AS month_start, sum(consumption_value) AS total_kwh
            FROM {schema}.meter_data_clean GROUP BY ALL),
        pairs AS (
            SELECT *, lag(total_kwh) OVER (PARTITION BY metering_point_id ORDER BY month_start) AS previous_month_kwh FROM months)
        SELECT *, total_kwh - previous_month_kwh AS delta_kwh,
               try_divide(total_kwh - previous_month_kwh, nullif(previous_month_kwh, 0)) AS delta_ratio
        FROM pairs""",
    "hourly_profile": """
        SELECT metering_point_id, reading_hour, reading_weekday, reading_weekday_label, avg(consumption_value) AS avg_kwh
        FROM {schema}.meter_data_clean GROUP BY ALL""",
    "missing_data_summary": """
        SELECT metering_point_id, reading_date, count(*) AS actual_readings, {expected} AS expected_readings,
               {expected} - count(*) AS missing_readings
        FROM {schema}.meter_data_stage GROUP BY metering_point_id, reading_date""",
    "load_variability": """
        SELECT metering_point_id, reading_date, stddev_pop(consumption_value) AS hourly_stddev_kwh, max(consumption_value) AS peak_kwh
        FROM {schema}.meter_data_clean GROUP BY ALL""",
    "daily_quality_flags": """
        SELECT metering_point_id, reading_date, total_kwh,
               total_kwh = 0 AND coalesce(lag(total_kwh) OVER days, 0) > 0 AND coalesce(lead(total_kwh) OVER days, 0) > 0 AS isolated_zero_flag
        FROM {schema}.daily_consumption WINDOW days AS (PARTITION BY metering_point_id ORDER BY reading_date)""",
    "meter_metadata_enriched": """
        SELECT metering_point_id, m.name, m.type, m.location, m.description, m.extra_metadata,
               reading_date, total_kwh, avg_kwh, min_kwh, max_kwh, reading_count
        FROM {schema}.daily_consumption LEFT JOIN {schema}.meter_metadata AS m USING (metering_point_id)""",
}


def drop_reporting(spark: SparkSession, schema: str = SCHEMA) -> None:
    """Drop the views, those that build on others first, and the tables (the lake's files stay)."""
    for name in reversed([v for v in VIEW_ORDER if v in VIEW_SQL]):
        spark.sql(f"DROP VIEW IF EXISTS {schema}.{name}")
    for name in (TABLE, METADATA_TABLE):
        spark.sql(f"DROP TABLE IF EXISTS {schema}.{name}")


def create_reporting(
    spark: SparkSession,
    data_path: str,
    listing: DataFrame | None = None,
    schema: str = SCHEMA,
    location: str | None = None,
) -> list[str]:
    """Create the reporting schema over the lake at ``data_path``; returns its objects in order.

    ``listing``: rows (metering_point_id, attributes, position) of the meters;
    without it, the metadata table and the enriched view are left out.
    ``location``: where the schema's own tables lie (default: the warehouse).
    """
    manifest = lake_manifest(spark, data_path)
    if manifest is None:
        raise FileNotFoundError(f"No lake at {data_path}")
    if manifest.day_rule != "utc" or manifest.unit != "micros" or manifest.layout == "meter_day":
        raise ValueError(f"lake at {data_path} is {manifest}; copy it once with migrate_lake()")
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}{at}")
    drop_reporting(spark, schema)
    made = [TABLE]
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in lake_schema(manifest.layout).fields)
    # external and without partitions in the catalog: Spark finds the folders itself and prunes them
    spark.sql(f"CREATE TABLE {schema}.{TABLE} ({columns}) USING parquet LOCATION '{data_path}'")
    if listing is not None:
        metadata = meta_ops.build_metadata(meta_ops.require_meters(meta_ops.normalize_listing(listing)))
        meta_ops.save_metadata_table(spark, metadata, f"{schema}.{METADATA_TABLE}")
        made.append(METADATA_TABLE)
    for name in VIEW_ORDER:
        if name in VIEW_SQL and (listing is not None or name != "meter_metadata_enriched"):
            spark.sql(f"CREATE VIEW {schema}.{name} AS {VIEW_SQL[name].format(schema=schema, expected=EXPECTED_READINGS_PER_DAY)}")
            made.append(name)
    return made


def refresh_reporting(spark: SparkSession, schema: str = SCHEMA) -> None:
    """Make the files of upserts since ``create_reporting`` known to this session."""
    spark.catalog.refreshTable(f"{schema}.{TABLE}")
