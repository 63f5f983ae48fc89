"""The reporting views as DataFrame -> DataFrame functions.

lake -> stage -> clean -+-> daily_consumption -+-> daily_quality_flags
          |             |                      +-> meter_metadata_enriched
          |             +-> monthly_consumption
          |             +-> hourly_profile
          |             +-> load_variability
          +-> missing_data_summary

All aggregates are partial (map-side) before their shuffle on the group keys,
so a meter with a huge share of the readings is combined before it moves.
The two window views run over already-aggregated rows: one row per meter and
day (or month), so a window partition is bounded by the calendar, not by the
number of readings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.functions.calendar import iso_weekday, month_start, utc_wall_clock, weekday_label
from wattlake.functions.metrics import guarded_ratio, isolated_zero
from wattlake.schema import EXPECTED_READINGS_PER_DAY, STAGE_COLUMNS

MP = "metering_point_id"


def stage(readings: DataFrame) -> DataFrame:
    """meter_data_stage: readings plus calendar fields of the UTC timestamp.

    Readings from the lake carry their partition day ``date`` (equal to the
    UTC day of the timestamp); it becomes ``reading_date``, so that a
    ``reading_date`` filter on any view prunes lake partitions.
    """
    ts = F.col("reading_ts_utc")
    day = F.col("date") if "date" in readings.columns else F.to_date(ts)
    base = readings.select(
        F.col(MP),
        utc_wall_clock(readings, "timestamp").alias("reading_ts_utc"),
        "consumption_value",
        "quality",
        "unit",
        "ingestion_timestamp",
        "ingestion_date",
        *(["date"] if "date" in readings.columns else []),
    )
    return base.select(
        MP,
        "reading_ts_utc",
        day.alias("reading_date"),
        F.hour(ts).cast("bigint").alias("reading_hour"),
        iso_weekday(ts).alias("reading_weekday"),
        weekday_label(ts).alias("reading_weekday_label"),
        F.month(ts).cast("bigint").alias("reading_month"),
        F.year(ts).cast("bigint").alias("reading_year"),
        "consumption_value",
        "quality",
        "unit",
        "ingestion_timestamp",
        "ingestion_date",
    )


def clean(staged: DataFrame) -> DataFrame:
    """meter_data_clean: non-null, non-negative readings (pushed to the scan)."""
    value = F.col("consumption_value")
    return staged.where(value.isNotNull() & (value >= 0)).select(*STAGE_COLUMNS)


def daily_consumption(cleaned: DataFrame) -> DataFrame:
    value = F.col("consumption_value")
    return cleaned.groupBy(MP, "reading_date").agg(
        F.sum(value).alias("total_kwh"),
        F.avg(value).alias("avg_kwh"),
        F.min(value).alias("min_kwh"),
        F.max(value).alias("max_kwh"),
        F.count(F.lit(1)).alias("reading_count"),
    )


def monthly_consumption(cleaned: DataFrame) -> DataFrame:
    """Monthly totals with the previous existing month's total (no densifying)."""
    monthly = cleaned.groupBy(MP, month_start(F.col("reading_date")).alias("month_start")).agg(
        F.sum("consumption_value").alias("total_kwh")
    )
    by_month = Window.partitionBy(MP).orderBy("month_start")
    total, previous = F.col("total_kwh"), F.col("previous_month_kwh")
    return monthly.withColumn("previous_month_kwh", F.lag("total_kwh").over(by_month)).select(
        MP,
        "month_start",
        "total_kwh",
        "previous_month_kwh",
        (total - previous).alias("delta_kwh"),
        guarded_ratio(total, previous).alias("delta_ratio"),
    )


def hourly_profile(cleaned: DataFrame) -> DataFrame:
    return cleaned.groupBy(MP, "reading_hour", "reading_weekday", "reading_weekday_label").agg(
        F.avg("consumption_value").alias("avg_kwh")
    )


def missing_data_summary(staged: DataFrame) -> DataFrame:
    """Counts stage rows (null and negative values included) against 24."""
    counts = staged.groupBy(MP, "reading_date").agg(F.count(F.lit(1)).alias("actual_readings"))
    expected = F.lit(EXPECTED_READINGS_PER_DAY)
    return counts.select(
        MP,
        "reading_date",
        "actual_readings",
        expected.alias("expected_readings"),
        (expected - F.col("actual_readings")).alias("missing_readings"),
    )


def load_variability(cleaned: DataFrame) -> DataFrame:
    value = F.col("consumption_value")
    return cleaned.groupBy(MP, "reading_date").agg(
        F.stddev_pop(value).alias("hourly_stddev_kwh"),
        F.max(value).alias("peak_kwh"),
    )


def daily_stats(cleaned: DataFrame) -> DataFrame:
    """daily_consumption and load_variability fused: one scan, one shuffle."""
    value = F.col("consumption_value")
    return cleaned.groupBy(MP, "reading_date").agg(
        F.sum(value).alias("total_kwh"),
        F.avg(value).alias("avg_kwh"),
        F.min(value).alias("min_kwh"),
        F.max(value).alias("max_kwh"),
        F.count(F.lit(1)).alias("reading_count"),
        F.stddev_pop(value).alias("hourly_stddev_kwh"),
    ).withColumn("peak_kwh", F.col("max_kwh"))


def daily_quality_flags(daily: DataFrame) -> DataFrame:
    """Isolated zero days: LAG and LEAD share one window (one sort)."""
    by_day = Window.partitionBy(MP).orderBy("reading_date")
    with_neighbours = daily.select(
        MP,
        "reading_date",
        "total_kwh",
        F.lag("total_kwh").over(by_day).alias("prev_day_kwh"),
        F.lead("total_kwh").over(by_day).alias("next_day_kwh"),
    )
    return with_neighbours.select(
        MP,
        "reading_date",
        "total_kwh",
        isolated_zero(F.col("total_kwh"), F.col("prev_day_kwh"), F.col("next_day_kwh")).alias(
            "isolated_zero_flag"
        ),
    )


def meter_metadata_enriched(daily: DataFrame, metadata: DataFrame) -> DataFrame:
    """Daily totals LEFT JOIN metadata; unmatched meters keep NULL attributes."""
    meta = metadata.select(MP, "name", "type", "location", "description", "extra_metadata")
    joined = daily.join(meta, MP, "left")
    return joined.select(
        MP,
        "name",
        "type",
        "location",
        "description",
        "extra_metadata",
        "reading_date",
        "total_kwh",
        "avg_kwh",
        "min_kwh",
        "max_kwh",
        "reading_count",
    )


def build_views(readings: DataFrame, metadata: DataFrame | None = None) -> dict[str, DataFrame]:
    """The whole view set over one readings frame, keyed by view name."""
    staged = stage(readings)
    cleaned = clean(staged)
    daily = daily_consumption(cleaned)
    views = {
        "meter_data_stage": staged,
        "meter_data_clean": cleaned,
        "daily_consumption": daily,
        "monthly_consumption": monthly_consumption(cleaned),
        "hourly_profile": hourly_profile(cleaned),
        "missing_data_summary": missing_data_summary(staged),
        "load_variability": load_variability(cleaned),
        "daily_quality_flags": daily_quality_flags(daily),
    }
    if metadata is not None:
        views["meter_metadata"] = metadata
        views["meter_metadata_enriched"] = meter_metadata_enriched(daily, metadata)
    return views
