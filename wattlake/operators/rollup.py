"""Day-level rollup of the lake, refreshed for the days an ingest touches.

One row per (meter, UTC day) with every per-day measure the views need:

    stage_count                   rows of the day (null / negative included)
    total_kwh, avg_kwh, min_kwh,  over clean rows only
    max_kwh, reading_count,
    hourly_stddev_kwh,
    hour_kwh, hour_counts         sum and count of each hour of the day (24 places)

From it, ``daily_consumption``, ``load_variability``, ``missing_data_summary``,
``monthly_consumption``, ``daily_quality_flags``, the enriched view and the hourly
profile follow without reading any reading row.  The profile adds up the hours'
sums and counts of a meter's days, so a day that is loaded again only changes
its own row.  Reports that do not need the hours do not read their columns.

The rollup is partitioned by ``reading_date``; ``refresh_rollup`` recomputes
exactly the given days from the lake (partition-pruned read, partial
aggregate, one shuffle) and dynamically overwrites those day partitions, so
an ingest run costs work proportional to the days it loaded, and a rerun is
idempotent.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattlake.functions.calendar import iso_weekday, month_start, weekday_label
from wattlake.functions.metrics import guarded_ratio
from wattlake.operators.views import stage
from wattlake.schema import EXPECTED_READINGS_PER_DAY
from wattlake.sources.lake import read_readings

MP = "metering_point_id"


def day_stats(staged: DataFrame) -> DataFrame:
    """The rollup rows of a staged frame (see module doc)."""
    value = F.col("consumption_value")
    clean = value.isNotNull() & (value >= 0)
    kept = F.when(clean, value)
    hours = [F.when(clean & (F.col("reading_hour") == h), value) for h in range(24)]
    return staged.groupBy(MP, "reading_date").agg(
        F.count(F.lit(1)).alias("stage_count"),
        F.sum(kept).alias("total_kwh"),
        F.avg(kept).alias("avg_kwh"),
        F.min(kept).alias("min_kwh"),
        F.max(kept).alias("max_kwh"),
        F.count(kept).alias("reading_count"),
        F.stddev_pop(kept).alias("hourly_stddev_kwh"),
        F.array(*[F.sum(h) for h in hours]).alias("hour_kwh"),
        F.array(*[F.count(h) for h in hours]).alias("hour_counts"),
    )


def refresh_rollup(
    spark: SparkSession,
    lake_root: str,
    rollup_root: str,
    days: list[dt.date] | None = None,
) -> None:
    """Recompute the rollup for ``days`` (all days when None) from the lake."""
    if days is not None and not days:
        return
    # The day list is a partition filter: only those days of the lake are read.
    staged = stage(read_readings(spark, lake_root, days=days))
    (
        day_stats(staged)
        .hint("rebalance", "reading_date")
        .sortWithinPartitions("reading_date", MP)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("reading_date")
        .parquet(rollup_root)
    )


ROLLUP_SCHEMA = (
    "metering_point_id string, stage_count bigint, total_kwh double, avg_kwh double, "
    "min_kwh double, max_kwh double, reading_count bigint, hourly_stddev_kwh double, "
    "hour_kwh array<double>, hour_counts array<bigint>, reading_date date"
)


def read_rollup(spark: SparkSession, rollup_root: str) -> DataFrame:
    return spark.read.schema(ROLLUP_SCHEMA).parquet(rollup_root)


def daily_from_rollup(rollup: DataFrame) -> DataFrame:
    return rollup.where(F.col("reading_count") > 0).select(
        MP, "reading_date", "total_kwh", "avg_kwh", "min_kwh", "max_kwh", "reading_count"
    )


def variability_from_rollup(rollup: DataFrame) -> DataFrame:
    return rollup.where(F.col("reading_count") > 0).select(
        MP, "reading_date", "hourly_stddev_kwh", F.col("max_kwh").alias("peak_kwh")
    )


def missing_from_rollup(rollup: DataFrame) -> DataFrame:
    expected = F.lit(EXPECTED_READINGS_PER_DAY)
    return rollup.select(
        MP,
        "reading_date",
        F.col("stage_count").alias("actual_readings"),
        expected.alias("expected_readings"),
        (expected - F.col("stage_count")).alias("missing_readings"),
    )


def monthly_from_rollup(rollup: DataFrame) -> DataFrame:
    """Monthly totals as sums of daily totals, then the same LAG as the view."""
    monthly = (
        daily_from_rollup(rollup)
        .groupBy(MP, month_start(F.col("reading_date")).alias("month_start"))
        .agg(F.sum("total_kwh").alias("total_kwh"))
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


def hourly_from_rollup(rollup: DataFrame) -> DataFrame:
    """The hourly profile from the hours' sums and counts.

    Raises on rows of a rollup that was written without them: refresh it once.
    """
    old = F.raise_error(F.lit("the rollup has days without hour columns; run refresh_rollup() for them"))
    counts = F.when(F.col("hour_counts").isNull(), old.cast("array<bigint>")).otherwise(F.col("hour_counts"))
    day = F.col("reading_date")
    hours = rollup.where("reading_count > 0").select(
        MP, iso_weekday(day).alias("reading_weekday"), weekday_label(day).alias("reading_weekday_label"), "hour_kwh", F.posexplode(counts).alias("hour", "n")
    )
    hours = hours.where("n > 0").select(MP, F.col("hour").cast("bigint").alias("reading_hour"), "reading_weekday", "reading_weekday_label", F.get("hour_kwh", F.col("hour")).alias("kwh"), "n")
    return hours.groupBy(MP, "reading_hour", "reading_weekday", "reading_weekday_label").agg((F.sum("kwh") / F.sum("n")).alias("avg_kwh"))
