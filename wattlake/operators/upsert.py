"""Write and upsert reading rows into the lake.

Layouts (``schema.LAYOUTS``): ``bucket`` (the default for a new lake) is
``date=<UTC day>/bucket=<k>/``, where k is a hash of the meter modulo the number
of buckets in the lake's manifest: files follow data volume, and a batch of few
meters (a new meter's backfill) rewrites only their buckets of each day.
``day`` is ``date=<UTC day>/`` with rows sorted by meter and timestamp.
``meter_day`` is the source system's ``metering_point=<id>/date=<day>/`` with one
file per meter and day: for lakes that exist, to be read or migrated.
Files are snappy Parquet, rows sorted by timestamp.  The upsert key is the timestamp within
(meter, day): an existing row goes when the new batch has a row with the same
meter and timestamp; every new row stays, duplicates inside the new batch
included.  Only partitions the batch touches are rewritten (dynamic overwrite).

Plan of an upsert:
  1. new rows -> row count and the set of days of the batch: one small
     aggregate (the day set is bounded by the batch's date range, the bucket
     set by the number of buckets).
  2. lake scan pruned to exactly those days and buckets (static partition
     pruning).  Every partition that is read and holds a new row is rewritten
     whole; one anti join on (meter, day, timestamp) gives the old rows that
     survive there.  In the ``bucket`` and ``meter_day`` layouts a semi join on
     the touched folders comes first, as a batch need not touch every bucket of
     every day.
  3. survivors UNION ALL new rows -> REBALANCE(partition keys) -> sort within
     partitions -> partitioned write.  REBALANCE lets AQE split a hot
     partition over several tasks and pack small ones together, so there is
     one file per partition in the normal case and no straggler when one
     meter or day holds a third of the rows.
Spark stages the output and swaps partitions only at job commit, so lost
executors just rerun tasks; reading and dynamically overwriting the same
root is safe because every read happens before the commit.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.functions.calendar import ntz_to_instant, utc_date
from wattlake.schema import DEFAULT_BUCKETS, DEFAULT_LAYOUT, LAYOUTS, PARTITION_COLUMNS, READING_COLUMNS
from wattlake.session import hadoop_fs, session_conf
from wattlake.sources.folders import is_local, overwrite_folders
from wattlake.sources.lake import bucket_of, read_lake
from wattlake.sources.manifest import Manifest, claim_manifest, lake_manifest

MP = "metering_point_id"


def _instant(df: DataFrame, column: str):
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return ntz_to_instant(F.col(column))
    return F.col(column)


def to_lake_rows(readings: DataFrame) -> DataFrame:
    """Reading rows as stored, plus the partition keys.

    Rows without meter or timestamp cannot be placed and are dropped; a NaN
    value is stored as NULL (so the clean view drops it).
    """
    value = F.col("consumption_value")
    rows = readings.where(F.col(MP).isNotNull() & F.col("timestamp").isNotNull()).select(
        F.col(MP).cast("string").alias(MP),
        _instant(readings, "timestamp").alias("timestamp"),
        F.when(F.isnan(value), F.lit(None).cast("double")).otherwise(value).alias("consumption_value"),
        F.col("quality").cast("string").alias("quality"),
        F.col("unit").cast("string").alias("unit"),
        _instant(readings, "ingestion_timestamp").alias("ingestion_timestamp"),
        F.col("ingestion_date").cast("date").alias("ingestion_date"),
    )
    return rows.withColumn("metering_point", F.col(MP)).withColumn("date", utc_date(rows, "timestamp"))


def write_partitions(rows: DataFrame, root: str, layout: str = "day", buckets: int = 0) -> None:
    """Dynamic-overwrite the partitions present in ``rows``.

    Timestamps are written as TIMESTAMP_MICROS (readable by any Parquet
    reader), whatever the session's default (INT96 in stock Spark).
    In the ``meter_day`` layout the work of a write grows with the number of
    folders, not bytes, so AQE must not coalesce the rebalanced partitions
    by size (it would hand thousands of tiny folders to one task); skew
    splitting stays on.  On a local or mounted disk ``sources.folders`` writes
    that layout.
    """
    keys = LAYOUTS[layout]
    spark = rows.sparkSession
    settings = {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}
    if layout == "meter_day":
        settings["spark.sql.adaptive.coalescePartitions.enabled"] = "false"
    with session_conf(spark, settings):
        if layout == "bucket":
            rows = rows.withColumn("bucket", bucket_of(F.col(MP), buckets))
        dealt = rows.select(*READING_COLUMNS, *keys).hint("rebalance", *keys).sortWithinPartitions(*keys, MP, "timestamp")
        if layout == "meter_day" and is_local(spark, root):
            return overwrite_folders(dealt, root, keys)
        (
            dealt.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "snappy")
            .partitionBy(*keys)
            .parquet(root)
        )


def surviving_rows(existing: DataFrame, new_rows: DataFrame, layout: str = "day") -> DataFrame:
    """Old rows of the touched partitions whose timestamp the batch does not bring.

    ``existing`` must already be limited to the batch's days.
    """
    replaced = new_rows.select(*PARTITION_COLUMNS, "timestamp").distinct()
    if layout != "day":  # every day that is read is a touched one
        touched = new_rows.select(*LAYOUTS[layout]).distinct()
        existing = existing.join(touched, LAYOUTS[layout], "left_semi")
    return existing.join(replaced, [*PARTITION_COLUMNS, "timestamp"], "left_anti")


def _refuse_shifted_folders(spark: SparkSession, root: str, days: list) -> None:
    """Folders near ``days`` must be named by the UTC day, or an upsert would leave old rows beside new ones."""
    near = {d + dt.timedelta(days=n) for d in days for n in (-1, 0, 1)}
    lake = read_lake(spark, root, check=False, layout="meter_day", nanos=False).where(F.col("date").isin(sorted(near)))
    if not lake.where(utc_date(lake, "timestamp") != F.col("date")).isEmpty():
        raise ValueError(f"lake at {root} has folders named by another offset's day; copy it once with migrate_lake() before upserting into it")


def upsert_readings(
    spark: SparkSession, readings: DataFrame, root: str, layout: str | None = None, buckets: int | None = None
) -> int:
    """Upsert ``readings`` into the lake at ``root``; returns the rows written.

    An existing lake keeps its layout; a new one gets ``layout`` (default
    ``bucket``, with ``buckets`` of them) in a manifest, claimed before the
    first row.  An empty batch writes nothing and touches no partition.
    """
    return upsert_readings_days(spark, readings, root, layout, buckets)[0]


def upsert_readings_days(
    spark: SparkSession, readings: DataFrame, root: str, layout: str | None = None, buckets: int | None = None
) -> tuple[int, list]:
    """``upsert_readings`` that also returns the UTC days the batch touched."""
    found = lake_manifest(spark, root)
    if found and layout and found.layout != layout:
        raise ValueError(f"lake at {root} has layout {found.layout}, not {layout}")
    if found and buckets and found.buckets != buckets:
        raise ValueError(f"lake at {root} has {found.buckets} buckets, not {buckets}")
    if found and found.unit == "nanos":
        raise ValueError(
            f"lake at {root} holds nanosecond timestamps (written by pandas); "
            "copy it once with migrate_lake() before upserting into it"
        )
    new_rows = to_lake_rows(readings).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        parts = [F.count(F.lit(1)).alias("n"), F.collect_set("date").alias("days")]
        if found and found.layout == "bucket":
            parts.append(F.collect_set(bucket_of(F.col(MP), found.buckets)).alias("buckets"))
        bounds = new_rows.agg(*parts).first()
        if not bounds["n"]:
            return 0, []
        new_lake = found is None
        if new_lake:
            layout = layout or DEFAULT_LAYOUT
            found = claim_manifest(spark, root, Manifest(layout, (buckets or DEFAULT_BUCKETS) if layout == "bucket" else 0))
            new_lake = found.layout == layout and not path_has_days(spark, root)
        if new_lake:
            out = new_rows
        else:
            existing = read_lake(spark, root, check=False, manifest=found).where(F.col("date").isin(sorted(bounds["days"])))
            batch = new_rows
            if found.layout == "bucket":
                batch = new_rows.withColumn("bucket", bucket_of(F.col(MP), found.buckets))
                if "buckets" in bounds:
                    existing = existing.where(F.col("bucket").isin(sorted(bounds["buckets"])))
            if found.day_rule != "utc":
                _refuse_shifted_folders(spark, root, bounds["days"])
            out = surviving_rows(existing, batch, found.layout).select(*READING_COLUMNS, *PARTITION_COLUMNS)
            out = out.unionByName(new_rows.select(*READING_COLUMNS, *PARTITION_COLUMNS))
        write_partitions(out, root, found.layout, found.buckets)
        return int(bounds["n"]), sorted(bounds["days"])
    finally:
        new_rows.unpersist()


def path_has_days(spark: SparkSession, root: str) -> bool:
    """Whether a writer that claimed the lake at the same time has put folders there."""
    fs, path = hadoop_fs(spark, root)
    return any("=" in status.getPath().getName() for status in fs.listStatus(path))


def migrate_lake(spark: SparkSession, source_root: str, target_root: str, layout: str | None = None, buckets: int | None = None) -> None:
    """Rewrite a lake (e.g. one written by pandas) with wattlake's writer.

    One partitioned rewrite into a new lake with a manifest; timestamps become
    microsecond instants, days UTC days.  ``layout``: ``bucket`` unless said otherwise.
    """
    layout = layout or DEFAULT_LAYOUT
    target = claim_manifest(spark, target_root, Manifest(layout, (buckets or DEFAULT_BUCKETS) if layout == "bucket" else 0))
    lake = read_lake(spark, source_root, whole=True)
    rows = lake.select(*READING_COLUMNS, *PARTITION_COLUMNS).withColumn("date", utc_date(lake, "timestamp"))
    write_partitions(rows, target_root, target.layout, target.buckets)


def adopt_lake(spark: SparkSession, root: str) -> Manifest:
    """Give a lake of another writer a manifest, after one scan of its day folders.

    Where every folder names the UTC day of its rows, readers take the folder
    as the day from then on, and a date filter prunes folders again.
    """
    found = lake_manifest(spark, root)
    if found is None:
        raise FileNotFoundError(f"No lake at {root}")
    lake = read_lake(spark, root, manifest=found)
    shifted = not lake.where(utc_date(lake, "timestamp") != F.col("date")).isEmpty()
    return claim_manifest(spark, root, replace(found, day_rule="offset" if shifted else "utc"))


def dedup_latest(readings: DataFrame) -> DataFrame:
    """Keep, per (meter, timestamp), the row with the latest ingestion time.

    Not part of the default upsert (a batch keeps its own duplicates, as in
    the source system); an option of the streaming ingest (``dedup=True``).
    ``max_by`` aggregates partially, so a hot key is combined map-side.
    """
    latest = F.max_by(
        F.struct(*[c for c in READING_COLUMNS if c not in (MP, "timestamp")]), "ingestion_timestamp"
    )
    return readings.groupBy(MP, "timestamp").agg(latest.alias("r")).select(MP, "timestamp", "r.*").select(
        *READING_COLUMNS
    )
