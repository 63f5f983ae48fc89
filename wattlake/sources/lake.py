"""Scan of the Hive-partitioned reading lake (layouts: ``schema.LAYOUTS``)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.functions.calendar import utc_date
from wattlake.schema import DEFAULT_LAYOUT, LAYOUTS, READING_COLUMNS, lake_schema
from wattlake.session import hadoop_fs, path_exists
from wattlake.sources.folders import has_data_file, is_local, read_folders
from wattlake.sources.manifest import NANOS_CONF, Manifest, lake_manifest


def detect_layout(spark: SparkSession, root: str) -> str | None:
    """Layout of an existing lake, None if there is none."""
    manifest = lake_manifest(spark, root)
    return manifest.layout if manifest else None


def bucket_of(meter: Column, buckets: int) -> Column:
    """The folder number of a meter in the ``bucket`` layout."""
    return F.pmod(F.xxhash64(meter.cast("string")), F.lit(buckets)).cast("int")


def _first_data_file(spark: SparkSession, root: str):
    """The first data file under ``root`` (None if there is none).

    A recursive listing that stops at the first hit: cheap on any file
    system, never a list of all files of a large lake.
    """
    fs, hpath = hadoop_fs(spark, root)
    if not fs.exists(hpath):
        return None
    files = fs.listFiles(hpath, True)
    while files.hasNext():
        status = files.next()
        path = status.getPath()
        parts = path.toString()[len(hpath.toString()):].split("/")
        if not any(p.startswith(("_", ".")) for p in parts if p):
            return path
    return None


def detect_nanos(spark: SparkSession, root: str) -> bool:
    """Whether the lake's files hold TIMESTAMP(NANOS) columns (pandas' default)."""
    manifest = lake_manifest(spark, root)
    return bool(manifest) and manifest.unit == "nanos"


def _nanos_schema(layout: str) -> T.StructType:
    fields = [
        T.StructField(f.name, T.LongType()) if isinstance(f.dataType, T.TimestampType) else f
        for f in lake_schema(layout).fields
    ]
    return T.StructType(fields)


def read_lake(
    spark: SparkSession,
    root: str,
    check: bool = True,
    layout: str | None = None,
    nanos: bool | None = None,
    manifest: Manifest | None = None,
    whole: bool = False,
) -> DataFrame:
    """All lake rows with the columns ``metering_point`` and ``date`` (and ``bucket``).

    The schema is given, so no file is sampled for inference and numeric
    looking ids stay strings.  Any file name under the partition folders is
    accepted (Spark writes part-*.parquet, other writers may not).
    With ``check``, a missing root or a root without files raises
    FileNotFoundError, as the reporting layer must not start on nothing.
    Layout and timestamp unit come from the lake's manifest, or from an
    inspection of all its footers where it has none.  TIMESTAMP(NANOS) columns
    (pandas' default) are read as raw longs and turned into instants, which
    needs a session setting; lakes in microseconds leave the session alone.
    ``whole`` says that no folder will be pruned: the folders of the
    ``meter_day`` layout, on a local or mounted disk, are then listed and read by
    tasks, as Spark's scan would keep all of them in the driver.
    """
    if check and not path_exists(spark, root):
        raise FileNotFoundError(f"Data path does not exist: {root}")
    if manifest is None and (layout is None or nanos is None):
        manifest = lake_manifest(spark, root)
    layout = layout or (manifest.layout if manifest else DEFAULT_LAYOUT)
    if nanos is None:
        nanos = bool(manifest) and manifest.unit == "nanos"
    schema = _nanos_schema(layout) if nanos else lake_schema(layout)
    in_tasks = whole and layout == "meter_day" and is_local(spark, root)
    if in_tasks:
        df = read_folders(spark, root, schema, LAYOUTS[layout])
    else:
        if nanos:
            spark.conf.set(NANOS_CONF, "true")
        df = spark.read.schema(schema).parquet(root)
    if nanos:
        for c in ("timestamp", "ingestion_timestamp"):
            df = df.withColumn(c, F.timestamp_micros(F.floor(F.col(c) / 1000)))
    if check and not (has_data_file(spark, root) if in_tasks else _first_data_file(spark, root)):
        raise FileNotFoundError(f"No Parquet files found under {root}")
    if layout != "meter_day":
        # The meter key lives in the files; expose it under the folder name
        # too, so callers filter one column whatever the layout.
        df = df.withColumn("metering_point", df["metering_point_id"])
    return df


def _by_utc_day(df: DataFrame, date_from, date_to, days) -> DataFrame:
    """``date`` from the timestamp; folders that cannot hold a wanted day are pruned first."""
    day = F.lit(1)
    if date_from is not None:
        df = df.where(F.col("date") >= F.date_sub(F.lit(date_from).cast("date"), day))
    if date_to is not None:
        df = df.where(F.col("date") <= F.date_add(F.lit(date_to).cast("date"), day))
    if days is not None:
        near = {d + dt.timedelta(days=n) for d in days for n in (-1, 0, 1)}
        df = df.where(F.col("date").isin(sorted(near)))
    return df.withColumn("date", utc_date(df, "timestamp"))


def read_readings(
    spark: SparkSession,
    root: str,
    date_from: dt.date | str | None = None,
    date_to: dt.date | str | None = None,
    meters: list[str] | DataFrame | None = None,
    check: bool = True,
    nanos: bool | None = None,
    days: list[dt.date] | None = None,
) -> DataFrame:
    """Reading rows for the views, with partition pruning.

    Columns: the reading record plus ``date``, the partition day.

    ``metering_point_id`` is taken from the partition column (equal to the file
    column by construction of the writer), so a filter on it, from here or
    from a query on the views, names a directory key and prunes partitions.
    ``date_from``/``date_to`` are inclusive and prune on the ``date`` key;
    ``days`` prunes to exactly those days.
    """
    if check and not path_exists(spark, root):
        raise FileNotFoundError(f"Data path does not exist: {root}")
    manifest = lake_manifest(spark, root)
    df = read_lake(spark, root, check=check, nanos=nanos, manifest=manifest)
    if manifest and manifest.day_rule != "utc":
        # Other writers name these folders by the day of the timestamp's own
        # offset: the UTC day is that folder's or one next to it.
        df = _by_utc_day(df, date_from, date_to, days)
    buckets = manifest.buckets if manifest else 0
    if date_from is not None:
        df = df.where(F.col("date") >= F.lit(date_from).cast("date"))
    if date_to is not None:
        df = df.where(F.col("date") <= F.lit(date_to).cast("date"))
    if days is not None:
        df = df.where(F.col("date").isin(sorted(set(days))))
    if isinstance(meters, list):
        df = df.where(F.col("metering_point").isin(meters))
        if buckets:  # literals once folded: only these folders are listed
            df = df.where(F.col("bucket").isin([bucket_of(F.lit(m), buckets) for m in meters]))
    elif meters is not None:
        # A checked broadcast of the meter set lets dynamic partition pruning
        # skip the folders of other meters in the meter/day layout (Spark
        # adds it when the meter set is itself selected by a predicate).
        from wattlake.operators.joins import join_small

        keys = meters.select(F.col(meters.columns[0]).cast("string").alias("metering_point")).distinct()
        on = ["metering_point"]
        if buckets:
            keys, on = keys.withColumn("bucket", bucket_of(F.col("metering_point"), buckets)), ["metering_point", "bucket"]
        df = join_small(df, keys, on, "left_semi")
    cols = [F.col("metering_point").alias("metering_point_id")] + [
        F.col(c) for c in READING_COLUMNS if c != "metering_point_id"
    ]
    # ``date`` (the folder key where the manifest says that it is the UTC day
    # of ``timestamp``) rides along: the stage view takes ``reading_date`` from
    # it, so a date filter on any view is a partition filter.
    return df.select(*cols, F.col("date"))
