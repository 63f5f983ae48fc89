"""Register the reporting views in the Spark catalog.

``register_views`` names every view of ``wattlake.operators.views`` so that
SQL users (a BI tool, ``spark.sql``) can query them.  Temp views by default;
``global_views=True`` registers them in ``global_temp`` for other sessions of
the same application.  The metadata table can be saved into the catalog with
``operators.metadata.save_metadata_table``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattlake.operators import metadata as meta_ops
from wattlake.operators.views import build_views
from wattlake.sources.lake import read_readings

VIEW_ORDER = [
    "meter_data_stage",
    "meter_data_clean",
    "daily_consumption",
    "monthly_consumption",
    "hourly_profile",
    "missing_data_summary",
    "load_variability",
    "daily_quality_flags",
    "meter_metadata",
    "meter_metadata_enriched",
]


def register_views(
    spark: SparkSession,
    readings: DataFrame,
    metadata: DataFrame | None = None,
    prefix: str = "",
    global_views: bool = False,
) -> dict[str, DataFrame]:
    """Create or replace the reporting views over ``readings`` (and metadata).

    Order matters only for readability: each view is a DataFrame whose plan
    already inlines its parents, so Catalyst optimises a query on any view
    down to the lake scan (column pruning, pushed filters, partition keys).
    """
    views = build_views(readings, metadata)
    for name in VIEW_ORDER:
        if name not in views:
            continue
        if global_views:
            views[name].createOrReplaceGlobalTempView(prefix + name)
        else:
            views[name].createOrReplaceTempView(prefix + name)
    return views


def drop_views(spark: SparkSession, prefix: str = "", global_views: bool = False) -> None:
    for name in VIEW_ORDER:
        if global_views:
            spark.catalog.dropGlobalTempView(prefix + name)
        else:
            spark.catalog.dropTempView(prefix + name)


def build_reporting_layer(
    spark: SparkSession,
    data_path: str,
    listing: DataFrame | str | None = None,
    metadata_table: str | None = None,
    prefix: str = "",
    global_views: bool = False,
) -> dict[str, DataFrame]:
    """Register the whole reporting layer over the lake at ``data_path``.

    Raises FileNotFoundError when the lake root is missing or holds no
    Parquet file.  ``listing`` is a frame of (metering_point_id, attributes,
    position) rows or the path of a JSON meter listing; it becomes the
    metadata dimension (saved as ``metadata_table`` when given) and the
    enriched view.  Without a listing only the reading views are registered.
    """
    readings = read_readings(spark, data_path)
    metadata = None
    if listing is not None:
        if isinstance(listing, str):
            from wattlake.sources.listing import read_listing

            listing = read_listing(spark, listing)
        metadata = meta_ops.build_metadata(meta_ops.require_meters(meta_ops.normalize_listing(listing)))
        if metadata_table:
            meta_ops.save_metadata_table(spark, metadata, metadata_table)
            metadata = spark.table(metadata_table)
    return register_views(spark, readings, metadata, prefix=prefix, global_views=global_views)
