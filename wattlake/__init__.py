"""wattlake: interval meter readings on Spark.

Landed JSON responses are flattened into reading rows, upserted into a
Parquet lake partitioned by day (or by meter and day), and reported on through
a set of DataFrame functions, also registrable as SQL views.  Everything is
built from Spark's own DataFrame / SQL / Structured Streaming operators; no
Python UDFs.
"""

from wattlake.schema import LAKE_SCHEMA, METADATA, READING, STAGE_COLUMNS, STATE


def __getattr__(name):
    # Main entry points, imported on first use to keep `import wattlake` light.
    entry_points = {
        "build_session": "wattlake.session",
        "read_readings": "wattlake.sources.lake",
        "upsert_readings": "wattlake.operators.upsert",
        "build_reporting_layer": "wattlake.plans.catalog",
        "register_views": "wattlake.plans.catalog",
        "run_ingest": "wattlake.plans.ingest",
        "start_stream_ingest": "wattlake.streaming.ingest",
    }
    if name in entry_points:
        import importlib

        return getattr(importlib.import_module(entry_points[name]), name)
    raise AttributeError(name)


__all__ = [
    "LAKE_SCHEMA",
    "METADATA",
    "READING",
    "STAGE_COLUMNS",
    "STATE",
    "build_reporting_layer",
    "build_session",
    "read_readings",
    "register_views",
    "run_ingest",
    "start_stream_ingest",
    "upsert_readings",
]
