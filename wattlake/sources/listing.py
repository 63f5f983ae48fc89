"""Meter listings: ``{"metering_points": {"<id>": {attributes} | null, ...}}``.

The JSON form of the meter configuration.  Meters keep their listing order
(``position``), which decides the tracked set when two meters share a name.
Attribute values keep their JSON types (VARIANT).  Two forms:

- documents: each file is one document, parsed by one task: for
  configuration-sized listings;
- lines: ``{"<id>": {attributes} | null}`` on each line, in files of any size and
  number.  Files are split, so a fleet's listing is read by many tasks.

``position`` is a struct (file, block, line, place) that orders the entries by
path and place in the file without bringing them together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Values are VARIANT: their JSON types survive (numbers, booleans, nested).
METERS_DDL = "map<string, map<string, variant>>"
LISTING_DDL = f"struct<metering_points: {METERS_DDL}>"


def _entries(docs: DataFrame, meters: Column, line: Column) -> DataFrame:
    # the line number is taken at the scan: it rises within a block of a file
    placed = docs.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), line.alias("line"), meters.alias("meters"))
    if not placed.where(F.col("meters").isNull()).isEmpty():
        raise ValueError("Metering points must be a 'metering_points' mapping (or lines) of meter ids to mappings")
    entries = placed.select("file", "block", "line", F.posexplode("meters").alias("place", "metering_point_id", "attributes"))
    return entries.select("metering_point_id", "attributes", F.struct("file", "block", "line", "place").alias("position"))


def read_listing(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """(metering_point_id, attributes, position) rows of the listing files.

    ``lines``: one meter a line (blank lines are skipped).  Raises ValueError
    when a document or line is not a mapping of meter ids to mappings (or null).
    """
    if lines:
        docs = spark.read.text(path).where(F.trim("value") != "")
        return _entries(docs, F.from_json("value", METERS_DDL, {"mode": "PERMISSIVE"}), F.monotonically_increasing_id())
    docs = spark.read.text(path, wholetext=True)
    meters = F.from_json("value", LISTING_DDL, {"mode": "PERMISSIVE"})["metering_points"]
    return _entries(docs, meters, F.lit(0).cast("long"))
