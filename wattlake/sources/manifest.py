"""What a lake is made of, kept beside its data.

``<root>/_manifest/<version>.json`` names the layout, the number of meter
buckets, the rule for the day folders and the unit of the timestamps.  The
writer that creates a lake claims version 1 before its first row; a reader or a
later writer takes everything from there, so no file or folder is sampled.
Versions are only ever added, each by an atomic creation: of two writers one
wins, and the other one goes on with the winner's manifest.

Lakes of other writers have none.  ``inspect_lake`` looks at all their folders
and, in a Spark job, at all their footers; ``adopt_lake`` checks the day rule in
one scan and writes the manifest.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from wattlake.session import claim_file, hadoop_fs, read_small_file, session_conf

FOLDER = "_manifest"
NANOS_CONF = "spark.sql.legacy.parquet.nanosAsLong"


@dataclass(frozen=True)
class Manifest:
    layout: str
    buckets: int = 0  # of meters, in each day; 0: the layout has none
    day_rule: str = "utc"  # "utc": folders name the UTC day; "offset": the day of the writer's offset
    unit: str = "micros"  # of timestamps: "micros" or "nanos"

    def to_json(self) -> str:
        return json.dumps(asdict(self))


def _versions(spark: SparkSession, root: str) -> list[int]:
    fs, folder = hadoop_fs(spark, f"{root}/{FOLDER}")
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def read_manifest(spark: SparkSession, root: str) -> Manifest | None:
    versions = _versions(spark, root)
    if not versions:
        return None
    return Manifest(**json.loads(read_small_file(spark, f"{root}/{FOLDER}/{versions[-1]}.json")))


def claim_manifest(spark: SparkSession, root: str, wanted: Manifest) -> Manifest:
    """Create version 1 with ``wanted``, or take what another writer claimed first."""
    claim_file(spark, f"{root}/{FOLDER}/1.json", wanted.to_json())
    return read_manifest(spark, root)


def change_manifest(spark: SparkSession, root: str, wanted: Manifest) -> None:
    """Add a version; raises if another writer adds one at the same time."""
    version = (_versions(spark, root) or [0])[-1] + 1
    if not claim_file(spark, f"{root}/{FOLDER}/{version}.json", wanted.to_json()):
        raise RuntimeError(f"manifest version {version} of {root} was written by another job; read it and try again")


def _folder_layout(spark: SparkSession, root: str) -> str | None:
    """The layout that all top folders of a lake name; mixed ones are refused."""
    fs, path = hadoop_fs(spark, root)
    if not fs.exists(path):
        return None
    found = set()
    entries = fs.listStatusIterator(path)
    while entries.hasNext():
        status = entries.next()
        key = status.getPath().getName().split("=")[0]
        if status.isDirectory() and key in ("metering_point", "date"):
            found.add("meter_day" if key == "metering_point" else "day")
    if len(found) > 1:
        raise ValueError(f"lake at {root} mixes folders by meter and folders by day; copy one of them into a lake of its own")
    return next(iter(found), None)


def inspect_lake(spark: SparkSession, root: str) -> Manifest | None:
    """What a lake without manifest is made of; None if it has no folders.

    Spark merges the schemas of all footers in a distributed job.  Nanosecond
    columns come as longs there, so files of different units do not merge and
    the lake is refused.
    """
    layout = _folder_layout(spark, root)
    if layout is None:
        return None
    with session_conf(spark, {NANOS_CONF: "true"}):
        try:
            schema = spark.read.option("mergeSchema", "true").parquet(root).schema
        except (PySparkException, Py4JJavaError) as e:
            if "UNABLE_TO_INFER_SCHEMA" in str(e):  # folders without a file
                return Manifest(layout, day_rule="offset")
            if "CANNOT_MERGE" in str(e) or "Failed to merge" in str(e):
                raise ValueError(
                    f"lake at {root} mixes files of different timestamp units; rewrite the files of one unit into a lake of their own with migrate_lake()"
                ) from e
            raise
    units = {isinstance(schema[c].dataType, T.LongType) for c in ("timestamp", "ingestion_timestamp") if c in schema.names}
    return Manifest(layout, day_rule="utc" if layout == "day" else "offset", unit="nanos" if True in units else "micros")


def lake_manifest(spark: SparkSession, root: str) -> Manifest | None:
    """The lake's own manifest, else what an inspection finds; None for no lake."""
    return read_manifest(spark, root) or inspect_lake(spark, root)
