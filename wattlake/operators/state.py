"""Ingestion state: last ingested day per meter, advanced by chunk outcomes.

A version of the table is a folder of its own, ``<root>/data-<id>/``, written
whole before ``<root>/_commits/<n>.json`` names it.  That small file is created
atomically, so a commit is a compare-and-set: a run that read version n commits
n + 1, and of two such runs one wins and the other one raises ``StateConflict``.
A failed or rerun job leaves the last version in place.

Older tables (``<root>/version=<n>/`` with a ``_SUCCESS`` marker) are read, and
continued by commits; a version without its marker raises, as taking it for no
state would load every meter from the start again.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.schema import STATE
from wattlake.session import claim_file, hadoop_fs, read_small_file

MP = "metering_point_id"
COMMITS = "_commits"
NO_VERSION = -1


class StateConflict(RuntimeError):
    """Another run has committed the version that this one was to write."""


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, hpath = hadoop_fs(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(hpath)] if fs.exists(hpath) else []


def _latest(spark: SparkSession, root: str) -> tuple[int, str | None]:
    """(version, folder) of the state, (NO_VERSION, None) if there is none."""
    commits = [int(n[:-5]) for n in _names(spark, f"{root}/{COMMITS}") if n.endswith(".json") and n[:-5].isdigit()]
    if commits:
        named = json.loads(read_small_file(spark, f"{root}/{COMMITS}/{max(commits)}.json"))
        return max(commits), f"{root}/{named['data']}"
    older = [int(n.split("=", 1)[1]) for n in _names(spark, root) if n.startswith("version=")]
    if not older:
        return NO_VERSION, None
    folder = f"{root}/version={max(older)}"
    if "_SUCCESS" not in _names(spark, folder):
        raise ValueError(f"{folder} has no _SUCCESS marker: its write did not end; remove it to go back to the version before")
    return max(older), folder


def state_version(spark: SparkSession, root: str) -> int:
    """Number of the latest version, ``NO_VERSION`` before the first."""
    return _latest(spark, root)[0]


def init_state(spark: SparkSession, root: str) -> None:
    """Create an empty state table if there is none."""
    if state_version(spark, root) == NO_VERSION:
        try:
            write_state(spark, spark.createDataFrame([], STATE), root, expected=NO_VERSION)
        except StateConflict:
            pass  # there is one now


def read_state(spark: SparkSession, root: str) -> DataFrame | None:
    """Latest state version, or None when there is no state table yet."""
    _, folder = _latest(spark, root)
    return None if folder is None else spark.read.schema(STATE).parquet(folder)


def write_state(spark: SparkSession, state: DataFrame, root: str, expected: int | None = None) -> int:
    """Commit ``state`` as the version after ``expected`` (default: the latest now); returns its number."""
    if expected is None:
        expected = state_version(spark, root)
    data = f"data-{uuid.uuid4().hex}"
    # No coalesce(1): a fleet's state has a row per meter and is written by
    # as many tasks as the plan has (AQE packs small outputs anyway).
    state.select(MP, "last_ingestion_date").write.parquet(f"{root}/{data}")
    if state_version(spark, root) != expected or not claim_file(spark, f"{root}/{COMMITS}/{expected + 1}.json", json.dumps({"data": data})):
        raise StateConflict(f"state at {root}: version {expected + 1} was committed by another run; plan this run again from it")
    return expected + 1


def lookup_state(state: DataFrame, metering_point_id: str) -> DataFrame:
    """Point lookup of one meter's row (zero or one row)."""
    return state.where(F.col(MP) == F.lit(metering_point_id)).select(MP, "last_ingestion_date")


def chunk_outcomes(plan: DataFrame, landed: DataFrame) -> DataFrame:
    """Status of every planned chunk.

    ``landed`` has (metering_point_id, chunk_from, chunk_to, parsed): one row
    per landed response file.  A chunk is ok when it has at least one landed
    file and every file of it parses, even if it holds no reading.
    """
    per_chunk = landed.groupBy(MP, "chunk_from", "chunk_to").agg(
        F.bool_and(F.coalesce(F.col("parsed"), F.lit(False))).alias("parsed")
    )
    joined = plan.join(per_chunk, [MP, "chunk_from", "chunk_to"], "left")
    return joined.withColumn(
        "outcome",
        F.when(F.col("parsed"), F.lit("ok"))
        .when(F.col("parsed").isNull(), F.lit("missing"))
        .otherwise(F.lit("unparsable")),
    ).drop("parsed")


def state_updates(outcomes: DataFrame, strict: bool = False) -> DataFrame:
    """(meter, new last_ingestion_date) for meters whose chunks allow it.

    Default: any ok chunk advances the meter to the end of its window, as the
    source system does (an older failed chunk is then not fetched again).
    ``strict``: every chunk must be ok.
    """
    ok = F.col("outcome") == "ok"
    flag = F.bool_and(ok) if strict else F.bool_or(ok)
    per_meter = outcomes.groupBy(MP).agg(flag.alias("advance"), F.max("date_to").alias("date_to"))
    return per_meter.where("advance").select(MP, F.col("date_to").alias("last_ingestion_date"))


def merge_state(state: DataFrame | None, updates: DataFrame) -> DataFrame:
    """Insert-or-update by meter: old rows not updated, plus the updates.

    One pass and one shuffle: of a meter's old and new row the new one wins.
    """
    updates = updates.select(MP, "last_ingestion_date")
    if state is None:
        return updates
    tagged = state.select(MP, "last_ingestion_date", F.lit(0).alias("is_new")).unionByName(updates.withColumn("is_new", F.lit(1)))
    return tagged.groupBy(MP).agg(F.max_by("last_ingestion_date", "is_new").alias("last_ingestion_date"))


def advance_state(state: DataFrame | None, outcomes: DataFrame, strict: bool = False) -> DataFrame:
    return merge_state(state, state_updates(outcomes, strict))

