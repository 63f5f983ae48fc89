"""One ingest run: plan -> landed responses -> readings -> lake -> state.

The fetcher (outside Spark: HTTP, tokens, retries) works through the plan and
lands each response as ``<raw>/metering_point=<id>/chunk_from=<d>/chunk_to=<d>/
<name>.json``.  ``run_ingest`` then does the rest as Spark jobs over all
meters at once:

1. plan = tracked meters x state -> windows -> chunks; the tracked set and
   the plan are checkpointed (each is reused by several later steps);
2. documents answering this plan (a semi join on the folder keys, which also
   prunes the listing of other folders);
3. normalise (VARIANT, built-ins only) and upsert into the lake;
4. optionally refresh the day-level rollup for the days written;
5. chunk outcomes -> per-meter any-ok -> new state version, committed only if
   no other run has committed one since step 1.

Responses count in the order in which they landed (file time, path, place in the
file), which is fixed at the scan, before any row is moved.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.operators.normalize import latest_response, normalize_responses, usable_document
from wattlake.operators.planning import load_plan
from wattlake.operators.state import advance_state, chunk_outcomes, read_state, state_version, write_state
from wattlake.operators.rollup import refresh_rollup
from wattlake.operators.upsert import upsert_readings_days
from wattlake.schema import DEFAULT_BACKFILL_DAYS, DEFAULT_CHUNK_DAYS
from wattlake.session import checkpointed
from wattlake.sources.responses import read_responses

MP = "metering_point_id"


@dataclass
class IngestResult:
    rows_written: int
    state_version: int
    plan: DataFrame
    outcomes: DataFrame
    rejects: DataFrame


def answering_documents(docs: DataFrame, plan: DataFrame) -> DataFrame:
    keys = plan.select(F.col(MP).alias("metering_point"), "chunk_from", "chunk_to").distinct()
    return docs.join(keys, ["metering_point", "chunk_from", "chunk_to"], "left_semi")


def run_ingest(
    spark: SparkSession,
    raw_root: str,
    lake_root: str,
    state_root: str,
    tracked: DataFrame,
    as_of: dt.date,
    backfill_days: int = DEFAULT_BACKFILL_DAYS,
    chunk_days: int = DEFAULT_CHUNK_DAYS,
    strict: bool = False,
    ingested_at: dt.datetime | None = None,
    whole_files: bool = True,
    landing: str = "folders",
    rejects_root: str | None = None,
    filter_to_plan: bool = True,
    rollup_root: str | None = None,
    plan: DataFrame | None = None,
) -> IngestResult:
    """Ingest whatever the fetcher landed for the plan of ``as_of``.

    ``tracked`` is a one-column frame of meter ids.  ``ingested_at`` stamps the
    rows (default: midnight UTC of ``as_of``, so reruns are deterministic).
    ``landing``/``whole_files`` say how the fetcher landed its responses
    (``sources.responses``).  With ``rejects_root``, skipped points and
    unparsable responses of this run are appended there as Parquet, stamped
    with the run's ``as_of``.
    ``filter_to_plan`` keeps only documents that answer a planned chunk (a
    semi join on the request keys: broadcast when the plan is proven small,
    else a shuffle of the documents).  A fetcher that lands every run in a
    folder of its own can turn it off; documents are then not joined at all
    and outcomes still match chunks by their keys.
    With ``rollup_root``, the day-level rollup is refreshed for the days
    this run wrote (``operators.rollup``).
    ``plan``: the plan that the fetcher worked through, if it is at hand
    (checkpointed); else it is made again from the state.
    """
    if ingested_at is None:
        ingested_at = dt.datetime.combine(as_of, dt.time(), tzinfo=dt.timezone.utc)
    version = state_version(spark, state_root)
    state = read_state(spark, state_root)
    # Both small frames are reused several times below: compute each once.
    tracked = checkpointed(tracked.select(F.col(tracked.columns[0]).cast("string").alias(MP)).distinct())
    if plan is None:
        plan = checkpointed(load_plan(tracked, state, as_of, backfill_days, chunk_days))
    docs = read_responses(spark, raw_root, whole_files=whole_files, landing=landing)
    if filter_to_plan:
        docs = answering_documents(docs, plan)
    # Parsed once; text is kept only of what is put aside whole.
    docs = docs.withColumn("response", F.col("response_order.line")).withColumn("doc", F.try_parse_json("value"))
    docs = docs.withColumn("parsed", usable_document(F.col("doc"))).withColumn("value", F.when(~F.col("parsed"), F.col("value")))
    docs = docs.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        readings, rejects = normalize_responses(docs.where("parsed"), tracked=tracked, as_of=ingested_at, keep=["response"])
        readings = readings.persist(StorageLevel.MEMORY_AND_DISK)  # looked at twice or more for the latest response
        try:
            written, days = upsert_readings_days(spark, latest_response(readings, "response", docs), lake_root)
        finally:
            readings.unpersist()
        if rollup_root:
            refresh_rollup(spark, lake_root, rollup_root, days)
        if rejects_root:
            write_rejects(docs, rejects.drop("response"), f"{rejects_root}/run_date={as_of}")
        landed = docs.select(F.col("metering_point").alias(MP), "chunk_from", "chunk_to", "parsed")
        outcomes = chunk_outcomes(plan, landed)
        version = write_state(spark, advance_state(state, outcomes, strict), state_root, expected=version)
    finally:
        docs.unpersist()
    return IngestResult(written, version, plan, outcomes, rejects)


def write_rejects(docs: DataFrame, rejects: DataFrame, path: str) -> None:
    """Skipped points and, whole, the responses that were no answer (``parsed`` is false)."""
    unusable = docs.where(~F.col("parsed")).select(
        F.col("metering_point").alias(MP),
        F.lit(None).cast("string").alias("start_text"),
        F.col("value").alias("point_json"),
        F.lit("unparsable_response").alias("reject_reason"),
    )
    out = rejects.select(MP, "start_text", "point_json", "reject_reason").unionByName(unusable)
    out.write.mode("overwrite").parquet(path)


def write_plan(plan: DataFrame, path: str) -> None:
    """Hand the plan to the fetcher as one small Parquet table."""
    plan.write.mode("overwrite").parquet(path)
