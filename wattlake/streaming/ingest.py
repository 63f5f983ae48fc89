"""Continuous ingest of landed responses (file stream -> lake upsert).

New response files are picked up by the file source (its checkpoint is the
record of what was read), normalised with the batch operator and upserted by
``foreachBatch``.  foreachBatch is at-least-once; a replayed micro-batch is
harmless because the upsert is idempotent: applying batch B again removes
every lake row keyed by B's (meter, timestamp) pairs and adds B back, which
is the state after the first application, duplicates inside B included.
Each micro-batch is one upsert in which later responses replace earlier ones
hour by hour, as if each had been saved by itself, in order of landing.
LAG/LEAD views stay batch queries over the lake: Spark does not run
non-time windows on streams.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.operators.normalize import latest_response, normalize_responses, usable_document
from wattlake.operators.rollup import refresh_rollup
from wattlake.operators.upsert import upsert_readings_days
from wattlake.plans.ingest import write_rejects
from wattlake.session import claim_file, path_exists
from wattlake.sources.responses import response_order, stream_responses

LEDGER = "applied"


def start_stream_ingest(
    spark: SparkSession,
    raw_root: str,
    lake_root: str,
    checkpoint: str,
    tracked: DataFrame | None = None,
    as_of: dt.datetime | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    whole_files: bool = True,
    landing: str = "folders",
    rejects_root: str | None = None,
    rollup_root: str | None = None,
):
    """Start the stream; returns the StreamingQuery.

    With ``rejects_root``, each micro-batch writes its skipped points and
    unusable responses to a folder of its own (overwritten on a replay).

    A batch is entered in a ledger beside the checkpoint once all its outputs
    are written.  A replay of an entered batch does nothing; one that broke off
    before is applied again as a whole, which every output takes (the upsert and
    the rollup by key, rejects by a folder for each batch).

    With ``rollup_root``, every micro-batch also refreshes the day-level
    rollup for the days it wrote (idempotent, like the upsert).
    """
    docs = stream_responses(spark, raw_root, max_files_per_trigger, whole_files, landing)

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        spark_ = batch.sparkSession
        entry = f"{checkpoint}/{LEDGER}/{batch_id}.json"
        if path_exists(spark_, entry):
            return  # a replay of a batch whose lake, rollup and rejects are all written
        # the order is taken from the scan; each response is parsed once
        batch = batch.withColumn("response_order", response_order()).withColumn("response", F.col("response_order.line"))
        batch = batch.withColumn("doc", F.try_parse_json("value"))
        batch = batch.withColumn("parsed", usable_document(F.col("doc"))).withColumn("value", F.when(~F.col("parsed"), F.col("value")))
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good = batch.where("parsed")
            readings, rejects = normalize_responses(good, tracked=tracked, as_of=as_of, keep=["response"])
            readings = readings.persist(StorageLevel.MEMORY_AND_DISK)  # looked at twice or more for the latest response
            try:
                _, days = upsert_readings_days(spark_, latest_response(readings, "response", good), lake_root)
            finally:
                readings.unpersist()
            if rollup_root:
                refresh_rollup(spark_, lake_root, rollup_root, days)
            if rejects_root:
                write_rejects(batch, rejects, f"{rejects_root}/batch={batch_id}")
            claim_file(spark_, entry, json.dumps({"days": [str(d) for d in days]}))
        finally:
            batch.unpersist()

    writer = docs.writeStream.foreachBatch(upsert_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
