"""Incremental-load plan: one window per meter, split into request chunks.

window:  no state -> [as_of - backfill_days, as_of];
         state    -> [last_ingestion_date - 7 days, as_of]  (overlap reload)
chunks:  inclusive [from, to] pieces of ``chunk_days`` days; the last one ends
         at ``to``; an inverted window gives no chunk.
The plan is a DataFrame (meter, date_from, date_to, chunk_from, chunk_to) that
the fetcher works through; chunk ``k`` of a meter starts at
``date_from + k * chunk_days``, so a landed file maps back to its chunk by
arithmetic, with an equi join, never a range join.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.schema import DEFAULT_BACKFILL_DAYS, DEFAULT_CHUNK_DAYS, OVERLAP_DAYS

MP = "metering_point_id"


def _date(value: dt.date | str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def load_windows(
    meters: DataFrame,
    state: DataFrame | None,
    as_of: dt.date | str | Column,
    backfill_days: int = DEFAULT_BACKFILL_DAYS,
    overlap_days: int = OVERLAP_DAYS,
) -> DataFrame:
    """(meter, last_ingestion_date, date_from, date_to) for every meter.

    ``state`` is (metering_point_id, last_ingestion_date); a meter without a
    row, or with a NULL date, is backfilled.  A missing state table (None)
    means every meter is backfilled.
    """
    ids = meters.select(F.col(meters.columns[0]).cast("string").alias(MP)).distinct()
    if state is None:
        joined = ids.withColumn("last_ingestion_date", F.lit(None).cast("date"))
    else:
        st = state.select(MP, "last_ingestion_date")
        joined = ids.join(st, MP, "left")
    today = _date(as_of)
    return joined.select(
        MP,
        "last_ingestion_date",
        F.coalesce(
            F.date_sub("last_ingestion_date", overlap_days), F.date_sub(today, backfill_days)
        ).alias("date_from"),
        today.alias("date_to"),
    )


def chunk_windows(windows: DataFrame, chunk_days: int = DEFAULT_CHUNK_DAYS) -> DataFrame:
    """Explode each window into inclusive chunks of ``chunk_days`` days."""
    if chunk_days <= 0:
        raise ValueError("chunk_days must be positive")
    span = F.datediff("date_to", "date_from")
    # greatest(.., 0) keeps sequence() from raising on an inverted window,
    # whatever order Catalyst evaluates the filter and the generator in.
    offsets = F.sequence(F.lit(0), F.greatest(span, F.lit(0)), F.lit(chunk_days))
    chunks = windows.where(F.col("date_from") <= F.col("date_to")).select(
        *windows.columns, F.posexplode(offsets).alias("chunk_index", "offset")
    )
    start = F.date_add("date_from", F.col("offset"))
    return chunks.select(
        *windows.columns,
        "chunk_index",
        start.alias("chunk_from"),
        F.least(F.date_add(start, chunk_days - 1), F.col("date_to")).alias("chunk_to"),
    )


def load_plan(
    meters: DataFrame,
    state: DataFrame | None,
    as_of: dt.date | str | Column,
    backfill_days: int = DEFAULT_BACKFILL_DAYS,
    chunk_days: int = DEFAULT_CHUNK_DAYS,
    overlap_days: int = OVERLAP_DAYS,
) -> DataFrame:
    return chunk_windows(
        load_windows(meters, state, as_of, backfill_days, overlap_days), chunk_days
    ).select(MP, "date_from", "date_to", "chunk_index", "chunk_from", "chunk_to")


def chunk_of(day: Column, date_from: Column, chunk_days: int = DEFAULT_CHUNK_DAYS) -> Column:
    """Index of the chunk holding ``day`` in a window starting at ``date_from``."""
    return F.floor(F.datediff(day, date_from) / F.lit(chunk_days)).cast("int")
