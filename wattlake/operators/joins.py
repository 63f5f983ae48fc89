"""Joins against small dimension tables, broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bounds a dimension must stay under before it is broadcast.  Meter metadata,
# ingestion state and the tracked set grow with the number of meters, not with
# the number of readings, but a size is still checked, never assumed.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 128 * 1024 * 1024


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES
) -> bool:
    """Check the row count and serialized bytes of ``df``.

    One partial aggregate over ``df``: each task counts its own rows, no row
    moves.  (A ``limit(n)`` probe would funnel up to n rows per partition
    into a single task when the side turns out large.)
    """
    probe = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*df.columns)))), F.lit(0)).alias("b"),
    )
    row = probe.first()
    return row["n"] <= max_rows and row["b"] <= max_bytes


def join_small(
    big: DataFrame,
    small: DataFrame,
    on,
    how: str = "left",
    max_rows: int = BROADCAST_MAX_ROWS,
    max_bytes: int = BROADCAST_MAX_BYTES,
) -> DataFrame:
    """Join ``big`` with ``small``; broadcast ``small`` only if it is proven small.

    Beyond the bound the plain join stays: a shuffled sort-merge join, which
    AQE may still turn into a broadcast from runtime sizes, and which its
    skew-join handling splits if one key is hot.

    The check runs ``small`` once more, so it is used where ``small`` is cheap
    to compute (metadata, state, the tracked set, the plan).  Where the small
    side is the end of an expensive pipeline, the plain join is left to AQE,
    which converts it only after measuring the shuffled side.
    """
    if fits_broadcast(small, max_rows, max_bytes):
        small = F.broadcast(small)
    return big.join(small, on, how)
