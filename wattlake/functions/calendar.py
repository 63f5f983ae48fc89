"""Calendar fields of a reading, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def utc_wall_clock(df: DataFrame, column: str) -> Column:
    """UTC wall-clock time (TIMESTAMP_NTZ) of a timestamp column.

    An instant (TIMESTAMP) is shifted by pure micro arithmetic, so the result
    never depends on ``spark.sql.session.timeZone``.  A column that is already
    TIMESTAMP_NTZ is taken to hold UTC wall-clock time and passes through.
    """
    dtype = df.schema[column].dataType
    col = F.col(column)
    if isinstance(dtype, T.TimestampNTZType):
        return col
    if isinstance(dtype, T.TimestampType):
        return F.expr(f"timestampadd(MICROSECOND, unix_micros(`{column}`), {_EPOCH_NTZ})")
    raise TypeError(f"{column} must be a timestamp, got {dtype.simpleString()}")


def ntz_to_instant(col: Column) -> Column:
    """Read a TIMESTAMP_NTZ as UTC and return the instant (TIMESTAMP)."""
    micros = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), col)
    return F.timestamp_micros(micros)


def hour_start(col: Column) -> Column:
    """Start of the hour of a TIMESTAMP_NTZ, staying TIMESTAMP_NTZ.

    ``date_trunc`` would return an instant read in the session time zone.
    """
    return F.timestamp_add("HOUR", F.hour(col), F.to_date(col).cast("timestamp_ntz"))


def ntz_literal(value) -> Column:
    """A TIMESTAMP_NTZ literal from a naive datetime (no time zone involved).

    ``F.lit`` of a naive datetime builds an instant from the Python process's
    local zone instead.
    """
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def utc_date(df: DataFrame, column: str) -> Column:
    """Calendar date in UTC."""
    return F.to_date(utc_wall_clock(df, column))


def iso_weekday(col: Column) -> Column:
    """ISO day of week, Monday = 1 .. Sunday = 7, as BIGINT."""
    return F.extract(F.lit("DAYOFWEEK_ISO"), col).cast("bigint")


def weekday_label(col: Column) -> Column:
    """English full weekday name, e.g. ``Wednesday``."""
    return F.date_format(col, "EEEE")


def month_start(col: Column) -> Column:
    """First day of the month of a date."""
    return F.trunc(col, "MM")
