"""Derived measures of the reporting views."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def guarded_ratio(current: Column, previous: Column) -> Column:
    """Relative change to ``previous``; NULL when that is NULL or 0."""
    return F.try_divide(current - previous, previous)


def isolated_zero(total: Column, previous: Column, following: Column) -> Column:
    """TRUE for a zero day whose neighbouring rows are both positive; never NULL."""
    return F.coalesce((total == 0) & (F.least(previous, following) > 0) & previous.isNotNull() & following.isNotNull(), F.lit(False))
