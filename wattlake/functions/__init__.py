"""Column expressions (all JVM-side built-ins, no Python UDFs)."""

from wattlake.functions.calendar import (
    iso_weekday,
    month_start,
    utc_date,
    utc_wall_clock,
    weekday_label,
)
from wattlake.functions.metrics import guarded_ratio, isolated_zero

__all__ = [
    "guarded_ratio",
    "isolated_zero",
    "iso_weekday",
    "month_start",
    "utc_date",
    "utc_wall_clock",
    "weekday_label",
]
