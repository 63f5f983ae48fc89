"""Readers: the Parquet lake, landed API responses, metadata rows."""

from wattlake.sources.lake import read_lake, read_readings
from wattlake.sources.responses import read_responses

__all__ = ["read_lake", "read_readings", "read_responses"]
