"""Structured Streaming form of the ingest."""

from wattlake.streaming.ingest import start_stream_ingest

__all__ = ["start_stream_ingest"]
