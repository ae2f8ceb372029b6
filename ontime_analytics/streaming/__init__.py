"""Structured Streaming entry points (incremental ingest of new flight files)."""

from ontime_analytics.streaming.ingest import start_flight_ingest

__all__ = ["start_flight_ingest"]
