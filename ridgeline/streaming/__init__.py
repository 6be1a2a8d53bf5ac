"""Structured Streaming ingest of the forecast landing."""

from .ingest import forecast_stream, newest_snapshots, read_newest, run_forecast_stream, upsert_batch

__all__ = ["forecast_stream", "newest_snapshots", "read_newest", "run_forecast_stream", "upsert_batch"]
