"""Structured Streaming forms of the roll-ups."""

from tickloom.streaming.diverted import HourlyTable
from tickloom.streaming.hourly import hourly_stats_stream, late_ticks, read_upserts, upsert_sink
from tickloom.streaming.ingest import batch_loader, ingest_stream

__all__ = ["HourlyTable", "batch_loader", "hourly_stats_stream", "ingest_stream", "late_ticks", "read_upserts", "upsert_sink"]
