"""Tick analytics on Spark: scans, roll-ups, star schema, marts, ledger and ingest."""

__version__ = "0.1.0"
