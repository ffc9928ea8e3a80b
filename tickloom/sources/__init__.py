"""Tick feeds: zipped logs, plain text logs, and adapters over existing tables."""

from tickloom.sources.adapters import (
    block_trades,
    status_log_from_orders,
    ticks_from_events,
)
from tickloom.sources.rows import split_bad_rows, type_ticks
from tickloom.sources.text import read_tick_csv
from tickloom.sources.zips import ZIP_SCHEMA, read_tick_zips, tick_paths, unzip_ticks

__all__ = [
    "ZIP_SCHEMA", "block_trades", "read_tick_csv", "read_tick_zips", "split_bad_rows",
    "status_log_from_orders", "tick_paths", "ticks_from_events", "type_ticks", "unzip_ticks",
]
