"""Per-tick expressions: turnover, hour bucket, trade-size class, relative change."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper volume bound of each trade-size class, and the open-ended top class.
TRADER_TYPE_BOUNDS = (("Retail", 5), ("Medium", 20), ("Shark", 100))
TOP_TRADER_TYPE = "Whale"

#: Class names in ascending order of size; their position is the surrogate key.
TRADER_TYPES = tuple(name for name, _ in TRADER_TYPE_BOUNDS) + (TOP_TRADER_TYPE,)


def turnover(price="Price", volume="Volume") -> Column:
    return F.col(price) * F.col(volume)


def hour_of(log_time="Log_Time") -> Column:
    """Hour of an ``HHMMSS`` integer."""
    return F.floor(F.col(log_time) / 10000).cast("int")


def trader_type(volume="Volume", bounds=TRADER_TYPE_BOUNDS, top=TOP_TRADER_TYPE) -> Column:
    """Trade-size class of a volume; a null volume has no class."""
    volume = F.col(volume) if isinstance(volume, str) else volume
    label = F.when(volume.isNull(), F.lit(None).cast("string"))
    for name, upper in bounds:
        label = label.when(volume <= upper, F.lit(name))
    return label.otherwise(F.lit(top))


def pct_change(start="Open", end="Close", digits: int | None = 2) -> Column:
    """Relative change in percent; null when the start is zero or missing."""
    start, end = F.col(start), F.col(end)
    change = F.try_divide(F.lit(100.0) * (end - start), start)
    return change if digits is None else F.round(change, digits)
