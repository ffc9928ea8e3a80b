"""Tick roll-ups and the merge of stored roll-ups.

Every roll-up is one HashAggregate with map-side partials, so a source or code that holds
a large share of the ticks reaches the shuffle as a handful of partial rows per task.

``Open_At``/``Close_At`` are the packed (Log_Time, seq) keys of the first and last tick.
Roll-ups that keep them can be merged again and still know which price came first.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import hour_of, tick_order, trader_type, turnover

HOURLY_KEYS = ("source_id", "Comm", "Trade_Date", "Hour")
SESSION_KEYS = ("source_id", "Comm", "Trade_Date")
DISTRIBUTION_KEYS = ("source_id", "Comm", "Trader_Type")


def _totals(volume: Column, turnover_: Column, low: Column, high: Column) -> list[Column]:
    return [
        F.sum(volume).alias("Total_Volume"),
        F.sum(turnover_).alias("Total_Turnover"),
        F.min(low).alias("Low"),
        F.max(high).alias("High"),
    ]


def _tick_totals() -> list[Column]:
    return _totals(F.col("Volume"), turnover(), F.col("Price"), F.col("Price"))


def _merged_totals() -> list[Column]:
    return _totals(F.col("Total_Volume"), F.col("Total_Turnover"), F.col("Low"), F.col("High"))


def _tick_ends() -> list[Column]:
    return [
        F.min_by("Price", "_at").alias("Open"),
        F.max_by("Price", "_at").alias("Close"),
        F.min("_at").alias("Open_At"),
        F.max("_at").alias("Close_At"),
    ]


def _merged_ends() -> list[Column]:
    return [
        F.min_by("Open", "Open_At").alias("Open"),
        F.max_by("Close", "Close_At").alias("Close"),
        F.min("Open_At").alias("Open_At"),
        F.max("Close_At").alias("Close_At"),
    ]


def _union(parts: tuple[DataFrame, ...]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# -- from ticks ----------------------------------------------------------------------
# ``also`` adds group keys, such as the chunk of a roll-up that is stored to be merged later.


def hourly_stats(ticks: DataFrame, also: Sequence[str] = (), latest: str | None = None) -> DataFrame:
    """Volume, turnover, low and high per source, code, date and hour; ``latest`` names a column whose largest value to add."""
    more = [F.max(latest).alias(latest)] if latest else []
    return ticks.withColumn("Hour", hour_of()).groupBy(*HOURLY_KEYS, *also).agg(*_tick_totals(), *more)


def hourly_ohlc(ticks: DataFrame) -> DataFrame:
    """:func:`hourly_stats` with the first and last price of the hour."""
    keyed = ticks.withColumns({"Hour": hour_of(), "_at": tick_order()})
    return keyed.groupBy(*HOURLY_KEYS).agg(*_tick_totals(), *_tick_ends()).drop("Open_At", "Close_At")


def session_partials(ticks: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Session summary in its mergeable form."""
    keyed = ticks.withColumn("_at", tick_order())
    return keyed.groupBy(*SESSION_KEYS, *also).agg(*_tick_totals(), *_tick_ends())


def session_summary(ticks: DataFrame) -> DataFrame:
    """Volume, turnover and open/high/low/close per source, code and trade date.

    Ticks with an equal ``Log_Time`` are taken in ``seq`` order.
    """
    return session_partials(ticks).drop("Open_At", "Close_At")


def trade_distribution(ticks: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Trades and volume per source, code and trade-size class."""
    return (
        ticks.withColumn("Trader_Type", trader_type())
        .groupBy(*DISTRIBUTION_KEYS, *also)
        .agg(F.count("Volume").alias("Trade_Count"), F.sum("Volume").alias("Total_Volume"))
    )


# -- merging stored roll-ups ---------------------------------------------------------


def merge_hourly(*parts: DataFrame) -> DataFrame:
    return _union(parts).groupBy(*HOURLY_KEYS).agg(*_merged_totals())


def merge_session(*parts: DataFrame) -> DataFrame:
    """Merge outputs of :func:`session_partials`."""
    merged = _union(parts).groupBy(*SESSION_KEYS).agg(*_merged_totals(), *_merged_ends())
    return merged.drop("Open_At", "Close_At")


def merge_distribution(*parts: DataFrame) -> DataFrame:
    return (
        _union(parts)
        .groupBy(*DISTRIBUTION_KEYS)
        .agg(F.sum("Trade_Count").alias("Trade_Count"), F.sum("Total_Volume").alias("Total_Volume"))
    )


# -- all three roll-ups from one pass over the ticks ------------------------------------


def tick_cells(ticks: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """The finest grain the three roll-ups share: source, code, date, hour and class.

    A load computes and stores these cells once; the roll-ups below are then small
    re-aggregations and the ticks are neither unzipped nor shuffled a second time.
    """
    return (
        ticks.withColumns({"Hour": hour_of(), "Trader_Type": trader_type(), "_at": tick_order()})
        .groupBy(*HOURLY_KEYS, "Trader_Type", *also)
        .agg(F.count("Volume").alias("Trade_Count"), *_tick_totals(), *_tick_ends())
    )


def hourly_from_cells(cells: DataFrame) -> DataFrame:
    return merge_hourly(cells)


def session_from_cells(cells: DataFrame) -> DataFrame:
    return merge_session(cells)


def distribution_from_cells(cells: DataFrame) -> DataFrame:
    return merge_distribution(cells)
