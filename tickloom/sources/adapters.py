"""Tick and ledger frames over tables that are already there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.schemas import TICK


def _date_int(ts: Column) -> Column:
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def _time_int(ts: Column) -> Column:
    return F.hour(ts) * 10000 + F.minute(ts) * 100 + F.second(ts)


def _volume(props: str) -> Column:
    """``k`` of a JSON object; one that holds nothing else is read without the JSON parser."""
    only_k = F.regexp_extract(props, r'^\{\s*"k"\s*:\s*(-?\d+)\s*\}$', 1)
    return F.coalesce(only_k.try_cast("bigint"), F.get_json_object(props, "$.k").cast("bigint"))


def ticks_from_events(events: DataFrame) -> DataFrame:
    """An event log as ticks: two calendar days to a source, event id as row order."""
    ts = F.col("ts")
    return events.select(
        F.col("event_type").alias("Comm"),
        F.lit("F").alias("Contract_Type"),
        _date_int(ts).alias("Trade_Date"),
        _time_int(ts).alias("Log_Time"),
        F.col("value").alias("Price"),
        _volume("props").alias("Volume"),
        (F.lit(6076) + F.floor((F.dayofmonth(ts) - 1) / 2)).cast("int").alias("source_id"),
        F.col("event_id").alias("seq"),
    ).select(*TICK.names)


def block_trades(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """One tick per order: its whole quantity at its total price, coded by priority.

    Line items are summed per order before the join, which then reuses that partitioning.
    """
    quantity = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").cast("bigint").alias("Volume")
    )
    ts = F.col("o_orderdate")
    return orders.join(quantity, "o_orderkey").select(
        F.col("o_orderpriority").alias("Comm"),
        F.lit("B").alias("Contract_Type"),
        _date_int(ts).alias("Trade_Date"),
        _time_int(ts).alias("Log_Time"),
        F.col("o_totalprice").alias("Price"),
        "Volume",
        F.year(ts).alias("source_id"),
        F.col("o_orderkey").alias("seq"),
    ).select(*TICK.names)


def status_log_from_orders(orders: DataFrame) -> DataFrame:
    """Orders as file-status transitions: customer = file, order = transition."""
    status = (
        F.when(F.col("o_orderstatus") == "O", "PENDING")
        .when(F.col("o_orderstatus") == "P", "PROCESSING")
        .when(F.col("o_orderkey") % 3 == 0, "FAILED")
        .otherwise("SUCCESS")
    )
    second_of_day = F.make_dt_interval(secs=(F.col("o_orderkey") % 86400).cast("decimal(18,6)"))
    return orders.select(
        F.col("o_custkey").cast("int").alias("file_id"),
        status.alias("status"),
        (F.col("o_orderdate") + second_of_day).alias("changed_at"),
        (F.col("o_orderkey") % 300).cast("int").alias("etl_sec"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_orderkey").alias("load_id"),
        F.lit(None).cast("string").alias("segment"),
        F.lit(None).cast("string").alias("txn"),
    )
