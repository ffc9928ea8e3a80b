"""Facts from staging.

The commodity and date dimensions carry no broadcast hint: Spark broadcasts them while
their size is below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles beyond it. The
trader-type dimension has four rows by definition and is broadcast outright.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MEASURES = ("Total_Volume", "Total_Turnover", "Low", "High")


def _with_commodity_id(staging: DataFrame, commodities: DataFrame) -> DataFrame:
    return staging.join(commodities, staging["Comm"] == commodities["Comm_Code"]).drop("Comm_Code")


def fact_session_summary(staging: DataFrame, commodities: DataFrame) -> DataFrame:
    """One row per source and commodity: open of its first date, close of its last.

    Rolled up by code before the join, so the join sees one row per group.
    """
    rolled = staging.groupBy("source_id", "Comm").agg(
        F.max("Trade_Date").alias("Date_id"),
        F.sum("Total_Volume").alias("Total_Volume"),
        F.sum("Total_Turnover").alias("Total_Turnover"),
        F.min("Low").alias("Low"),
        F.max("High").alias("High"),
        F.min_by("Open", "Trade_Date").alias("Open"),
        F.max_by("Close", "Trade_Date").alias("Close"),
    )
    return _with_commodity_id(rolled, commodities).select(
        "source_id", "Comm_id", "Date_id", *_MEASURES, "Open", "Close"
    )


def fact_hourly_stats(staging: DataFrame, commodities: DataFrame) -> DataFrame:
    """One row per source, commodity, date and hour."""
    return _with_commodity_id(staging, commodities).select(
        "source_id", "Comm_id", F.col("Trade_Date").alias("Date_id"), "Hour", *_MEASURES
    )


def fact_trade_distribution(
    staging: DataFrame, commodities: DataFrame, trader_types: DataFrame
) -> DataFrame:
    """One row per source, commodity and trade-size class."""
    rolled = staging.groupBy("source_id", "Comm", "Trader_Type").agg(
        F.sum("Trade_Count").alias("Trade_Count"), F.sum("Total_Volume").alias("Total_Volume")
    )
    types = F.broadcast(trader_types)
    return (
        _with_commodity_id(rolled, commodities)
        .join(types, F.col("Trader_Type") == types["Trader_Type_Name"])
        .select("source_id", "Comm_id", "Trader_Type_id", "Trade_Count", "Total_Volume")
    )


def with_year(facts: DataFrame) -> DataFrame:
    """The partition column of the hourly fact."""
    return facts.withColumn("year", F.floor(F.col("Date_id") / 10000).cast("int"))
