"""Row-level tick operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import hour_of, trader_type, turnover


def is_valid() -> Column:
    """A price above zero and a code.

    Null prices fail the comparison by themselves. NaN sorts above every number in Spark
    and has to be excluded by name.
    """
    return (F.col("Price") > 0) & ~F.isnan("Price") & F.col("Comm").isNotNull()


def valid_ticks(ticks: DataFrame) -> DataFrame:
    return ticks.filter(is_valid())


def with_turnover(ticks: DataFrame) -> DataFrame:
    return ticks.withColumn("Turnover", turnover())


def with_hour(ticks: DataFrame) -> DataFrame:
    return ticks.withColumn("Hour", hour_of())


def with_trader_type(ticks: DataFrame) -> DataFrame:
    return ticks.withColumn("Trader_Type", trader_type())
