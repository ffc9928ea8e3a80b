"""Dimensions. Each function returns the rows to add; existing rows and ids never change."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import calendar_columns, date_of
from tickloom.functions.pricing import TRADER_TYPES
from tickloom.operators.sequences import number_rows
from tickloom.schemas import DIM_COMMODITY, DIM_DATE, DIM_TRADER_TYPE


def new_keys(candidates: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Distinct candidate rows whose key is not in ``existing`` yet.

    Candidates are made distinct first, so a code with very many rows joins as one row.
    """
    return candidates.filter(F.col(key).isNotNull()).distinct().join(
        existing.select(key).distinct(), key, "left_anti"
    )


def merge_new_keys(existing: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """``existing`` plus the candidates with a new key."""
    return existing.unionByName(new_keys(candidates, existing, key))


def new_commodities(existing: DataFrame, staging: DataFrame) -> DataFrame:
    """Codes of ``staging`` that have no id yet, numbered on from the highest id."""
    codes = new_keys(staging.select(F.col("Comm").alias("Comm_Code")), existing, "Comm_Code")
    highest = existing.agg(F.coalesce(F.max("Comm_id"), F.lit(0))).scalar()
    return number_rows(codes, ["Comm_Code"], "Comm_id", highest).select(*DIM_COMMODITY.names)


def sync_commodity_dim(existing: DataFrame, staging: DataFrame) -> DataFrame:
    return existing.unionByName(new_commodities(existing, staging))


def trader_type_dim(spark: SparkSession) -> DataFrame:
    """The four trade-size classes with their ids."""
    return spark.createDataFrame(list(enumerate(TRADER_TYPES, start=1)), DIM_TRADER_TYPE)


def new_dates(existing: DataFrame, staging: DataFrame) -> DataFrame:
    """Calendar rows for the trade dates that are not in the dimension."""
    dates = new_keys(staging.select(F.col("Trade_Date").alias("Date_id")), existing, "Date_id")
    return dates.withColumns(calendar_columns(date_of(F.col("Date_id")))).select(*DIM_DATE.names)


def sync_date_dim(existing: DataFrame, staging: DataFrame) -> DataFrame:
    return existing.unionByName(new_dates(existing, staging))


def with_iso_week(dates: DataFrame) -> DataFrame:
    """The dimension with ISO week numbers next to the Sunday-based ones."""
    return dates.withColumn("Iso_Week", F.weekofyear("Full_Date"))
