"""Calendar attributes of a ``YYYYMMDD`` integer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_of(date_id) -> Column:
    """The calendar date, or null when the digits name none."""
    text = date_id.cast("string")
    return F.when(F.length(text) == 8, F.try_to_date(text, "yyyyMMdd"))


def week_of_year_sunday(date: Column) -> Column:
    """Week 0-53 with Sunday as first day; days before the first Sunday are week 0."""
    return F.floor((F.dayofyear(date) + 7 - F.dayofweek(date)) / 7).cast("int")


def calendar_columns(date: Column) -> dict[str, Column]:
    return {
        "Full_Date": date,
        "Year": F.year(date),
        "Month": F.month(date),
        "Quarter": F.quarter(date),
        "Week_Num": week_of_year_sunday(date),
        "Day_Name": F.date_format(date, "EEEE"),
    }
