"""Column expressions; everything here stays inside the JVM."""

from tickloom.functions.calendar import calendar_columns, date_of, week_of_year_sunday
from tickloom.functions.ordering import ledger_order, tick_order
from tickloom.functions.pricing import hour_of, pct_change, trader_type, turnover

__all__ = [
    "calendar_columns", "date_of", "hour_of", "ledger_order", "pct_change",
    "tick_order", "trader_type", "turnover", "week_of_year_sunday",
]
