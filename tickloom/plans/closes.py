"""Volatility warnings at a cost that does not grow with history.

A session is compared with its code's session before it, which may be years back. Two small tables carry
what is needed, both partitioned by month: the closes of all staged sessions, and for every code the
last close before the month (its *opening*). A load reads and writes the months it touches. A session
that comes late, or is corrected, may also change the openings of months behind it; those are
worked out again up to the last month there is.

A source's closes are removed before its staging is replaced and added afterwards, so a load that dies in
between and is run again finds the state consistent with what is staged. Staging that is written without a
load drops the state, and the next load builds it anew.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators import quality
from tickloom.plans.warehouse import Warehouse
from tickloom.schemas import STATE_CLOSES, STATE_OPENING
from tickloom.session import materialise


def month_of(date="Trade_Date") -> Column:
    return F.floor(F.col(date) / 100).cast("int")


def months_of(sessions: DataFrame) -> list[int]:
    """The months of some sessions; as many as a calendar has."""
    return sorted(row[0] for row in sessions.filter("Trade_Date IS NOT NULL").select(month_of()).distinct().collect())


def _of_months(wh: Warehouse, name: str, months: Iterable[int]) -> DataFrame:
    return wh.table(name).filter(F.col("month").isin([*months]))


def _daily(closes: DataFrame, *keys: str) -> DataFrame:
    """One close per code and date: that of the largest source, as in :func:`tickloom.operators.quality.dq_volatility`."""
    return closes.groupBy("Comm", "Trade_Date", *keys).agg(F.max_by("Close", "source_id").alias("Close"))


def _put(wh: Warehouse, name: str, rows: DataFrame, months: list[int]) -> None:
    """Make ``rows`` the contents of the months."""
    # Stored first, as they come from the table that is written.
    stored = materialise(rows, name)
    wh.replace(name, stored)
    if len(months) > 1 or stored.isEmpty():
        there = {row[0] for row in stored.select("month").distinct().collect()}
        for month in set(months) - there:
            wh.remove(f"{name}/month={month}")


def forget(wh: Warehouse, ids: list[int], staged: DataFrame) -> None:
    """Take the closes of sources out, given what is staged of them."""
    months = months_of(staged)
    if months:
        _put(wh, "state_closes", _of_months(wh, "state_closes", months).filter(~F.col("source_id").isin(ids)), months)
        _renew_openings(wh, months[0])


def remember(wh: Warehouse, ids: list[int], staged: DataFrame) -> list[int]:
    """Add the closes of sources from what is staged of them; returns their months."""
    months = months_of(staged)
    if months:
        new = staged.filter("Trade_Date IS NOT NULL").withColumn("month", month_of()).select(*STATE_CLOSES.names)
        others = _of_months(wh, "state_closes", months).filter(~F.col("source_id").isin(ids))
        _put(wh, "state_closes", others.unionByName(new), months)
        _renew_openings(wh, months[0])
    return months


def _renew_openings(wh: Warehouse, first: int) -> None:
    """Openings of all months behind ``first``, and of ``first`` itself where it is new."""
    known = sorted(int(m) for m in wh.partitions("state_closes"))
    opened = {int(m) for m in wh.partitions("state_opening")}
    for month in opened - set(known):  # of a month that has lost its last session
        wh.remove(f"state_opening/month={month}")
    earlier = [m for m in known if m < first]
    wanted = [m for m in known if m > first or (m == first and first not in opened)]
    if not wanted:
        return
    # From the last month whose opening still holds: that of ``first``, or of the month before it.
    base = first if first in opened else max(earlier, default=None)
    start = base if base is not None else first
    span = [m for m in known if start <= m < wanted[-1]]
    lasts = _daily(_of_months(wh, "state_closes", span), "month").groupBy("Comm", "month").agg(
        F.max("Trade_Date").alias("Trade_Date"), F.max_by("Close", "Trade_Date").alias("Close"))
    rows = lasts.select("Comm", "Trade_Date", "Close", "month")
    if base is not None:
        # What was known before the base month counts for it and all behind.
        rows = rows.unionByName(_of_months(wh, "state_opening", [base]).withColumn("month", F.lit(base - 1)).select(*rows.columns))
    later = F.explode(F.filter(F.array(*map(F.lit, wanted)), lambda m: m > F.col("month")))
    opening = rows.withColumn("_for", later).groupBy("Comm", F.col("_for").alias("month")).agg(
        F.max_by("Close", "Trade_Date").alias("Close"), F.max("Trade_Date").alias("Trade_Date"))
    _put(wh, "state_opening", opening.select(*STATE_OPENING.names), wanted)


def drop(wh: Warehouse) -> None:
    """Staging has changed otherwise than by a load; the next load rebuilds the state."""
    wh.remove("state_closes")
    wh.remove("state_opening")


def ensure(wh: Warehouse) -> None:
    """Build the state where there is none but sessions are staged; a listing decides."""
    if not wh.listing("state_closes") and wh.partitions("stg_session_summary"):
        rebuild(wh)


def rebuild(wh: Warehouse) -> None:
    """Both tables anew from all that is staged."""
    drop(wh)
    staged = wh.table("stg_session_summary").filter("Trade_Date IS NOT NULL")
    wh.replace("state_closes", staged.withColumn("month", month_of()).select(*STATE_CLOSES.names))
    months = sorted(int(m) for m in wh.partitions("state_closes"))
    if months:
        _renew_openings(wh, months[0])


def volatility(wh: Warehouse, months: list[int] | None = None, pct: float = 0.20) -> DataFrame:
    """:func:`tickloom.operators.quality.dq_volatility` of some months (of all by default), from the carried state."""
    months = sorted(int(m) for m in wh.partitions("state_closes")) if months is None else months
    days = _daily(_of_months(wh, "state_closes", months), "month").withColumn("_opening", F.lit(False))
    opening = _of_months(wh, "state_opening", months).withColumn("_opening", F.lit(True))
    # A code has at most one row per day of a month, and its opening before them.
    by_date = Window.partitionBy("Comm", "month").orderBy("Trade_Date")
    moved = days.unionByName(opening.select(*days.columns)).withColumn("Prev_Close", F.lag("Close").over(by_date))
    return quality.large_moves(moved.filter("NOT _opening").drop("_opening", "month"), pct)


def warnings(wh: Warehouse, staged: DataFrame, months: list[int], pct: float = 0.20) -> DataFrame:
    """``source_id, violations``: the sessions of a load whose close moved too much, counted per source."""
    moved = volatility(wh, months, pct).select("Comm", "Trade_Date")
    return staged.join(moved, ["Comm", "Trade_Date"], "left_semi").groupBy("source_id").agg(F.count("*").alias("violations"))
