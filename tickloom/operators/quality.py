"""Data-quality rules as rows: dataset, rule, severity, violations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCKER, WARNING, INFO = "BLOCKER", "WARNING", "INFO"
ROWS = "ROWS"


class QualityError(ValueError):
    """A blocker rule was violated."""


def _row_rules(columns: Sequence[str]) -> list[tuple[str, str, Column]]:
    """The rules that apply to a frame with these columns, as (rule, severity, violated)."""
    col = F.col
    rules = [
        (("Total_Turnover",), "NEGATIVE_TURNOVER", BLOCKER, lambda: col("Total_Turnover") < 0),
        (("Trade_Date",), "NULL_TRADE_DATE", BLOCKER, lambda: col("Trade_Date").isNull()),
        (("Total_Volume",), "NEGATIVE_VOLUME", BLOCKER, lambda: col("Total_Volume") < 0),
        (("High", "Low"), "HIGH_BELOW_LOW", BLOCKER, lambda: col("High") < col("Low")),
        (
            ("Total_Volume", "Total_Turnover"), "ZERO_TURNOVER", WARNING,
            lambda: (col("Total_Volume") > 0) & (col("Total_Turnover") == 0),
        ),
    ]
    return [
        (name, severity, violated())
        for needs, name, severity, violated in rules
        if set(needs) <= set(columns)
    ]


def dq_report(df: DataFrame, dataset: str, by: Sequence[str] = (), rows: bool = False) -> DataFrame:
    """Violations of every applicable rule, counted in one aggregate.

    ``by`` splits the counts, e.g. per ``source_id``. EMPTY can only be seen without it: a
    group that has no rows has no group. ``rows`` adds the number of rows, as the rule ROWS.
    """
    rules = _row_rules(df.columns)
    counts = df.groupBy(*by).agg(
        F.count("*").alias("_rows"), *[F.count_if(violated).alias(name) for name, _, violated in rules]
    )
    entries = [("EMPTY", BLOCKER, (F.col("_rows") == 0).cast("bigint"))] if not by else []
    entries += [(name, severity, F.col(name)) for name, severity, _ in rules]
    entries += [(ROWS, INFO, F.col("_rows"))] if rows else []
    listed = F.array(*[
        F.struct(F.lit(n).alias("rule"), F.lit(s).alias("severity"), v.alias("violations"))
        for n, s, v in entries
    ])
    return counts.select(*by, F.lit(dataset).alias("dataset"), F.inline(listed))


def enforce(report: DataFrame) -> DataFrame:
    """Raise if a blocker is violated, else return the violated warnings.

    A report may have a row per source. The error shows the first twenty violated blockers and
    says how many there are in all.
    """
    broken = report.filter((F.col("severity") == BLOCKER) & (F.col("violations") > 0))
    shown = broken.select("dataset", "rule", "violations").orderBy("dataset", "rule", F.desc("violations")).take(20)
    if shown:
        listed = "; ".join(f"{r.dataset}: {r.rule} ({r.violations})" for r in shown)
        raise QualityError(f"{broken.count()} blockers violated: {listed}")
    return report.filter((F.col("severity") == WARNING) & (F.col("violations") > 0))


def blocked_sources(*reports: DataFrame) -> DataFrame:
    """Sources with a violated blocker in any of the per-source reports."""
    broken = None
    for report in reports:
        part = report.filter((F.col("severity") == BLOCKER) & (F.col("violations") > 0))
        part = part.select("source_id", F.concat_ws(": ", "dataset", "rule").alias("reason"))
        broken = part if broken is None else broken.unionByName(part)
    return broken.groupBy("source_id").agg(F.min("reason").alias("reason"))


def dq_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter("row_count > 1")


def dq_foreign_key(df: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Key values without a dimension row, with the number of rows that carry them.

    Counted per key before the join: a frequent orphan is one row there.
    """
    dim_key = dim_key or key
    used = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("row_count"))
    return used.join(dim.select(F.col(dim_key).alias(key)), key, "left_anti")


def key_report(fact: DataFrame, dataset: str, keys: Sequence[str], dims: dict[str, DataFrame]) -> DataFrame:
    """Unique and foreign keys of a fact as report rows; ``dims`` names the dimension of each foreign key."""
    def row(rule, counts):
        return counts.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("violations")).select(
            F.lit(dataset).alias("dataset"), F.lit(rule).alias("rule"), F.lit(BLOCKER).alias("severity"), "violations")

    report = row("PRIMARY_KEY", dq_unique(fact, keys))
    for key, dim in dims.items():
        report = report.unionByName(row(f"FOREIGN_KEY_{key}", dq_foreign_key(fact, dim, key)))
    return report


def dq_missing_dim(staging: DataFrame, commodities: DataFrame) -> DataFrame:
    """Staged codes that the commodity dimension does not know."""
    return dq_foreign_key(staging, commodities, "Comm", "Comm_Code")


def dq_volatility(session: DataFrame, pct: float = 0.20) -> DataFrame:
    """Sessions whose close moved by more than ``pct`` since the contract's previous session.

    Sessions are first brought to one row per contract and date, so a window group has at
    most one row per calendar day however many sources or ticks a contract has.
    """
    daily = session.groupBy("Comm", "Trade_Date").agg(F.max_by("Close", "source_id").alias("Close"))
    by_date = Window.partitionBy("Comm").orderBy("Trade_Date")
    moved = daily.withColumn("Prev_Close", F.lag("Close").over(by_date))
    return large_moves(moved, pct)


def large_moves(moved: DataFrame, pct: float) -> DataFrame:
    """Rows whose ``Close`` differs from ``Prev_Close`` by more than ``pct``, with the change."""
    change = F.try_divide(F.col("Close") - F.col("Prev_Close"), F.col("Prev_Close"))
    return moved.withColumn("Change", change).filter(F.abs("Change") > pct)


def volatility_report(session: DataFrame, dataset: str, pct: float = 0.20) -> DataFrame:
    """:func:`dq_volatility` as warning rows per source."""
    moved = dq_volatility(session, pct).select("Comm", "Trade_Date")
    flagged = session.select("source_id", "Comm", "Trade_Date").join(moved, ["Comm", "Trade_Date"], "left_semi")
    return flagged.groupBy("source_id").agg(F.count("*").alias("violations")).select(
        "source_id", F.lit(dataset).alias("dataset"), F.lit("VOLATILITY").alias("rule"),
        F.lit(WARNING).alias("severity"), "violations",
    )
