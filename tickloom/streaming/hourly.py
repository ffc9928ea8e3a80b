"""One-hour tumbling statistics of a tick stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions import hour_of, turnover

KEYS = ("source_id", "Comm", "Trade_Date", "Hour")


def event_time() -> Column:
    """``Trade_Date`` and ``Log_Time`` as an instant, read as UTC."""
    day = F.make_date(
        F.floor(F.col("Trade_Date") / 10000).cast("int"),
        (F.floor(F.col("Trade_Date") / 100) % 100).cast("int"),
        (F.col("Trade_Date") % 100).cast("int"),
    )
    time = F.col("Log_Time")
    second = F.floor(time / 10000) * 3600 + F.floor(time / 100) % 100 * 60 + time % 100
    return F.timestamp_seconds(F.unix_date(day) * 86400 + second)


def hourly_stats_stream(ticks: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Hourly statistics in event time; the state of an hour goes once ``lateness`` has passed.

    Trade date stays a key of its own: a night session can trade past midnight. The hour is the
    one that the batch roll-up gives. Ticks that come later than ``lateness`` are left out;
    :func:`late_ticks` counts them.
    """
    windowed = (
        ticks.withColumns({"_at": event_time(), "Turnover": turnover()})
        .withWatermark("_at", lateness)
        .withColumn("Hour", hour_of())
        .groupBy("source_id", "Comm", "Trade_Date", "Hour", F.window("_at", "1 hour").alias("_window"))
        .agg(
            F.sum("Volume").alias("Total_Volume"),
            F.sum("Turnover").alias("Total_Turnover"),
            F.min("Price").alias("Low"),
            F.max("Price").alias("High"),
        )
    )
    return windowed.drop("_window")


def late_ticks(query: StreamingQuery) -> int:
    """Rows that the watermark has left out so far, by the progress the query keeps.

    A tick counts once per partial aggregate it would have joined, so this is the number of
    late groups per batch, and 0 only if nothing was late.
    """
    states = [state for progress in query.recentProgress for state in progress["stateOperators"]]
    return sum(int(state["numRowsDroppedByWatermark"]) for state in states)


def upsert_sink(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer for update mode: each batch is a partition of its own.

    A replayed batch overwrites its partition. Rows go from the tasks to files; no result
    passes through the driver as it would with a memory sink.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def read_upserts(spark: SparkSession, path: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """The latest version of every key in an upsert table."""
    rows = spark.read.parquet(path)
    values = [name for name in rows.columns if name not in (*keys, "batch_id")]
    return rows.groupBy(*keys).agg(*[F.max_by(name, "batch_id").alias(name) for name in values])
