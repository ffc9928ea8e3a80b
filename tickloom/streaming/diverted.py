"""Hourly statistics of a tick stream that loses no tick: late ones are set aside as rows.

Spark's own windowed aggregate drops what comes behind the watermark and can only count it. Here each micro-batch
writes three small tables, a partition per batch: the roll-up of its ticks in time, the ticks that came
after their hour was closed, and the mark, the latest event time so far. An hour is closed once it ended ``lateness``
or more before the mark of the *earlier* batches, so a batch that is run again decides as it did before and
overwrites what it wrote. No state is held between batches: partial roll-ups of an hour are merged when read.

Roll-ups of many batches are folded into a base by :meth:`HourlyTable.compact`.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tickloom.operators import rollups
from tickloom.plans.warehouse import Warehouse
from tickloom.schemas import STG_HOURLY_STATS, TICK
from tickloom.streaming.hourly import event_time

_MARK = StructType([StructField("mark", LongType())])
_LAST = StructType([StructField("last_at", LongType())])
_BATCH = StructField("batch_id", LongType())


class HourlyTable:
    """Hours and late ticks below ``path``; a batch counts once its mark is written, which is last."""

    def __init__(self, spark: SparkSession, path: str, lateness: timedelta = timedelta(days=1)):
        self.store = Warehouse(spark, path)
        self.spark = spark
        self.lateness = int(lateness.total_seconds())

    def batches(self) -> list[int]:
        """Numbers of the batches that are written in full."""
        numbers = sorted(map(int, self.store.partitions("marks")))
        return [n for n in numbers if "_SUCCESS" in self.store.listing(f"marks/batch_id={n}")]

    def mark(self, before: int | None = None) -> int | None:
        """The latest event time, in seconds, of all batches, or of those before one."""
        earlier = [n for n in self.batches() if before is None or n < before]
        return self.store.read(f"marks/batch_id={earlier[-1]}", _MARK).first()["mark"] if earlier else None

    def writer(self) -> Callable[[DataFrame, int], None]:
        """A ``foreachBatch`` function for valid ticks."""

        def write(batch: DataFrame, batch_id: int) -> None:
            mark = self.mark(before=batch_id)
            rows = batch.withColumn("_at", F.unix_seconds(event_time()))
            hour_end = (F.floor(F.col("_at") / 3600) + 1) * 3600
            late = F.lit(False) if mark is None else F.coalesce(hour_end <= mark - self.lateness, F.lit(False))
            rolled = rollups.hourly_stats(rows.filter(~late), latest="_at")
            self._put("hours", batch_id, rolled.select(*STG_HOURLY_STATS.names, F.col("_at").alias("last_at")))
            self._put("late", batch_id, rows.filter(late).select(*TICK.names))
            # From the few rows just written; late ticks are older than the mark in any case.
            found = self.store.read(f"hours/batch_id={batch_id}", _LAST).agg(F.max("last_at")).first()[0]
            marks = [m for m in (mark, found) if m is not None]
            self._put("marks", batch_id, self.spark.createDataFrame([(max(marks, default=None),)], _MARK).coalesce(1))

        return write

    def _put(self, name: str, batch_id: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(self.store.path(f"{name}/batch_id={batch_id}"))

    def _base(self) -> int:
        """The last batch that a finished base has; -1 without one."""
        bases = sorted(map(int, self.store.partitions("base")))
        return max((n for n in bases if "_SUCCESS" in self.store.listing(f"base/upto={n}")), default=-1)

    def _since(self, name: str, schema: StructType, after: int = -1) -> DataFrame:
        last = max(self.batches(), default=-1)
        rows = self.store.read(name, StructType([*schema.fields, _BATCH]))
        return rows.filter((F.col("batch_id") > after) & (F.col("batch_id") <= last)).drop("batch_id")

    def hours(self) -> DataFrame:
        """The statistics of every hour over the ticks that came in time."""
        base = self._base()
        parts = [self._since("hours", STG_HOURLY_STATS, base)]
        if base >= 0:
            parts.append(self.store.read(f"base/upto={base}", STG_HOURLY_STATS))
        return rollups.merge_hourly(*parts)

    def late(self) -> DataFrame:
        """The ticks that came after their hour was closed."""
        return self._since("late", TICK)

    def corrected(self) -> DataFrame:
        """The statistics of every hour over all ticks, as a batch roll-up gives them."""
        return rollups.merge_hourly(self.hours(), rollups.hourly_stats(self.late()).select(*STG_HOURLY_STATS.names))

    def compact(self) -> None:
        """Fold the roll-ups of all batches into one base.

        What it replaces stays until the next compaction, for queries that were planned before.
        """
        upto, base = max(self.batches(), default=-1), self._base()
        if upto <= base:
            return
        self.hours().write.mode("overwrite").parquet(self.store.path(f"base/upto={upto}"))
        for old in map(int, self.store.partitions("base")):
            if old < base:
                self.store.remove(f"base/upto={old}")
        for old in map(int, self.store.partitions("hours")):
            if old <= base:
                self.store.remove(f"hours/batch_id={old}")
