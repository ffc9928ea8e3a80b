"""Ordered operations on groups or frames that may be far larger than one task.

A window over a whole frame, or over a key that owns a third of the rows, runs in a single
task. Here the rows are cut into range slices first. The slice number is materialised with
the rows, because a recomputed range exchange may draw its cuts elsewhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.session import materialise


def _sliced(df: DataFrame, by: list, label: str) -> DataFrame:
    # No slice count is given, so AQE merges slices that turn out small; they stay contiguous.
    ranged = df.repartitionByRange(*by)
    return materialise(ranged.withColumn("_slice", F.spark_partition_id()), label)


def number_rows(df: DataFrame, order: Sequence[str], name: str, start: int | Column = 0) -> DataFrame:
    """Consecutive numbers from ``start + 1`` in the order of columns that are unique together.

    Rows are numbered inside their slice; the window that spans slices sees one row each.
    """
    ranged = _sliced(df, [*order], "numbered")
    sizes = ranged.groupBy("_slice").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_slice", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    start = start if isinstance(start, Column) else F.lit(start)
    # One row per slice, so the broadcast is bounded by the number of shuffle partitions.
    return (
        ranged.withColumn("_row", F.row_number().over(Window.partitionBy("_slice").orderBy(*order)))
        .join(F.broadcast(offsets), "_slice")
        .withColumn(name, (start + F.col("_offset") + F.col("_row")).cast("int"))
        .drop("_slice", "_row", "_offset")
    )


def with_previous(
    df: DataFrame, key: str, order: Sequence[str], value: str, name: str, at: str | None = None
) -> DataFrame:
    """``lag(value)`` per key, for keys of any size.

    The ``order`` columns are unique together within the key; none of them may be null. Each
    slice of a key looks back inside itself, and its first row takes the last value of the
    key's previous slice. One aggregate gives the last value of every key in every slice. Slices
    are consecutive ranges of (key, order), so fewer keys than there are slices span two of
    them, and the broadcast has at most two rows per slice.

    ``at`` names a column of numbers in the same order as ``order``. With it, and a numeric
    ``value``, the aggregate hashes; without, it sorts.
    """
    ranged = _sliced(df, [key, *order], "ordered")
    within = Window.partitionBy(key, "_slice").orderBy(*order)
    across = Window.partitionBy(key).orderBy("_slice")
    ends = ranged.groupBy(key, "_slice").agg(F.max_by(value, at or F.struct(*order)).alias("_end"))
    carried = ends.select(
        key, "_slice", F.lag("_end").over(across).alias("_carried"),
        F.count("*").over(Window.partitionBy(key)).alias("_slices"),
    ).filter("_slices > 1").drop("_slices")
    return (
        ranged.withColumns({"_row": F.row_number().over(within), "_before": F.lag(value).over(within)})
        .join(F.broadcast(carried), [key, "_slice"], "left")
        .withColumn(name, F.when(F.col("_row") == 1, F.col("_carried")).otherwise(F.col("_before")))
        .drop("_slice", "_row", "_before", "_carried")
    )
