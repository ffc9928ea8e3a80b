"""Inputs of the registered queries, derived by Spark from the provided tables.

The provided data is clean. Frames called *planted* or *dirty* break it by rule, over the
whole table, so that filters, quality rules and quarantine have something to find.
"""

from __future__ import annotations

import contextlib
import itertools
import posixpath
import sys
import zipfile

import pandas as pd
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import dims, rollups
from tickloom.operators.ticks import valid_ticks
from tickloom.paths import arrow_path
from tickloom.schemas import DIM_COMMODITY, DIM_DATE, TICK_COLUMNS
from tickloom.session import empty_frame, materialise, scratch_path
from tickloom.sources import block_trades, status_log_from_orders, ticks_from_events

register_pickle_by_value(sys.modules[__name__])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_from_events(table(spark, sf_dir, "events"))


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_ticks(raw_ticks(spark, sf_dir))


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_trades(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"))


def status_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status_log_from_orders(table(spark, sf_dir, "orders"))


def planted_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks with zero, negative, NaN and null prices and null codes among them."""
    kind = F.col("seq") % 20
    price = (
        F.when(kind == 0, F.lit(0.0))
        .when(kind == 1, -F.col("Price"))
        .when(kind == 2, F.lit(float("nan")))
        .when(kind == 3, F.lit(None).cast("double"))
        .otherwise(F.col("Price"))
    )
    code = F.when(kind != 4, F.col("Comm"))
    return raw_ticks(spark, sf_dir).withColumns({"Price": price, "Comm": code})


def coded_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks under many codes: one per event type and user."""
    events = table(spark, sf_dir, "events")
    code = F.concat_ws("-", "event_type", F.col("user_id").cast("string"))
    return valid_ticks(ticks_from_events(events.withColumn("event_type", code)))


def dirty_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly staging with negative volumes, zero prices, missing dates and swapped bounds."""
    rows = raw_ticks(spark, sf_dir).withColumns({
        "Volume": F.col("Volume") - 30,
        "Price": F.when(F.col("seq") % 7 == 0, 0.0).otherwise(F.col("Price")),
        "Trade_Date": F.when(F.col("seq") % 97 != 0, F.col("Trade_Date")),
    })
    swap = F.col("Hour") == 13
    return rollups.hourly_stats(rows).withColumns({
        "Low": F.when(swap, F.col("High")).otherwise(F.col("Low")),
        "High": F.when(swap, F.col("Low")).otherwise(F.col("High")),
    })


def commodity_dim(staging: DataFrame) -> DataFrame:
    """The commodity dimension of a staging table, stored like any dimension."""
    empty = empty_frame(staging.sparkSession, DIM_COMMODITY)
    return materialise(dims.sync_commodity_dim(empty, staging), "dim_commodity")


def date_dim(staging: DataFrame) -> DataFrame:
    empty = empty_frame(staging.sparkSession, DIM_DATE)
    return materialise(dims.sync_date_dim(empty, staging), "dim_date")


def staged(df: DataFrame) -> DataFrame:
    """A roll-up as a stored staging table."""
    return materialise(df, "staging")


# -- files ---------------------------------------------------------------------------

LOG_HEADER = ",".join(TICK_COLUMNS)


def _log_line(mended: bool = False) -> list:
    """A log line; some lines broken by rule, unless ``mended``."""
    kind = F.col("seq") % 50
    price = F.format_string("%.2f", "Price")
    line = F.concat_ws(
        ",", "Comm", "Contract_Type", F.col("Trade_Date").cast("string"),
        F.lpad(F.col("Log_Time").cast("string"), 6, "0"), price, F.col("Volume").cast("string"),
    )
    at = lambda time: F.concat_ws(
        ",", "Comm", "Contract_Type", F.col("Trade_Date").cast("string"), F.lit(time), price, F.lit("1"))
    if mended:
        return line
    return (
        F.when(kind == 0, F.concat(line, F.lit(",surplus")))
        .when(kind == 1, F.concat_ws(",", "Comm", "Contract_Type", F.col("Trade_Date").cast("string")))
        .when(kind == 2, F.concat_ws(",", "Comm", "Contract_Type", F.lit("yesterday"), F.lit("090000"), price, F.lit("1")))
        .when(kind == 3, F.concat(F.lit("NA"), F.substring(line, F.length("Comm") + 1, F.length(line))))
        .when(kind == 4, at("93015123"))
        .when(kind == 5, at("999999"))
        .when(kind == 6, at("250000"))
        .when(kind == 7, F.concat_ws(",", "Comm", "Contract_Type", F.col("Trade_Date").cast("string"), F.lit("090000"), price, F.lit("-3")))
        .otherwise(line)
    )


def csv_landing(spark: SparkSession, sf_dir: str) -> str:
    """The events as text logs, a folder per source."""
    path = scratch_path(spark, "logs")
    lines = raw_ticks(spark, sf_dir).select(_log_line().alias("value"), "source_id")
    lines.write.option("header", False).partitionBy("source_id").text(path)
    return path


def _put(path: str, content: bytes) -> None:
    filesystem, inner = arrow_path(path)
    filesystem.create_dir(posixpath.dirname(inner), recursive=True)
    with filesystem.open_output_stream(inner) as out:
        out.write(content)


def _write_archives(batches, template: str):
    """Batches of (source_id, line), sources together, as archives written line by line; the ids of those written."""
    with contextlib.ExitStack() as opened:
        member, now = None, None
        for batch in batches:
            ids = batch.column("source_id").to_pylist()
            lines = batch.column("line").to_pylist()
            for file_id, rows in itertools.groupby(zip(ids, lines, strict=True), key=lambda pair: pair[0]):
                if member is None or file_id != now:
                    opened.close()
                    now = file_id
                    filesystem, path = arrow_path(template.format(id=file_id))
                    filesystem.create_dir(posixpath.dirname(path), recursive=True)
                    out = opened.enter_context(filesystem.open_output_stream(path))
                    archive = opened.enter_context(zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED))
                    archive.writestr(zipfile.ZipInfo("readme.md"), "not a log")
                    info = zipfile.ZipInfo(f"{file_id}.csv")
                    info.compress_type = zipfile.ZIP_DEFLATED
                    member = opened.enter_context(archive.open(info, "w", force_zip64=True))
                    member.write(f"{LOG_HEADER}\n".encode())
                    yield pa.RecordBatch.from_arrays([pa.array([file_id], pa.int32())], ["file_id"])
                member.write("".join(line + "\n" for _, line in rows).encode())


def write_archives(ticks: DataFrame, template: str, mended: bool = False) -> list[int]:
    """Ticks as zipped logs, one archive per source at its path; returns the ids, as many as archives."""
    lines = ticks.select("source_id", "seq", _log_line(mended).alias("line"))
    # Sorted by Spark, which spills; a task holds one batch of lines.
    lines = lines.repartition("source_id").sortWithinPartitions("source_id", "seq").select("source_id", "line")
    written = lines.mapInArrow(lambda batches: _write_archives(batches, template), "file_id int")
    return [row.file_id for row in written.collect()]


def write_damaged(spark: SparkSession, path: str) -> None:
    """A file that is no archive."""
    def write(rows: pd.DataFrame) -> pd.DataFrame:
        _put(path, b"no archive")
        return rows

    spark.range(1).groupBy("id").applyInPandas(write, "id long").collect()


def zip_landing(spark: SparkSession, sf_dir: str, name: str = "{id}.zip") -> tuple[str, list[int]]:
    """The events as zipped logs: their folder and the file ids, one archive per source."""
    landing = scratch_path(spark, "archives")
    return landing, write_archives(raw_ticks(spark, sf_dir), f"{landing}/{name}")
