"""Incremental ingest of zipped logs as they land."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tickloom.plans.load import _utc_now, load_archives
from tickloom.plans.warehouse import Warehouse
from tickloom.sources.zips import SOURCE_PATTERN, ZIP_SCHEMA, source_id_of, unzip_ticks


def batch_loader(
    wh: Warehouse, columns: list[str] | None = None, first_load_id: int = 1, pattern: str = SOURCE_PATTERN,
    stream: str = "ingest",
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that loads the archives whose paths a micro-batch has.

    The batch is a load of its own, with the load id ``first_load_id`` plus its number, and a transaction by the
    name of the stream and that number: run again, it leaves ledger, job log and facts as running it once does.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        started = _utc_now()
        # One row per archive of the batch, the work list of the load.
        ids = sorted({row[0] for row in batch.select(source_id_of(batch["path"], pattern)).collect()})
        if ids:
            parsed = unzip_ticks(batch, columns, "quarantine", pattern, timings=True)
            load_archives(wh, ids, parsed, first_load_id + batch_id, started, txn=f"{stream}/{batch_id}")

    return load


def ingest_stream(
    spark: SparkSession, landing: str, wh: Warehouse, checkpoint: str,
    columns: list[str] | None = None, files_per_batch: int | None = None,
    first_load_id: int = 1, pattern: str = SOURCE_PATTERN, stream: str = "ingest",
    loader: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Load every archive that is new since the last run: staging, facts, ledger and job log.

    An archive is one source and lands in one micro-batch (see :func:`batch_loader`). ``stream`` names the
    transactions; two streams into one warehouse, or one with a new checkpoint, need different names.
    ``loader`` takes the batches instead of what the other arguments describe.
    """
    archives = spark.readStream.format("binaryFile").schema(ZIP_SCHEMA).option("pathGlobFilter", "*.zip")
    if files_per_batch:
        archives = archives.option("maxFilesPerTrigger", files_per_batch)
    return (
        archives.load(landing)
        .select("path")
        .writeStream.foreachBatch(loader or batch_loader(wh, columns, first_load_id, pattern, stream))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
