"""Parquet tables under one root, and the sinks that write them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.operators import ledger
from tickloom.schemas import FILE_STATUS_LOG, JOB_LOG, LEDGER_STATE, TABLES
from tickloom.session import empty_frame


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append rows; a failed job leaves no partial file behind."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def append_jdbc(df: DataFrame, url: str, table: str, batch_rows: int = 2000, **properties: str) -> None:
    """Append to a database table in batches of ``batch_rows``."""
    df.write.jdbc(url, table, mode="append", properties={"batchsize": str(batch_rows), **properties})


def replace_by_source(
    df: DataFrame, path: str, keys: Sequence[str] = ("source_id",), written: Observation | None = None
) -> None:
    """Replace the rows of every source in ``df`` and keep all other sources.

    Only partitions that occur in ``df`` are overwritten, so a repeated load gives the same
    table and an empty frame changes nothing. The rebalance hint gathers a source into few
    files and lets AQE split one that is too big for a task. ``written`` takes the number of rows,
    ``rows``, as they are written.
    """
    gathered = df.hint("rebalance", *keys)
    if written is not None:
        gathered = gathered.observe(written, F.count(F.lit(1)).alias("rows"))
    (
        gathered.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def save_mart(df: DataFrame, path: str) -> None:
    """Write a query result as a table, dropping its previous contents."""
    df.write.mode("overwrite").parquet(path)


def save_mart_table(df: DataFrame, name: str) -> None:
    """The same as a catalog table."""
    df.write.mode("overwrite").saveAsTable(name)


def absent_files(spark: SparkSession, paths: Iterable[str]) -> set[str]:
    """Those of the paths at which the file system has nothing; one look per path."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def missing(path: str) -> bool:
        where = jvm.org.apache.hadoop.fs.Path(path)
        return not where.getFileSystem(conf).exists(where)

    return {path for path in paths if missing(path)}


class Warehouse:
    """Named tables below ``root``; a table that was never written reads as empty.

    The ledger and the job log only ever grow. They are written under an *era*, and a snapshot folds the
    ledger up to an era into one row per file (:meth:`snapshot_ledger`). So the state of the files is the last
    snapshot and the transitions of the one era after it, however long the history is.
    """

    #: Files in the era of the ledger at which a load takes a snapshot.
    files_per_era = 64

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _at(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def listing(self, name: str) -> list[str]:
        """Names in the folder of a table, without a job; nothing if there is no such folder."""
        files, where = self._at(self.path(name))
        return sorted(entry.getPath().getName() for entry in files.listStatus(where)) if files.exists(where) else []

    def remove(self, name: str) -> None:
        files, where = self._at(self.path(name))
        files.delete(where, True)

    def partitions(self, name: str) -> list[str]:
        """Values of the first partition column that a table has folders of."""
        return [entry.split("=", 1)[1] for entry in self.listing(name) if "=" in entry]

    def complete(self, name: str) -> list[int]:
        """Numbers of the finished versions ``<name>/<key>=<number>``; one being written has no mark yet."""
        numbers = sorted(int(entry.split("=", 1)[1]) for entry in self.listing(name) if "=" in entry)
        key = {"ledger_snapshot": "era", "fact_manifest": "version"}[name]
        return [n for n in numbers if "_SUCCESS" in self.listing(f"{name}/{key}={n}")]

    def table(self, name: str) -> DataFrame:
        return self.read(name, TABLES[name][0])

    def read(self, name: str, schema: StructType) -> DataFrame:
        files, where = self._at(self.path(name))
        if not files.exists(where):
            return empty_frame(self.spark, schema)
        return self.spark.read.schema(schema).parquet(self.path(name)).select(*schema.names)

    def append(self, name: str, df: DataFrame) -> None:
        schema, partition_by = TABLES[name]
        if partition_by == ("era",):
            append_table(df.select(*schema.names), f"{self.path(name)}/era={self.era()}")
        else:
            append_table(df.select(*schema.names), self.path(name), partition_by)

    def replace(self, name: str, df: DataFrame, written: Observation | None = None) -> None:
        """Replace the partitions that occur in ``df``, a source of staging for example."""
        schema, partition_by = TABLES[name]
        if not partition_by or partition_by == ("era",):
            raise ValueError(f"{name} is not partitioned by its rows")
        replace_by_source(df.select(*schema.names), self.path(name), partition_by, written)

    def clear(self, name: str, sources: Iterable[int]) -> None:
        """Remove the rows of sources from a table partitioned by source first.

        For sources that are about to be loaded again: what they no longer have must not stay. One
        listing finds which of them have rows.
        """
        there = set(self.partitions(name))
        for source in sources:
            if str(int(source)) in there:
                self.remove(f"{name}/source_id={int(source)}")

    # -- ledger ----------------------------------------------------------------------------

    def era(self) -> int:
        """The era that is written now: the one after the last snapshot."""
        return max(self.complete("ledger_snapshot"), default=0) + 1

    def ledger_state(self) -> DataFrame:
        """One row per file: the last snapshot and the transitions since, folded."""
        era = self.era()
        since = ledger.transition_states(self.read(f"file_status_log/era={era}", FILE_STATUS_LOG))
        if era == 1:
            return ledger.fold_states(since)
        return ledger.fold_states(self.read(f"ledger_snapshot/era={era - 1}", LEDGER_STATE).unionByName(since))

    def snapshot_ledger(self) -> None:
        """Fold the ledger up to now and begin a new era. The snapshot counts once it is written in full;
        the one before it stays until the next."""
        era = self.era()
        self.ledger_state().repartitionByRange("file_id").write.mode("overwrite").parquet(self.path(f"ledger_snapshot/era={era}"))
        for old in self.complete("ledger_snapshot"):
            if old < era - 1:
                self.remove(f"ledger_snapshot/era={old}")

    def snapshot_when_due(self) -> None:
        if len(self.listing(f"file_status_log/era={self.era()}")) >= self.files_per_era:
            self.snapshot_ledger()

    def log_jobs(self, *entries: DataFrame) -> None:
        """Append job-log entries, numbered from the highest number on, frame by frame. One writer at a time.

        Numbers grow with eras, so the highest is in the last one.
        """
        eras = sorted(map(int, self.partitions("etl_job_logs")))
        last = self.read(f"etl_job_logs/era={eras[-1]}", JOB_LOG).agg(F.max("log_id")).first()[0] if eras else None
        # A load has a few entries per file, all known to the driver; they need no distributed numbering.
        order = ("execution_time", "run_id", "file_id", "task_id", "status", "row_count", "error_message")
        place = lambda row: [(row[c] is not None, row[c]) if row[c] is not None else (False,) for c in order]
        rows = [row for frame in entries for row in sorted(frame.select(*JOB_LOG.names[1:]).collect(), key=place)]
        numbered = [(i, *row) for i, row in enumerate(rows, start=(last or 0) + 1)]
        if numbered:
            self.append("etl_job_logs", self.spark.createDataFrame(numbered, JOB_LOG).coalesce(1))

    def mart(self, name: str, df: DataFrame) -> None:
        save_mart(df, self.path(name))
