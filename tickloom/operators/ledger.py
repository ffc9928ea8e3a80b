"""File ledger, job log and service levels.

The ledger is append-only: each status change is a row, the current state a fold over them.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import ledger_order
from tickloom.operators.sequences import number_rows, with_previous
from tickloom.schemas import FILE_STATUS_LOG, JOB_ENTRY, LEDGER_STATE

STATUSES = ("PENDING", "PROCESSING", "SUCCESS", "FAILED")
FIRST_FILE_ID = 6076

# Status before -> statuses allowed after it; None is a file's first row.
# Back to PENDING is a requested backfill.
LEGAL_TRANSITIONS = {
    None: ("PENDING",),
    "PENDING": ("PROCESSING",),
    "PROCESSING": ("SUCCESS", "FAILED"),
    "SUCCESS": ("PENDING",),
    "FAILED": ("PENDING",),
}


def file_status(log: DataFrame) -> DataFrame:
    """Current state of every file.

    Status goes through the aggregate as its position in STATUSES: a numeric buffer keeps
    the fold a HashAggregate.
    """
    at = ledger_order()
    code = F.array_position(F.array(*map(F.lit, STATUSES)), F.col("status")).cast("int")
    folded = log.groupBy("file_id").agg(
        F.max_by(code, at).alias("_code"),
        F.min("changed_at").alias("created_at"),
        F.max("changed_at").alias("updated_at"),
        F.max_by("etl_sec", at).alias("etl_sec"),
        F.count_if(F.col("status") == "FAILED").alias("retry_count"),
    )
    names = F.array(*map(F.lit, STATUSES))
    return folded.select(
        "file_id", F.get(names, F.col("_code") - 1).alias("status"),
        "created_at", "updated_at", "etl_sec", "retry_count",
    )


def transition_states(log: DataFrame) -> DataFrame:
    """Every transition as the state it would be if it were the file's only one."""
    at, done = ledger_order(), F.col("status") == "SUCCESS"
    return log.select(
        "file_id", at.alias("last_at"), F.array_position(F.array(*map(F.lit, STATUSES)), F.col("status")).cast("int").alias("code"),
        "etl_sec", F.col("changed_at").alias("created_at"), F.col("changed_at").alias("updated_at"),
        (F.col("status") == "FAILED").cast("bigint").alias("retry_count"), F.col("segment").alias("open_segment"),
        F.when(done, at).alias("ok_at"), F.when(done, F.col("load_id")).alias("load_id"),
        F.when(done, F.coalesce("segment", F.col("load_id").cast("string"))).alias("segment"),
    ).select(*LEDGER_STATE.names)


def fold_states(states: DataFrame) -> DataFrame:
    """One state per file from any number of partial ones, in any order: snapshots and later transitions alike."""
    last = lambda name: F.max_by(name, "last_at").alias(name)
    ok = lambda name: F.max_by(name, "ok_at").alias(name)
    return states.groupBy("file_id").agg(
        F.max("last_at").alias("last_at"), last("code"), last("etl_sec"), F.min("created_at").alias("created_at"),
        F.max("updated_at").alias("updated_at"), F.sum("retry_count").alias("retry_count"), last("open_segment"),
        F.max("ok_at").alias("ok_at"), ok("load_id"), ok("segment"),
    ).select(*LEDGER_STATE.names)


def status_of(states: DataFrame) -> DataFrame:
    """The columns of :func:`file_status` from folded states."""
    names = F.array(*map(F.lit, STATUSES))
    return states.select(
        "file_id", F.get(names, F.col("code") - 1).alias("status"), "created_at", "updated_at", "etl_sec", "retry_count")


def pending_files(status: DataFrame, n: int = 1) -> DataFrame:
    """The ``n`` pending files with the smallest ids."""
    return status.filter(F.col("status") == "PENDING").select("file_id").orderBy("file_id").limit(n)


def retryable_files(status: DataFrame, max_retries: int = 3) -> DataFrame:
    """Failed files with attempts left."""
    return status.filter((F.col("status") == "FAILED") & (F.col("retry_count") < max_retries)).select(
        "file_id", "retry_count"
    )


def next_file_id(log: DataFrame, seed: int = FIRST_FILE_ID - 1) -> DataFrame:
    """One row: the id after the highest known one."""
    return log.agg((F.coalesce(F.max("file_id"), F.lit(seed)) + 1).cast("int").alias("file_id"))


def transitions(
    files: DataFrame, status: Column | str, at: datetime, etl_sec: Column | int = 0,
    load_id: int | None = None, step: int = 0, segment: str | None = None, txn: str | None = None,
) -> DataFrame:
    """Ledger rows that move each ``file_id`` of ``files`` to a status.

    ``step`` orders transitions that share a timestamp. ``segment`` is where the attempt's facts are.
    """
    status = F.lit(status) if isinstance(status, str) else status
    etl_sec = F.lit(etl_sec) if isinstance(etl_sec, int) else etl_sec
    return files.select(
        F.col("file_id").cast("int").alias("file_id"),
        status.alias("status"),
        F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz").alias("changed_at"),
        etl_sec.cast("int").alias("etl_sec"),
        F.lit(step).cast("bigint").alias("seq"),
        F.lit(load_id).cast("bigint").alias("load_id"),
        F.lit(segment).cast("string").alias("segment"),
        F.lit(txn).cast("string").alias("txn"),
    ).select(*FILE_STATUS_LOG.names)


def seed_next(log: DataFrame, at: datetime, seed: int = FIRST_FILE_ID - 1) -> DataFrame:
    """The PENDING row of the next file."""
    return transitions(next_file_id(log, seed), "PENDING", at)


def opening_moves(
    spark: SparkSession, ids: Iterable[int], status: dict[int, str], at: datetime, load_id: int,
    segment: str | None = None, txn: str | None = None,
) -> DataFrame:
    """The ledger rows that bring every file of a load to PROCESSING by legal steps.

    ``status`` has that of known files. A file that is not PENDING is requested first; one that
    a crashed load left PROCESSING has failed before that. Steps 0 to 2 order the rows.
    """
    rows = []
    for i in dict.fromkeys(ids):
        if status.get(i) == "PROCESSING":
            rows.append((i, "FAILED", at, 0, 0, None, None, txn))
        if status.get(i) != "PENDING":
            rows.append((i, "PENDING", at, 0, 1, None, None, txn))
        rows.append((i, "PROCESSING", at, 0, 2, load_id, segment, txn))
    return spark.createDataFrame(rows, FILE_STATUS_LOG).coalesce(1)


def request_backfill(log: DataFrame, ids: list[int], at: datetime) -> DataFrame:
    """PENDING rows that send known files through the load again."""
    known = log.filter(F.col("file_id").isin(*ids)).select("file_id").distinct()
    return transitions(known, "PENDING", at)


def illegal_transitions(log: DataFrame) -> DataFrame:
    """Status changes the state machine does not allow.

    A file with very many transitions is looked at slice by slice. A status that is none of
    STATUSES shows as UNKNOWN in the row after it. Status and order travel as numbers.
    """
    names = F.array(*map(F.lit, STATUSES))
    changes = log.select(
        "file_id", "status", "changed_at", "seq",
        F.array_position(names, F.col("status")).cast("int").alias("_code"), ledger_order().alias("_at"))
    moves = with_previous(changes, "file_id", ["changed_at", "seq"], "_code", "_prev", "_at")
    before = F.when(F.col("_prev") > 0, F.get(names, F.col("_prev") - 1)).when(F.col("_prev") == 0, "UNKNOWN")
    moves = moves.withColumn("prev_status", before)
    legal = F.lit(False)
    for before, after in LEGAL_TRANSITIONS.items():
        known = F.col("prev_status").isNull() if before is None else F.col("prev_status") == before
        legal = legal | (known & F.col("status").isin(*after))
    return moves.filter(~F.coalesce(legal, F.lit(False))).select(
        "file_id", "changed_at", "seq", "prev_status", "status"
    )


def sla_report(
    log: DataFrame, max_sec: int = 120, deadline_hour: int = 8, timezone: str = "UTC"
) -> DataFrame:
    """Alert level of every finished run.

    A failure is CRITICAL and is not checked further. Otherwise a run longer than
    ``max_sec``, or finished at or after ``deadline_hour`` in ``timezone``, is a WARNING.
    Ledger times are UTC wall clock. The hour rule takes any evening run for late; move the
    deadline or the zone to suit the schedule.
    """
    ran = F.col("status") == "SUCCESS"
    local = F.convert_timezone(F.lit("UTC"), F.lit(timezone), F.col("changed_at"))
    slow = F.when(ran, F.col("etl_sec") > max_sec)
    late = F.when(ran, F.hour(local) >= deadline_hour)
    level = F.when(~ran, "CRITICAL").when(slow | late, "WARNING").otherwise("PASS")
    return log.filter(F.col("status").isin("SUCCESS", "FAILED")).select(
        "file_id", "status", F.col("changed_at").alias("finished_at"), "etl_sec",
        slow.alias("too_slow"), late.alias("too_late"), level.alias("level"),
    )


def current_loads(log: DataFrame) -> DataFrame:
    """The last successful load of each source."""
    return (
        log.filter(F.col("status") == "SUCCESS")
        .groupBy(F.col("file_id").alias("source_id"))
        .agg(F.max_by("load_id", ledger_order()).alias("load_id"))
    )


def visible(fact: DataFrame, log: DataFrame) -> DataFrame:
    """Fact rows of each source's current load; older, failed and unfinished loads are hidden.

    The fact is partitioned by exactly these two columns, so the join also prunes files.
    """
    return fact.join(current_loads(log), ["source_id", "load_id"], "left_semi")


def sla_breaches(
    log: DataFrame, load_id: int, at: datetime, max_sec: int = 120, deadline_hour: int = 8, timezone: str = "UTC",
    txn: str | None = None,
) -> DataFrame:
    """Job-log entries, tagged ``SLA``, for the runs of a load that :func:`sla_report` does not pass."""
    runs = sla_report(log.filter(F.col("load_id") == load_id), max_sec, deadline_hour, timezone)
    why = F.concat_ws(", ", F.when(F.col("status") == "FAILED", "failed"), F.when(F.col("too_slow"), "too slow"), F.when(F.col("too_late"), "too late"))
    return runs.filter("level <> 'PASS'").select(
        F.lit("manual").alias("dag_id"), F.lit("sla").alias("task_id"), F.lit(str(load_id)).alias("run_id"),
        F.col("file_id").cast("string").alias("file_id"), "level", F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz").alias("execution_time"),
        F.lit(0).cast("bigint").alias("row_count"), F.concat(F.lit("SLA "), "level", F.lit(": "), why).alias("error_message"),
        F.lit(txn).cast("string").alias("txn"),
    ).withColumnRenamed("level", "status").select(*JOB_ENTRY.names)


def job_entry(
    spark: SparkSession, status: str, at: datetime, dag_id: str = "manual", task_id: str = "manual",
    run_id: str = "manual", file_id=None, row_count: int = 0, error_message: str | None = None, txn: str | None = None,
) -> DataFrame:
    """One job-log row."""
    file_id = None if file_id is None else str(file_id)
    row = (dag_id, task_id, run_id, file_id, status, at, row_count, error_message, txn)
    return spark.createDataFrame([row], JOB_ENTRY)


def with_log_id(entries: DataFrame, after: int = 0) -> DataFrame:
    """Job-log entries with numbers from ``after + 1`` on, in the order they were made.

    Numbers are stored with the entries they were given to (:meth:`Warehouse.log_jobs`), so a
    late entry takes the next number and moves no other. Entries alike in all but their text
    are ordered by that.
    """
    order = ["execution_time", "run_id", "file_id", "task_id", "status", "row_count", "error_message"]
    return number_rows(entries, [c for c in order if c in entries.columns], "log_id", start=after)


def job_report(job_log: DataFrame) -> DataFrame:
    """Runs, rows and last run by status."""
    return job_log.groupBy("status").agg(
        F.count("*").alias("runs"),
        F.sum("row_count").alias("row_count"),
        F.max("execution_time").alias("last_run"),
    )
