"""The tick load and the star load.

A load takes any number of files in one set of jobs. Facts go into a segment of the attempt and
become visible through the ledger's SUCCESS rows, which name it and are written last: a reader sees
either the previous load of a source or the whole new one (:mod:`tickloom.plans.publish`).

What a load knows per *file* (status, seconds, row counts, warnings) is held by the driver, as is the list of
files it was asked for. What grows with ticks or codes stays in tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import dims, facts, marts, quality, rollups
from tickloom.operators.ledger import (
    job_entry,
    opening_moves,
    pending_files,
    sla_breaches,
    status_of,
    transitions,
)
from tickloom.operators.ticks import is_valid, valid_ticks
from tickloom.plans import closes
from tickloom.plans.publish import new_segment, visible_fact, write_facts
from tickloom.plans.warehouse import Warehouse, absent_files
from tickloom.schemas import JOB_ENTRY, TABLES, TICK_COLUMNS
from tickloom.session import materialise
from tickloom.sources.rows import READ_SECONDS, UNKNOWN_HEADER, UNREADABLE_ARCHIVE
from tickloom.sources.zips import pattern_of, read_tick_zips, tick_paths

ABSENT = "no file"
STAGING = ("stg_hourly_stats", "stg_session_summary", "stg_trade_distribution")


def _utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _each(tables: dict, write: Callable) -> None:
    """Run one write per table side by side; the tables do not depend on each other."""
    with ThreadPoolExecutor(len(tables)) as pool:
        for done in [pool.submit(write, name, rows) for name, rows in tables.items()]:
            done.result()


def stage_ticks(wh: Warehouse, ticks: DataFrame) -> DataFrame:
    """Roll usable ticks up into the staging tables, source by source replaced.

    The ticks are read once, into stored cells; the roll-ups come from those. A source that
    violates a blocker rule is left out of all three tables. Returns the stored quality
    report, one row per source, table and rule.
    """
    report, _ = _stage_cells(wh, materialise(rollups.tick_cells(valid_ticks(ticks)), "cells"))
    closes.drop(wh)
    return report


def _stage_cells(wh: Warehouse, cells: DataFrame) -> tuple[DataFrame, list[Row]]:
    """Staging from cells; returns the report, and those rows of it that count anything, a few per source.

    The report also has the rows of every source, under the rule ROWS. Each write counts what it writes, and the
    counts must be those of the report.
    """
    rolled = {
        "stg_hourly_stats": rollups.hourly_from_cells(cells),
        "stg_session_summary": rollups.session_from_cells(cells),
        "stg_trade_distribution": rollups.distribution_from_cells(cells),
    }
    reports = [quality.dq_report(df, name, by=["source_id"], rows=True) for name, df in rolled.items()]
    report = materialise(reduce(DataFrame.unionByName, reports), "quality")
    told = report.filter(F.col("violations") > 0).select("source_id", "dataset", "rule", "severity", "violations").collect()
    blocked = {r["source_id"] for r in told if r["severity"] == quality.BLOCKER}
    written = {name: Observation(name) for name in rolled}

    def write(name: str, df: DataFrame) -> None:
        wh.replace(name, df.filter(~F.col("source_id").isin([*blocked])) if blocked else df, written[name])

    _each(rolled, write)
    for name, seen in written.items():
        expected = sum(r["violations"] for r in told if r["dataset"] == name and r["rule"] == quality.ROWS and r["source_id"] not in blocked)
        if seen.get.get("rows", 0) != expected:
            raise RuntimeError(f"{name}: {seen.get.get('rows', 0)} rows written, {expected} counted")
    return report, told


def _cells_and_bad_lines(parsed: DataFrame) -> DataFrame:
    """Cells of the valid ticks, and every bad line as a row of its own.

    Reason, row number and text of a bad line are group keys, and null for a good one. So
    both come out of the same aggregate, and files are unzipped and parsed a single time.
    """
    bad = F.col("reason").isNotNull()
    blanked = {name: F.when(~bad, F.col(name)) for name in TICK_COLUMNS}
    rows = parsed.withColumns({**blanked, "bad_seq": F.when(bad, F.col("seq"))})
    return rollups.tick_cells(rows.filter(bad | is_valid()), also=("reason", "bad_seq", "line"))


class Staged(NamedTuple):
    """What staging found out, per file of a load: rows staged, why a file failed, seconds, warnings."""

    rows: dict[int, int]
    failed: dict[int, str]
    seconds: dict[int, int]
    warnings: dict[int, list[str]]


def stage_lines(wh: Warehouse, parsed: DataFrame, loaded: Iterable[int] = ()) -> Staged:
    """:func:`stage_ticks` for parsed files, with their bad lines kept in the quarantine.

    Files that cannot be read to the end, or have an unknown header, are not staged at all.
    ``loaded`` are the sources of these files: what is staged or in quarantine of theirs from an
    earlier delivery goes, also where the new one has nothing.
    """
    loaded = [*loaded]
    closes.ensure(wh)
    stored = materialise(_cells_and_bad_lines(parsed), "cells")
    of_files = F.col("reason").isin(UNREADABLE_ARCHIVE, UNKNOWN_HEADER, READ_SECONDS)
    # A row or two per file, but one per line below an unknown header.
    notes = stored.filter(of_files).select("source_id", "reason", F.when(F.col("reason") == READ_SECONDS, F.col("line")).alias("line"))
    failed: dict[int, str] = {}
    seconds: dict[int, float] = {}
    for row in notes.distinct().collect():
        if row["reason"] == READ_SECONDS:
            seconds[row["source_id"]] = seconds.get(row["source_id"], 0) + -(-float(row["line"]) // 1)
        else:
            failed[row["source_id"]] = min(row["reason"], failed.get(row["source_id"], row["reason"]))
    there = set(wh.partitions("stg_session_summary"))
    again = [i for i in loaded if str(i) in there]
    if again:
        closes.forget(wh, again, _staged(wh, "stg_session_summary", again))
    for name in ("quarantine", *STAGING):
        wh.clear(name, loaded)
    bad = stored.filter(F.col("reason").isNotNull() & (F.col("reason") != READ_SECONDS)).withColumnRenamed("bad_seq", "seq")
    cells = stored.filter(F.col("reason").isNull()).drop("reason", "bad_seq", "line")
    with ThreadPoolExecutor(1) as pool:
        quarantined = pool.submit(wh.replace, "quarantine", bad)
        _, told = _stage_cells(wh, cells.filter(~F.col("source_id").isin([*failed])) if failed else cells)
        quarantined.result()
    rows: dict[int, int] = {}
    warned: dict[int, list[str]] = {}
    for source, dataset, rule, severity, n in told:
        if rule == quality.ROWS:
            rows[source] = rows.get(source, 0) + n
        elif severity == quality.BLOCKER:
            failed[source] = min(f"{dataset}: {rule}", failed.get(source, f"{dataset}: {rule}"))
        else:
            warned.setdefault(source, []).append(f"WARNING {dataset} {rule} ({n})")
    good = [i for i in rows if i not in failed]
    if good:
        sessions = _staged(wh, "stg_session_summary", good)
        months = closes.remember(wh, good, sessions)
        for source, n in closes.warnings(wh, sessions, months).collect():
            warned.setdefault(source, []).append(f"WARNING stg_session_summary VOLATILITY ({n})")
    return Staged({i: n for i, n in rows.items() if i not in failed}, failed, {i: int(s) for i, s in seconds.items()}, warned)


def _staged(wh: Warehouse, name: str, ids: Iterable[int] | None) -> DataFrame:
    rows = wh.table(name)
    if ids is None:
        return rows
    # A join prunes the partitions as a list in the filter would, however long the list.
    wanted = wh.spark.createDataFrame([(i,) for i in ids], "source_id int")
    return rows.join(wanted, "source_id", "left_semi")


def sync_dims(wh: Warehouse, sessions: DataFrame) -> None:
    """Add the codes and dates of staged sessions; rows already there stay as they are.

    One look finds which dimensions lack something; on most days none does.
    """
    classes = dims.trader_type_dim(wh.spark)
    known = {name: wh.table(name) for name in ("dim_commodity", "dim_trader_type", "dim_date")}
    lacking = {
        "dim_commodity": dims.new_keys(sessions.select(F.col("Comm").alias("Comm_Code")), known["dim_commodity"], "Comm_Code"),
        "dim_trader_type": dims.new_keys(classes, known["dim_trader_type"], "Trader_Type_Name"),
        "dim_date": dims.new_keys(sessions.select(F.col("Trade_Date").alias("Date_id")), known["dim_date"], "Date_id"),
    }
    looks = [df.limit(1).select(F.lit(name).alias("name")) for name, df in lacking.items()]
    found = {row[0] for row in reduce(DataFrame.unionByName, looks).collect()}
    new_rows = {
        "dim_commodity": lambda: dims.new_commodities(known["dim_commodity"], sessions),
        "dim_trader_type": lambda: lacking["dim_trader_type"],
        "dim_date": lambda: dims.new_dates(known["dim_date"], sessions),
    }
    if found:
        _each({name: new_rows[name] for name in found}, lambda name, find: wh.append(name, find()))


def load_star(
    wh: Warehouse, load_id: int, ids: Iterable[int] | None = None, segment: str | None = None
) -> None:
    """Dimensions, then the three facts, from staging.

    ``ids`` limits the load to some sources and reads only their partitions; by default every
    staged source is loaded anew. The facts are written as one segment, by default the one
    that a SUCCESS row without a segment stands for; what is there under that name is replaced as a whole.
    """
    staged = {name: _staged(wh, name, ids) for name in STAGING}
    sync_dims(wh, staged["stg_session_summary"])

    codes, types = wh.table("dim_commodity"), wh.table("dim_trader_type")
    loaded = {
        "fact_session_summary": facts.fact_session_summary(staged["stg_session_summary"], codes),
        "fact_hourly_stats": facts.with_year(facts.fact_hourly_stats(staged["stg_hourly_stats"], codes)),
        "fact_trade_distribution": facts.fact_trade_distribution(
            staged["stg_trade_distribution"], codes, types
        ),
    }
    load_column = F.lit(load_id).cast("bigint")
    _each(loaded, lambda name, df: write_facts(wh, name, df.withColumn("load_id", load_column), segment or str(load_id)))


KEYS = {
    "fact_session_summary": (("source_id", "Comm_id"), ("Comm_id", "Date_id")),
    "fact_hourly_stats": (("source_id", "Comm_id", "Date_id", "Hour"), ("Comm_id", "Date_id")),
    "fact_trade_distribution": (("source_id", "Comm_id", "Trader_Type_id"), ("Comm_id", "Trader_Type_id")),
}


def load_checks(wh: Warehouse, load_id: int, segment: str | None = None) -> DataFrame:
    """Keys of the facts of a load and of the dimensions, as report rows; all are blockers.

    With ``segment`` those that an attempt has written, seen or not, else those that readers see.
    """
    dims_ = {"Comm_id": "dim_commodity", "Date_id": "dim_date", "Trader_Type_id": "dim_trader_type"}
    reports = []
    for name, (keys, foreign) in KEYS.items():
        rows = visible_fact(wh, name) if segment is None else wh.table(name).filter(F.col("segment") == segment)
        rows = rows.filter(F.col("load_id") == load_id)
        reports.append(quality.key_report(rows, name, keys, {k: wh.table(dims_[k]) for k in foreign}))
    for name, keys in (("dim_commodity", ["Comm_Code"]), ("dim_commodity", ["Comm_id"]), ("dim_date", ["Date_id"])):
        report = quality.key_report(wh.table(name), name, keys, {})
        reports.append(report.withColumn("rule", F.concat("rule", F.lit(f"_{keys[0]}"))))
    return reduce(DataFrame.unionByName, reports)


def build_marts(wh: Warehouse) -> dict[str, DataFrame]:
    """Write the three marts and the movers from the facts that readers see; returns them by name."""
    sessions, codes = visible_fact(wh, "fact_session_summary"), wh.table("dim_commodity")
    coded = marts.with_commodity_code(sessions, codes)
    found = {
        "Comm_change": marts.comm_change(sessions, codes),
        "hourly_stats": marts.hourly_profile(visible_fact(wh, "fact_hourly_stats")),
        "Trader_Types": marts.trader_type_totals(visible_fact(wh, "fact_trade_distribution"), wh.table("dim_trader_type")),
        "top_gainers": marts.top_gainers(coded),
        "top_losers": marts.top_losers(coded),
    }
    _each(found, lambda name, df: wh.mart(f"marts/{name}", df))
    return {name: wh.spark.read.parquet(wh.path(f"marts/{name}")) for name in found}


def _earlier(wh: Warehouse, name: str, txn: str) -> DataFrame:
    """Rows of a log that a micro-batch has written before. It is the last one, so they are in the last two eras."""
    schema = TABLES[name][0]
    logs = [wh.read(f"{name}/era={era}", schema) for era in sorted(map(int, wh.partitions(name)))[-2:]]
    return reduce(DataFrame.unionByName, logs, wh.table(name).limit(0)).filter(F.col("txn") == txn)


def load_archives(
    wh: Warehouse, ids: list[int], parsed: DataFrame | None, load_id: int, started: datetime, absent: Iterable[int] = (),
    txn: str | None = None,
) -> DataFrame:
    """Load parsed archives of the file ids end to end, and log it; returns their ledger state.

    ``absent`` ids have no file and end as FAILED; ``parsed`` is None if no id has one. The keys
    of the facts are checked before the ledger makes them visible.

    ``txn`` names a micro-batch. Its rows in the ledger and the job log carry the name, and are looked up before
    any is appended. So a batch that comes again leaves each row once: if its outcome is in the ledger
    nothing is done, and if it died on the way it goes on in the segment that it began.
    """
    spark = wh.spark
    files = spark.createDataFrame([(i,) for i in ids], "file_id int")
    state = status_of(wh.ledger_state()).join(F.broadcast(files), "file_id", "left_semi")
    segment, logged = new_segment(load_id), False
    known = {row["file_id"]: row["status"] for row in state.collect()}
    opened = False
    if txn is not None:
        rows = _earlier(wh, "file_status_log", txn).select("file_id", "status", "seq", "segment").collect()
        if {r["file_id"] for r in rows if r["seq"] == _OUTCOME} >= set(ids):
            return state
        begun = {r["segment"] for r in rows if r["status"] == "PROCESSING"}
        # Begun and neither ended nor given up since: all its files are still being processed.
        opened = bool(begun) and all(known.get(i) == "PROCESSING" for i in ids)
        segment = max(begun) if opened else segment
        logged = not _earlier(wh, "etl_job_logs", txn).isEmpty()
    if not opened:
        wh.append("file_status_log", opening_moves(spark, ids, known, started, load_id, segment, txn))
    failed = dict.fromkeys(absent, ABSENT)
    staged = Staged({}, {}, {}, {})
    try:
        if parsed is not None:
            present = [i for i in ids if i not in failed]
            staged = stage_lines(wh, parsed, present)
            failed |= staged.failed
            good = [i for i in present if i not in failed]
            load_star(wh, load_id, good, segment)
            unknown = quality.dq_missing_dim(_staged(wh, "stg_session_summary", good), wh.table("dim_commodity"))
            unknown = unknown.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("violations")).select(
                F.lit("stg_session_summary").alias("dataset"), F.lit("MISSING_CODE").alias("rule"),
                F.lit(quality.BLOCKER).alias("severity"), "violations")
            quality.enforce(load_checks(wh, load_id, segment).unionByName(unknown))
    except Exception as error:
        finished = _utc_now()
        wh.append("file_status_log", transitions(files, "FAILED", finished, 0, load_id, step=_OUTCOME + 1))
        wh.log_jobs(job_entry(spark, "FAILED", finished, run_id=str(load_id), error_message=str(error)))
        raise
    finished = _utc_now()
    rows = [(i, failed.get(i), staged.seconds.get(i, 0)) for i in ids]
    outcome = spark.createDataFrame(rows, "file_id int, reason string, sec int").coalesce(1)
    status = F.when(F.col("reason").isNull(), "SUCCESS").otherwise("FAILED")
    ended = transitions(outcome, status, finished, F.col("sec"), load_id, step=_OUTCOME, segment=segment, txn=txn)
    if not logged:
        entries = spark.createDataFrame([_job_row(i, failed.get(i), staged, load_id, finished, txn) for i in ids], JOB_ENTRY)
        wh.log_jobs(entries, sla_breaches(ended, load_id, finished, txn=txn))
    wh.append("file_status_log", ended)
    wh.snapshot_when_due()
    return status_of(wh.ledger_state()).join(F.broadcast(files), "file_id", "left_semi")


# Steps 0 to 2 of the transitions at one instant open a load.
_OUTCOME = 3


def _job_row(i: int, reason: str | None, staged: Staged, load_id: int, at: datetime, txn: str | None) -> tuple:
    """The job-log entry of a file: the rows staged of it, and why it failed or what to beware of."""
    rows = 0 if reason else staged.rows.get(i, 0)
    message = reason or (None if rows else "WARNING EMPTY") or "; ".join(sorted(set(staged.warnings.get(i, ())))) or None
    return ("manual", "load_files", str(load_id), str(i), "FAILED" if reason else "SUCCESS", at, rows, message, txn)


def load_files(
    spark: SparkSession, wh: Warehouse, template: str, ids: Iterable[int], load_id: int,
    columns: list[str] | None = None, started: datetime | None = None,
) -> DataFrame:
    """Load the archives of some file ids end to end; returns their ledger state.

    The template names an id's path, such as ``/landing/{id}/LOG.zip``, and thereby the id of a
    path. Absent and unreadable archives, and sources that break a blocker rule, end as FAILED,
    the others as SUCCESS. Every file takes the legal steps of the ledger: one that is not
    PENDING is requested first. ``etl_sec`` is the time the file's own task took to read it.
    The file ids are the driver's own work list, one small row per file. After a
    crash the same load can simply be run again: staging is replaced source by source, facts go
    into a segment of the new attempt, known dimension rows are not added twice, and what the dead
    attempt has left is invisible.
    One load runs at a time, as ids are given out from the highest one known.
    """
    ids = list(dict.fromkeys(ids))
    if not ids:
        return status_of(wh.ledger_state()).filter(F.lit(False))
    paths = dict(zip(ids, tick_paths(template, ids), strict=True))
    gone = absent_files(spark, paths.values())
    absent = [i for i in ids if paths[i] in gone]
    parsed = None
    if len(absent) < len(ids):
        there = [paths[i] for i in ids if paths[i] not in gone]
        parsed = read_tick_zips(spark, there, columns, "quarantine", pattern_of(template), timings=True)
    return load_archives(wh, ids, parsed, load_id, started or _utc_now(), absent)


def load_pending(
    spark: SparkSession, wh: Warehouse, template: str, load_id: int, n: int = 1,
    columns: list[str] | None = None,
) -> DataFrame:
    """:func:`load_files` for the ``n`` pending files with the smallest ids; without any, no rows."""
    chosen = pending_files(status_of(wh.ledger_state()), n)
    return load_files(spark, wh, template, [row.file_id for row in chosen.collect()], load_id, columns)
