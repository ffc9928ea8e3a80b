"""The registered queries: ``name -> callable(spark, sf_dir) -> DataFrame``.

Turnover sums are rounded to cents here, and only here: a double sum differs in its last
bits with the order of the rows.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom import sources, streaming
from tickloom.catalog import fixtures as fx
from tickloom.functions import hour_of
from tickloom.operators import dims, facts, ledger, marts, quality, rollups, ticks
from tickloom.plans import closes, load, publish, warehouse
from tickloom.schemas import DIM_COMMODITY, DIM_DATE, DIM_TRADER_TYPE, TICK_COLUMNS
from tickloom.session import empty_frame, materialise, scratch_path

QUERIES = {}
EPOCH = datetime(2024, 2, 1)


def query(function):
    QUERIES[function.__name__] = function
    return function


def cents(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 2) for name in columns or ("Total_Turnover",)})


# -- row level -----------------------------------------------------------------------


@query
def valid_ticks(spark, sf_dir):
    return ticks.valid_ticks(fx.planted_ticks(spark, sf_dir))


@query
def tick_turnover(spark, sf_dir):
    return cents(ticks.with_turnover(fx.ticks(spark, sf_dir)), "Turnover").select(
        "seq", "Comm", "Price", "Volume", "Turnover"
    )


@query
def tick_hour(spark, sf_dir):
    return ticks.with_hour(fx.ticks(spark, sf_dir)).select("seq", "Log_Time", "Hour")


@query
def tick_trader_type(spark, sf_dir):
    return ticks.with_trader_type(fx.blocks(spark, sf_dir)).select("seq", "Volume", "Trader_Type")


# -- roll-ups ------------------------------------------------------------------------


@query
def hourly_stats(spark, sf_dir):
    return cents(rollups.hourly_stats(fx.ticks(spark, sf_dir)))


@query
def hourly_ohlc(spark, sf_dir):
    return cents(rollups.hourly_ohlc(fx.ticks(spark, sf_dir)))


@query
def session_summary(spark, sf_dir):
    return cents(rollups.session_summary(fx.ticks(spark, sf_dir)))


@query
def trade_distribution(spark, sf_dir):
    return rollups.trade_distribution(fx.ticks(spark, sf_dir))


@query
def block_trade_distribution(spark, sf_dir):
    return rollups.trade_distribution(fx.blocks(spark, sf_dir))


def _chunked(spark, sf_dir) -> DataFrame:
    """The ticks with the number of their chunk; every chunk is rolled up by itself."""
    return fx.ticks(spark, sf_dir).withColumn("chunk", F.floor(F.col("seq") / 1000))


@query
def merge_hourly(spark, sf_dir):
    stored = materialise(rollups.hourly_stats(_chunked(spark, sf_dir), also=["chunk"]), "partials")
    return cents(rollups.merge_hourly(stored))


@query
def merge_session(spark, sf_dir):
    stored = materialise(rollups.session_partials(_chunked(spark, sf_dir), also=["chunk"]), "partials")
    return cents(rollups.merge_session(stored))


@query
def merge_distribution(spark, sf_dir):
    stored = materialise(rollups.trade_distribution(_chunked(spark, sf_dir), also=["chunk"]), "partials")
    return rollups.merge_distribution(stored)


@query
def rollups_from_cells(spark, sf_dir):
    """Session summary by way of the shared cells of a load."""
    cells = materialise(rollups.tick_cells(fx.ticks(spark, sf_dir)), "cells")
    return cents(rollups.session_from_cells(cells))


# -- dimensions ----------------------------------------------------------------------


@query
def dim_commodity(spark, sf_dir):
    return dims.sync_commodity_dim(empty_frame(spark, DIM_COMMODITY), fx.coded_ticks(spark, sf_dir))


@query
def dim_commodity_incremental(spark, sf_dir):
    """A second batch of sources extends the dimension of the first."""
    rows = fx.coded_ticks(spark, sf_dir)
    first = fx.commodity_dim(rows.filter("source_id <= 6078"))
    return dims.sync_commodity_dim(first, rows.filter("source_id > 6078"))


@query
def dim_trader_type(spark, sf_dir):
    """The seeded classes, with the trades staged under each."""
    staging = rollups.trade_distribution(fx.blocks(spark, sf_dir))
    used = staging.groupBy("Trader_Type").agg(F.sum("Trade_Count").alias("Trade_Count"))
    seeded = dims.merge_new_keys(
        empty_frame(spark, DIM_TRADER_TYPE), dims.trader_type_dim(spark), "Trader_Type_Name"
    )
    labelled = seeded.join(used, F.col("Trader_Type") == F.col("Trader_Type_Name"), "left")
    return labelled.select("Trader_Type_id", "Trader_Type_Name", "Trade_Count")


@query
def dim_date(spark, sf_dir):
    rows = fx.blocks(spark, sf_dir).unionByName(fx.ticks(spark, sf_dir))
    return dims.sync_date_dim(empty_frame(spark, DIM_DATE), rows)


# -- facts and marts -------------------------------------------------------------------


def _session_star(spark, sf_dir, rows=fx.ticks) -> tuple[DataFrame, DataFrame]:
    staging = fx.staged(rollups.session_summary(rows(spark, sf_dir)))
    codes = fx.commodity_dim(staging)
    return facts.fact_session_summary(staging, codes), codes


def _hourly_star(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    staging = fx.staged(rollups.hourly_stats(fx.ticks(spark, sf_dir)))
    codes = fx.commodity_dim(staging)
    return facts.fact_hourly_stats(staging, codes), codes


def _distribution_star(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    staging = fx.staged(rollups.trade_distribution(fx.blocks(spark, sf_dir)))
    types = dims.trader_type_dim(spark)
    return facts.fact_trade_distribution(staging, fx.commodity_dim(staging), types), types


@query
def fact_session_summary(spark, sf_dir):
    return cents(_session_star(spark, sf_dir)[0])


@query
def fact_hourly_stats(spark, sf_dir):
    return cents(_hourly_star(spark, sf_dir)[0])


@query
def fact_trade_distribution(spark, sf_dir):
    return _distribution_star(spark, sf_dir)[0]


@query
def comm_change(spark, sf_dir):
    return cents(marts.comm_change(*_session_star(spark, sf_dir)))


@query
def top_gainers(spark, sf_dir):
    return marts.top_gainers(rollups.session_summary(fx.coded_ticks(spark, sf_dir)))


@query
def top_losers(spark, sf_dir):
    return marts.top_losers(rollups.session_summary(fx.coded_ticks(spark, sf_dir)))


@query
def hourly_profile(spark, sf_dir):
    return cents(marts.hourly_profile(rollups.hourly_stats(fx.ticks(spark, sf_dir))))


@query
def trader_type_totals(spark, sf_dir):
    return marts.trader_type_totals(*_distribution_star(spark, sf_dir))


def _class_totals(spark, sf_dir) -> DataFrame:
    staging = rollups.trade_distribution(fx.blocks(spark, sf_dir))
    return staging.groupBy("Trader_Type").agg(
        F.sum("Total_Volume").alias("Total_Volume"), F.sum("Trade_Count").alias("Total_Count")
    )


@query
def volume_share(spark, sf_dir):
    totals = _class_totals(spark, sf_dir).select("Trader_Type", "Total_Volume")
    return marts.share_of_total(totals, "Total_Volume")


@query
def count_share(spark, sf_dir):
    totals = _class_totals(spark, sf_dir).select("Trader_Type", "Total_Count")
    return marts.share_of_total(totals, "Total_Count")


@query
def price_spread(spark, sf_dir):
    return cents(marts.price_spread(rollups.session_summary(fx.ticks(spark, sf_dir))), "Spread")


@query
def session_leaderboard(spark, sf_dir):
    return marts.session_leaderboard(rollups.session_summary(fx.coded_ticks(spark, sf_dir)), k=3)


@query
def volume_spikes(spark, sf_dir):
    return marts.volume_spikes(rollups.hourly_stats(fx.ticks(spark, sf_dir)), n=5, k=2.0)


@query
def session_trend(spark, sf_dir):
    staging = fx.staged(rollups.session_summary(fx.blocks(spark, sf_dir)))
    codes, dates = fx.commodity_dim(staging), fx.date_dim(staging)
    fact = facts.fact_session_summary(staging, codes)
    return cents(marts.session_trend(fact, codes, dates, by=("Year", "Quarter")))


# -- quality -------------------------------------------------------------------------


@query
def dq_enforced(spark, sf_dir):
    """Warnings of the planted staging once its blockers are out of the way, and how many blockers stopped it before."""
    report = quality.dq_report(fx.dirty_staging(spark, sf_dir), "stg_hourly_stats")
    try:
        quality.enforce(report)
        blockers = 0
    except quality.QualityError as error:
        blockers = int(str(error).split()[0])
    passed = quality.enforce(report.filter("severity = 'WARNING'"))
    return passed.withColumn("blockers", F.lit(blockers).cast("bigint"))


@query
def dq_report(spark, sf_dir):
    return quality.dq_report(fx.dirty_staging(spark, sf_dir), "stg_hourly_stats")


@query
def dq_report_by_source(spark, sf_dir):
    return quality.dq_report(fx.dirty_staging(spark, sf_dir), "stg_hourly_stats", by=["source_id"])


@query
def dq_volatility(spark, sf_dir):
    moves = quality.dq_volatility(rollups.session_summary(fx.ticks(spark, sf_dir)), pct=0.20)
    return moves.withColumn("Change", F.round("Change", 6))


@query
def dq_unique(spark, sf_dir):
    """Session staging has a row per date, so the fact's key repeats there."""
    return quality.dq_unique(rollups.session_summary(fx.ticks(spark, sf_dir)), ["source_id", "Comm"])


@query
def dq_foreign_key(spark, sf_dir):
    """Dates of one feed against the calendar of another."""
    calendar = fx.date_dim(fx.ticks(spark, sf_dir))
    staging = rollups.session_summary(fx.blocks(spark, sf_dir))
    return quality.dq_foreign_key(staging, calendar, "Trade_Date", "Date_id")


@query
def dq_missing_dim(spark, sf_dir):
    """Codes that appear after the first source, against its dimension."""
    staging = fx.staged(rollups.session_summary(fx.coded_ticks(spark, sf_dir)))
    return quality.dq_missing_dim(staging, fx.commodity_dim(staging.filter("source_id = 6076")))


# -- sinks and whole loads ---------------------------------------------------------------


@query
def replace_by_source(spark, sf_dir):
    """All sources are loaded, then every odd one again with a correction."""
    rows = fx.ticks(spark, sf_dir)
    path = scratch_path(spark, "stg_session_summary")
    warehouse.replace_by_source(rollups.session_summary(rows), path)
    odd = rows.filter("source_id % 2 = 1").withColumn("Volume", F.col("Volume") * 2)
    warehouse.replace_by_source(rollups.session_summary(odd), path)
    return cents(spark.read.parquet(path))


@query
def append_table(spark, sf_dir):
    rows = fx.ticks(spark, sf_dir)
    path = scratch_path(spark, "stg_trade_distribution")
    for parity in (0, 1):
        part = rows.filter(F.col("source_id") % 2 == parity)
        warehouse.append_table(rollups.trade_distribution(part), path)
    return spark.read.parquet(path)


@query
def save_mart(spark, sf_dir):
    """A mart written twice holds the second result only."""
    path = scratch_path(spark, "mart")
    hourly = rollups.hourly_stats(fx.ticks(spark, sf_dir))
    warehouse.save_mart(hourly, path)
    warehouse.save_mart(marts.hourly_profile(hourly), path)
    return cents(spark.read.parquet(path))


@query
def load_star(spark, sf_dir):
    """Staging, dimensions and facts; the odd sources are then loaded a second time."""
    wh = load.Warehouse(spark, scratch_path(spark, "warehouse"))
    load.stage_ticks(wh, fx.ticks(spark, sf_dir))
    ids = sorted(row.source_id for row in wh.table("stg_session_summary").select("source_id").distinct().collect())
    for load_id, chosen in ((1, ids), (2, [i for i in ids if i % 2])):
        load.load_star(wh, load_id, chosen)
        files = spark.createDataFrame([(i,) for i in chosen], "file_id int")
        wh.append("file_status_log", ledger.transitions(files, "SUCCESS", EPOCH, 1, load_id, step=load_id))
    fact = load.visible_fact(wh, "fact_session_summary")
    return cents(marts.with_commodity_code(fact, wh.table("dim_commodity"))).drop("Comm_id")


def _loaded(spark, sf_dir, name):
    landing, ids = fx.zip_landing(spark, sf_dir, name)
    wh = load.Warehouse(spark, scratch_path(spark, "warehouse"))
    status = load.load_files(spark, wh, f"{landing}/{name}", ids, 1, list(TICK_COLUMNS))
    return status, wh, landing, ids


def _runs(wh, load_id=1):
    log = wh.table("etl_job_logs").filter((F.col("task_id") == "load_files") & (F.col("run_id") == str(load_id)))
    return log.withColumn("file_id", F.col("file_id").cast("int"))


def _starred(spark, sf_dir):
    """Facts, dimensions and ledger of all ticks, loaded once."""
    wh = load.Warehouse(spark, scratch_path(spark, "warehouse"))
    load.stage_ticks(wh, fx.ticks(spark, sf_dir))
    load.load_star(wh, 1)
    files = wh.table("stg_session_summary").select(F.col("source_id").alias("file_id")).distinct()
    wh.append("file_status_log", ledger.transitions(files, "SUCCESS", EPOCH, 1, 1, step=1))
    return wh


@query
def marts_from_facts(spark, sf_dir):
    """The three marts, built in one call from the stored, visible facts; a row of each as label and totals."""
    found = load.build_marts(_starred(spark, sf_dir))
    volume = F.col("Total_Volume").cast("bigint").alias("Total_Volume")
    turnover = F.round("Total_Turnover", 2).alias("measure")
    return (
        found["Comm_change"].select(F.lit("Comm_change").alias("mart"), F.col("Comm").alias("label"), volume, F.col("Pct_Change").alias("measure"))
        .unionByName(found["hourly_stats"].select(F.lit("hourly_stats").alias("mart"), F.col("Hour").cast("string").alias("label"), volume, turnover))
        .unionByName(found["Trader_Types"].select(
            F.lit("Trader_Types").alias("mart"), F.col("Trader_Type").alias("label"), volume, F.col("Total_Count").cast("double").alias("measure")))
    )


@query
def movers_from_facts(spark, sf_dir):
    """The largest rises and falls over the visible session facts."""
    found = load.build_marts(_starred(spark, sf_dir))
    return found["top_gainers"].withColumn("side", F.lit("up")).unionByName(found["top_losers"].withColumn("side", F.lit("down")))


@query
def hourly_fact_by_year(spark, sf_dir):
    """The hourly fact as stored, read by its year partition."""
    fact = load.visible_fact(_starred(spark, sf_dir), "fact_hourly_stats")
    return cents(fact.groupBy("year", "Hour").agg(
        F.sum("Total_Volume").alias("Total_Volume"), F.sum("Total_Turnover").alias("Total_Turnover")))


@query
def load_files(spark, sf_dir):
    """Zipped logs through the whole load: ledger state and staged rows of every file."""
    status, wh, _, _ = _loaded(spark, sf_dir, "{id}.zip")
    return status.join(_runs(wh).select("file_id", "row_count"), "file_id").select(
        "file_id", "status", "retry_count", "row_count")


@query
def load_files_nested(spark, sf_dir):
    """The same, with the file id in the folder and one name for all archives."""
    status, wh, _, _ = _loaded(spark, sf_dir, "{id}/LOG.zip")
    visible = load.visible_fact(wh, "fact_session_summary").select(F.col("source_id").alias("file_id")).distinct()
    return status.join(_runs(wh).select("file_id", "row_count"), "file_id").join(visible, "file_id", "left_semi").select(
        "file_id", "status", "retry_count", "row_count")


@query
def load_pending_files(spark, sf_dir):
    """Pending files through the load, one of them absent: only that one fails, and all moves are legal."""
    landing, ids = fx.zip_landing(spark, sf_dir)
    wh = load.Warehouse(spark, scratch_path(spark, "warehouse"))
    files = spark.createDataFrame([(i,) for i in [*ids, 9999]], "file_id int")
    wh.append("file_status_log", ledger.transitions(files, "PENDING", EPOCH))
    status = load.load_pending(spark, wh, f"{landing}/{{id}}.zip", 1, len(ids) + 1, list(TICK_COLUMNS))
    illegal = ledger.illegal_transitions(wh.table("file_status_log")).agg(F.count("*").alias("illegal"))
    return status.select("file_id", "status").join(F.broadcast(illegal))


@query
def reload_files(spark, sf_dir):
    """All sources, then the odd ones once more: some emptied, some mended. What the second delivery left."""
    _, wh, landing, ids = _loaded(spark, sf_dir, "{id}.zip")
    odd = [i for i in ids if i % 2]
    price = F.when(F.col("source_id") % 4 == 1, F.lit(0.0)).otherwise(F.col("Price"))
    again = fx.raw_ticks(spark, sf_dir).filter("source_id % 2 = 1").withColumn("Price", price)
    fx.write_archives(again, f"{landing}/{{id}}.zip", mended=True)
    status = load.load_files(spark, wh, f"{landing}/{{id}}.zip", odd, 2, list(TICK_COLUMNS))
    runs = _runs(wh, 2).select("file_id", "row_count", F.coalesce(F.col("error_message") == "WARNING EMPTY", F.lit(False)).alias("empty"))
    count = lambda df, name: df.groupBy(F.col("source_id").alias("file_id")).agg(F.count("*").alias(name))
    rows = status.select("file_id").join(runs, "file_id")
    rows = rows.join(count(wh.table("quarantine"), "quarantined"), "file_id", "left")
    rows = rows.join(count(load.visible_fact(wh, "fact_session_summary"), "visible_sessions"), "file_id", "left")
    return rows.fillna(0, ["quarantined", "visible_sessions"])


@query
def job_log(spark, sf_dir):
    """The stored numbers of the job log, after an entry that comes late with an early time."""
    _, wh, _, _ = _loaded(spark, sf_dir, "{id}.zip")
    wh.log_jobs(ledger.job_entry(spark, "FAILED", EPOCH, task_id="load_files", run_id="0", file_id="late"))
    # Whether a load breaks service levels depends on the clock; its entries come before the late one.
    breaches = wh.table("etl_job_logs").filter("task_id = 'sla'").agg(F.count("*").alias("_breaches"))
    rows = wh.table("etl_job_logs").filter("task_id = 'load_files'").join(F.broadcast(breaches))
    log_id = F.when(F.col("run_id") == "0", F.col("log_id") - F.col("_breaches")).otherwise(F.col("log_id"))
    return rows.select(log_id.alias("log_id"), "run_id", "file_id")


@query
def load_checks(spark, sf_dir):
    """Primary and foreign keys of the facts of a load."""
    _, wh, _, _ = _loaded(spark, sf_dir, "{id}.zip")
    return load.load_checks(wh, 1)


@query
def rerun_load(spark, sf_dir):
    """A load dies once its facts are written; every odd file comes again without a price, and the load is run again."""
    landing, ids = fx.zip_landing(spark, sf_dir)
    wh = load.Warehouse(spark, scratch_path(spark, "warehouse"))
    files, dead = wh.spark.createDataFrame([(i,) for i in ids], "file_id int"), publish.new_segment(1)
    wh.append("file_status_log", ledger.transitions(files, "PENDING", EPOCH, step=1))
    wh.append("file_status_log", ledger.transitions(files, "PROCESSING", EPOCH, load_id=1, step=2, segment=dead))
    load.stage_ticks(wh, fx.ticks(spark, sf_dir))
    load.load_star(wh, 1, segment=dead)
    again = fx.raw_ticks(spark, sf_dir).withColumn("Price", F.when(F.col("source_id") % 2 == 1, 0.0).otherwise(F.col("Price")))
    fx.write_archives(again, f"{landing}/{{id}}.zip", mended=True)
    status = load.load_files(spark, wh, f"{landing}/{{id}}.zip", ids, 1, list(TICK_COLUMNS))
    sessions = load.visible_fact(wh, "fact_session_summary").groupBy(F.col("source_id").alias("file_id")).agg(
        F.count("*").alias("visible_sessions"), F.sum("Total_Volume").cast("bigint").alias("visible_volume"))
    illegal = ledger.illegal_transitions(wh.table("file_status_log")).agg(F.count("*").alias("illegal"))
    rows = status.select("file_id", "status", "retry_count").join(sessions, "file_id", "left")
    return rows.fillna(0, ["visible_sessions", "visible_volume"]).join(F.broadcast(illegal))


@query
def compacted_facts(spark, sf_dir):
    """Sources in three loads, the odd ones once more, compacted after the second and the last and without what is superseded."""
    wh = load.Warehouse(spark, scratch_path(spark, "warehouse"))
    load.stage_ticks(wh, fx.ticks(spark, sf_dir))
    sources = wh.table("stg_session_summary").select(F.col("source_id").alias("file_id")).distinct()
    ids = sorted(row[0] for row in sources.collect())
    for load_id, chosen in enumerate((*[[i for i in ids if i % 3 == k] for k in range(3)], [i for i in ids if i % 2]), start=1):
        segment = publish.new_segment(load_id)
        load.load_star(wh, load_id, chosen, segment)
        done = ledger.transitions(sources.filter(F.col("file_id").isin(chosen)), "SUCCESS", EPOCH, 1, load_id, load_id, segment)
        wh.append("file_status_log", done)
        if load_id % 2 == 0:
            publish.compact_facts(wh)
            for day in (0, 2):
                publish.vacuum(wh, EPOCH + timedelta(days=2 * load_id + day))
    fact = load.visible_fact(wh, "fact_session_summary")
    folders = F.lit(len(wh.partitions("fact_session_summary"))).cast("bigint")
    return cents(marts.with_commodity_code(fact, wh.table("dim_commodity"))).drop("Comm_id").withColumn("folders", folders)


@query
def carried_volatility(spark, sf_dir):
    """Moves from the carried closes: later sources are staged first, odd ones corrected at last."""
    wh = load.Warehouse(spark, scratch_path(spark, "warehouse"))
    sessions = fx.staged(rollups.session_summary(fx.ticks(spark, sf_dir)))
    ids = sorted(row[0] for row in sessions.select("source_id").distinct().collect())
    corrected = sessions.withColumn("Close", F.when(F.col("source_id") % 2 == 1, F.col("Close") * 2).otherwise(F.col("Close")))
    for chosen, rows in ((ids[len(ids) // 2:], sessions), (ids[: len(ids) // 2], sessions), ([i for i in ids if i % 2], corrected)):
        closes.forget(wh, chosen, wh.table("stg_session_summary").filter(F.col("source_id").isin(chosen)))
        wh.replace("stg_session_summary", rows.filter(F.col("source_id").isin(chosen)))
        closes.remember(wh, chosen, wh.table("stg_session_summary").filter(F.col("source_id").isin(chosen)))
    return closes.volatility(wh).withColumn("Change", F.round("Change", 6))


# -- ledger ----------------------------------------------------------------------------


@query
def ledger_snapshots(spark, sf_dir):
    """The state of all files from snapshots: a log that comes in three parts, each with rows older than the one before."""
    wh = load.Warehouse(spark, scratch_path(spark, "warehouse"))
    log = fx.status_log(spark, sf_dir)
    for part in range(3):
        wh.append("file_status_log", log.filter(F.col("seq") % 3 == part))
        if part < 2:
            wh.snapshot_ledger()
    return ledger.status_of(wh.ledger_state())


@query
def file_status(spark, sf_dir):
    return ledger.file_status(fx.status_log(spark, sf_dir))


@query
def pending_files(spark, sf_dir):
    return ledger.pending_files(ledger.file_status(fx.status_log(spark, sf_dir)), n=10)


@query
def retryable_files(spark, sf_dir):
    return ledger.retryable_files(ledger.file_status(fx.status_log(spark, sf_dir)), max_retries=3)


@query
def next_file_id(spark, sf_dir):
    return ledger.next_file_id(fx.status_log(spark, sf_dir))


@query
def seed_and_backfill(spark, sf_dir):
    """The ledger after the next file is seeded and the failed files are requested again."""
    log = fx.status_log(spark, sf_dir)
    failed = ledger.file_status(log).filter("status = 'FAILED'")
    at = datetime(2030, 1, 1)
    extended = log.unionByName(ledger.seed_next(log, at)).unionByName(
        ledger.transitions(failed, "PENDING", at)
    )
    return ledger.file_status(extended)


@query
def request_backfill(spark, sf_dir):
    """The ledger after known files, and one that is not, are requested again."""
    log = fx.status_log(spark, sf_dir)
    asked = ledger.request_backfill(log, [1, 2, 4, 5, 7, -1], datetime(2030, 1, 1))
    return ledger.file_status(log.unionByName(asked)).filter("status = 'PENDING'").select("file_id", "updated_at")


@query
def illegal_transitions(spark, sf_dir):
    return ledger.illegal_transitions(fx.status_log(spark, sf_dir))


@query
def sla_report(spark, sf_dir):
    return ledger.sla_report(fx.status_log(spark, sf_dir))


@query
def sla_report_local_time(spark, sf_dir):
    log = fx.status_log(spark, sf_dir)
    return ledger.sla_report(log, max_sec=200, deadline_hour=18, timezone="Asia/Tokyo")


@query
def job_report(spark, sf_dir):
    """Finished transitions as job-log rows, reported by status."""
    runs = fx.status_log(spark, sf_dir).filter("status IN ('SUCCESS', 'FAILED')")
    return ledger.job_report(runs.select(
        "status", F.col("changed_at").alias("execution_time"),
        F.col("etl_sec").cast("bigint").alias("row_count"),
    ))


@query
def job_log_ids(spark, sf_dir):
    """Every finished transition as a numbered job-log entry."""
    runs = fx.status_log(spark, sf_dir).filter("status IN ('SUCCESS', 'FAILED')")
    entries = runs.select(
        F.lit("load_files").alias("task_id"), F.col("seq").cast("string").alias("run_id"),
        F.col("file_id").cast("string").alias("file_id"), "status",
        F.col("changed_at").alias("execution_time"),
    )
    return ledger.with_log_id(entries)


@query
def visible_facts(spark, sf_dir):
    """Three loads of every source: the first succeeds, the second for even sources only,
    the third fails."""
    staging = fx.staged(rollups.trade_distribution(fx.ticks(spark, sf_dir)))
    loads = F.explode(F.array(*[F.lit(i).cast("bigint") for i in (1, 2, 3)]))
    fact = staging.withColumn("load_id", loads).withColumn(
        "Total_Volume", F.col("Total_Volume") + F.col("load_id")
    )
    files = staging.select(F.col("source_id").alias("file_id")).distinct()
    second = F.when(F.col("file_id") % 2 == 0, "SUCCESS").otherwise("FAILED")
    log = ledger.transitions(files, "SUCCESS", EPOCH, load_id=1, step=1)
    log = log.unionByName(ledger.transitions(files, second, EPOCH, load_id=2, step=2))
    log = log.unionByName(ledger.transitions(files, "FAILED", EPOCH, load_id=3, step=3))
    return ledger.visible(fact, log)


# -- files and streams -------------------------------------------------------------------

_PARSED = ("source_id", *TICK_COLUMNS)


@query
def read_tick_zips(spark, sf_dir):
    good, _ = sources.split_bad_rows(sources.read_tick_zips(spark, f"{fx.zip_landing(spark, sf_dir)[0]}/*.zip"))
    return good.select(*_PARSED, "seq")


@query
def quarantine_zips(spark, sf_dir):
    landing, _ = fx.zip_landing(spark, sf_dir)
    _, bad = sources.split_bad_rows(sources.read_tick_zips(spark, f"{landing}/*.zip", list(TICK_COLUMNS)))
    return bad


def _csv(spark, sf_dir):
    landing = fx.csv_landing(spark, sf_dir)
    return sources.split_bad_rows(sources.read_tick_csv(spark, landing, list(TICK_COLUMNS), r"source_id=(\d+)/"))


@query
def read_tick_csv(spark, sf_dir):
    return _csv(spark, sf_dir)[0].select(*_PARSED)


@query
def quarantine_csv(spark, sf_dir):
    return _csv(spark, sf_dir)[1].select("source_id", "reason", "line")


@query
def hourly_stats_stream(spark, sf_dir):
    """Event-time hours over a file stream of the events, in update mode."""
    schema = fx.table(spark, sf_dir, "events").schema
    # A glob, since a stream takes a plain path for a folder only.
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    rows = ticks.valid_ticks(fx.ticks_from_events(stream))
    path = scratch_path(spark, "hourly-stream")
    run = (
        streaming.hourly_stats_stream(rows)
        .writeStream.outputMode("update")
        .foreachBatch(streaming.upsert_sink(path))
        .option("checkpointLocation", scratch_path(spark, "stream-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return cents(streaming.read_upserts(spark, path))


@query
def hourly_stream_late(spark, sf_dir):
    """Events that arrive in four parts, the last with ticks of hours long closed: hours in time, with the late ticks
    that were set aside, and both together."""
    events = fx.table(spark, sf_dir, "events")
    landing, checkpoint = scratch_path(spark, "events"), scratch_path(spark, "stream-checkpoint")
    table = streaming.HourlyTable(spark, scratch_path(spark, "hours"))
    day, held_back = F.dayofmonth("ts"), F.col("event_id") % 10 == 0
    early = (day <= 20) & held_back
    for n, part in enumerate((day.between(1, 10) & ~early, day.between(11, 20) & ~early, (day > 20) & ~early, early)):
        events.filter(part).write.mode("append").parquet(landing)
        arrived = spark.readStream.schema(events.schema).parquet(landing)
        run = ticks.valid_ticks(fx.ticks_from_events(arrived)).writeStream.foreachBatch(table.writer())
        run.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        if n % 2:
            table.compact()
    late = table.late().withColumn("Hour", hour_of()).groupBy(*rollups.HOURLY_KEYS).agg(F.count("*").alias("late_ticks"))
    in_time = table.hours().select(*rollups.HOURLY_KEYS, F.col("Total_Volume").alias("volume_in_time"))
    rows = table.corrected().join(in_time, [*rollups.HOURLY_KEYS], "left").join(late, [*rollups.HOURLY_KEYS], "left")
    return cents(rows.fillna(0, ["volume_in_time", "late_ticks"]))


def _streamed(spark, sf_dir, damaged=False):
    landing, _ = fx.zip_landing(spark, sf_dir)
    if damaged:
        fx.write_damaged(spark, f"{landing}/9999.zip")
    wh = load.Warehouse(spark, scratch_path(spark, "warehouse"))
    checkpoint = scratch_path(spark, "stream-checkpoint")
    run = streaming.ingest_stream(spark, landing, wh, checkpoint, list(TICK_COLUMNS), files_per_batch=5)
    run.awaitTermination()
    return wh


@query
def ingest_stream(spark, sf_dir):
    """Archives picked up by a stream, in micro-batches of five files; the staged sessions."""
    return cents(_streamed(spark, sf_dir).table("stg_session_summary"))


@query
def ingest_ledger(spark, sf_dir):
    """Ledger and visible sessions after the stream, with a damaged archive among the others."""
    wh = _streamed(spark, sf_dir, damaged=True)
    seen = load.visible_fact(wh, "fact_session_summary").groupBy(F.col("source_id").alias("file_id")).agg(F.count("*").alias("visible_sessions"))
    status = ledger.file_status(wh.table("file_status_log")).select("file_id", "status")
    return status.join(seen, "file_id", "left").fillna(0, ["visible_sessions"])


@query
def ingest_replayed(spark, sf_dir):
    """The stream again, with every micro-batch run twice: ledger rows, job-log rows and visible sessions of each file."""
    landing, _ = fx.zip_landing(spark, sf_dir)
    wh = load.Warehouse(spark, scratch_path(spark, "warehouse"))
    loader = streaming.batch_loader(wh, list(TICK_COLUMNS))

    def twice(batch, batch_id):
        loader(batch, batch_id)
        loader(batch, batch_id)

    streaming.ingest_stream(
        spark, landing, wh, scratch_path(spark, "stream-checkpoint"), files_per_batch=8, loader=twice).awaitTermination()
    count = lambda df, key, name: df.groupBy(F.col(key).cast("int").alias("file_id")).agg(F.count("*").alias(name))
    rows = count(wh.table("file_status_log"), "file_id", "ledger_rows")
    rows = rows.join(count(wh.table("etl_job_logs").filter("task_id = 'load_files'"), "file_id", "job_rows"), "file_id")
    rows = rows.join(count(load.visible_fact(wh, "fact_session_summary"), "source_id", "visible_sessions"), "file_id")
    return rows.join(ledger.status_of(wh.ledger_state()).select("file_id", "status"), "file_id")
