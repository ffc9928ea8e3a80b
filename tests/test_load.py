import os
import random
import statistics
import zipfile
from datetime import datetime, timezone

import pytest
from conftest import as_set, plan_of

from tickloom.operators import ledger, quality, rollups
from tickloom.plans import load, warehouse
from tickloom.schemas import TICK_COLUMNS
from tickloom.session import scratch_root
from tickloom.streaming import ingest_stream

COLUMNS = list(TICK_COLUMNS)


def utc_now():
    return datetime.now(timezone.utc).replace(tzinfo=None)


def put(folder, file_id, *lines, header=",".join(COLUMNS)):
    with zipfile.ZipFile(os.path.join(folder, f"{file_id}.zip"), "w") as z:
        z.writestr("T.csv", "\n".join([header, *lines]) + "\n")


def damage(folder, file_id):
    """An archive whose last part is broken, far behind its first readable lines."""
    dice = random.Random(1)
    lines = [f"A,F,20251201,090000,{dice.random()},3" for _ in range(200_000)]
    path = os.path.join(folder, f"{file_id}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("T.csv", "\n".join([",".join(COLUMNS), *lines]))
    with open(path, "r+b") as f:
        f.seek(os.path.getsize(path) - 5000)
        f.write(b"\xff" * 2000)


def test_sources_are_replaced_one_by_one(make_ticks, spark, tmp_path):
    path = str(tmp_path / "stg")
    first = rollups.session_summary(make_ticks(
        ("A", 1, 1, 1.0, 1, 1), ("A", 1, 1, 1.0, 2, 2), ("B", 1, 1, 1.0, 2, 2),
    ))
    second = rollups.session_summary(make_ticks(("A", 1, 1, 9.0, 9, 2)))
    warehouse.replace_by_source(first, path)
    for _ in range(2):
        warehouse.replace_by_source(second, path)
        assert as_set(spark.read.parquet(path), "source_id", "Comm", "Total_Volume") == {(1, "A", 1), (2, "A", 9)}
    warehouse.replace_by_source(second.filter("false"), path)
    assert spark.read.parquet(path).count() == 2
    assert "PartitionFilters: [isnotnull(source_id" in plan_of(spark.read.parquet(path).filter("source_id = 2"))


def test_marts_are_overwritten(spark, tmp_path):
    path = str(tmp_path / "mart")
    for n in (5, 2):
        warehouse.save_mart(spark.range(n), path)
    assert spark.read.parquet(path).count() == 2


def test_marts_in_the_catalog(spark, conf, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS marts LOCATION '{tmp_path}'")
    for n in (5, 2):
        warehouse.save_mart_table(spark.range(n), "marts.numbers")
    assert spark.table("marts.numbers").count() == 2


def test_tables_that_were_never_written_are_empty(spark, tmp_path):
    wh = load.Warehouse(spark, str(tmp_path))
    assert wh.table("fact_hourly_stats").isEmpty() and load.visible_fact(wh, "fact_hourly_stats").isEmpty()
    with pytest.raises(ValueError):
        wh.replace("dim_date", wh.table("dim_date"))


def succeed(wh, load_id, *ids):
    files = wh.spark.createDataFrame([(i,) for i in ids], "file_id int")
    wh.append("file_status_log", ledger.transitions(files, "SUCCESS", datetime(2025, 1, 1), load_id=load_id, step=load_id))


def test_reload_that_drops_a_year_leaves_nothing_behind(make_ticks, spark, tmp_path):
    wh = load.Warehouse(spark, str(tmp_path))
    load.stage_ticks(wh, make_ticks(("A", 20241231, 90000, 1.0, 1, 1), ("A", 20250102, 90000, 2.0, 1, 1)))
    load.load_star(wh, 1)
    assert load.visible_fact(wh, "fact_hourly_stats").isEmpty()
    succeed(wh, 1, 1)
    assert as_set(load.visible_fact(wh, "fact_hourly_stats"), "year") == {(2024,), (2025,)}
    load.stage_ticks(wh, make_ticks(("B", 20250102, 90000, 2.0, 1, 1)))
    load.load_star(wh, 2)
    assert as_set(load.visible_fact(wh, "fact_hourly_stats"), "year") == {(2024,), (2025,)}
    succeed(wh, 2, 1)
    assert as_set(load.visible_fact(wh, "fact_hourly_stats"), "year", "Comm_id") == {(2025, 2)}
    assert as_set(wh.table("dim_commodity")) == {(1, "A"), (2, "B")}
    assert wh.table("dim_date").count() == 2 and wh.table("dim_trader_type").count() == 4
    pruned = plan_of(wh.table("fact_hourly_stats").filter("year = 2025"))
    assert "PartitionFilters: [isnotnull(year" in pruned
    for name, keys in (("fact_session_summary", ["source_id", "Comm_id"]),
                       ("fact_hourly_stats", ["source_id", "Comm_id", "Date_id", "Hour"]),
                       ("fact_trade_distribution", ["source_id", "Comm_id", "Trader_Type_id"])):
        fact = load.visible_fact(wh, name)
        assert fact.count() and quality.dq_unique(fact, keys).isEmpty()
        assert quality.dq_foreign_key(fact, wh.table("dim_commodity"), "Comm_id").isEmpty()


def test_a_source_that_breaks_a_blocker_is_not_staged(make_ticks, spark, tmp_path):
    wh = load.Warehouse(spark, str(tmp_path))
    report = load.stage_ticks(wh, make_ticks(("A", 1, 1, 1.0, 5, 1), ("A", 1, 1, 1.0, -5, 2)))
    for name in load.STAGING:
        assert as_set(wh.table(name), "source_id") == {(1,)}
    assert as_set(quality.blocked_sources(report), "source_id") == {(2,)}


def test_files_end_to_end(spark, tmp_path):
    wh, landing = load.Warehouse(spark, str(tmp_path / "wh")), tmp_path / "in"
    landing.mkdir()
    put(landing, 1, "A,F,20251201,090000,10,3", "A,F,20251201,100000,12,200", "A,F,bad,1,1,1")
    put(landing, 2, "A,F,20251202,090000,10,-3")
    put(landing, 3, "A,F,20251203,090000,0,3")
    (landing / "4.zip").write_bytes(b"junk")
    put(landing, 5, "x,y", header="a,b")
    damage(landing, 6)
    status = load.load_files(spark, wh, f"{landing}/{{id}}.zip", [1, 2, 3, 4, 5, 6], 1, COLUMNS)
    assert as_set(status, "file_id", "status", "retry_count") == {
        (1, "SUCCESS", 0), (2, "SUCCESS", 0), (3, "SUCCESS", 0), (4, "FAILED", 1), (5, "FAILED", 1),
        (6, "FAILED", 1),
    }
    entries = wh.table("etl_job_logs").collect()
    assert sorted(r.log_id for r in entries) == list(range(1, len(entries) + 1))
    logged = {r.file_id: (r.status, r.row_count, r.error_message) for r in entries if r.task_id == "load_files"}
    breaches = {r.file_id: r.error_message for r in entries if r.task_id == "sla"}
    assert all(breaches[i] == "SLA CRITICAL: failed" for i in "456")
    # Two hours, one session, two classes.
    assert logged["1"] == ("SUCCESS", 5, None)
    assert logged["3"] == ("SUCCESS", 0, "WARNING EMPTY")
    assert logged["2"] == ("SUCCESS", 0, "WARNING EMPTY") and logged["4"][2] == "unreadable archive"
    assert as_set(wh.table("quarantine").filter("source_id = 2"), "reason") == {("negative volume",)}
    assert logged["5"][2] == "unknown header" and logged["6"][2] == "unreadable archive"
    assert wh.table("stg_session_summary").filter("source_id = 6").isEmpty()
    assert as_set(wh.table("quarantine").filter("source_id = 1"), "line") == {("A,F,bad,1,1,1",)}
    fact = load.visible_fact(wh, "fact_session_summary")
    assert as_set(fact, "source_id", "Open", "Close", "Total_Volume", "load_id") == {(1, 10.0, 12.0, 203, 1)}

    # File 2 is delivered again and reprocessed.
    put(landing, 2, "A,F,20251202,090000,15,3", "C,F,20251202,090000,10,3")
    wh.append("file_status_log", ledger.request_backfill(wh.table("file_status_log"), [2], utc_now()))
    assert as_set(ledger.pending_files(ledger.file_status(wh.table("file_status_log")))) == {(2,)}
    done = load.load_pending(spark, wh, f"{landing}/{{id}}.zip", 2, columns=COLUMNS)
    assert as_set(done, "file_id", "status") == {(2, "SUCCESS")}
    assert load.load_pending(spark, wh, f"{landing}/{{id}}.zip", 3, columns=COLUMNS).isEmpty()
    fact = load.visible_fact(wh, "fact_session_summary")
    assert as_set(fact, "source_id", "load_id") == {(1, 1), (2, 2)}
    assert wh.table("dim_commodity").count() == 2
    # The close of A went from 12 to 15.
    last = wh.table("etl_job_logs").filter("run_id = '2' AND task_id = 'load_files'").first()
    assert last.error_message == "WARNING stg_session_summary VOLATILITY (1)"

    # The same load once more, as after a crash, changes no visible row.
    before = as_set(fact)
    load.load_star(wh, 2, [2])
    assert as_set(load.visible_fact(wh, "fact_session_summary")) == before
    assert load.visible_fact(wh, "fact_session_summary").count() == 3


def test_a_source_too_big_for_one_task_is_written_by_several(spark, conf, tmp_path):
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "400KB")
    conf("spark.sql.shuffle.partitions", "60")
    hot = spark.range(300_000, numPartitions=6).selectExpr("if(id % 3 = 0, 1, id % 50 + 2) source_id", "uuid() v")
    path = tmp_path / "t"
    warehouse.replace_by_source(hot, str(path))
    files = {p.name: len(list(p.glob("*.parquet"))) for p in path.glob("source_id=*")}
    assert files.pop("source_id=1") > 3
    assert statistics.median(files.values()) == 1


def test_an_absent_file_fails_alone(spark, tmp_path):
    wh, landing = load.Warehouse(spark, str(tmp_path / "wh")), tmp_path / "in"
    landing.mkdir()
    put(landing, 1, "A,F,20251201,090000,10,3")
    status = load.load_files(spark, wh, f"{landing}/{{id}}.zip", [1, 2], 1, COLUMNS)
    assert as_set(status, "file_id", "status") == {(1, "SUCCESS"), (2, "FAILED")}
    status = load.load_files(spark, wh, f"{landing}/{{id}}.zip", [3], 2, COLUMNS)
    assert as_set(status, "file_id", "status") == {(3, "FAILED")}
    assert as_set(wh.table("etl_job_logs").filter("status = 'FAILED'"), "file_id", "error_message") == {("2", "no file"), ("3", "no file")}
    assert ledger.illegal_transitions(wh.table("file_status_log")).isEmpty()


def test_a_load_that_raises_is_logged_as_failed(spark, tmp_path, monkeypatch):
    wh = load.Warehouse(spark, str(tmp_path / "wh"))
    put(tmp_path, 1, "A,F,20251201,090000,10,3")
    monkeypatch.setattr(load, "load_star", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        load.load_files(spark, wh, f"{tmp_path}/{{id}}.zip", [1], 1, COLUMNS)
    assert as_set(ledger.file_status(wh.table("file_status_log")), "file_id", "status") == {(1, "FAILED")}
    assert as_set(wh.table("etl_job_logs"), "status") == {("FAILED",)}


def test_a_crashed_load_can_be_run_again(spark, tmp_path):
    wh = load.Warehouse(spark, str(tmp_path / "wh"))
    put(tmp_path, 1, "A,F,20251201,090000,10,3")
    files = spark.createDataFrame([(1,)], "file_id int")
    for step, status in enumerate(("PENDING", "PROCESSING")):
        wh.append("file_status_log", ledger.transitions(files, status, datetime(2025, 1, 1), step=step))
    load.load_files(spark, wh, f"{tmp_path}/{{id}}.zip", [1], 1, COLUMNS)
    log = wh.table("file_status_log").orderBy("changed_at", "seq").select("status").collect()
    assert [r.status for r in log] == ["PENDING", "PROCESSING", "FAILED", "PENDING", "PROCESSING", "SUCCESS"]
    assert ledger.illegal_transitions(wh.table("file_status_log")).isEmpty()


def test_a_delivery_without_rows_leaves_none_of_the_one_before(spark, tmp_path):
    wh = load.Warehouse(spark, str(tmp_path / "wh"))
    put(tmp_path, 1, "A,F,20251201,090000,10,3", "broken")
    load.load_files(spark, wh, f"{tmp_path}/{{id}}.zip", [1], 1, COLUMNS)
    assert load.visible_fact(wh, "fact_session_summary").count() == 1 and wh.table("quarantine").count() == 1
    put(tmp_path, 1, "A,F,20251201,090000,0,3")
    load.load_files(spark, wh, f"{tmp_path}/{{id}}.zip", [1], 2, COLUMNS)
    last = wh.table("etl_job_logs").filter("run_id = '2' AND task_id = 'load_files'").first()
    assert (last.row_count, last.error_message) == (0, "WARNING EMPTY")
    assert load.visible_fact(wh, "fact_session_summary").isEmpty() and wh.table("quarantine").isEmpty()


def test_stream_picks_up_only_new_archives(spark, tmp_path):
    wh, landing = load.Warehouse(spark, str(tmp_path / "wh")), tmp_path / "in"
    landing.mkdir()

    def run():
        ingest_stream(spark, str(landing), wh, str(tmp_path / "cp"), COLUMNS).awaitTermination()
        return as_set(wh.table("stg_session_summary"), "source_id", "Comm", "Total_Volume")

    put(landing, 1, "A,F,20251201,090000,10,3")
    put(landing, 2, "A,F,20251202,090000,10,4", "broken")
    assert run() == {(1, "A", 3), (2, "A", 4)}
    put(landing, 3, "B,F,20251203,090000,10,5")
    assert run() == {(1, "A", 3), (2, "A", 4), (3, "B", 5)}
    assert run() == {(1, "A", 3), (2, "A", 4), (3, "B", 5)}
    assert as_set(wh.table("quarantine"), "source_id", "line") == {(2, "broken")}


def test_scratch_comes_from_the_session(spark):
    assert scratch_root(spark) == spark.sparkContext.getCheckpointDir()


