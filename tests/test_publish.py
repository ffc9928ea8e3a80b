import os
import random
import zipfile
from datetime import datetime, timedelta

import pytest
from conftest import as_set, plan_of

from tickloom.operators import ledger, quality
from tickloom.plans import closes, load, publish
from tickloom.schemas import TICK_COLUMNS
from tickloom.streaming import batch_loader

COLUMNS = list(TICK_COLUMNS)
T0 = datetime(2025, 12, 1, 7, 0)


def put(folder, file_id, *lines):
    with zipfile.ZipFile(os.path.join(folder, f"{file_id}.zip"), "w") as z:
        z.writestr("T.csv", "\n".join([",".join(COLUMNS), *lines]) + "\n")


def warehouse(spark, tmp_path):
    return load.Warehouse(spark, str(tmp_path / "wh"))


def run(wh, tmp_path, ids, load_id):
    return load.load_files(wh.spark, wh, f"{tmp_path}/{{id}}.zip", ids, load_id, COLUMNS)


def seen(wh, name="fact_session_summary"):
    return as_set(load.visible_fact(wh, name), "source_id", "Total_Volume", "load_id")


def test_a_load_that_died_after_its_facts_leaves_nothing(spark, tmp_path, monkeypatch):
    wh = warehouse(spark, tmp_path)
    put(tmp_path, 7, "A,F,20241231,090000,10,3", "B,F,20250102,090000,10,4")
    put(tmp_path, 8, "A,F,20250102,090000,10,5")
    with monkeypatch.context() as patch:
        patch.setattr(load, "load_checks", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(wh, tmp_path, [7, 8], 1)
    assert wh.table("fact_session_summary").count() == 3 and seen(wh) == set()
    # The files come again, one emptied and one with less; the same load is run again.
    put(tmp_path, 7, "A,F,20241231,090000,0,3")
    put(tmp_path, 8, "A,F,20250102,090000,10,6")
    assert as_set(run(wh, tmp_path, [7, 8], 1), "file_id", "status") == {(7, "SUCCESS"), (8, "SUCCESS")}
    assert seen(wh) == {(8, 6, 1)} and as_set(load.visible_fact(wh, "fact_hourly_stats"), "year") == {(2025,)}
    assert ledger.illegal_transitions(wh.table("file_status_log")).isEmpty()
    # Same load, once more: still only the last try, and its keys are unique.
    run(wh, tmp_path, [7, 8], 1)
    assert seen(wh) == {(8, 6, 1)}
    assert load.load_checks(wh, 1).filter("violations > 0").isEmpty()


def batches(spark, tmp_path):
    paths = lambda *ids: spark.createDataFrame([(f"file:{tmp_path}/{i}.zip",) for i in ids], "path string")
    return [paths(1, 2), paths(3)]


def contents(wh):
    """Ledger, job log and facts without what a clock says."""
    log = wh.table("file_status_log").select("file_id", "status", "seq", "load_id", "txn")
    jobs = wh.table("etl_job_logs").select("log_id", "file_id", "task_id", "status", "row_count", "error_message", "txn")
    return (sorted(map(str, log.collect())), sorted(map(str, jobs.collect())), sorted(seen(wh)),
            as_set(wh.table("stg_session_summary")), as_set(wh.table("quarantine")), as_set(wh.table("dim_commodity")))


def feed(tmp_path):
    put(tmp_path, 1, "A,F,20251201,090000,10,3", "broken")
    put(tmp_path, 2, "B,F,20251202,090000,10,4")
    (tmp_path / "3.zip").write_bytes(b"junk")


def test_every_batch_twice_is_every_batch_once(spark, tmp_path):
    feed(tmp_path)
    results = []
    for times in (1, 2):
        wh = load.Warehouse(spark, str(tmp_path / f"wh{times}"))
        loader = batch_loader(wh, COLUMNS)
        for i, batch in enumerate(batches(spark, tmp_path)):
            for _ in range(times):
                loader(batch, i)
        results.append(contents(wh))
    assert results[0] == results[1]
    assert len(results[0][0]) == 9


@pytest.mark.parametrize("dies_in", ["load_star", "load_checks", "log_jobs", "the outcome"])
def test_a_batch_that_was_killed_goes_on(spark, tmp_path, monkeypatch, dies_in):
    """Killed, not failed: nothing is written after the place where it dies."""
    feed(tmp_path)
    once, wh = load.Warehouse(spark, str(tmp_path / "once")), warehouse(spark, tmp_path)
    batch = batches(spark, tmp_path)[0]
    batch_loader(once, COLUMNS)(batch, 0)

    class Killed(BaseException):
        pass

    def die(*_, **__):
        raise Killed

    append = load.Warehouse.append
    with monkeypatch.context() as patch:
        if dies_in == "log_jobs":
            patch.setattr(load.Warehouse, dies_in, die)
        elif dies_in == "the outcome":
            patch.setattr(load.Warehouse, "append", lambda self, name, df: die() if name == "file_status_log" and not df.filter(
                "status = 'SUCCESS'").isEmpty() else append(self, name, df))
        else:
            patch.setattr(load, dies_in, die)
        with pytest.raises(Killed):
            batch_loader(wh, COLUMNS)(batch, 0)
    assert seen(wh) == set()
    batch_loader(wh, COLUMNS)(batch, 0)
    assert contents(wh) == contents(once)


def test_ledger_snapshots(spark, tmp_path):
    """Late rows, snapshots at any time: the state is the fold of the whole log, from one era's files."""
    wh, dice = warehouse(spark, tmp_path), random.Random(5)
    for step in range(9):
        files = spark.createDataFrame([(dice.randrange(6),) for _ in range(3)], "file_id int").distinct()
        at = T0 + timedelta(minutes=dice.choice([step, dice.randrange(12)]))
        wh.append("file_status_log", ledger.transitions(files, dice.choice(ledger.STATUSES), at, step, step % 4, step=step, segment=f"s{step}"))
        if step % 3 == 2:
            wh.snapshot_ledger()
        assert as_set(ledger.status_of(wh.ledger_state())) == as_set(ledger.file_status(wh.table("file_status_log")))
    assert wh.era() == 4 and wh.partitions("ledger_snapshot") == ["2", "3"]
    read = {path.split("/wh/")[1].rsplit("/", 1)[0] for path in wh.ledger_state().inputFiles()}
    assert read <= {"ledger_snapshot/era=3", "file_status_log/era=4"} and "ledger_snapshot/era=3" in read
    # A snapshot that was not finished does not count.
    wh.spark.range(1).write.parquet(wh.path("ledger_snapshot/era=4"))
    os.remove(wh.path("ledger_snapshot/era=4") + "/_SUCCESS")
    assert wh.era() == 4


def test_a_load_takes_a_snapshot_when_the_era_has_many_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(load.Warehouse, "files_per_era", 2)
    wh = warehouse(spark, tmp_path)
    for i in range(1, 3):
        put(tmp_path, i, f"A,F,2025120{i},090000,10,{i}")
        run(wh, tmp_path, [i], i)
    assert wh.era() > 1 and len(wh.listing(f"file_status_log/era={wh.era()}")) < 2
    assert seen(wh) == {(1, 1, 1), (2, 2, 2)}
    numbers = [r.log_id for r in wh.table("etl_job_logs").orderBy("log_id").collect()]
    assert numbers == list(range(1, len(numbers) + 1))


def stage(wh, make_ticks, load_id, *ticks):
    """A load without archives: staging, facts and the ledger row that makes them visible."""
    load.stage_ticks(wh, make_ticks(*ticks))
    ids = sorted({t[-1] for t in ticks})
    segment = publish.new_segment(load_id)
    load.load_star(wh, load_id, ids, segment)
    files = wh.spark.createDataFrame([(i,) for i in ids], "file_id int")
    wh.append("file_status_log", ledger.transitions(files, "SUCCESS", T0 + timedelta(minutes=load_id), load_id=load_id, segment=segment))


def test_compaction_keeps_what_is_seen_and_bounds_the_folders(spark, tmp_path, make_ticks):
    wh, folders = warehouse(spark, tmp_path), []
    for n in range(1, 5):
        stage(wh, make_ticks, n, ("A", 20241230 + n % 2, 90000, 1.0, n, n), ("A", 20250102, 90000, 2.0, n, n % 3 + 1))
        if n % 2 == 0:
            before = {name: as_set(load.visible_fact(wh, name)) for name in publish.FACTS}
            assert publish.compact_facts(wh)
            assert before == {name: as_set(load.visible_fact(wh, name)) for name in publish.FACTS}
            assert publish.vacuum(wh, T0 + timedelta(days=n)) is not None
            folders.append([len(wh.partitions(name)) for name in publish.FACTS])
            assert before == {name: as_set(load.visible_fact(wh, name)) for name in publish.FACTS}
    assert all(count <= 8 for count in folders[-1])
    publish.vacuum(wh, T0 + timedelta(days=30))
    live = {r[0] for r in publish.current_segments(wh).select("stored").collect()}
    assert set(wh.partitions("fact_session_summary")) == live and len(live) <= 3
    assert publish.compact_facts(wh) is None or len(live) > 1
    # A load after a compaction takes its sources out of it.
    stage(wh, make_ticks, 20, ("Z", 20250105, 90000, 5.0, 99, 2))
    assert (2, 99, 20) in seen(wh) and len([row for row in seen(wh) if row[0] == 2]) == 1


def test_a_compaction_that_died_is_not_seen(spark, tmp_path, make_ticks, monkeypatch):
    wh = warehouse(spark, tmp_path)
    for n in (1, 2):
        stage(wh, make_ticks, n, ("A", 20250102, 90000, 1.0, n, n))
    before, write = seen(wh), publish.write_facts

    def fail(wh, name, *rest, **more):
        if name == "fact_hourly_stats":
            raise OSError("gone")
        write(wh, name, *rest, **more)

    with monkeypatch.context() as patch:
        patch.setattr(publish, "write_facts", fail)
        with pytest.raises(OSError):
            publish.compact_facts(wh)
    assert seen(wh) == before and wh.complete("fact_manifest") == []
    publish.vacuum(wh, T0)
    gone = publish.vacuum(wh, T0 + timedelta(days=2))
    assert len(gone) == 1 and gone[0].startswith("c1-") and seen(wh) == before
    assert publish.compact_facts(wh) and seen(wh) == before


def test_vacuum_leaves_a_running_load_alone(spark, tmp_path, make_ticks):
    wh = warehouse(spark, tmp_path)
    load.stage_ticks(wh, make_ticks(("A", 20250102, 90000, 1.0, 1, 1)))
    files = spark.createDataFrame([(1,)], "file_id int")
    wh.append("file_status_log", ledger.transitions(files, "PROCESSING", T0, load_id=1, step=2, segment="1-run"))
    load.load_star(wh, 1, [1], "1-run")
    for day in (0, 9):
        assert publish.vacuum(wh, T0 + timedelta(days=day)) == []
    wh.append("file_status_log", ledger.transitions(files, "SUCCESS", T0, load_id=1, step=3, segment="1-run"))
    assert seen(wh) == {(1, 1, 1)}


def sessions(spark, *rows):
    return spark.createDataFrame([(c, d, 1, 1.0, 1.0, 1.0, p, p, s) for c, d, p, s in rows],
                                 "Comm string, Trade_Date int, Total_Volume long, Total_Turnover double, Low double, High double, Open double, Close double, source_id int")


def restage(wh, ids, rows):
    """What a load does to staged sessions and the carried closes."""
    closes.ensure(wh)
    closes.forget(wh, ids, load._staged(wh, "stg_session_summary", ids))
    wh.clear("stg_session_summary", ids)
    wh.replace("stg_session_summary", sessions(wh.spark, *rows))
    staged = load._staged(wh, "stg_session_summary", ids)
    months = closes.remember(wh, ids, staged)
    return as_set(closes.warnings(wh, staged, months))


def test_carried_closes_warn_as_all_of_history_does(spark, tmp_path):
    """Sessions in random order, late ones and corrected ones over three years."""
    wh, dice = warehouse(spark, tmp_path), random.Random(11)
    for _ in range(8):
        ids = sorted(dice.sample(range(1, 7), dice.choice([1, 1, 2])))
        rows = []
        for source in ids:
            month = dice.choice([202401, 202402, 202406, 202411, 202502, 202603])
            for code in dice.sample("ABC", dice.choice([0, 1, 2, 3])):
                rows += [(code, month * 100 + day, dice.choice([10.0, 11.0, 13.0, 20.0]), source) for day in dice.sample(range(1, 4), 2)]
        warned = restage(wh, ids, rows)
        everything = wh.table("stg_session_summary")
        assert as_set(closes.volatility(wh), "Comm", "Trade_Date", "Close", "Prev_Close") == as_set(
            quality.dq_volatility(everything), "Comm", "Trade_Date", "Close", "Prev_Close")
        whole = quality.volatility_report(everything, "s").select("source_id", "violations")
        assert warned == {row for row in as_set(whole) if row[0] in ids}


def test_a_load_reads_no_older_sessions(spark, tmp_path):
    wh = warehouse(spark, tmp_path)
    for source, month in enumerate((202401, 202402, 202403), start=1):
        restage(wh, [source], [("A", month * 100 + 1, 10.0 * source, source)])
    read = {path.split("/wh/")[1].rsplit("/", 1)[0] for path in closes.volatility(wh, [202403]).inputFiles()}
    assert all(not path.startswith("stg_session_summary") for path in read)
    assert "PartitionFilters: [isnotnull(month" in plan_of(closes.volatility(wh, [202403]))
    assert as_set(closes.volatility(wh, [202403]), "Trade_Date", "Prev_Close") == {(20240301, 20.0)}
    assert sorted(wh.partitions("state_opening")) == ["202402", "202403"]


def test_a_kill_between_forgetting_and_remembering(spark, tmp_path):
    wh = warehouse(spark, tmp_path)
    restage(wh, [1], [("A", 20240101, 10.0, 1)])
    restage(wh, [2], [("A", 20240301, 15.0, 2)])
    closes.forget(wh, [1], load._staged(wh, "stg_session_summary", [1]))
    wh.clear("stg_session_summary", [1])  # killed here, and run again with a corrected delivery
    restage(wh, [1], [("A", 20240201, 14.0, 1)])
    assert as_set(closes.volatility(wh)) == as_set(quality.dq_volatility(wh.table("stg_session_summary")).select(*closes.volatility(wh).columns)) == set()


def test_staging_without_a_load_rebuilds_the_closes(spark, tmp_path, make_ticks):
    wh = warehouse(spark, tmp_path)
    load.stage_ticks(wh, make_ticks(("A", 20240102, 90000, 10.0, 1, 1), ("A", 20240203, 90000, 20.0, 1, 2)))
    assert wh.listing("state_closes") == []
    put(tmp_path, 3, "A,F,20240305,090000,30,3")
    run(wh, tmp_path, [3], 1)
    assert as_set(closes.volatility(wh), "Trade_Date", "Prev_Close") == {(20240203, 10.0), (20240305, 20.0)}
    entry = wh.table("etl_job_logs").filter("task_id = 'load_files'").first()
    assert (entry.row_count, entry.error_message) == (3, "WARNING stg_session_summary VOLATILITY (1)")


def test_rows_are_counted_as_they_are_written(spark, tmp_path, make_ticks, monkeypatch):
    wh = warehouse(spark, tmp_path)
    ticks = make_ticks(("A", 20240102, 90000, 10.0, 1, 1), ("A", 20240102, 100000, 10.0, 1, 1), ("A", 20240102, 90000, 1.0, -5, 2))
    report = load.stage_ticks(wh, ticks)
    rows = as_set(report.filter("rule = 'ROWS' AND source_id = 1"), "dataset", "violations")
    assert rows == {("stg_hourly_stats", 2), ("stg_session_summary", 1), ("stg_trade_distribution", 1)}
    replace = load.Warehouse.replace
    monkeypatch.setattr(load.Warehouse, "replace", lambda self, name, df, written=None: replace(self, name, df.limit(0), written))
    with pytest.raises(RuntimeError, match="rows written"):
        load.stage_ticks(wh, ticks)
