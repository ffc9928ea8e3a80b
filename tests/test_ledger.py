import random
from datetime import datetime, timedelta

from conftest import as_set, plan_of

from tickloom.operators import ledger
from tickloom.schemas import FILE_STATUS_LOG, JOB_ENTRY

T0 = datetime(2025, 12, 1, 7, 0)


def log(spark, *rows):
    """(file_id, status, minutes after T0, etl_sec) rows in order."""
    full = [(f, s, T0 + timedelta(minutes=m), sec, i, None, None, None) for i, (f, s, m, sec) in enumerate(rows)]
    return spark.createDataFrame(full, FILE_STATUS_LOG)


def test_status_folds_the_transitions(spark):
    rows = log(spark, (1, "PENDING", 0, 0), (1, "PROCESSING", 5, 0), (1, "FAILED", 6, 60), (1, "PENDING", 9, 0),
               (1, "PROCESSING", 10, 0), (1, "SUCCESS", 10, 42), (2, "PENDING", 1, 0))
    assert as_set(ledger.file_status(rows)) == {
        (1, "SUCCESS", T0, T0 + timedelta(minutes=10), 42, 1),
        (2, "PENDING", T0 + timedelta(minutes=1), T0 + timedelta(minutes=1), 0, 0),
    }
    assert "SortAggregate" not in plan_of(ledger.file_status(rows))


def test_work_lists(spark):
    status = ledger.file_status(log(
        spark, (9, "PENDING", 0, 0), (8, "PENDING", 0, 0), (7, "SUCCESS", 0, 0), (6, "FAILED", 0, 0),
        (5, "FAILED", 0, 0), (5, "FAILED", 1, 0), (5, "FAILED", 2, 0),
    ))
    assert [r.file_id for r in ledger.pending_files(status).collect()] == [8]
    assert [r.file_id for r in ledger.pending_files(status, 5).collect()] == [8, 9]
    assert as_set(ledger.retryable_files(status)) == {(6, 1)}


def test_seed_and_backfill(spark):
    assert as_set(ledger.seed_next(log(spark), T0), "file_id", "status") == {(6076, "PENDING")}
    rows = log(spark, (6080, "PENDING", 0, 0), (6079, "SUCCESS", 0, 5))
    assert as_set(ledger.seed_next(rows, T0), "file_id") == {(6081,)}
    redo = ledger.request_backfill(rows, [6079, 1], T0 + timedelta(hours=1))
    assert as_set(redo, "file_id", "status") == {(6079, "PENDING")}
    assert as_set(ledger.file_status(rows.unionByName(redo)), "file_id", "status") == {
        (6079, "PENDING"), (6080, "PENDING"),
    }


def test_every_pair_of_states(spark):
    legal = {("PENDING", "PROCESSING"), ("PROCESSING", "SUCCESS"), ("PROCESSING", "FAILED"),
             ("SUCCESS", "PENDING"), ("FAILED", "PENDING")}
    pairs = [(a, b) for a in ledger.STATUSES for b in ledger.STATUSES]
    rows = []
    for i, (a, b) in enumerate(pairs):
        rows += [(i, a, 0, 0), (i, b, 1, 0)]
    found = as_set(ledger.illegal_transitions(log(spark, *rows)), "file_id", "prev_status", "status")
    expected = {(i, a, b) for i, (a, b) in enumerate(pairs) if (a, b) not in legal}
    expected |= {(i, None, a) for i, (a, b) in enumerate(pairs) if a != "PENDING"}
    assert found == expected


def test_transitions_of_a_file_that_owns_a_third_of_the_log(spark, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    dice = random.Random(4)
    rows = [(0 if i % 3 == 0 else dice.randint(1, 40), dice.choice(ledger.STATUSES), i // 50, 0) for i in range(1500)]
    before, expected = {}, set()
    for i, (file, status, _, _) in enumerate(rows):
        previous = before.get(file)
        if status not in ledger.LEGAL_TRANSITIONS[previous]:
            expected.add((i, previous, status))
        before[file] = status
    assert as_set(ledger.illegal_transitions(log(spark, *rows)), "seq", "prev_status", "status") == expected


def test_service_levels(spark):
    rows = log(spark, (1, "FAILED", 0, 999), (2, "SUCCESS", 0, 121), (3, "SUCCESS", 0, 120),
               (4, "SUCCESS", 60, 1), (5, "SUCCESS", 59, 1), (6, "PENDING", 600, 0))
    report = ledger.sla_report(rows)
    assert as_set(report, "file_id", "too_slow", "too_late", "level") == {
        (1, None, None, "CRITICAL"), (2, True, False, "WARNING"), (3, False, False, "PASS"),
        (4, False, True, "WARNING"), (5, False, False, "PASS"),
    }
    tokyo = ledger.sla_report(rows, max_sec=1800, deadline_hour=17, timezone="Asia/Tokyo")
    assert as_set(tokyo.filter("level = 'WARNING'"), "file_id") == {(4,)}


def test_service_levels_do_not_depend_on_the_session_zone(spark, conf):
    rows = log(spark, (4, "SUCCESS", 60, 1), (5, "SUCCESS", 59, 1))
    conf("spark.sql.session.timeZone", "America/New_York")
    assert as_set(ledger.sla_report(rows), "file_id", "level") == {(4, "WARNING"), (5, "PASS")}


def test_job_log(spark):
    rows = ledger.job_entry(spark, "SUCCESS", T0, file_id=7, row_count=3).unionByName(
        ledger.job_entry(spark, "SUCCESS", T0 + timedelta(minutes=1), row_count=4)
    ).unionByName(ledger.job_entry(spark, "FAILED", T0, error_message="boom"))
    assert rows.schema == JOB_ENTRY
    assert as_set(ledger.job_report(rows)) == {
        ("SUCCESS", 2, 7, T0 + timedelta(minutes=1)), ("FAILED", 1, 0, T0),
    }
    assert as_set(rows, "file_id") == {("7",), (None,)}
    numbered = ledger.with_log_id(rows.filter("status = 'SUCCESS'"))
    assert as_set(numbered, "log_id", "row_count") == {(1, 3), (2, 4)}


def test_only_current_loads_are_visible(spark):
    fact = spark.createDataFrame([(1, 1, "old"), (1, 2, "new"), (2, 1, "a"), (2, 2, "failed"), (3, 1, "running")],
                                 "source_id int, load_id bigint, v string")
    full = [(1, "SUCCESS", T0, 0, 0, 1), (1, "SUCCESS", T0, 0, 1, 2), (2, "SUCCESS", T0, 0, 0, 1),
            (2, "FAILED", T0, 0, 1, 2), (3, "PROCESSING", T0, 0, 0, 1)]
    assert as_set(ledger.visible(fact, spark.createDataFrame([(*row, None, None) for row in full], FILE_STATUS_LOG)), "v") == {("new",), ("a",)}


def test_states_fold_in_any_order_and_grouping(spark):
    """Partial states of random parts of a log, folded in two steps, are the fold of the log."""
    dice = random.Random(3)
    full = [(dice.randrange(9), dice.choice(ledger.STATUSES), T0 + timedelta(minutes=dice.randrange(40)), dice.randrange(99), i, i % 7,
             dice.choice([None, f"{i % 7}-x"]), None) for i in range(200)]
    whole = spark.createDataFrame(full, FILE_STATUS_LOG)
    parts = [ledger.fold_states(ledger.transition_states(whole.filter(f"seq % 3 = {k}"))) for k in range(3)]
    folded = ledger.fold_states(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert as_set(folded) == as_set(ledger.fold_states(ledger.transition_states(whole)))
    assert as_set(ledger.status_of(folded)) == as_set(ledger.file_status(whole))
    assert as_set(folded.filter("ok_at IS NOT NULL").select("file_id", "load_id")) == as_set(
        ledger.current_loads(whole).select("source_id", "load_id"))
