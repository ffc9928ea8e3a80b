import random

import pytest
from conftest import as_set, plan_of
from pyspark.sql import functions as F

from tickloom.operators import rollups

DAY = 20251201


def some_ticks(make_ticks, n=400, seed=3):
    """Ticks of which a third has one code, one source and one second."""
    dice = random.Random(seed)
    rows = []
    for _ in range(n):
        if dice.random() < 1 / 3:
            rows.append(("HOT", DAY, 90000, dice.randint(1, 500) / 4, dice.randint(0, 200), 1))
        else:
            time = dice.randint(0, 23) * 10000 + dice.randint(0, 59) * 100
            rows.append((dice.choice("ABC"), DAY + dice.randint(0, 1), time, dice.randint(1, 500) / 4,
                         dice.randint(0, 200), dice.randint(1, 3)))
    return rows, make_ticks(*rows)


def brute_sessions(rows):
    groups = {}
    for seq, (comm, date, time, price, volume, source) in enumerate(rows):
        groups.setdefault((source, comm, date), []).append((time, seq, price, volume))
    out = set()
    for key, ticks in groups.items():
        ticks.sort()
        prices = [t[2] for t in ticks]
        out.add((*key, sum(t[3] for t in ticks), sum(t[2] * t[3] for t in ticks), min(prices), max(prices),
                 prices[0], prices[-1]))
    return out


def test_session_summary_against_brute_force(make_ticks):
    rows, ticks = some_ticks(make_ticks)
    columns = ("source_id", "Comm", "Trade_Date", "Total_Volume", "Total_Turnover", "Low", "High", "Open", "Close")
    assert as_set(rollups.session_summary(ticks), *columns) == brute_sessions(rows)


def test_equal_times_are_taken_in_row_order(make_ticks):
    ticks = make_ticks(("A", DAY, 90000, 11.0, 1, 1), ("A", DAY, 90000, 10.0, 1, 1))
    row = rollups.session_summary(ticks).first()
    assert (row.Open, row.Close) == (11.0, 10.0)


@pytest.mark.parametrize("cut", ["seq % 3", "seq div 100", "hash(seq) % 5"])
def test_merging_any_split_equals_the_direct_rollup(make_ticks, cut):
    _, ticks = some_ticks(make_ticks)
    chunked = ticks.withColumn("chunk", F.expr(cut))
    for roll, partial, merge in (
        (rollups.hourly_stats, rollups.hourly_stats, rollups.merge_hourly),
        (rollups.session_summary, rollups.session_partials, rollups.merge_session),
        (rollups.trade_distribution, rollups.trade_distribution, rollups.merge_distribution),
    ):
        direct = roll(ticks)
        stored = partial(chunked, also=["chunk"]).drop("chunk")
        assert as_set(merge(stored), *direct.columns) == as_set(direct)
        parts = [partial(chunked.filter(F.col("chunk") == c.chunk)) for c in chunked.select("chunk").distinct().collect()]
        assert as_set(merge(*parts), *direct.columns) == as_set(direct)


def test_cells_give_the_same_rollups(make_ticks):
    _, ticks = some_ticks(make_ticks)
    cells = rollups.tick_cells(ticks)
    for from_cells, direct in (
        (rollups.hourly_from_cells(cells), rollups.hourly_stats(ticks)),
        (rollups.session_from_cells(cells), rollups.session_summary(ticks)),
        (rollups.distribution_from_cells(cells), rollups.trade_distribution(ticks)),
    ):
        assert as_set(from_cells, *direct.columns) == as_set(direct)


def test_rollups_account_for_the_same_volume(make_ticks):
    _, ticks = some_ticks(make_ticks)
    sums = [
        as_set(roll(ticks).groupBy("source_id").agg(F.sum("Total_Volume")))
        for roll in (rollups.hourly_stats, rollups.session_summary, rollups.trade_distribution)
    ]
    assert sums[0] == sums[1] == sums[2]


def test_prices_stay_within_bounds(make_ticks):
    _, ticks = some_ticks(make_ticks)
    for df in (rollups.session_summary(ticks), rollups.hourly_ohlc(ticks)):
        assert df.filter("Open < Low OR Open > High OR Close < Low OR Close > High").isEmpty()


def test_open_and_close_do_not_need_a_sort(make_ticks):
    ticks = make_ticks(("A", DAY, 90000, 11.0, 1, 1))
    for df in (rollups.session_summary(ticks), rollups.hourly_ohlc(ticks), rollups.tick_cells(ticks)):
        plan = plan_of(df)
        assert "SortAggregate" not in plan and plan.count("Exchange") == 1
