from datetime import date, timedelta

import pytest
from conftest import as_set, plan_of

from tickloom.functions import calendar_columns, date_of
from tickloom.operators import dims, facts, marts, quality, rollups
from tickloom.schemas import (
    DIM_COMMODITY,
    DIM_DATE,
    DIM_TRADER_TYPE,
    STG_HOURLY_STATS,
    STG_SESSION_SUMMARY,
)


def sessions(spark, *rows):
    """(Comm, Trade_Date, source_id, Open, Close) rows as session staging."""
    full = [(c, d, 10, 100.0, min(o, cl), max(o, cl), o, cl, s) for c, d, s, o, cl in rows]
    return spark.createDataFrame(full, STG_SESSION_SUMMARY)


def empty(spark, schema):
    return spark.createDataFrame([], schema)


def test_ids_are_dense_and_never_change(spark):
    first = dims.sync_commodity_dim(
        empty(spark, DIM_COMMODITY), sessions(spark, ("M", 20251201, 1, 1.0, 1.0), ("B", 20251201, 1, 1.0, 1.0))
    )
    assert as_set(first) == {(1, "B"), (2, "M")}
    later = sessions(spark, ("A", 20251202, 2, 1.0, 1.0), ("M", 20251202, 2, 1.0, 1.0), (None, 20251202, 2, 1.0, 1.0))
    second = dims.sync_commodity_dim(first, later)
    assert as_set(second) == {(1, "B"), (2, "M"), (3, "A")}
    assert dims.new_commodities(second, later).isEmpty()


def test_trader_types(spark):
    types = dims.trader_type_dim(spark)
    assert as_set(types) == {(1, "Retail"), (2, "Medium"), (3, "Shark"), (4, "Whale")}
    assert dims.merge_new_keys(types, types, "Trader_Type_Name").count() == 4
    assert dims.merge_new_keys(empty(spark, DIM_TRADER_TYPE), types, "Trader_Type_Name").count() == 4


def test_calendar_against_python(spark):
    days = [date(1999, 12, 20) + timedelta(days=i) for i in range(0, 9000, 3)]
    ids = spark.createDataFrame([(int(d.strftime("%Y%m%d")),) for d in days], "Date_id int")
    out = ids.withColumns(calendar_columns(date_of(ids["Date_id"])))
    assert as_set(out) == {
        (int(d.strftime("%Y%m%d")), d, d.year, d.month, (d.month + 2) // 3, int(d.strftime("%U")), d.strftime("%A"))
        for d in days
    }


def test_dates_that_do_not_exist_have_no_calendar(spark):
    rows = sessions(spark, ("A", 20251345, 1, 1.0, 1.0), ("A", 20251201, 1, 1.0, 1.0), ("A", 7, 1, 1.0, 1.0))
    out = dims.sync_date_dim(empty(spark, DIM_DATE), rows)
    assert as_set(out, "Date_id", "Full_Date", "Day_Name") == {
        (20251345, None, None), (7, None, None), (20251201, date(2025, 12, 1), "Monday"),
    }
    assert as_set(dims.with_iso_week(out).filter("Date_id = 20251201"), "Iso_Week") == {(49,)}


def test_session_fact_opens_with_the_first_date_and_closes_with_the_last(spark):
    staging = sessions(spark, ("A", 20251202, 1, 7.0, 8.0), ("A", 20251201, 1, 5.0, 6.0), ("X", 20251201, 1, 1.0, 1.0))
    codes = spark.createDataFrame([(4, "A")], DIM_COMMODITY)
    fact = facts.fact_session_summary(staging, codes)
    assert as_set(fact) == {(1, 4, 20251202, 20, 200.0, 5.0, 8.0, 5.0, 8.0)}
    assert as_set(quality.dq_missing_dim(staging, codes)) == {("X", 1)}
    assert quality.dq_unique(fact, ["source_id", "Comm_id"]).isEmpty()


def test_hourly_fact_key_includes_the_date(spark, make_ticks):
    ticks = make_ticks(("A", 20251201, 90000, 1.0, 1, 1), ("A", 20251202, 90500, 2.0, 1, 1))
    codes = spark.createDataFrame([(1, "A")], DIM_COMMODITY)
    fact = facts.fact_hourly_stats(rollups.hourly_stats(ticks), codes)
    assert quality.dq_unique(fact, ["source_id", "Comm_id", "Date_id", "Hour"]).isEmpty()
    assert as_set(quality.dq_unique(fact, ["source_id", "Comm_id", "Hour"]), "row_count") == {(2,)}
    assert as_set(facts.with_year(fact), "year") == {(2025,)}


def test_stored_dimensions_are_broadcast_by_size_only(spark, conf, tmp_path):
    path = str(tmp_path / "codes")
    spark.createDataFrame([(1, "A")], DIM_COMMODITY).write.parquet(path)
    staging = sessions(spark, ("A", 20251202, 1, 7.0, 8.0))

    def joined():
        return plan_of(facts.fact_hourly_stats(
            spark.createDataFrame([], STG_HOURLY_STATS), spark.read.schema(DIM_COMMODITY).parquet(path)
        ))

    assert "BroadcastHashJoin" in joined()
    conf("spark.sql.autoBroadcastJoinThreshold", "1")
    assert "SortMergeJoin" in joined()
    assert staging.count() == 1


def test_percent_change_of_a_zero_open_is_null_and_ranks_last_or_first(spark):
    staging = sessions(spark, ("A", 1, 1, 0.0, 5.0), ("B", 1, 1, 10.0, 11.0), ("C", 1, 1, 10.0, 8.0))
    assert [tuple(r) for r in marts.top_gainers(staging).collect()] == [("B", 10.0), ("C", -20.0), ("A", None)]
    assert [tuple(r) for r in marts.top_losers(staging, 2).collect()] == [("A", None), ("C", -20.0)]
    spread = marts.price_spread(staging)
    assert as_set(spread, "Comm", "Spread", "Spread_Pct") == {("A", 5.0, None), ("B", 1.0, 10.0), ("C", 2.0, 20.0)}


def test_comm_change_is_sorted_by_change(spark):
    codes = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C")], DIM_COMMODITY)
    staging = sessions(spark, ("A", 1, 1, 0.0, 5.0), ("B", 1, 1, 10.0, 8.0), ("C", 1, 1, 10.0, 11.0))
    mart = marts.comm_change(facts.fact_session_summary(staging, codes), codes)
    assert [r.Comm for r in mart.collect()] == ["C", "B", "A"]


def test_top_movers_take_n_rows_per_task(spark):
    plan = plan_of(marts.top_gainers(sessions(spark, ("A", 1, 1, 1.0, 5.0))))
    assert "TakeOrderedAndProject" in plan


def test_leaderboard_cuts_before_the_shuffle(spark):
    staging = sessions(spark, *[(c, 1, 1, 1.0, 1.0) for c in "DCBA"])
    board = marts.session_leaderboard(staging, 2)
    assert as_set(board, "Rank", "Comm") == {(1, "A"), (2, "B")}
    assert plan_of(board).count("WindowGroupLimit") == 2


def test_share_of_total_needs_no_single_task_window(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "k string, v bigint")
    shares = marts.share_of_total(df, "v")
    assert [tuple(r) for r in shares.collect()] == [("b", 3, 75.0), ("a", 1, 25.0)]
    assert "Window" not in plan_of(shares)
    zero = marts.share_of_total(spark.createDataFrame([("a", 0)], "k string, v bigint"), "v")
    assert zero.first().Share is None


def test_volume_spikes(spark):
    rows = [("A", 20251200 + d, 9, v, 1.0, 1.0, 1.0, d) for d, v in enumerate([10, 10, 10, 31, 40], start=1)]
    spikes = marts.volume_spikes(spark.createDataFrame(rows, STG_HOURLY_STATS), n=3, k=3.0)
    assert as_set(spikes, "Trade_Date", "Trailing_Volume") == {(20251204, 10.0)}


@pytest.mark.parametrize("by", [("Year",), ("Year", "Month"), ("Year", "Quarter"), ("Year", "Week_Num")])
def test_trend_by_calendar_period(spark, by):
    staging = sessions(spark, ("A", 20251201, 1, 5.0, 6.0), ("A", 20251202, 2, 7.0, 9.0))
    codes = spark.createDataFrame([(1, "A")], DIM_COMMODITY)
    dates = dims.sync_date_dim(empty(spark, DIM_DATE), staging)
    trend = marts.session_trend(facts.fact_session_summary(staging, codes), codes, dates, by)
    assert as_set(trend, "Comm", "Total_Volume", "Low", "High", "Open", "Close") == {("A", 20, 5.0, 9.0, 5.0, 9.0)}
