import pytest
from conftest import as_set, plan_of
from pyspark.sql import functions as F

from tickloom.functions import tick_order, trader_type
from tickloom.operators.ticks import valid_ticks, with_hour, with_trader_type, with_turnover
from tickloom.sources import ticks_from_events


def test_only_positive_prices_with_a_code_are_valid(make_ticks):
    ticks = make_ticks(
        ("A", 20251201, 90000, 5.0, 1, 1), ("A", 20251201, 90000, 0.0, 1, 1),
        ("A", 20251201, 90000, -1.0, 1, 1), ("A", 20251201, 90000, None, 1, 1),
        ("A", 20251201, 90000, float("nan"), 1, 1), (None, 20251201, 90000, 5.0, 1, 1),
    )
    assert as_set(valid_ticks(ticks), "seq") == {(0,)}


@pytest.mark.parametrize("volume, label", [
    (0, "Retail"), (5, "Retail"), (6, "Medium"), (20, "Medium"), (21, "Shark"), (100, "Shark"),
    (101, "Whale"), (None, None),
])
def test_trade_size_classes(make_ticks, volume, label):
    ticks = make_ticks(("A", 20251201, 90000, 1.0, volume, 1))
    assert with_trader_type(ticks).first().Trader_Type == label


def test_turnover_and_hour(make_ticks):
    ticks = make_ticks(("A", 20251201, 235959, 2.5, 4, 1), ("A", 20251201, 59, 2.0, 3, 1))
    assert as_set(with_hour(with_turnover(ticks)), "Turnover", "Hour") == {(10.0, 23), (6.0, 0)}


def test_order_key_follows_time_then_row(spark):
    pairs = [(0, 0), (0, 2**43 - 1), (1, 0), (235959, 7), (235959, 8), (999999, 0)]
    df = spark.createDataFrame(pairs, "Log_Time int, seq bigint").withColumn("key", tick_order())
    ordered = [(r.Log_Time, r.seq) for r in df.orderBy("key").collect()]
    assert ordered == sorted(pairs)


@pytest.mark.parametrize("time, row", [(-1, 0), (1 << 20, 0), (1, 1 << 43), (1, -1)])
def test_order_key_refuses_what_does_not_fit(spark, time, row):
    df = spark.createDataFrame([(time, row)], "Log_Time int, seq bigint")
    with pytest.raises(Exception, match="out of range"):
        df.select(tick_order()).collect()


def test_expressions_stay_in_the_jvm_and_filters_reach_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = plan_of(valid_ticks(ticks_from_events(events)).select(trader_type(), "Price"))
    assert "Python" not in plan
    assert "GreaterThan(value,0.0)" in plan
    assert "user_id" not in plan


def test_volume_of_any_json_object(spark):
    rows = [('{"k": 7}',), ('{"a": "\\"k\\": 1", "k": 9}',), ('{"j": 1}',), (None,)]
    events = spark.createDataFrame(rows, "props string").select(
        F.lit(1).cast("bigint").alias("event_id"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ts"),
        F.lit("view").alias("event_type"), F.lit(1.0).alias("value"), "props",
    )
    assert [r.Volume for r in ticks_from_events(events).collect()] == [7, 9, None, None]
