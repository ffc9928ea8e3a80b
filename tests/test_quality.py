import pytest
from conftest import as_set, plan_of

from tickloom.operators import quality
from tickloom.schemas import DIM_COMMODITY, STG_SESSION_SUMMARY, STG_TRADE_DISTRIBUTION

CLEAN = ("A", 20251201, 10, 100.0, 1.0, 2.0, 1.0, 2.0, 1)


def staging(spark, **change):
    names = STG_SESSION_SUMMARY.names
    row = tuple(change.get(name, value) for name, value in zip(names, CLEAN))
    return spark.createDataFrame([CLEAN, row], STG_SESSION_SUMMARY)


@pytest.mark.parametrize("rule, severity, change", [
    ("NEGATIVE_TURNOVER", "BLOCKER", {"Total_Turnover": -1.0}),
    ("NULL_TRADE_DATE", "BLOCKER", {"Trade_Date": None}),
    ("NEGATIVE_VOLUME", "BLOCKER", {"Total_Volume": -1}),
    ("HIGH_BELOW_LOW", "BLOCKER", {"Low": 3.0}),
    ("ZERO_TURNOVER", "WARNING", {"Total_Turnover": 0.0}),
])
def test_each_rule(spark, rule, severity, change):
    report = quality.dq_report(staging(spark, **change), "stg")
    assert as_set(report.filter("violations > 0")) == {("stg", rule, severity, 1)}
    if severity == "BLOCKER":
        with pytest.raises(quality.QualityError, match=rule):
            quality.enforce(report)
        blocked = quality.blocked_sources(quality.dq_report(staging(spark, **change), "stg", by=["source_id"]))
        assert as_set(blocked) == {(1, f"stg: {rule}")}
    else:
        assert as_set(quality.enforce(report), "rule") == {(rule,)}


def test_clean_and_empty_frames(spark):
    assert quality.enforce(quality.dq_report(staging(spark), "stg")).isEmpty()
    with pytest.raises(quality.QualityError, match="EMPTY"):
        quality.enforce(quality.dq_report(spark.createDataFrame([], STG_SESSION_SUMMARY), "stg"))


def test_rules_follow_the_columns(spark):
    df = spark.createDataFrame([("A", "Retail", 1, 1, 1)], STG_TRADE_DISTRIBUTION)
    assert as_set(quality.dq_report(df, "d"), "rule") == {("EMPTY",), ("NEGATIVE_VOLUME",)}


def test_a_report_is_one_aggregate(spark):
    assert plan_of(quality.dq_report(staging(spark), "stg")).count("Exchange") == 1


def test_volatility(spark):
    rows = [("A", d, 1, 1.0, 1.0, 1.0, 1.0, close, 1) for d, close in ((1, 100.0), (2, 121.0), (3, 145.2), (4, 100.0))]
    rows.append(("B", 2, 1, 1.0, 1.0, 1.0, 1.0, 500.0, 1))
    rows.append(("Z", 1, 1, 1.0, 1.0, 1.0, 1.0, 0.0, 1))
    rows.append(("Z", 2, 1, 1.0, 1.0, 1.0, 1.0, 5.0, 1))
    moves = quality.dq_volatility(spark.createDataFrame(rows, STG_SESSION_SUMMARY))
    assert as_set(moves, "Comm", "Trade_Date") == {("A", 2), ("A", 4)}


def test_orphans_are_counted_per_key(spark):
    codes = spark.createDataFrame([(1, "A")], DIM_COMMODITY)
    fact = spark.createDataFrame([(1,), (9,), (9,), (None,)], "Comm_id int")
    assert as_set(quality.dq_foreign_key(fact, codes, "Comm_id")) == {(9, 2)}
