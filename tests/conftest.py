import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

from tickloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, shuffle_partitions=4, memory="4g")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("scratch")))
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def change(key, value):
        before[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture
def make_ticks(spark):
    """Ticks from (Comm, Trade_Date, Log_Time, Price, Volume, source_id) rows, numbered in order."""
    from tickloom.schemas import TICK

    def build(*rows):
        full = [(r[0], "F", r[1], r[2], r[3], r[4], r[5], i) for i, r in enumerate(rows)]
        return spark.createDataFrame(full, TICK)

    return build


def plan_of(df):
    """The physical plan before execution, as text."""
    return df._jdf.queryExecution().executedPlan().toString()


def as_set(df, *columns):
    return {tuple(row) for row in df.select(*(columns or df.columns)).collect()}
