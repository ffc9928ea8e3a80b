import pytest
from compare import differences, duck

import __spark_entry__ as entry
from tickloom.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_its_twin(spark, connection, name):
    assert differences(spark, connection, SF, name) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 24
