"""Every query against its SQL counterpart, on whole tables."""

import pytest
from compare import difference
from conftest import SMALL

import __spark_entry__ as driver
from martloom.oracles import ORACLES
from martloom.queries import QUERIES


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    assert difference(QUERIES[name](spark, SMALL), ORACLES[name], SMALL) == ""


def test_entry(spark):
    assert driver.entry(spark).count() == 6
