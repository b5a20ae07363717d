"""Every registered query against its SQL on the given tables."""

import os

import pytest

import __spark_entry__ as driver
from tests import oracle
from tests.conftest import SF_DIR
from tradeloom.plans import oracles, queries

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracles.sql()))
def test_equals_sql(spark, db, name):
    assert oracle.difference(driver.queries()[name](spark, SF_DIR), db, driver.oracle_sql()[name]) is None


def test_queries_without_sql_are_known():
    assert set(queries.QUERIES) == set(oracles.sql())
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_json_rows_hold_the_latest_candles(spark):
    texts = driver.queries()["ohlc_latest_json"](spark, SF_DIR)
    latest = driver.queries()["ohlc_latest"](spark, SF_DIR)
    read = spark.read.schema(latest.schema).json(texts.rdd.map(lambda r: r.json))
    assert sorted(map(tuple, read.select("symbol", "open_price", "total_trades").collect())) == sorted(
        map(tuple, latest.select("symbol", "open_price", "total_trades").collect())
    )


def test_entry(spark):
    assert driver.entry(spark).limit(1).count() == 1
