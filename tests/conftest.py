import os
from datetime import datetime, timedelta, timezone

import pytest

from tradeloom import schemas
from tradeloom.session import local_session

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "4",
        "tests",
        **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def trades(spark):
    """Build clean trades from (id, symbol, price, quantity, seconds, flag); quote is the product."""

    def build(*rows):
        start = datetime(2024, 1, 1, tzinfo=timezone.utc)
        full = [
            (i, s, float(p), float(q), float(p) * float(q), start + timedelta(seconds=sec), flag)
            for i, s, p, q, sec, flag in rows
        ]
        return spark.createDataFrame(full, schemas.SILVER)

    return build


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def same(left, right):
    assert left.columns == right.columns
    assert rows_of(left) == rows_of(right)
