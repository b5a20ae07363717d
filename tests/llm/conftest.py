import os
import random

import pytest
from pyspark.sql import types as T

from tradeloom.session import ship_package

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def documents(spark):
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


# Columns that operators use inside, with other meanings here.
CLASHING = ["row", "id", "size", "digest", "print", "root", "block", "word", "n", "copies", "sketch", "range", "tie"]


@pytest.fixture(scope="session")
def frame(spark):
    """Documents (doc_id, text, source) with extra columns whose names operators use inside."""

    def build(*rows):
        fields = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
        fields += [T.StructField("source", T.StringType())]
        fields += [T.StructField(name, T.StringType()) for name in CLASHING]
        full = [(*r, *[None] * (3 - len(r)), *["x"] * len(CLASHING)) for r in rows]
        return spark.createDataFrame(full, T.StructType(fields))

    return build


def odd_rows():
    """Nulls in all columns, empty and blank texts, ties, repeated rows, a very long text."""
    rng = random.Random(5)
    long_text = " ".join("".join(rng.choices("abcdefgh", k=rng.randint(1, 9))) for _ in range(60_000))
    prose = " ".join("".join(rng.choices("etaoinsh", k=rng.randint(1, 7))) for _ in range(300))
    return [
        (1, prose, "a"),
        (1, prose, "a"),
        (2, prose.upper(), "a"),
        (3, prose.replace("e", "a", 1), "b"),
        (4, None, "b"),
        (5, "", None),
        (None, "alone without an id", "b"),
        (None, None, None),
        (6, " \t\n ", "a"),
        (7, long_text, "b"),
        (8, "É ß 가 é 😀 \x00   x", "é"),
        (9, "word", "c"),
    ]
