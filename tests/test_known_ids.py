import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tradeloom.streaming import known_ids
from tradeloom.streaming.known_ids import IdFilters


def ids(spark, low, high):
    return spark.range(low, high).select(F.concat(F.lit("batch:"), F.col("id").cast("string")).alias("event_id"))


def test_blocks_follow_the_ids():
    assert [known_ids.blocks_for(n) for n in (0, 1, 24, 25, 48, 49, 24 * 1024, 24 * 1024 + 1)] == [0, 1, 1, 2, 2, 4, 1024, 2048]


def test_no_id_is_lost_and_few_absent_ones_pass(spark, tmp_path):
    filters = IdFilters(str(tmp_path))
    blocks = {"a": filters.write(ids(spark, 0, 24 * 1024), "a"), "b": filters.write(ids(spark, 50_000, 50_010), "b")}
    assert blocks == {"a": 1024, "b": 1}
    found = filters.candidates(spark, ids(spark, 0, 24 * 1024), blocks)
    assert found.filter("part = 'a'").distinct().count() == 24 * 1024
    assert rows_of(filters.candidates(spark, ids(spark, 50_000, 50_003), blocks).filter("part = 'b'")) == [
        ("b", f"batch:{n}") for n in range(50_000, 50_003)
    ]
    absent = filters.candidates(spark, ids(spark, 1_000_000, 1_200_000), blocks)
    assert absent.count() < 200


def test_filters_are_met_by_a_join_on_part_and_block(spark, tmp_path):
    filters = IdFilters(str(tmp_path))
    blocks = {"a": filters.write(ids(spark, 0, 1000), "a"), "b": filters.write(ids(spark, 0, 50), "b")}
    text = filters.candidates(spark, ids(spark, 0, 10), blocks)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"(BroadcastHash|SortMerge)Join \[part[^\]]*block", text)
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "Python" not in text


@pytest.mark.parametrize("given", [[], [(None,)]])
def test_nothing_to_keep(spark, tmp_path, given):
    filters = IdFilters(str(tmp_path))
    assert filters.write(spark.createDataFrame(given, "event_id string"), "a") == 0
    assert filters.candidates(spark, ids(spark, 0, 3), {"a": 0}).count() == 0
    assert filters.candidates(spark, ids(spark, 0, 3), {}).count() == 0


def test_repeats_and_null_questions(spark, tmp_path):
    filters = IdFilters(str(tmp_path))
    rows = spark.createDataFrame([("x",), ("x",), (None,), ("",)], "event_id string")
    blocks = {"a": filters.write(rows, "a")}
    asked = spark.createDataFrame([("x",), (None,), ("",)], "event_id string")
    assert rows_of(filters.candidates(spark, asked.filter("event_id IS NOT NULL"), blocks)) == [("a", ""), ("a", "x")]


def test_questions_are_shuffled_without_their_masks(spark, tmp_path):
    filters = IdFilters(str(tmp_path))
    blocks = {"a": filters.write(ids(spark, 0, 1000), "a")}
    text = filters.candidates(spark, ids(spark, 0, 10), blocks)._jdf.queryExecution().optimizedPlan().toString()
    above, below = text.split("Join", 1)[0], text.split("Join", 1)[1].split("\n", 1)
    assert "shiftleft" in above + below[0] and "shiftleft" not in below[1]
