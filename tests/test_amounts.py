import math
import random
import re
from collections import defaultdict
from datetime import datetime
from decimal import Decimal, localcontext

from pyspark.sql import functions as F

from tests.conftest import rows_of
from tradeloom import schemas
from tradeloom.functions import amounts, measures
from tradeloom.operators import merge, normalize, reads, signals

COMMON = [2e11, 3e11, 0.30000000000000004, 1e-17, 0.1, 0.2, 1e11, 1.5e21, 5.0, 0.0, 12345.678, 1e-28]


def written_sum(values):
    with localcontext() as context:
        context.prec = 400
        return float(sum(Decimal(repr(v)) for v in values))


def groups_of(rows):
    held = defaultdict(list)
    for group, value in rows:
        if value is not None:
            held[group].append(value)
    return held


def random_amounts(rng, kind):
    if kind == 0:
        return round(rng.uniform(0, 1e4), rng.randint(0, 8))
    if kind == 1:
        return rng.uniform(1e-9, 1)
    if kind == 2:
        return rng.uniform(-5e12, 5e12)
    return rng.choice([-1, 1]) * rng.choice(COMMON)


def test_sums_are_the_nearest_doubles(spark):
    rng = random.Random(2)
    rows = [(g, random_amounts(rng, g % 4)) for g in range(200) for _ in range(rng.randint(1, 30))]
    rows += [(200, None), (201, None), (201, 2e11)]
    frame = spark.createDataFrame(rows, "g int, x double").repartition(5)
    split = amounts.with_parts(frame, "x").groupBy("g")
    found = split.agg(*amounts.sums("x", "s"), amounts.exact_sum("x").alias("once"))
    found = {r.g: r for r in found.select("g", amounts.total("s").alias("total"), "once").collect()}
    for group, values in groups_of(rows).items():
        expected = written_sum(values)
        assert found[group].total == expected and found[group].once == expected, (group, values)
    assert found[200].total is None and found[200].once is None


def test_sums_of_binary_fractions_are_fsum(spark):
    # Numbers whose written form is their exact value, so that both ways of summing agree.
    rng = random.Random(3)
    rows = [(g, rng.choice([-1, 1]) * rng.randint(1, 2**24) * 2.0 ** rng.randint(-12, 20)) for g in range(40) for _ in range(50)]
    frame = spark.createDataFrame(rows, "g int, x double")
    found = {r.g: r.s for r in frame.groupBy("g").agg(amounts.exact_sum("x").alias("s")).collect()}
    assert found == {g: math.fsum(v) for g, v in groups_of(rows).items()}


def test_amounts_beyond_all_decimals_are_kept_as_doubles(spark):
    rows = [(0, 1e300), (0, 1.0), (1, 5e-324), (1, 0.25), (2, -1e30), (2, 1e30), (2, 7.0), (3, 1e-40), (3, 2e-40)]
    frame = spark.createDataFrame(rows, "g int, x double")
    found = {r.g: r.s for r in frame.groupBy("g").agg(amounts.exact_sum("x").alias("s")).collect()}
    assert found == {0: 1e300, 1: 0.25, 2: 7.0, 3: 1e-40 + 2e-40}


def test_differences(spark):
    rows = [(0, 3e11, 0.1), (0, 0.30000000000000004, 1e-17), (1, 0.1, 0.3), (2, None, 2e11), (3, 5.0, None)]
    frame = amounts.with_parts(spark.createDataFrame(rows, "g int, x double, y double"), "x", "y")
    sums = frame.groupBy("g").agg(*amounts.sums("x", "a"), *amounts.sums("y", "b"))
    found = dict(rows_of(sums.select("g", amounts.difference("a", "b"))))
    assert found == {0: written_sum([3e11, 0.30000000000000004, -0.1, -1e-17]), 1: -0.2, 2: -2e11, 3: 5.0}


UNUSUAL = [
    ("1", "200000000000", "1", "200000000000", "1704067200000000", "true", "true"),
    ("2", "1", "0.5", "300000000000", "1704067201000000", "false", "true"),
    ("3", "2", "0.30000000000000004", None, "1704067202000000", "true", "true"),
    ("4", "3", "1e-17", None, "1704067203000000", "false", "true"),
    ("5", "NaN", "1", "1", "1704067204000000", "true", "true"),
    ("6", "1", "Infinity", "1", "1704067204000000", "true", "true"),
    ("7", "0", "1", "1", "1704067204000000", "true", "true"),
    ("8", "1", "1", "NaN", "1704067204000000", "true", "true"),
    ("9", "1e200", "1e200", None, "1704067204000000", "true", "true"),
]


def test_no_finite_trade_is_shut_out(spark):
    trades = normalize.normalize(spark.createDataFrame(UNUSUAL, schemas.HISTORY))
    silver = normalize.valid(trades)
    assert sorted(r.event_id for r in silver.collect()) == ["batch:1", "batch:2", "batch:3", "batch:4"]
    reasons = {r.event_id: r.reject_reason for r in normalize.rejected(trades).collect()}
    assert reasons == {
        "batch:5": "bad_price",
        "batch:6": "bad_quantity",
        "batch:7": "bad_price",
        "batch:8": "bad_quote",
        "batch:9": "bad_quote",
    }
    quantity = written_sum([1.0, 0.5, 0.30000000000000004, 1e-17])
    quote = written_sum([2e11, 3e11, 0.6000000000000001, 3 * 1e-17])
    (candle,) = signals.ohlc(silver).collect()
    assert (candle.total_quantity, candle.total_quote_qty, candle.total_trades) == (quantity, quote, 4)
    (average,) = signals.vwap(silver).collect()
    assert average.vwap_price == quote / quantity
    (flow,) = signals.maker_taker_flow(silver).collect()
    assert flow.net_flow == written_sum([3e11, 3 * 1e-17, -2e11, -0.6000000000000001])
    assert {r.event_id for r in signals.large_trades(silver).collect()} == {"batch:1", "batch:2"}
    whales = signals.large_trades(silver)
    (hour,) = reads.whales_last_hour(whales, as_of=datetime(2024, 1, 1, 0, 30)).collect()
    assert (hour.whale_count_1h, hour.whale_total_value_1h) == (2, 5e11)


def test_partials_of_unusual_amounts_combine_in_any_split(spark):
    rng = random.Random(4)
    silver = normalize.valid(normalize.normalize(spark.createDataFrame(UNUSUAL * 3, schemas.HISTORY)))
    extra = spark.createDataFrame(
        [(f"x{i}", "BTCUSDT", 1.0, rng.choice(COMMON) + 1e-9, rng.choice(COMMON), datetime(2024, 1, 1), None) for i in range(60)],
        schemas.SILVER,
    )
    silver = silver.unionByName(extra).withColumn("part", F.abs(F.hash("event_id", "quantity")) % 3).cache()
    whole = measures.summarise(silver)
    split = merge.combine_partials(*[measures.summarise(silver.filter(F.col("part") == i)) for i in range(3)])
    for finish in (measures.candles, measures.average_prices, measures.taker_flow):
        assert rows_of(finish(split)) == rows_of(finish(whole))
    assert split.select(*schemas.PARTIALS.names).columns == schemas.PARTIALS.names


def test_amounts_of_the_other_side_are_not_added(spark):
    """Nothing is added for them, and a sum of no ordinary amounts is still 0 unless all amounts are of the side."""
    rows = [(1, 2.5, True), (1, 4.0, False), (2, 2.5, True), (3, 1e12, True), (4, 2.5, None), (5, None, True), (6, None, False)]
    split = amounts.with_parts(spark.createDataFrame(rows, "g int, x double, side boolean").repartition(3), "x")
    sums = split.groupBy("g").agg(*amounts.sums("x", "on", "side"), *amounts.sums("x", "off", "NOT side"))
    found = {r.g: (r.on if r.on is None else float(r.on), r.off if r.off is None else float(r.off)) for r in sums.collect()}
    assert found == {1: (2.5, 4.0), 2: (2.5, 0.0), 3: (None, 0.0), 4: (0.0, 0.0), 5: (None, 0.0), 6: (0.0, None)}
    text = sums._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum(" in text and not re.search(r"partial_sum\(CASE WHEN [^)]* ELSE ", text)
