from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF_DIR, rows_of, same
from tradeloom.functions import measures
from tradeloom.operators import merge, signals
from tradeloom.plans import queries

TIMES = ["open_event_time", "close_event_time"]
T0 = datetime(2024, 1, 1)


def test_candle_orders_the_same_instant_by_id(trades):
    rows = [("b", "X", 5, 1, 0, True), ("a", "X", 7, 1, 0, False), ("c", "X", 1, 2, 0, None), ("d", "X", 3, 1, 60, True)]
    for order in (rows, rows[::-1]):
        candle = signals.ohlc(trades(*order)).orderBy("candle_time").first()
        assert (candle.open_price, candle.close_price) == (7.0, 1.0)
        assert (candle.high_price, candle.low_price) == (7.0, 1.0)
        assert (candle.total_quantity, candle.total_quote_qty, candle.total_trades) == (4.0, 14.0, 3)
        assert candle.candle_time == T0 and candle.open_event_time == T0


def test_flow_leaves_unknown_sides_out(trades):
    some = trades(("a", "X", 2, 3, 0, False), ("b", "X", 2, 1, 1, True), ("c", "X", 9, 9, 2, None), ("d", "Y", 9, 9, 2, None))
    assert rows_of(signals.maker_taker_flow(some)) == [("X", T0, 3.0, 1.0, 6.0, 2.0, 4.0)]
    # The wide measures keep bucket Y for candles and still give it no flow.
    wide = measures.summarise(some)
    assert wide.count() == 2
    same(measures.taker_flow(wide), signals.maker_taker_flow(some))


def test_vwap_ratios(trades):
    row = signals.vwap(trades(("a", "X", 2, 1, 0, True), ("b", "X", 5, 2, 1, None))).first()
    assert row.vwap_price == 4.0 and row.avg_trade_size == 1.5
    assert row.close_vs_vwap_diff == 1.0 and row.close_vs_vwap_pct == 25.0


def test_zero_quantity_gives_null_ratios(trades):
    row = signals.vwap(trades(("a", "X", 2, 0, 0, True))).first()
    assert row.vwap_price is None and row.close_vs_vwap_pct is None


def test_threshold_is_strict(trades):
    some = trades(("a", "X", 50000, 1, 0, True), ("b", "X", 50000.5, 1, 0, None))
    assert rows_of(signals.large_trades(some).select("event_id", "trade_value_usdt")) == [("b", 50000.5)]


def test_sums_are_exact_and_keep_small_amounts(trades):
    rows = [(f"i{n}", "X", 0.1, 1, 0, True) for n in range(10)]
    assert signals.ohlc(trades(*rows)).first().total_quote_qty == 1.0


def test_small_quantities_count(trades):
    row = signals.vwap(trades(("a", "X", 30000.5, 0.00004, 0, True), ("b", "X", 30000.5, 0.00000001, 1, False))).first()
    assert row.total_quantity == 0.00004001 and row.vwap_price == pytest.approx(30000.5)


def test_upsert_refuses_repeated_source_keys_and_unknown_names(spark):
    target = spark.createDataFrame([(1, "a")], "k int, name string")
    twins = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "k int, name string")
    with pytest.raises(Exception, match="two source rows for one key"):
        merge.upsert(target, twins, ["k"], {"name": F.col("source.name")}).collect()
    for update, insert in (({"nome": F.lit(1)}, None), ({}, {"nome": F.lit(1)})):
        with pytest.raises(ValueError, match="nome"):
            merge.upsert(target, target, ["k"], update, insert)
    with pytest.raises(ValueError, match="q"):
        merge.upsert(target, target, ["q"], {})


def test_both_sides_of_every_merge_rule_fire(spark):
    """In the registered fixture some source rows open earlier, some close later, and some do neither."""
    early, late = (
        signals.ohlc(half, "1 hour").select("symbol", "candle_time", *[F.col(c).alias(c + side) for c in TIMES])
        for half, side in zip(queries._halves(spark, SF_DIR), ("", "_new"))
    )
    both = early.join(late, ["symbol", "candle_time"])
    for rule in ("open_event_time_new < open_event_time", "close_event_time_new > close_event_time"):
        assert both.filter(rule).count() and both.filter(f"NOT ({rule})").count()


def test_upsert_updates_inserts_and_keeps(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (None, "n", 0)], "k int, name string, n int")
    source = spark.createDataFrame([(2, "B", 5), (3, "C", 7), (None, "m", 1)], "k int, name string, n int")
    added = {"n": F.col("target.n") + F.col("source.n")}
    merged = merge.upsert(target, source, ["k"], added)
    # NULL keys match nothing: both rows stay.
    assert rows_of(merged) == [(1, "a", 10), (2, "b", 25), (3, "C", 7), (None, "m", 1), (None, "n", 0)]
    mapped = merge.upsert(target, source, ["k"], added, {"k": F.col("source.k"), "n": -F.col("source.n")})
    assert rows_of(mapped.filter("k = 3")) == [(3, None, -7)]


def test_insert_if_absent_keeps_the_first(trades):
    target = trades(("a", "X", 1, 1, 0, True))
    source = trades(("a", "X", 9, 9, 9, True), ("b", "X", 2, 2, 2, None))
    merged = merge.insert_if_absent(target, source)
    assert rows_of(merged.select("event_id", "price")) == [("a", 1.0), ("b", 2.0)]
    same(merge.insert_if_absent(merged, source), merged)


def test_finished_tables_merge_like_a_recompute(trades):
    first = [("a", "X", 5, 1, 10, True), ("b", "X", 7, 1, 20, False), ("e", "Y", 1, 1, 0, True)]
    late = [("c", "X", 2, 2, 5, False), ("d", "X", 3, 1, 15, True), ("f", "Z", 4, 1, 0, False)]
    old, new, whole = trades(*first), trades(*late), trades(*first, *late)
    same(merge.merge_ohlc(signals.ohlc(old), signals.ohlc(new)), signals.ohlc(whole))
    same(merge.merge_flow(signals.maker_taker_flow(old), signals.maker_taker_flow(new)), signals.maker_taker_flow(whole))
    same(merge.merge_vwap(signals.vwap(old), signals.vwap(new)), signals.vwap(whole))


def test_equal_times_keep_the_targets_open_and_close(trades):
    old, new = trades(("z", "X", 5, 1, 10, True)), trades(("a", "X", 9, 1, 10, True))
    merged = merge.merge_ohlc(signals.ohlc(old), signals.ohlc(new)).first()
    assert (merged.open_price, merged.close_price) == (5.0, 5.0)


trade_rows = st.lists(
    st.tuples(
        st.sampled_from(["X", "Y"]),
        st.integers(1, 9),
        st.integers(1, 4),
        st.integers(0, 150),
        st.sampled_from([True, False, None]),
        st.integers(0, 2),
    ),
    min_size=1,
    max_size=25,
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(trade_rows)
def test_any_split_combines_to_the_whole(trades, rows):
    named = [(f"i{n}", s, p / 10, q, sec, flag) for n, (s, p, q, sec, flag, _) in enumerate(rows)]
    parts = [[named[n] for n, row in enumerate(rows) if row[5] == batch] for batch in range(3)]
    summed = [measures.summarise(trades(*part)) for part in parts]
    same(merge.combine_partials(*reversed(summed)), measures.summarise(trades(*named)).select(*summed[0].columns))
