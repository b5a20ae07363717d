import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tradeloom import schemas
from tradeloom.operators import reads, signals, tables

MINUTES = [("a", "X", 100, 1, 0, False), ("b", "X", 110, 2, 60, False), ("c", "Y", 50, 4, 60, True), ("d", "Y", 60, 1, 120, None)]


def gold(some, threshold=150.0):
    return signals.ohlc(some), signals.maker_taker_flow(some), signals.large_trades(some, threshold), signals.vwap(some)


def test_latest_candles_by_time_then_symbol(trades):
    ohlc = signals.ohlc(trades(*MINUTES))
    newest = reads.latest_ohlc(ohlc, limit="3").collect()
    assert [(r.symbol, r.close_price) for r in newest] == [("Y", 60.0), ("X", 110.0), ("Y", 50.0)]
    assert "open_event_time" not in newest[0].asDict()
    assert [r.symbol for r in reads.latest_ohlc(ohlc, symbol=" x ").collect()] == ["X", "X"]


def test_latest_whales_from_the_value_up(trades):
    whales = signals.large_trades(trades(*MINUTES), 90.0)
    assert [r.event_id for r in reads.latest_whales(whales, min_value=200).collect()] == ["b", "c"]
    assert [r.event_id for r in reads.latest_whales(whales, symbol="Y", min_value="0").collect()] == ["c"]
    assert reads.latest_whales(whales).count() == 0


@pytest.mark.parametrize("symbol", ["btc-usd", "A" * 21, "x'; --", "É"])
def test_bad_symbols(symbol):
    with pytest.raises(ValueError):
        reads.check_symbol(symbol)


def test_good_symbols():
    assert reads.check_symbol(None) is None and reads.check_symbol("  ") is None
    assert reads.check_symbol(" btcusdt ") == "BTCUSDT"


@pytest.mark.parametrize("limit", [0, -1, 5001, "ten", None, "1.5", 2.7, True, float("inf")])
def test_bad_limits(limit):
    with pytest.raises(ValueError):
        reads.check_limit(limit, 5000)


@pytest.mark.parametrize("value", [-1, "much", None, "nan"])
def test_bad_values(value):
    with pytest.raises(ValueError):
        reads.check_min_value(value)


def test_summary(trades):
    row = reads.dashboard_summary(*gold(trades(*MINUTES)), min_value=150, as_of="2024-01-01 00:02:00").first()
    assert tuple(row.latest_price) == ("Y", 60.0, datetime(2024, 1, 1, 0, 2))
    assert row.price_change_1h_pct == pytest.approx(-40.0)
    # Bought 100 + 220, sold 200.
    assert row.net_flow_1h == row.net_flow == 120.0 and row.market_sentiment == "BULLISH"
    assert (row.whale_count_1h, row.whale_total_value_1h) == (2, 420.0)
    assert (row.whale_count_recent, row.whale_total_value) == (2, 420.0)
    assert row.latest_close_vs_vwap_pct == 0.0


def test_summary_of_one_symbol(trades):
    row = reads.dashboard_summary(*gold(trades(*MINUTES)), symbol="y", min_value=150, as_of="2024-01-01 00:02:00").first()
    assert tuple(row.latest_price) == ("Y", 60.0, datetime(2024, 1, 1, 0, 2))
    assert row.price_change_1h_pct == pytest.approx(20.0)
    assert (row.net_flow_1h, row.market_sentiment, row.whale_count_1h) == (-200.0, "BEARISH", 1)


def test_summary_of_nothing(trades):
    row = reads.dashboard_summary(*gold(trades()), symbol="btcusdt").first()
    assert tuple(row.latest_price) == ("BTCUSDT", None, None)
    assert (row.price_change_1h_pct, row.net_flow_1h, row.whale_count_1h, row.whale_total_value_1h) == (0, 0, 0, 0)
    assert (row.latest_close_vs_vwap_pct, row.market_sentiment) == (0.0, "NEUTRAL")
    assert reads.dashboard_by_symbol(*gold(trades())).count() == 0


def test_summary_spans_sixty_rows_not_sixty_minutes(trades):
    # One trade every ten minutes: the 60th newest row is 590 minutes back.
    some = trades(*[(f"i{n:03}", "X", 100 + n, 1, 600 * n, False) for n in range(80)])
    row = reads.dashboard_summary(*gold(some)).first()
    assert row.price_change_1h_pct == pytest.approx((179 - 120) / 120 * 100)
    per_symbol = reads.dashboard_by_symbol(*gold(some)).first()
    assert per_symbol.price_change_1h_pct == row.price_change_1h_pct
    assert per_symbol.net_flow_1h == row.net_flow_1h


def test_last_hour_includes_both_ends(trades):
    whales = signals.large_trades(trades(("a", "X", 9, 1, 0, True), ("b", "X", 9, 1, 3600, True), ("c", "X", 9, 1, 3601, True)), 1)
    assert reads.whales_last_hour(whales, 0, "2024-01-01 01:00:00").first().whale_count_1h == 2
    # By the clock these trades are long past.
    assert tuple(reads.whales_last_hour(whales, 0).first()) == (0, 0.0)


def test_json_rows(spark):
    some = spark.createDataFrame(
        [(1, Decimal("1.50"), datetime(2024, 1, 1, 0, 0, 7), None)], "n int, d decimal(9,2), t timestamp, gone string"
    )
    assert json.loads(reads.json_rows(some).first().json) == {
        "n": 1, "d": 1.5, "t": "2024-01-01T00:00:07.000000+00:00", "gone": None,
    }


def test_named_tables(spark, trades, tmp_path):
    ohlc, flow, whales, vwap = gold(trades(*MINUTES))
    folder = f"{tmp_path}/ohlc"
    ohlc.withColumn("day", F.to_date("candle_time")).write.partitionBy("day").parquet(folder)
    flow.write.parquet(f"{tmp_path}/flow")
    names = tables.register_tables(spark, {"ohlc": folder, "flow": f"{tmp_path}/flow"}, "gold_test")
    assert names == ["gold_test.ohlc_1min", "gold_test.maker_taker_flow_1min"]
    newest = spark.sql("SELECT symbol, close_price FROM gold_test.ohlc_1min ORDER BY candle_time DESC, symbol LIMIT 20")
    assert newest.count() == 4 and newest.first().symbol == "Y"
    # A name can be moved to a newer folder; the old files stay.
    ohlc.limit(1).write.parquet(f"{tmp_path}/newer")
    tables.register_tables(spark, {"ohlc": f"{tmp_path}/newer"}, "gold_test")
    assert spark.table("gold_test.ohlc_1min").count() == 1
    assert spark.read.parquet(folder).count() == 4
    assert {r.tableName for r in spark.sql("SHOW TABLES IN gold_test").collect()} == {"ohlc_1min", "maker_taker_flow_1min"}


def test_managed_tables_are_refused(spark, trades, tmp_path):
    ohlc = signals.ohlc(trades(*MINUTES))
    ohlc.write.parquet(f"{tmp_path}/ohlc")
    spark.sql("CREATE DATABASE IF NOT EXISTS gold_managed")
    ohlc.write.mode("overwrite").saveAsTable("gold_managed.ohlc_1min")
    with pytest.raises(ValueError):
        tables.register_tables(spark, {"ohlc": f"{tmp_path}/ohlc"}, "gold_managed")
    assert spark.table("gold_managed.ohlc_1min").count() == 4


def test_row_counts(trades):
    candles, flow, whales, vwap = gold(trades(*MINUTES))
    counted = reads.row_counts({"ohlc": candles, "whale": whales, "flow": flow, "vwap": vwap})
    assert rows_of(counted) == [("flow", 3, "maker_taker_flow_1min"), ("ohlc", 4, "ohlc_1min"), ("vwap", 4, "vwap_1min"), ("whale", 2, "whale_alert")]
    assert schemas.GOLD_TABLES["ohlc"] == "ohlc_1min"
