"""Column layouts of the raw, clean and derived tables."""

from __future__ import annotations

from pyspark.sql import types as T

from tradeloom.functions import amounts

# The input formats that have to be read as they come.
HISTORY_COLUMNS = [
    "Trade_ID",
    "Price",
    "Quantity",
    "Quote_Qty",
    "Timestamp",
    "is_Buyer_Maker",
    "is_Best_Match",
]
ENVELOPE_DDL = "a BIGINT, s STRING, p STRING, q STRING, T BIGINT, m BOOLEAN"
DEFAULT_SYMBOL = "BTCUSDT"
LARGE_TRADE_VALUE = 50000.0

# Raw history arrives as text; nothing is typed before normalisation.
HISTORY = T.StructType([T.StructField(name, T.StringType()) for name in HISTORY_COLUMNS])
LIVE = T.StructType([T.StructField("value", T.StringType())])
BRONZE = T.StructType(LIVE.fields + HISTORY.fields)

# The layout of clean trades, one row per event_id.
SILVER = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("quote_qty", T.DoubleType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("is_buyer_maker", T.BooleanType()),
    ]
)
SILVER_COLUMNS = SILVER.names

REJECTED = T.StructType(SILVER.fields + [T.StructField("reject_reason", T.StringType())])

# The columns of an alert, in the order they are read in.
LARGE_TRADE_COLUMNS = [
    "event_id",
    "symbol",
    "event_time",
    "price",
    "quantity",
    "quote_qty",
    "is_buyer_maker",
    "trade_value_usdt",
]
LARGE_TRADES = T.StructType(
    [
        T.StructField("trade_value_usdt", T.DoubleType()) if name == "trade_value_usdt" else SILVER[name]
        for name in LARGE_TRADE_COLUMNS
    ]
)

# The first or last trade of a bucket, ordered by its fields from left to right.
TICK = T.StructType([SILVER["event_time"], SILVER["event_id"], SILVER["price"]])


# Mergeable bucket measures.
PARTIALS = T.StructType(
    [
        T.StructField("bucket", T.TimestampType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("opened", TICK),
        T.StructField("closed", TICK),
        T.StructField("high_price", T.DoubleType()),
        T.StructField("low_price", T.DoubleType()),
        *amounts.sum_fields("quantity_sum"),
        *amounts.sum_fields("quote_sum"),
        T.StructField("trade_count", T.LongType()),
        *amounts.sum_fields("bought_quantity"),
        *amounts.sum_fields("sold_quantity"),
        *amounts.sum_fields("bought_quote"),
        *amounts.sum_fields("sold_quote"),
        T.StructField("flagged_count", T.LongType()),
    ]
)

# Logical name of a derived table -> name it is registered under.
GOLD_TABLES = {
    "ohlc": "ohlc_1min",
    "whale": "whale_alert",
    "flow": "maker_taker_flow_1min",
    "vwap": "vwap_1min",
}


def _layout(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


_TEXT, _NUMBER, _COUNT, _TIME = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampType()

# The layouts of the finished tables.
FINISHED = {
    "ohlc": _layout(
        ("symbol", _TEXT),
        ("candle_time", _TIME),
        ("open_price", _NUMBER),
        ("open_event_time", _TIME),
        ("high_price", _NUMBER),
        ("low_price", _NUMBER),
        ("close_price", _NUMBER),
        ("close_event_time", _TIME),
        ("total_quantity", _NUMBER),
        ("total_quote_qty", _NUMBER),
        ("total_trades", _COUNT),
    ),
    "flow": _layout(
        ("symbol", _TEXT),
        ("window_start", _TIME),
        ("buy_aggressive_qty", _NUMBER),
        ("sell_aggressive_qty", _NUMBER),
        ("buy_aggressive_quote_qty", _NUMBER),
        ("sell_aggressive_quote_qty", _NUMBER),
        ("net_flow", _NUMBER),
    ),
    "vwap": _layout(
        ("symbol", _TEXT),
        ("window_start", _TIME),
        ("total_quantity", _NUMBER),
        ("total_quote_qty", _NUMBER),
        ("trade_count", _COUNT),
        ("close_price", _NUMBER),
        ("close_event_time", _TIME),
        ("vwap_price", _NUMBER),
        ("avg_trade_size", _NUMBER),
        ("close_vs_vwap_diff", _NUMBER),
        ("close_vs_vwap_pct", _NUMBER),
    ),
}
