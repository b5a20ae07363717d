"""Derived trade signals over clean trades."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom import schemas
from tradeloom.functions import measures


def ohlc(trades: DataFrame, bucket: str = "1 minute") -> DataFrame:
    """Open, high, low, close and volume per symbol and bucket."""
    return measures.candles(measures.summarise(trades, bucket))


def vwap(trades: DataFrame, bucket: str = "1 minute") -> DataFrame:
    """Volume-weighted average price per symbol and bucket, compared with the close."""
    return measures.average_prices(measures.summarise(trades, bucket))


def maker_taker_flow(trades: DataFrame, bucket: str = "1 minute") -> DataFrame:
    """Volume by aggressor side and its net; trades of unknown side are left out."""
    flagged = trades.filter("is_buyer_maker IS NOT NULL")
    return measures.taker_flow(measures.summarise(flagged, bucket))


def large_trades(trades: DataFrame, threshold: float = schemas.LARGE_TRADE_VALUE) -> DataFrame:
    """Trades worth strictly more than the threshold."""
    return (
        trades.filter(F.col("quote_qty") > threshold)
        .withColumn("trade_value_usdt", F.col("quote_qty").cast("double"))
        .select(*schemas.LARGE_TRADE_COLUMNS)
    )
