"""Bucket measures as commutative monoids: summarise, combine, present.

Every measure is a min, a max, a sum or a count, so partial results of any split of the trades, in
any order, combine to the result of the whole. Opening and closing price are min and max of
``(event_time, event_id, price)``: trades on the same instant are ordered by their id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions import amounts

BUCKET_KEYS = ["bucket", "symbol"]


def bucket_measures() -> list[Column]:
    """The measures of a group of trades, as aggregate expressions over ``amounts.with_parts``."""
    tick = F.struct("event_time", "event_id", "price")
    maker_sold, taker_bought = "is_buyer_maker", "NOT is_buyer_maker"
    return [
        F.min(tick).alias("opened"),
        F.max(tick).alias("closed"),
        F.max("price").alias("high_price"),
        F.min("price").alias("low_price"),
        *amounts.sums("quantity", "quantity_sum"),
        *amounts.sums("quote_qty", "quote_sum"),
        F.count("*").alias("trade_count"),
        *amounts.sums("quantity", "bought_quantity", taker_bought),
        *amounts.sums("quantity", "sold_quantity", maker_sold),
        *amounts.sums("quote_qty", "bought_quote", taker_bought),
        *amounts.sums("quote_qty", "sold_quote", maker_sold),
        F.count(maker_sold).alias("flagged_count"),
    ]


def summarise(trades: DataFrame, bucket: str = "1 minute") -> DataFrame:
    """One row of mergeable measures per symbol and tumbling bucket.

    A caller that selects a few columns pays for those only: Catalyst prunes unused aggregates.
    The bucket leads the grouping keys, so the sort in front of the ordered measures runs on a
    number and not on the symbol text.
    """
    start = F.window("event_time", bucket)["start"].alias("bucket")
    return amounts.with_parts(trades, "quantity", "quote_qty").groupBy(start, "symbol").agg(*bucket_measures())


_SMALLEST = ["opened", "low_price"]
_GREATEST = ["closed", "high_price"]


def combine(partials: DataFrame) -> DataFrame:
    """Fold partial rows of the same symbol and bucket into one."""
    folds = []
    for name in partials.columns:
        if name in BUCKET_KEYS:
            continue
        fold = F.min if name in _SMALLEST else F.max if name in _GREATEST else F.sum
        folds.append(fold(name).alias(name))
    return partials.groupBy(*BUCKET_KEYS).agg(*folds)


def candles(measures: DataFrame) -> DataFrame:
    return measures.select(
        "symbol",
        F.col("bucket").alias("candle_time"),
        F.col("opened.price").alias("open_price"),
        F.col("opened.event_time").alias("open_event_time"),
        "high_price",
        "low_price",
        F.col("closed.price").alias("close_price"),
        F.col("closed.event_time").alias("close_event_time"),
        amounts.total("quantity_sum").alias("total_quantity"),
        amounts.total("quote_sum").alias("total_quote_qty"),
        F.col("trade_count").alias("total_trades"),
    )


def taker_flow(measures: DataFrame) -> DataFrame:
    """Buckets without a single flagged trade have no flow row."""
    return measures.filter("flagged_count > 0").select(
        "symbol",
        F.col("bucket").alias("window_start"),
        amounts.total("bought_quantity").alias("buy_aggressive_qty"),
        amounts.total("sold_quantity").alias("sell_aggressive_qty"),
        amounts.total("bought_quote").alias("buy_aggressive_quote_qty"),
        amounts.total("sold_quote").alias("sell_aggressive_quote_qty"),
        amounts.difference("bought_quote", "sold_quote").alias("net_flow"),
    )


def average_prices(measures: DataFrame) -> DataFrame:
    return with_ratios(
        measures.select(
            "symbol",
            F.col("bucket").alias("window_start"),
            amounts.total("quantity_sum").alias("total_quantity"),
            amounts.total("quote_sum").alias("total_quote_qty"),
            "trade_count",
            F.col("closed.price").alias("close_price"),
            F.col("closed.event_time").alias("close_event_time"),
        )
    )


def with_ratios(totals: DataFrame) -> DataFrame:
    """Volume-weighted price and what follows from it; a zero divisor gives NULL, not an error."""
    vwap = F.try_divide("total_quote_qty", "total_quantity")
    return totals.withColumn("vwap_price", vwap).select(
        "symbol",
        "window_start",
        "total_quantity",
        "total_quote_qty",
        "trade_count",
        "close_price",
        "close_event_time",
        "vwap_price",
        F.try_divide("total_quantity", "trade_count").alias("avg_trade_size"),
        (F.col("close_price") - F.col("vwap_price")).alias("close_vs_vwap_diff"),
        (F.try_divide(F.col("close_price") - F.col("vwap_price"), F.col("vwap_price")) * 100).alias(
            "close_vs_vwap_pct"
        ),
    )
