"""Read queries over the derived tables: newest rows, dashboard summary, table statistics."""

from __future__ import annotations

import re
from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom import schemas
from tradeloom.functions import amounts

# Argument ranges of the read queries.
_SYMBOL = re.compile(r"[A-Z0-9_]{1,20}")
SUMMARY_ROWS = 60
# Fixed value: the note every summary carries.
SUMMARY_NOTE = "Metrics are computed from latest up to 60 one-minute rows."


def check_symbol(symbol: str | None) -> str | None:
    """Trimmed, upper-cased symbol; None for none or blank."""
    cleaned = (symbol or "").strip().upper()
    if not cleaned:
        return None
    if not _SYMBOL.fullmatch(cleaned):
        raise ValueError("symbol takes 1 to 20 characters out of A-Z, 0-9 and _")
    return cleaned


def check_limit(limit: int | str, most: int) -> int:
    try:
        rows = int(limit)
    except (TypeError, ValueError, OverflowError):
        raise ValueError("limit takes a whole number") from None
    if isinstance(limit, bool) or (not isinstance(limit, str) and rows != limit):
        raise ValueError("limit takes a whole number")
    if not 1 <= rows <= most:
        raise ValueError(f"limit takes 1 to {most}")
    return rows


def check_min_value(value: float | str) -> float:
    try:
        number = float(value)
    except (TypeError, ValueError):
        raise ValueError("min_value takes a number") from None
    if not number >= 0:
        raise ValueError("min_value takes a number from 0 up")
    return number


def _where(rows: DataFrame, *conditions: Column | None) -> DataFrame:
    """Keep rows that meet all given conditions; None stands for no condition."""
    present = [c for c in conditions if c is not None]
    return rows.filter(reduce(lambda a, b: a & b, present)) if present else rows


def is_symbol(symbol: str | None) -> Column | None:
    cleaned = check_symbol(symbol)
    return None if cleaned is None else F.col("symbol") == cleaned


def _newest(rows: DataFrame, time: str, tie: str, count: int) -> DataFrame:
    """Top rows by time; the tie column makes the choice among equal times definite."""
    return rows.orderBy(F.col(time).desc(), F.col(tie)).limit(count)


def latest_ohlc(ohlc: DataFrame, limit: int = 100, symbol: str | None = None) -> DataFrame:
    chosen = _where(ohlc, is_symbol(symbol)).drop("open_event_time", "close_event_time")
    return _newest(chosen, "candle_time", "symbol", check_limit(limit, 5000))


def latest_whales(
    whales: DataFrame,
    limit: int = 50,
    symbol: str | None = None,
    min_value: float = schemas.LARGE_TRADE_VALUE,
) -> DataFrame:
    """Newest alerts from ``min_value`` up. The table itself starts above its own threshold."""
    worth = F.col("trade_value_usdt") >= check_min_value(min_value)
    chosen = _where(whales, worth, is_symbol(symbol)).select(*schemas.LARGE_TRADE_COLUMNS)
    return _newest(chosen, "event_time", "event_id", check_limit(limit, 2000))


def latest_flow(flow: DataFrame, limit: int = 100, symbol: str | None = None) -> DataFrame:
    return _newest(_where(flow, is_symbol(symbol)), "window_start", "symbol", check_limit(limit, 5000))


def latest_vwap(vwap: DataFrame, limit: int = 100, symbol: str | None = None) -> DataFrame:
    return _newest(_where(vwap, is_symbol(symbol)), "window_start", "symbol", check_limit(limit, 5000))


def latest_trades(trades: DataFrame, limit: int = 20, columns: list[str] | None = None) -> DataFrame:
    newest = _newest(trades, "event_time", "event_id", limit)
    return newest.select(*columns) if columns else newest


def _in_last_hour(as_of: datetime | str | Column | None) -> Column:
    """The hour up to ``as_of``; without it the hour before now, as the clock tells."""
    hour = F.expr("INTERVAL 1 HOUR")
    if as_of is None:
        return F.col("event_time") >= F.current_timestamp() - hour
    moment = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    return (F.col("event_time") >= moment - hour) & (F.col("event_time") <= moment)


def _whale_totals() -> list[Column]:
    return [
        F.count("*").alias("whale_count_1h"),
        F.coalesce(amounts.exact_sum("trade_value_usdt"), F.lit(0.0)).alias("whale_total_value_1h"),
    ]


def whales_last_hour(
    whales: DataFrame,
    min_value: float = schemas.LARGE_TRADE_VALUE,
    as_of: datetime | str | Column | None = None,
    symbol: str | None = None,
) -> DataFrame:
    """One row: number and value of the alerts of the last hour."""
    return _recent_whales(whales, min_value, as_of, symbol).agg(*_whale_totals())


def _recent_whales(whales, min_value, as_of, symbol) -> DataFrame:
    worth = F.col("trade_value_usdt") >= check_min_value(min_value)
    return _where(whales, worth, _in_last_hour(as_of), is_symbol(symbol))


def _newest_per_symbol(rows: DataFrame, time: str, count: int) -> DataFrame:
    """Newest rows of every symbol; the rank limit also runs before the shuffle."""
    place = F.row_number().over(Window.partitionBy("symbol").orderBy(F.col(time).desc()))
    return rows.withColumn("_place", place).filter(F.col("_place") <= count).drop("_place")


def _by_age(time: str, *values: str) -> Column:
    """Struct whose least element is the row ``_newest`` puts first, and whose greatest the last."""
    return F.struct((-F.unix_micros(time)).alias("age"), "symbol", *values)


def _summary(
    candles: DataFrame,
    flow: DataFrame,
    whales: DataFrame,
    averages: DataFrame,
    by: list[str],
    asked_symbol: str | None,
) -> DataFrame:
    """Reduce each table on its own, stack the few resulting rows and fold them into the answer."""
    candle = _by_age("candle_time", "close_price", "candle_time")
    parts = [
        candles.groupBy(*by).agg(F.min(candle).alias("newest"), F.max(candle)["close_price"].alias("base_close")),
        flow.groupBy(*by).agg(amounts.exact_sum("net_flow").alias("net")),
        whales.groupBy(*by).agg(*_whale_totals()),
        averages.groupBy(*by).agg(
            F.min(_by_age("window_start", "close_vs_vwap_pct"))["close_vs_vwap_pct"].alias("pct")
        ),
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    folded = stacked.groupBy(*by).agg(*[F.max(c).alias(c) for c in stacked.columns if c not in by])

    zero = F.lit(0.0)
    latest = F.coalesce("newest.close_price", zero)
    base = F.coalesce("base_close", zero)
    change = F.when(base == 0, zero).otherwise(F.try_divide(latest - base, base) * 100)
    price = F.struct(
        F.coalesce("newest.symbol", F.lit(asked_symbol)).alias("symbol"),
        F.col("newest.close_price").alias("price"),
        F.col("newest.candle_time").alias("time"),
    )
    measured = folded.select(
        *by,
        price.alias("latest_price"),
        change.alias("price_change_1h_pct"),
        F.coalesce("net", zero).alias("net_flow_1h"),
        F.coalesce("whale_count_1h", F.lit(0).cast("bigint")).alias("whale_count_1h"),
        F.coalesce("whale_total_value_1h", zero).alias("whale_total_value_1h"),
        F.coalesce("pct", zero).alias("latest_close_vs_vwap_pct"),
    )
    mood = F.when(F.col("net_flow_1h") > 0, "BULLISH").when(F.col("net_flow_1h") < 0, "BEARISH").otherwise("NEUTRAL")
    return measured.select(
        "*",
        mood.alias("market_sentiment"),
        F.lit(SUMMARY_NOTE).alias("window_note"),
        F.col("whale_count_1h").alias("whale_count_recent"),
        F.col("whale_total_value_1h").alias("whale_total_value"),
        F.col("net_flow_1h").alias("net_flow"),
    )


def dashboard_summary(
    ohlc: DataFrame,
    flow: DataFrame,
    whales: DataFrame,
    vwap: DataFrame,
    symbol: str | None = None,
    min_value: float = schemas.LARGE_TRADE_VALUE,
    as_of: datetime | str | Column | None = None,
) -> DataFrame:
    """One row over the newest 60 rows of all symbols together, or of the one asked for."""
    only = is_symbol(symbol)
    return _summary(
        _newest(_where(ohlc, only), "candle_time", "symbol", SUMMARY_ROWS),
        _newest(_where(flow, only), "window_start", "symbol", SUMMARY_ROWS),
        _recent_whales(whales, min_value, as_of, symbol),
        _newest(_where(vwap, only), "window_start", "symbol", 1),
        by=[],
        asked_symbol=check_symbol(symbol),
    )


def dashboard_by_symbol(
    ohlc: DataFrame,
    flow: DataFrame,
    whales: DataFrame,
    vwap: DataFrame,
    min_value: float = schemas.LARGE_TRADE_VALUE,
    as_of: datetime | str | Column | None = None,
) -> DataFrame:
    """The same summary for every symbol at once, each over its own newest 60 rows."""
    return _summary(
        _newest_per_symbol(ohlc, "candle_time", SUMMARY_ROWS),
        _newest_per_symbol(flow, "window_start", SUMMARY_ROWS),
        _recent_whales(whales, min_value, as_of, None),
        _newest_per_symbol(vwap, "window_start", 1),
        by=["symbol"],
        asked_symbol=None,
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Number of rows per logical table, with the name the table is registered under."""
    counted = [
        rows.agg(F.count("*").alias("total_records")).select(
            F.lit(name).alias("name"), "total_records", F.lit(schemas.GOLD_TABLES.get(name, name)).alias("table")
        )
        for name, rows in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def json_rows(rows: DataFrame) -> DataFrame:
    """One JSON object per row: ISO-8601 times with offset, decimals as numbers, NULLs kept."""
    plain = [
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in rows.schema.fields
    ]
    options = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx", "ignoreNullFields": "false"}
    return rows.select(F.to_json(F.struct(*plain), options).alias("json"))
