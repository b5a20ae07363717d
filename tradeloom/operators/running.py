"""Sliding totals of alerts as the difference of two running totals.

Alerts are summed per symbol and minute, and these sums run on from minute to minute. How much any span of time holds
is then the running total at its end less that at its start, plus the alerts in the two minutes that the ends cut: the
alerts between are not read. A day's folder starts with what the days before it hold, so the newest total before a moment
lies in that moment's own day, however long ago the last alert was.

The sums keep the parts of ``amounts``, so a difference is as exact as the sum over the span itself, but for amounts
that are beyond all of its decimals.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.functions import amounts
from tradeloom.operators import reads

#: Running totals up to the end of a minute.
RUNNING = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("minute", T.TimestampType()),
        T.StructField("alerts", T.LongType()),
        *amounts.sum_fields("value"),
        T.StructField("day", T.DateType()),
    ]
)
_SUMS = ["alerts", *[f.name for f in amounts.sum_fields("value")]]
_MINUTE = "INTERVAL 1 MINUTE"


def _minute(time: Column) -> Column:
    return F.date_trunc("minute", time)


def _day(time: Column) -> Column:
    """The day in UTC, whatever the session's zone."""
    return F.date_from_unix_date(F.floor(F.unix_micros(time) / F.lit(86_400_000_000)).cast("int"))


def _sums_of(alerts: DataFrame, *keys: Column) -> DataFrame:
    split = amounts.with_parts(alerts, "trade_value_usdt")
    return split.groupBy("symbol", *keys).agg(
        F.count("*").alias("alerts"), *amounts.sums("trade_value_usdt", "value")
    )


def running_totals(alerts: DataFrame) -> DataFrame:
    """Per symbol: the total up to the end of each minute that has alerts, and up to the start of each day.

    A day's first row is made for every day from a symbol's first alert to the newest alert of all, so that any moment up
    to then finds a row in its day. First days are summed, then minutes within a day: a symbol of many years is no
    single group of minutes, only one of days.
    """
    minutes = _sums_of(alerts, _minute(F.col("event_time")).alias("minute")).withColumn("day", _day(F.col("minute")))
    days = minutes.groupBy("symbol", "day").agg(*[F.sum(c).alias(c) for c in _SUMS])
    last = days.agg(F.date_add(F.max("day"), 1)).scalar()
    every = days.groupBy("symbol").agg(F.min("day").alias("first"))
    every = every.select("symbol", F.explode(F.sequence("first", last, F.expr("INTERVAL 1 DAY"))).alias("day"))
    before = Window.partitionBy("symbol").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    carried = every.join(days, ["symbol", "day"], "left")
    carried = carried.select("symbol", "day", *[F.sum(c).over(before).alias(c) for c in _SUMS])
    # What is carried into a day stands before its first minute.
    start = F.timestamp_micros(F.unix_date("day").cast("bigint") * F.lit(86_400_000_000)) - F.expr(_MINUTE)
    carried = carried.withColumn("minute", start).withColumn("alerts", F.coalesce("alerts", F.lit(0)))
    so_far = Window.partitionBy("symbol", "day").orderBy("minute").rowsBetween(Window.unboundedPreceding, 0)
    stacked = carried.unionByName(minutes)
    return stacked.select("symbol", "minute", *[F.sum(c).over(so_far).alias(c) for c in _SUMS], "day")


def write_running(alerts: DataFrame, folder: str) -> None:
    """One folder per day; rows in order of time within a file."""
    rows = running_totals(alerts).hint("rebalance", F.col("day")).sortWithinPartitions("day", "minute")
    rows.write.partitionBy("day").parquet(folder)


def read_running(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(RUNNING).parquet(folder)


def _before(running: DataFrame, moment: Column, symbol: Column | None) -> DataFrame:
    """Per symbol the newest total that ends before the moment's minute: one day is read."""
    day = running.filter((F.col("day") == _day(moment)) & (F.col("minute") < _minute(moment)))
    day = day if symbol is None else day.filter(symbol)
    newest = F.max_by(F.struct(*_SUMS), "minute")
    return day.groupBy("symbol").agg(newest.alias("sums")).select("symbol", "sums.*")


def totals_of_span(
    running: DataFrame,
    alerts: DataFrame,
    as_of: datetime | str | Column,
    symbol: str | None = None,
    span: str = "INTERVAL 1 HOUR",
) -> DataFrame:
    """One row: number and value of the alerts from ``as_of`` less the span up to ``as_of``, both ends included.

    A moment after the last day of the totals counts as the end of that day. ``alerts`` has to be the table that the
    totals were made of; of it the minutes that the ends cut are read, by their time.
    """
    only = reads.is_symbol(symbol)
    asked = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    end, start = asked, asked - F.expr(span)
    chosen = alerts if only is None else alerts.filter(only)
    time = F.col("event_time")
    # Each piece counts for or against the span.
    last = running.agg(F.max("day")).scalar()
    close = F.timestamp_micros(F.unix_date(last).cast("bigint") * F.lit(86_400_000_000)) + F.expr("INTERVAL 1439 MINUTES")
    at_end, at_start = F.least(end, close), F.least(start, close)
    edges = [
        (1, _sums_of(chosen.filter((time >= _minute(end)) & (time <= end)))),
        (-1, _sums_of(chosen.filter((time >= _minute(start)) & (time < start)))),
    ]
    pieces = [(1, _before(running, at_end, only)), (-1, _before(running, at_start, only)), *edges]
    signed = [
        rows.select(*[(F.col(c) if sign > 0 else -F.col(c)).alias(c) for c in _SUMS]) for sign, rows in pieces
    ]
    stacked = signed[0]
    for rows in signed[1:]:
        stacked = stacked.unionByName(rows)
    sums = stacked.agg(*[F.sum(c).cast(RUNNING[c].dataType).alias(c) for c in _SUMS])
    return sums.select(
        F.coalesce("alerts", F.lit(0)).cast("bigint").alias("whale_count_1h"),
        F.coalesce(amounts.total("value"), F.lit(0.0)).alias("whale_total_value_1h"),
    )
