"""Trades out of the test tables: ``events`` as live trades, ``lineitem`` as history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom import schemas

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _event_fields(events: DataFrame) -> DataFrame:
    """Price, amount, time and side of every event; the JSON is parsed once per row."""
    side = F.when(F.col("user_id") % 10 != 9, F.col("user_id") % 2 == 0)
    return events.select(
        F.col("event_id").alias("number"),
        F.upper("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.col("ts").cast("timestamp").alias("event_time"),
        side.alias("is_buyer_maker"),
        F.inline(F.array(F.from_json("props", "k DOUBLE"))),
    )


def live_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid clean trades with the full precision of the event time."""
    return (
        _event_fields(table(spark, sf_dir, "events"))
        .filter("price > 0 AND k > 0 AND event_time IS NOT NULL")
        .select(
            F.concat(F.lit("stream:"), "symbol", F.lit(":"), F.col("number").cast("string")).alias("event_id"),
            "symbol",
            "price",
            F.col("k").alias("quantity"),
            (F.col("price") * F.col("k")).alias("quote_qty"),
            "event_time",
            "is_buyer_maker",
        )
    )


def live_messages(events: DataFrame) -> DataFrame:
    """Every event as the JSON envelope a bus would deliver, as bytes; works on streams as well."""
    envelope = F.struct(
        F.col("number").alias("a"),
        F.col("symbol").alias("s"),
        F.col("price").cast("string").alias("p"),
        F.col("k").cast("string").alias("q"),
        F.unix_millis("event_time").alias("T"),
        F.col("is_buyer_maker").alias("m"),
    )
    return _event_fields(events).select(F.to_json(envelope).cast("binary").alias("value"))


def history_rows(lines: DataFrame) -> DataFrame:
    """Every line item as a row of the raw history layout, all text."""
    text = {
        "Trade_ID": F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")),
        "Price": (F.col("l_extendedprice") / F.col("l_quantity")).cast("string"),
        "Quantity": F.col("l_quantity").cast("string"),
        "Quote_Qty": F.col("l_extendedprice").cast("string"),
        "Timestamp": F.unix_micros(F.col("l_shipdate").cast("timestamp")).cast("string"),
        "is_Buyer_Maker": F.when(F.col("l_linestatus") == "F", "True").otherwise("False"),
        "is_Best_Match": F.lit("True"),
    }
    return lines.select(*[text[name].alias(name) for name in schemas.HISTORY_COLUMNS])


def history_trades(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Clean trades, ids not yet unique; ``extra`` line-item columns ride along."""
    line = F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("batch:"), line).alias("event_id"),
        F.lit(schemas.DEFAULT_SYMBOL).alias("symbol"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("quote_qty"),
        F.col("l_shipdate").cast("timestamp").alias("event_time"),
        (F.col("l_linestatus") == "F").alias("is_buyer_maker"),
        *extra,
    )
