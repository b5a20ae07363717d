"""Raw rows to clean trades: one projection, a validity rule with reasons, one row per id."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom import schemas
from tradeloom.functions import fields


@dataclass(frozen=True)
class Rules:
    """What a deployment may want to change about the raw formats."""

    default_symbol: str = schemas.DEFAULT_SYMBOL
    stream_unit: str = "ms"
    history_unit: str = "us"
    event_time_precision: str = "exact"


def with_missing_columns(raw: DataFrame) -> DataFrame:
    """Give a table that holds only history or only live rows the columns of the other kind."""
    absent = [f for f in schemas.BRONZE.fields if f.name not in raw.columns]
    return raw.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent}) if absent else raw


def parse_envelope(raw: DataFrame, *keep: str) -> DataFrame:
    """Live envelope to its six fields; rows without an envelope, or a broken one, get NULLs.

    ``inline`` is a generator, which filters on its output cannot move below. As plain struct
    fields the parse would be repeated inside every pushed predicate.
    """
    return raw.select(*keep, F.inline(F.array(F.from_json("value", schemas.ENVELOPE_DDL))))


def _settled(rows: DataFrame, *columns: Column) -> DataFrame:
    """A projection whose expressions no later filter repeats, as it stands behind a generator, too."""
    return rows.select(F.inline(F.array(F.struct(*columns))))


def normalize(raw: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Every raw row as a trade in the clean layout, valid or not."""
    history = schemas.HISTORY_COLUMNS[:-1]
    opened = parse_envelope(with_missing_columns(raw), *history)
    typed = _settled(
        opened,
        F.col("a").alias("stream_id"),
        F.col("Trade_ID").alias("history_id"),
        F.coalesce("s", F.lit(rules.default_symbol)).alias("symbol"),
        fields.number(F.coalesce("p", "Price")).alias("unit_price"),
        fields.number(F.coalesce("q", "Quantity")).alias("amount"),
        fields.number(F.col("Quote_Qty")).alias("given_quote"),
        F.coalesce(
            fields.instant(F.col("T"), rules.stream_unit, rules.event_time_precision),
            fields.instant(
                fields.whole_number(F.col("Timestamp")), rules.history_unit, rules.event_time_precision
            ),
        ).alias("event_time"),
        F.coalesce("m", fields.flag(F.col("is_Buyer_Maker"))).alias("maker_flag"),
    )
    price, quantity = F.col("unit_price"), F.col("amount")
    quote = fields.quote_value(F.col("given_quote"), price, quantity)
    content = [F.col("symbol"), F.col("event_time"), price, quantity, quote, F.col("maker_flag")]
    trade = [
        fields.trade_key(F.col("stream_id"), F.col("history_id"), F.col("symbol"), content).alias("event_id"),
        "symbol",
        price.alias("price"),
        quantity.alias("quantity"),
        quote.alias("quote_qty"),
        "event_time",
        F.col("maker_flag").alias("is_buyer_maker"),
    ]
    return typed.select(*trade)


# Checked in this order; the first that does not hold names the rejection. NaN is above infinity.
_REQUIREMENTS = {
    "no_id": "event_id IS NOT NULL",
    "bad_price": "price > 0 AND price < double('infinity')",
    "bad_quantity": "quantity > 0 AND quantity < double('infinity')",
    "bad_quote": "abs(quote_qty) < double('infinity')",
    "bad_time": "event_time IS NOT NULL",
}


def _holds(requirement: str) -> Column:
    """An unknown comparison (NULL price) counts as not met."""
    return F.coalesce(F.expr(requirement), F.lit(False))


def with_reject_reason(trades: DataFrame) -> DataFrame:
    """NULL reason marks a valid trade."""
    reason = F.coalesce(*[F.when(~_holds(rule), F.lit(name)) for name, rule in _REQUIREMENTS.items()])
    return trades.withColumn("reject_reason", reason)


def valid(trades: DataFrame) -> DataFrame:
    return trades.filter(" AND ".join(_REQUIREMENTS.values()))


def rejected(trades: DataFrame) -> DataFrame:
    """The complement of ``valid``, for the quarantine table."""
    return with_reject_reason(trades).filter("reject_reason IS NOT NULL")


def derivable(trades: DataFrame) -> DataFrame:
    """Trades complete enough for every derived table; only the maker flag may be unknown."""
    return trades.filter(" AND ".join(f"{c} IS NOT NULL" for c in schemas.SILVER_COLUMNS if c != "is_buyer_maker"))


#: Together they are one key: sorts by it compare numbers, as ids all begin alike, and texts only where hashes are equal.
ID_KEY = ["id_hash", "event_id"]


def with_id_hash(trades: DataFrame) -> DataFrame:
    return trades if ID_KEY[0] in trades.columns else trades.withColumn(ID_KEY[0], F.hash("event_id"))


def first_per_id(trades: DataFrame) -> DataFrame:
    """One row per ``event_id``, the least in time and then in value, whatever the row order.

    Spark turns rank-and-filter into a group limit that runs before the shuffle too, so an id that
    was sent a billion times leaves one row per map task. Rows that bring the hash of their id keep it, and lie
    dealt and sorted by ``ID_KEY`` for a join that follows.
    """
    columns = ("event_time", "price", "quantity", "quote_qty", "is_buyer_maker", "symbol")
    order = [F.col(c).asc_nulls_first() for c in columns]
    rank = F.row_number().over(Window.partitionBy(*ID_KEY).orderBy(*order))
    return with_id_hash(trades).withColumn("_rank", rank).filter("_rank = 1").select(*trades.columns)
