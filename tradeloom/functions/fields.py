"""Column expressions that turn raw text fields into typed trade fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Epochs outside the years 1 to 9999 are no usable event time.
_FIRST_SECOND = -62135596800
_LAST_SECOND = 253402300799

# How ids of live and of file trades start; hashes of the content have no prefix.
LIVE_ID = "stream:"
FILE_ID = "batch:"

_UNITS_PER_SECOND = {"s": 1, "ms": 1_000, "us": 1_000_000}


def number(text: Column) -> Column:
    """Text to double; NULL instead of an ANSI error on malformed text."""
    return text.try_cast("double")


def whole_number(text: Column) -> Column:
    """Text to bigint, also from a decimal or exponent form, whose fraction is cut."""
    return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))


def instant(epoch: Column, unit: str, precision: str = "exact") -> Column:
    """Epoch count to timestamp; ``precision="second"`` drops the fraction of the second."""
    if precision not in ("exact", "second"):
        raise ValueError("precision is 'exact' or 'second'")
    per_second = _UNITS_PER_SECOND[unit]
    usable = F.when(epoch.between(_FIRST_SECOND * per_second, (_LAST_SECOND + 1) * per_second - 1), epoch)
    exact = {"s": F.timestamp_seconds, "ms": F.timestamp_millis, "us": F.timestamp_micros}[unit](usable)
    return exact if precision == "exact" else F.date_trunc("second", exact)


def flag(text: Column) -> Column:
    """'true' / 'false' in any case to boolean, everything else to NULL."""
    lowered = F.lower(text)
    return F.when(lowered.isin("true", "false"), lowered == "true")


def quote_value(given: Column, price: Column, quantity: Column) -> Column:
    """The stated quote quantity, or price times quantity where none is stated."""
    return F.coalesce(given, price * quantity)


def trade_key(stream_id: Column, history_id: Column, symbol: Column, content: list[Column]) -> Column:
    """Id of a trade: bus sequence number, else file id, else SHA-256 of what the row says."""
    text = F.concat_ws("||", *[c.cast("string") for c in content])
    return F.coalesce(
        F.concat(F.lit(LIVE_ID), symbol, F.lit(":"), stream_id.cast("string")),
        F.concat(F.lit(FILE_ID), history_id),
        F.sha2(text, 256),
    )
