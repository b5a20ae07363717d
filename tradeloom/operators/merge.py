"""Upserts without a transactional table format: joins and folds that return the merged table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions import measures


def absent_rows(
    source: DataFrame,
    target: DataFrame,
    key: str | Sequence[str] = "event_id",
    wanted: DataFrame | None = None,
    cut: bool = False,
) -> DataFrame:
    """Source rows whose key the target does not hold; ``source`` has one row per key.

    The target, which only grows, is first cut to the keys the source asks for. Where the source
    keys are small by Spark's own size figures they are broadcast and the target is not shuffled;
    otherwise both sides meet in a sort-merge join on the key. ``wanted`` may name the same keys by
    a cheaper plan than the source's own. ``cut``: the target holds no other keys, so they meet the source at once.
    """
    keys = [key] if isinstance(key, str) else list(key)
    known = target.select(*keys)
    if not cut:
        known = known.join(source.select(*keys) if wanted is None else wanted, keys, "left_semi")
    return source.join(known, keys, "left_anti")


def insert_if_absent(target: DataFrame, source: DataFrame, key: str = "event_id") -> DataFrame:
    """Target plus the source rows with a new key; matched rows keep the target's values.

    The whole target is part of the result, so its keys are met directly.
    """
    return target.unionByName(source.join(target.select(key), key, "left_anti"))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Mapping[str, Column],
    insert: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The target after updating matched rows and inserting the others.

    Expressions name columns as ``target.x`` and ``source.x``. Columns without an ``update`` keep
    the target's value on a match. New rows take the source column of the same name, or its
    ``insert`` expression; with an ``insert`` map, columns it does not name become NULL. As in a
    SQL MERGE the source must be unique on the keys, which is checked while it lies sorted for the join,
    and NULL keys match nothing.
    """
    unknown = {*keys, *update, *(insert or ())} - set(target.columns)
    if unknown or set(keys) - set(source.columns):
        raise ValueError(f"no such columns: {sorted(unknown | (set(keys) - set(source.columns)))}")
    twin = F.count("*").over(Window.partitionBy(*keys)) > 1
    has_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    refused = F.raise_error(F.lit("two source rows for one key")).cast("boolean")
    left = target.withColumn("_held", F.lit(True)).alias("target")
    right = source.withColumn("_given", F.when(twin & has_key, refused).otherwise(F.lit(True))).alias("source")
    same_key = [F.col(f"target.{k}") == F.col(f"source.{k}") for k in keys]
    joined = left.join(right, same_key, "full_outer")
    held, given = F.col("target._held").isNotNull(), F.col("source._given").isNotNull()

    def merged(name: str) -> Column:
        kept = F.col(f"target.{name}")
        changed = update.get(name, kept)
        if insert is not None:
            new = insert.get(name, F.lit(None))
        else:
            new = F.col(f"source.{name}") if name in source.columns else F.lit(None)
        return F.when(held & given, changed).when(held, kept).otherwise(new).alias(name)

    return joined.select(*[merged(name) for name in target.columns])


# What a new row of the average-price table brings along; the ratios follow from it.
VWAP_TOTALS = [
    "symbol",
    "window_start",
    "total_quantity",
    "total_quote_qty",
    "trade_count",
    "close_price",
    "close_event_time",
]


def _extreme(fold, *names: str) -> dict[str, Column]:
    return {n: fold(f"target.{n}", f"source.{n}") for n in names}


def _added(*names: str) -> dict[str, Column]:
    return {n: F.col(f"target.{n}") + F.col(f"source.{n}") for n in names}


def _replaced_if(condition: str, *names: str) -> dict[str, Column]:
    return {n: F.when(F.expr(condition), F.col(f"source.{n}")).otherwise(F.col(f"target.{n}")) for n in names}


def merge_ohlc(target: DataFrame, source: DataFrame) -> DataFrame:
    """Fold newer candles into a candle table; on equal times the target's open and close stay."""
    rules = {
        **_replaced_if("source.open_event_time < target.open_event_time", "open_price", "open_event_time"),
        **_replaced_if("source.close_event_time > target.close_event_time", "close_price", "close_event_time"),
        **_extreme(F.greatest, "high_price"),
        **_extreme(F.least, "low_price"),
        **_added("total_quantity", "total_quote_qty", "total_trades"),
    }
    return upsert(target, source, ["symbol", "candle_time"], rules)


def merge_flow(target: DataFrame, source: DataFrame) -> DataFrame:
    """Every flow measure is a sum, the net included."""
    sums = [c for c in target.columns if c not in ("symbol", "window_start")]
    return upsert(target, source, ["symbol", "window_start"], _added(*sums))


def merge_vwap(target: DataFrame, source: DataFrame) -> DataFrame:
    """Fold the totals and the close, then derive the ratios once from what came out."""
    rules = {
        **_added("total_quantity", "total_quote_qty", "trade_count"),
        **_replaced_if("source.close_event_time > target.close_event_time", "close_price", "close_event_time"),
    }
    insert = {c: F.col(f"source.{c}") for c in VWAP_TOTALS}
    return measures.with_ratios(upsert(target, source, ["symbol", "window_start"], rules, insert))


def merge_large_trades(target: DataFrame, source: DataFrame) -> DataFrame:
    """Alerts never change once written; only new ids are added."""
    return insert_if_absent(target, source)


def combine_partials(*parts: DataFrame) -> DataFrame:
    """Fold partial measures of any number of batches, in any order, by one aggregation.

    Unlike the merges of finished tables this needs no join, keeps the id that orders trades of
    the same instant, and gives the same rows however the trades were split.
    """
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return measures.combine(stacked)
