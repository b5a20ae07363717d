"""The registered queries: every operator of the library over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom import schemas
from tradeloom.functions import measures
from tradeloom.operators import merge, normalize, reads, running, signals, tables
from tradeloom.session import configure, scratch_dir
from tradeloom.sources import landing, market, raw
from tradeloom.streaming.medallion import Medallion, Settings

# No event is worth 50,000; this threshold selects about four in a hundred.
LIVE_THRESHOLD = 10000.0

# The history spans seven years and one batch holds them all.
BY_YEAR = Settings(period="year", fan_out=2)

# The columns the inspection of clean trades shows.
SILVER_INSPECTION = ["symbol", "price", "quantity", "quote_qty", "is_buyer_maker", "event_time"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register under the function's name; times leave as zone-free timestamps like the tables'."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = build(configure(spark), sf_dir)
        return rows.select(
            *[
                F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType == T.TimestampType() else F.col(f.name)
                for f in rows.schema.fields
            ]
        )

    run.__name__ = build.__name__
    run.__doc__ = build.__doc__
    QUERIES[build.__name__] = run
    return build


# --- inputs ---------------------------------------------------------------------------------


def _raw_history(spark, sf_dir):
    return market.history_rows(market.table(spark, sf_dir, "lineitem"))


def _raw_live(spark, sf_dir):
    return raw.decode_payload(market.live_messages(market.table(spark, sf_dir, "events")))


def _bronze(spark, sf_dir):
    return raw.unify(_raw_history(spark, sf_dir), _raw_live(spark, sf_dir))


def _history(spark, sf_dir):
    return normalize.first_per_id(market.history_trades(spark, sf_dir))


def _live_whales(spark, sf_dir):
    return signals.large_trades(market.live_trades(spark, sf_dir), LIVE_THRESHOLD)


def _halves(spark, sf_dir):
    """The live trades in two batches that share every busy bucket, with opens and closes on both sides."""
    trades = market.live_trades(spark, sf_dir)
    even = F.element_at(F.split("event_id", ":"), -1).cast("bigint") % 2 == 0
    return trades.filter(even), trades.filter(~even)


def _deliveries(spark, sf_dir):
    """The history in three batches that share days and ids."""
    lines = market.table(spark, sf_dir, "lineitem")
    return [market.history_rows(lines.filter(F.col("l_returnflag") == flag)) for flag in ("A", "N", "R")]


def _delivered_trades(spark, sf_dir):
    """First and later deliveries as clean trades, each unique by id."""
    trades = market.history_trades(spark, sf_dir, "l_returnflag")
    first = trades.filter("l_returnflag = 'A'").drop("l_returnflag")
    later = trades.filter("l_returnflag <> 'A'").drop("l_returnflag")
    return normalize.first_per_id(first), normalize.first_per_id(later)


# --- raw tables -----------------------------------------------------------------------------


@query
def bronze_batch_scan(spark, sf_dir):
    folder = scratch_dir(spark, "history")
    _raw_history(spark, sf_dir).write.csv(folder)
    return raw.scan_history(spark, folder)


@query
def bronze_stream_scan(spark, sf_dir):
    folder = scratch_dir(spark, "bronze")
    events = raw.open_bus(spark, "parquet", None, market.EVENTS, path=f"{sf_dir}/events*.parquet")
    live = raw.decode_payload(market.live_messages(events))
    raw.append_live(live, folder, f"{folder}/checkpoint", availableNow=True).awaitTermination()
    return spark.read.schema(schemas.LIVE).parquet(f"{folder}/live")


@query
def bronze_stream_from_latest(spark, sf_dir):
    """Two of six landings are there before the stream starts, one never comes; the stream stops and goes on in between.

    The result is the trades that reached Bronze, and the number of lost landings beside each.
    """
    folder, bronze = scratch_dir(spark, "landing"), scratch_dir(spark, "bronze")
    events = market.table(spark, sf_dir, "events").withColumn("segment", F.col("event_id") % 6)

    def land(*segments: int) -> None:
        for segment in segments:
            messages = market.live_messages(events.filter(F.col("segment") == segment))
            landing.land(messages.select(F.lit(segment).alias("segment"), "value"), folder)

    def started():
        bus = raw.open_bus(spark, landing.FORMAT, path=folder)
        copy = bus.writeStream.format("parquet").option("checkpointLocation", f"{bronze}/checkpoint")
        running = copy.trigger(processingTime="0 seconds").start(f"{bronze}/bus")
        running.processAllAvailable()
        return running

    land(0, 1)
    running = started()
    land(2, 3)
    running.processAllAvailable()
    running.stop()
    land(5)
    started().stop()
    bus = spark.read.schema(landing.SCHEMA).parquet(f"{bronze}/bus")
    lost = landing.losses(bus).agg(F.sum("lost")).scalar()
    trades = normalize.normalize(raw.decode_payload(bus))
    return trades.select("event_id", "symbol", "price", "quantity", "event_time").withColumn("lost", lost)


@query
def bronze_appended(spark, sf_dir):
    """Two appends to the history, the second with a column the first does not have, read back together."""
    folder = scratch_dir(spark, "appended")
    first, later, last = _deliveries(spark, sf_dir)
    raw.append_history(first, folder)
    raw.append_history(later.union(last).withColumn("Venue", F.concat(F.lit("venue-"), "is_Buyer_Maker")), folder)
    _raw_live(spark, sf_dir).write.parquet(f"{folder}/live")
    return raw.read_bronze(spark, folder, evolve=True)


@query
def bronze_unified(spark, sf_dir):
    return _bronze(spark, sf_dir)


# --- clean trades ---------------------------------------------------------------------------


@query
def parse_envelope(spark, sf_dir):
    return normalize.parse_envelope(_raw_live(spark, sf_dir))


@query
def normalize_trades(spark, sf_dir):
    return normalize.normalize(_bronze(spark, sf_dir))


@query
def quote_qty_derivation(spark, sf_dir):
    """Given for two of the three deliveries, derived for the third and for live trades."""
    lines = market.table(spark, sf_dir, "lineitem")
    parts = [
        market.history_rows(lines.filter("l_returnflag <> 'R'")),
        market.history_rows(lines.filter("l_returnflag = 'R'")).drop("Quote_Qty"),
        _raw_live(spark, sf_dir),
    ]
    united = parts[0]
    for part in parts[1:]:
        united = raw.unify(united, part)
    return normalize.normalize(united).select("event_id", "price", "quantity", "quote_qty")


@query
def event_time_normalization(spark, sf_dir):
    """Milliseconds and microseconds, exact and cut to seconds."""
    bronze = _bronze(spark, sf_dir)
    exact = normalize.normalize(bronze)
    cut = normalize.normalize(bronze, normalize.Rules(event_time_precision="second"))
    return exact.select("event_id", F.lit("exact").alias("precision"), "event_time").unionByName(
        cut.select("event_id", F.lit("second").alias("precision"), "event_time")
    )


@query
def maker_flag_normalization(spark, sf_dir):
    """JSON booleans, text in three spellings, and text that is no boolean."""
    lines = market.table(spark, sf_dir, "lineitem")
    spelled = (
        F.when(F.col("l_returnflag") == "A", F.upper("is_Buyer_Maker"))
        .when(F.col("l_returnflag") == "N", F.lower("is_Buyer_Maker"))
        .when(F.col("l_linestatus") == "F", F.col("is_Buyer_Maker"))
        .otherwise("unknown")
    )
    history = lines.withColumns(
        {
            "Trade_ID": F.concat_ws("-", "l_orderkey", "l_linenumber"),
            "is_Buyer_Maker": F.when(F.col("l_linestatus") == "F", "True").otherwise("False"),
        }
    ).select("Trade_ID", spelled.alias("is_Buyer_Maker"))
    trades = normalize.normalize(raw.unify(history, _raw_live(spark, sf_dir)))
    return trades.select("event_id", "is_buyer_maker")


@query
def event_id_synthesis(spark, sf_dir):
    return normalize.normalize(_bronze(spark, sf_dir)).select("event_id", "symbol")


@query
def event_id_hash_fallback(spark, sf_dir):
    """Live messages that lost their sequence number."""
    nameless = _raw_live(spark, sf_dir).select(F.regexp_replace("value", '"a":[0-9]+,', "").alias("value"))
    return normalize.normalize(nameless).select("event_id", "symbol", "event_time", "price", "quantity")


@query
def silver_valid(spark, sf_dir):
    return normalize.valid(normalize.normalize(_bronze(spark, sf_dir)))


@query
def silver_rejected(spark, sf_dir):
    return normalize.rejected(normalize.normalize(_bronze(spark, sf_dir)))


@query
def silver_dedupe(spark, sf_dir):
    return _history(spark, sf_dir)


@query
def silver_insert_if_absent(spark, sf_dir):
    return merge.insert_if_absent(*_delivered_trades(spark, sf_dir))


_stores: dict[tuple[str, str, str], Medallion] = {}


def _store(spark, sf_dir: str, label: str, build: Callable[[Medallion], None], settings: Settings) -> Medallion:
    """Tables written once per application; the read queries scan them."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _stores:
        store = Medallion(scratch_dir(spark, label), settings)
        build(store)
        _stores[key] = store
    return _stores[key]


def forget_stores() -> None:
    """Write the tables anew for the next query that reads them."""
    _stores.clear()


def _silver_store(spark, sf_dir) -> Medallion:
    """All raw rows of both kinds, stored as one batch."""
    return _store(spark, sf_dir, "silver", lambda store: store.process(_bronze(spark, sf_dir), 0), BY_YEAR)


def _live_store(spark, sf_dir) -> Medallion:
    """The live trades with the full precision of their times, stored as one batch."""
    settings = Settings(large_trade_value=LIVE_THRESHOLD)
    trades = normalize.with_reject_reason(market.live_trades(spark, sf_dir))
    return _store(spark, sf_dir, "live", lambda store: store.store(trades, 0), settings)


@query
def silver_latest(spark, sf_dir):
    return reads.latest_trades(_silver_store(spark, sf_dir).trades(spark))


@query
def silver_latest_columns(spark, sf_dir):
    columns = SILVER_INSPECTION
    return reads.latest_trades(_silver_store(spark, sf_dir).trades(spark), columns=columns)


@query
def silver_count(spark, sf_dir):
    return _silver_store(spark, sf_dir).trades(spark).agg(F.count("*").alias("total_rows"))


@query
def gold_input(spark, sf_dir):
    return normalize.derivable(normalize.normalize(_bronze(spark, sf_dir)))


# --- derived tables -------------------------------------------------------------------------


@query
def ohlc(spark, sf_dir):
    return signals.ohlc(market.live_trades(spark, sf_dir))


@query
def ohlc_1h(spark, sf_dir):
    return signals.ohlc(market.live_trades(spark, sf_dir), "1 hour")


@query
def ohlc_history(spark, sf_dir):
    """Every day of the history is one instant, so ids alone decide open and close."""
    return signals.ohlc(_history(spark, sf_dir))


@query
def vwap(spark, sf_dir):
    return signals.vwap(market.live_trades(spark, sf_dir))


@query
def vwap_1h(spark, sf_dir):
    return signals.vwap(market.live_trades(spark, sf_dir), "1 hour")


@query
def maker_taker_flow(spark, sf_dir):
    return signals.maker_taker_flow(market.live_trades(spark, sf_dir))


@query
def maker_taker_flow_history(spark, sf_dir):
    return signals.maker_taker_flow(_history(spark, sf_dir))


@query
def whale_alert(spark, sf_dir):
    return signals.large_trades(_history(spark, sf_dir))


@query
def whale_alert_live(spark, sf_dir):
    return _live_whales(spark, sf_dir)


# --- merges ---------------------------------------------------------------------------------


@query
def merge_ohlc_first_batch(spark, sf_dir):
    """Merging into an empty table gives the batch itself."""
    batch = signals.ohlc(market.live_trades(spark, sf_dir))
    return merge.merge_ohlc(spark.createDataFrame([], batch.schema), batch)


def _combined(spark, sf_dir):
    first, second = _halves(spark, sf_dir)
    return merge.combine_partials(measures.summarise(first, "1 hour"), measures.summarise(second, "1 hour"))


@query
def combine_ohlc(spark, sf_dir):
    return measures.candles(_combined(spark, sf_dir))


@query
def combine_flow(spark, sf_dir):
    return measures.taker_flow(_combined(spark, sf_dir))


@query
def combine_vwap(spark, sf_dir):
    return measures.average_prices(_combined(spark, sf_dir))


@query
def merge_ohlc(spark, sf_dir):
    """Finished candles of one half merged into those of the other."""
    return merge.merge_ohlc(*(signals.ohlc(half, "1 hour") for half in _halves(spark, sf_dir)))


@query
def merge_flow(spark, sf_dir):
    return merge.merge_flow(*(signals.maker_taker_flow(half, "1 hour") for half in _halves(spark, sf_dir)))


@query
def merge_vwap(spark, sf_dir):
    return merge.merge_vwap(*(signals.vwap(half, "1 hour") for half in _halves(spark, sf_dir)))


@query
def merge_upsert_generic(spark, sf_dir):
    """Candles without volumes merged by rules of the caller; new rows by an insert map that leaves one out."""
    columns = ["symbol", "candle_time", "high_price", "low_price", "close_price", "close_event_time", "total_trades"]
    target, source = (signals.ohlc(half, "1 hour").select(columns) for half in _halves(spark, sf_dir))
    later = F.col("source.close_event_time") > F.col("target.close_event_time")
    rules = {
        "high_price": F.greatest("target.high_price", "source.high_price"),
        "low_price": F.least("target.low_price", "source.low_price"),
        "total_trades": F.col("target.total_trades") + F.col("source.total_trades"),
    } | {
        name: F.when(later, F.col(f"source.{name}")).otherwise(F.col(f"target.{name}"))
        for name in ("close_price", "close_event_time")
    }
    insert = {name: F.col(f"source.{name}") for name in columns if name != "close_price"}
    return merge.upsert(target, source, ["symbol", "candle_time"], rules, insert)


@query
def merge_whale(spark, sf_dir):
    first, later = _delivered_trades(spark, sf_dir)
    return merge.merge_large_trades(signals.large_trades(first), signals.large_trades(later))


def _three_batches(spark, sf_dir, label: str, order=(0, 1, 2), replay: bool = False) -> Medallion:
    """The deliveries as batches of one stream; with ``replay`` each is delivered twice."""

    def build(store: Medallion) -> None:
        deliveries = _deliveries(spark, sf_dir)
        for number, delivery in enumerate(order):
            for _ in range(2 if replay else 1):
                store.process(deliveries[delivery], number)

    return _store(spark, sf_dir, label, build, BY_YEAR)


@query
def gold_as_of_batch(spark, sf_dir):
    """Candles as they stood after the second of three batches."""
    return _three_batches(spark, sf_dir, "batches").ohlc(spark, as_of=1)


@query
def gold_replayed_batches(spark, sf_dir):
    """Every batch delivered twice: candles as if delivered once."""
    return _three_batches(spark, sf_dir, "replayed", replay=True).ohlc(spark)


@query
def gold_compacted(spark, sf_dir):
    """Trades out of the folded run of the first two batches and the third."""
    store = _three_batches(spark, sf_dir, "batches")
    if len(store.parts(spark)) != 2:
        raise RuntimeError("the first two batches are not folded")
    return store.trades(spark)


@query
def gold_late_batch(spark, sf_dir):
    """The delivery that starts the history comes last: finished candles of old days change."""
    return _three_batches(spark, sf_dir, "late", order=(2, 1, 0)).ohlc(spark)


# --- streams --------------------------------------------------------------------------------


def _streamed(spark, sf_dir) -> Medallion:
    """Three landings in the raw table, one run of the stream after each, over one checkpoint.

    The first brings a delivery of the history and all live messages, the others a delivery each. A run takes
    all that has landed; what an id was first delivered with stays.
    """

    def build(store: Medallion) -> None:
        bronze = scratch_dir(spark, "bronze")
        _raw_live(spark, sf_dir).write.parquet(f"{bronze}/live")
        for delivery in _deliveries(spark, sf_dir):
            raw.append_history(delivery, bronze)
            rows = raw.stream_bronze(spark, bronze)
            store.start(rows, f"{store.root}/checkpoint", availableNow=True).awaitTermination()

    return _store(spark, sf_dir, "stream", build, BY_YEAR)


@query
def stream_silver(spark, sf_dir):
    return _streamed(spark, sf_dir).trades(spark)


@query
def stream_ohlc(spark, sf_dir):
    return _streamed(spark, sf_dir).ohlc(spark)


@query
def stream_flow(spark, sf_dir):
    return _streamed(spark, sf_dir).flow(spark)


@query
def stream_vwap(spark, sf_dir):
    return _streamed(spark, sf_dir).vwap(spark)


@query
def stream_whale(spark, sf_dir):
    return _streamed(spark, sf_dir).whales(spark)


# --- read queries ---------------------------------------------------------------------------


@query
def ohlc_latest(spark, sf_dir):
    return reads.latest_ohlc(_live_store(spark, sf_dir).ohlc(spark))


@query
def ohlc_latest_symbol(spark, sf_dir):
    return reads.latest_ohlc(_live_store(spark, sf_dir).ohlc(spark), limit=500, symbol=" purchase ")


@query
def ohlc_latest_json(spark, sf_dir):
    return reads.json_rows(reads.latest_ohlc(_live_store(spark, sf_dir).ohlc(spark)))


@query
def flow_latest(spark, sf_dir):
    return reads.latest_flow(_live_store(spark, sf_dir).flow(spark))


@query
def vwap_latest(spark, sf_dir):
    return reads.latest_vwap(_live_store(spark, sf_dir).vwap(spark))


@query
def whale_latest(spark, sf_dir):
    return reads.latest_whales(_live_store(spark, sf_dir).whales(spark), min_value=LIVE_THRESHOLD)


@query
def whale_latest_symbol(spark, sf_dir):
    return reads.latest_whales(_live_store(spark, sf_dir).whales(spark), 200, "purchase", 15000)


def _newest_event(spark, sf_dir):
    """The newest event time as a scalar subquery: no driver round trip."""
    events = market.table(spark, sf_dir, "events")
    return events.agg(F.max(F.col("ts").cast("timestamp"))).scalar()


@query
def ohlc_newest_periods(spark, sf_dir):
    """Newest candles of a symbol out of the periods whose counts make them certain."""
    store = _live_store(spark, sf_dir)
    return reads.latest_ohlc(store.newest(spark, "ohlc", 500, "purchase"), 500, "purchase")


@query
def whale_newest_periods(spark, sf_dir):
    return reads.latest_whales(_live_store(spark, sf_dir).newest(spark, "whales", 50), min_value=LIVE_THRESHOLD)


@query
def silver_newest_periods(spark, sf_dir):
    return reads.latest_trades(_silver_store(spark, sf_dir).newest(spark, "trades", 20))


@query
def file_ids_delivered_twice(spark, sf_dir):
    """Clean trades after all raw rows were stored as two batches that share files of the history."""
    def build(store: Medallion) -> None:
        raw_rows = _bronze(spark, sf_dir)
        store.process(raw_rows, 0)
        store.process(raw_rows.filter("Trade_ID IS NOT NULL"), 1)

    return _store(spark, sf_dir, "twice", build, BY_YEAR).trades(spark)


@query
def whale_last_hour(spark, sf_dir):
    whales = signals.large_trades(market.live_trades(spark, sf_dir), 0.0)
    return reads.whales_last_hour(whales, 0.0, _newest_event(spark, sf_dir))


@query
def whale_hours_running(spark, sf_dir):
    """The hour before six moments, out of running totals that are written once for all of them.

    The moments are the newest event and 1, 26, 1000 and 9000 hours and half a minute before it, and ten days after it.
    """
    folder = scratch_dir(spark, "running")
    whales = signals.large_trades(market.live_trades(spark, sf_dir), 0.0)
    running.write_running(whales, folder)
    totals, newest = running.read_running(spark, folder), _newest_event(spark, sf_dir)
    found = []
    for hours in (0, 1, 26, 1000, 9000, -240):
        shift = f"INTERVAL {hours} HOUR" + (" + INTERVAL 30 SECOND" if hours > 0 else "")
        hour = running.totals_of_span(totals, whales, newest - F.expr(shift))
        found.append(hour.select(F.lit(hours).cast("bigint").alias("hours_before"), "*"))
    rows = found[0]
    for more in found[1:]:
        rows = rows.union(more)
    return rows


def _summary_inputs(spark, sf_dir):
    """The written tables a dashboard reads."""
    store = _live_store(spark, sf_dir)
    return store.ohlc(spark), store.flow(spark), store.whales(spark), store.vwap(spark)


def _flat(summary: DataFrame) -> DataFrame:
    renamed = {"symbol": "latest_symbol", "price": "latest_price", "time": "latest_time"}
    return summary.select(
        *[F.col(f"latest_price.{old}").alias(new) for old, new in renamed.items()],
        *[c for c in summary.columns if c not in ("latest_price", "symbol")],
    )


@query
def dashboard_summary(spark, sf_dir):
    as_of = _newest_event(spark, sf_dir)
    inputs = _summary_inputs(spark, sf_dir)
    return _flat(reads.dashboard_summary(*inputs, min_value=LIVE_THRESHOLD, as_of=as_of))


@query
def dashboard_summary_symbol(spark, sf_dir):
    as_of = _newest_event(spark, sf_dir)
    inputs = _summary_inputs(spark, sf_dir)
    return _flat(reads.dashboard_summary(*inputs, "VIEW", LIVE_THRESHOLD, as_of))


@query
def dashboard_by_symbol(spark, sf_dir):
    as_of = _newest_event(spark, sf_dir)
    inputs = _summary_inputs(spark, sf_dir)
    return _flat(reads.dashboard_by_symbol(*inputs, LIVE_THRESHOLD, as_of))


@query
def gold_stats(spark, sf_dir):
    candles, flow, whales, averages = _summary_inputs(spark, sf_dir)
    return reads.row_counts({"ohlc": candles, "whale": whales, "flow": flow, "vwap": averages})


# Fixed value: the statement that shows whether the named tables answer.
NEWEST_CANDLES = "SELECT symbol, candle_time, close_price FROM {table} ORDER BY candle_time DESC, symbol LIMIT 20"


@query
def sql_latest_candles(spark, sf_dir):
    tables.register_views({"ohlc": _live_store(spark, sf_dir).ohlc(spark)})
    return spark.sql(NEWEST_CANDLES.format(table="ohlc_1min"))


@query
def sql_registered_tables(spark, sf_dir):
    """Rows per named table over the published folders, through SQL."""
    store = _live_store(spark, sf_dir)
    names = tables.register_tables(spark, store.publish(spark), "gold_published")
    counts = [f"SELECT '{n.split('.')[1]}' AS name, count(*) AS total_rows FROM {n}" for n in names]
    return spark.sql(" UNION ALL ".join(counts))
