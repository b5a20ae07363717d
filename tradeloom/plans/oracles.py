"""Independent SQL for every registered query whose result SQL can state (DuckDB dialect)."""

from __future__ import annotations

# Live trades from events, valid ones only; {time} is the event time.
_LIVE = """
SELECT 'stream:' || upper(event_type) || ':' || event_id AS event_id,
       upper(event_type) AS symbol,
       value AS price,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) AS quantity,
       value * CAST(json_extract_string(props, '$.k') AS DOUBLE) AS quote_qty,
       {time} AS event_time,
       CASE WHEN user_id % 10 = 9 THEN NULL ELSE user_id % 2 = 0 END AS is_buyer_maker
FROM events
"""
_VALID = "price > 0 AND quantity > 0 AND event_time IS NOT NULL"
_EXACT = "ts"
_MILLIS = "date_trunc('millisecond', ts)"

_HISTORY = """
SELECT 'batch:' || l_orderkey || '-' || l_linenumber AS event_id,
       'BTCUSDT' AS symbol,
       l_extendedprice / l_quantity AS price,
       l_quantity AS quantity,
       l_extendedprice AS quote_qty,
       l_shipdate AS event_time,
       l_linestatus = 'F' AS is_buyer_maker
FROM lineitem
"""
_COLUMNS = "event_id, symbol, price, quantity, quote_qty, event_time, is_buyer_maker"
_ORDER = "event_time, price, quantity, quote_qty, is_buyer_maker NULLS FIRST"


def _unique(rows: str, first: str = "") -> str:
    """One row per id; ``first`` leads the order that picks it."""
    return f"""
SELECT {_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY {first}{_ORDER}) AS n FROM ({rows}))
WHERE n = 1
"""


_T = f"SELECT * FROM ({_LIVE.format(time=_EXACT)}) WHERE {_VALID}"
_L = _unique(_HISTORY)
_ALL_RAW = f"{_LIVE.format(time=_MILLIS)} UNION ALL {_HISTORY}"
_ALL_VALID = f"SELECT * FROM ({_ALL_RAW}) WHERE {_VALID}"
_SILVER = _unique(_ALL_VALID)

# The delivery a line item arrives in; ids already delivered stay as they are.
_DELIVERED = _HISTORY.replace(
    "FROM lineitem",
    ", CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS delivery FROM lineitem",
)


def _decimal(x: str) -> str:
    """The number as it is written out, exactly."""
    return f"CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 16))"


def _double(x: str) -> str:
    """The nearest double of a decimal number."""
    return f"CAST(CAST({x} AS VARCHAR) AS DOUBLE)"


def _sum(x: str) -> str:
    return _double(f"sum({_decimal(x)})")


def _ohlc(trades: str, bucket: str = "1 minute") -> str:
    return f"""
SELECT symbol, time_bucket(INTERVAL '{bucket}', event_time) AS candle_time,
       arg_min(price, (event_time, event_id)) AS open_price, min(event_time) AS open_event_time,
       max(price) AS high_price, min(price) AS low_price,
       arg_max(price, (event_time, event_id)) AS close_price, max(event_time) AS close_event_time,
       {_sum('quantity')} AS total_quantity, {_sum('quote_qty')} AS total_quote_qty,
       count(*) AS total_trades
FROM ({trades}) GROUP BY 1, 2
"""


def _vwap(trades: str, bucket: str = "1 minute") -> str:
    return f"""
SELECT symbol, window_start, total_quantity, total_quote_qty, trade_count, close_price, close_event_time,
       total_quote_qty / total_quantity AS vwap_price,
       total_quantity / trade_count AS avg_trade_size,
       close_price - total_quote_qty / total_quantity AS close_vs_vwap_diff,
       (close_price - total_quote_qty / total_quantity) / (total_quote_qty / total_quantity) * 100
         AS close_vs_vwap_pct
FROM (SELECT symbol, time_bucket(INTERVAL '{bucket}', event_time) AS window_start,
             {_sum('quantity')} AS total_quantity, {_sum('quote_qty')} AS total_quote_qty,
             count(*) AS trade_count,
             arg_max(price, (event_time, event_id)) AS close_price, max(event_time) AS close_event_time
      FROM ({trades}) GROUP BY 1, 2)
"""


def _flow(trades: str, bucket: str = "1 minute") -> str:
    def side(amount: str, sold: str) -> str:
        return f"sum(CASE WHEN {sold} is_buyer_maker THEN {_decimal(amount)} ELSE 0 END)"

    bought, sold = side("quote_qty", "NOT"), side("quote_qty", "")
    return f"""
SELECT symbol, time_bucket(INTERVAL '{bucket}', event_time) AS window_start,
       {_double(side('quantity', 'NOT'))} AS buy_aggressive_qty,
       {_double(side('quantity', ''))} AS sell_aggressive_qty,
       {_double(bought)} AS buy_aggressive_quote_qty,
       {_double(sold)} AS sell_aggressive_quote_qty,
       {_double(f'({bought} - {sold})')} AS net_flow
FROM ({trades}) WHERE is_buyer_maker IS NOT NULL GROUP BY 1, 2
"""


def _both_halves(table) -> str:
    """Hourly rows of the live trades with even and with odd event numbers; the even ones are the target."""
    number = "CAST(split_part(event_id, ':', 3) AS BIGINT) % 2"
    return " UNION ALL ".join(
        f"SELECT *, {half} AS half FROM ({table(f'SELECT * FROM ({_T}) WHERE {number} = {half}', '1 hour')})"
        for half in (0, 1)
    )


def _whales(trades: str, threshold: float) -> str:
    return f"""
SELECT event_id, symbol, event_time, price, quantity, quote_qty, is_buyer_maker, quote_qty AS trade_value_usdt
FROM ({trades}) WHERE quote_qty > {threshold}
"""


_OHLC_READ = """symbol, candle_time, open_price, high_price, low_price, close_price,
total_quantity, total_quote_qty, total_trades"""
_T_WHALES = _whales(_T, 10000)
_NEWEST = "(SELECT max(ts) FROM events)"

_SUMMARY_TAIL = """
         CASE WHEN net > 0 THEN 'BULLISH' WHEN net < 0 THEN 'BEARISH' ELSE 'NEUTRAL' END AS market_sentiment,
         'Metrics are computed from latest up to 60 one-minute rows.' AS window_note,
         whales AS whale_count_recent, worth AS whale_total_value, net AS net_flow
"""
_SUMMARY_HEAD = """
         symbol AS latest_symbol, last_price AS latest_price, last_time AS latest_time,
         CASE WHEN base = 0 THEN 0 ELSE (last_price - base) / base * 100 END AS price_change_1h_pct,
         net AS net_flow_1h, whales AS whale_count_1h, worth AS whale_total_value_1h,
         pct AS latest_close_vs_vwap_pct,
"""


def _summary(trades: str) -> str:
    """One row over the newest 60 rows of each table, whatever their symbols."""
    return f"""
WITH c AS (SELECT *, row_number() OVER (ORDER BY candle_time DESC, symbol) AS n FROM ({_ohlc(trades)})
           QUALIFY n <= 60),
     f AS (SELECT net_flow FROM ({_flow(trades)}) ORDER BY window_start DESC, symbol LIMIT 60),
     w AS (SELECT * FROM ({_whales(trades, 10000)})
           WHERE event_time >= {_NEWEST} - INTERVAL 1 HOUR AND event_time <= {_NEWEST}),
     m AS (SELECT (SELECT symbol FROM c WHERE n = 1) AS symbol,
                  (SELECT close_price FROM c WHERE n = 1) AS last_price,
                  (SELECT candle_time FROM c WHERE n = 1) AS last_time,
                  (SELECT close_price FROM c ORDER BY n DESC LIMIT 1) AS base,
                  (SELECT {_sum('net_flow')} FROM f) AS net,
                  (SELECT count(*) FROM w) AS whales,
                  (SELECT coalesce({_sum('trade_value_usdt')}, 0) FROM w) AS worth,
                  (SELECT close_vs_vwap_pct FROM ({_vwap(trades)})
                   ORDER BY window_start DESC, symbol LIMIT 1) AS pct)
SELECT {_SUMMARY_HEAD} {_SUMMARY_TAIL} FROM m
"""


_SUMMARY_BY_SYMBOL = f"""
WITH c AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY candle_time DESC) AS n
           FROM ({_ohlc(_T)}) QUALIFY n <= 60),
     f AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY window_start DESC) AS n
           FROM ({_flow(_T)}) QUALIFY n <= 60),
     v AS (SELECT symbol, arg_max(close_vs_vwap_pct, window_start) AS pct FROM ({_vwap(_T)}) GROUP BY 1),
     w AS (SELECT symbol, count(*) AS whales, {_sum('trade_value_usdt')} AS worth FROM ({_T_WHALES})
           WHERE event_time >= {_NEWEST} - INTERVAL 1 HOUR AND event_time <= {_NEWEST} GROUP BY 1),
     e AS (SELECT symbol, arg_min(close_price, n) AS last_price, max(candle_time) AS last_time,
                  arg_max(close_price, n) AS base FROM c GROUP BY 1),
     s AS (SELECT symbol, {_sum('net_flow')} AS net FROM f GROUP BY 1),
     m AS (SELECT symbol, last_price, last_time, base, coalesce(net, 0) AS net,
                  coalesce(whales, 0) AS whales, coalesce(worth, 0) AS worth, pct
           FROM e LEFT JOIN s USING (symbol) LEFT JOIN v USING (symbol) LEFT JOIN w USING (symbol))
SELECT {_SUMMARY_HEAD} {_SUMMARY_TAIL} FROM m
"""

# The raw forms as text.
_HISTORY_TEXT = """
SELECT l_orderkey || '-' || l_linenumber AS "Trade_ID",
       CAST(l_extendedprice / l_quantity AS VARCHAR) AS "Price",
       CAST(l_quantity AS VARCHAR) AS "Quantity",
       CAST(l_extendedprice AS VARCHAR) AS "Quote_Qty",
       CAST(epoch_us(l_shipdate) AS VARCHAR) AS "Timestamp",
       CASE WHEN l_linestatus = 'F' THEN 'True' ELSE 'False' END AS "is_Buyer_Maker",
       'True' AS "is_Best_Match"
FROM lineitem
"""
_LIVE_TEXT = """
SELECT '{"a":' || event_id || ',"s":"' || upper(event_type) || '","p":"' || CAST(value AS VARCHAR)
       || '","q":"' || CAST(CAST(json_extract_string(props, '$.k') AS DOUBLE) AS VARCHAR)
       || '","T":' || (epoch_us(ts) // 1000)
       || CASE WHEN user_id % 10 = 9 THEN '' WHEN user_id % 2 = 0 THEN ',"m":true' ELSE ',"m":false' END
       || '}' AS value
FROM events
"""


def sql() -> dict[str, str]:
    h1 = "1 hour"
    first_seen = _unique(_DELIVERED, "delivery, ")
    seen_by_two = _unique(f"SELECT * FROM ({_DELIVERED}) WHERE delivery <= 1", "delivery, ")
    # Deliveries N and R form one later batch.
    two_steps = _unique(_DELIVERED, "least(delivery, 1), ")
    streamed = f"{first_seen} UNION ALL SELECT * FROM ({_LIVE.format(time=_MILLIS)}) WHERE {_VALID}"
    hashed = f"SELECT * FROM ({_LIVE.format(time=_MILLIS)})"
    return {
        "bronze_batch_scan": _HISTORY_TEXT,
        "bronze_stream_scan": _LIVE_TEXT,
        "bronze_stream_from_latest": f"""
SELECT event_id, symbol, price, quantity, event_time, CAST(1 AS BIGINT) AS lost
FROM ({_LIVE.format(time=_MILLIS)[: -len("FROM events") - 1]}
      FROM (SELECT * FROM events WHERE event_id % 6 IN (2, 3, 5)))
""",
        "bronze_appended": f"""
SELECT *, CASE WHEN l_returnflag <> 'A' THEN 'venue-' || "is_Buyer_Maker" END AS "Venue"
FROM ({_HISTORY_TEXT.replace("FROM lineitem", ", l_returnflag FROM lineitem")})
UNION ALL BY NAME {_LIVE_TEXT}
""".replace("SELECT *,", "SELECT * EXCLUDE (l_returnflag),"),
        "bronze_unified": f"{_HISTORY_TEXT} UNION ALL BY NAME {_LIVE_TEXT}",
        "parse_envelope": """
SELECT event_id AS a, upper(event_type) AS s, CAST(value AS VARCHAR) AS p,
       CAST(CAST(json_extract_string(props, '$.k') AS DOUBLE) AS VARCHAR) AS q,
       epoch_us(ts) // 1000 AS "T",
       CASE WHEN user_id % 10 = 9 THEN NULL ELSE user_id % 2 = 0 END AS m
FROM events
""",
        "normalize_trades": _ALL_RAW,
        "quote_qty_derivation": f"""
SELECT event_id, price, quantity, quote_qty FROM ({_LIVE.format(time=_MILLIS)})
UNION ALL
SELECT 'batch:' || l_orderkey || '-' || l_linenumber, l_extendedprice / l_quantity, l_quantity,
       CASE WHEN l_returnflag = 'R' THEN (l_extendedprice / l_quantity) * l_quantity ELSE l_extendedprice END
FROM lineitem
""",
        "event_time_normalization": f"""
SELECT event_id, 'exact' AS precision, event_time FROM ({_ALL_RAW})
UNION ALL SELECT event_id, 'second', date_trunc('second', event_time) FROM ({_ALL_RAW})
""",
        "maker_flag_normalization": f"""
SELECT event_id, is_buyer_maker FROM ({_LIVE.format(time=_MILLIS)})
UNION ALL
SELECT 'batch:' || l_orderkey || '-' || l_linenumber,
       CASE WHEN l_returnflag IN ('A', 'N') THEN l_linestatus = 'F' WHEN l_linestatus = 'F' THEN true END
FROM lineitem
""",
        "event_id_synthesis": f"SELECT event_id, symbol FROM ({_ALL_RAW})",
        "event_id_hash_fallback": f"""
SELECT sha256(concat_ws('||', symbol, CAST(event_time AS VARCHAR), CAST(price AS VARCHAR),
              CAST(quantity AS VARCHAR), CAST(quote_qty AS VARCHAR), CAST(is_buyer_maker AS VARCHAR))) AS event_id,
       symbol, event_time, price, quantity FROM ({hashed})
""",
        "silver_valid": _ALL_VALID,
        "silver_rejected": f"""
SELECT *, CASE WHEN price IS NULL OR NOT price > 0 THEN 'bad_price'
               WHEN quantity IS NULL OR NOT quantity > 0 THEN 'bad_quantity' ELSE 'bad_time' END AS reject_reason
FROM ({_ALL_RAW}) WHERE ({_VALID}) IS NOT TRUE
""",
        "silver_dedupe": _L,
        "silver_insert_if_absent": two_steps,
        "silver_latest": f"SELECT * FROM ({_SILVER}) ORDER BY event_time DESC, event_id LIMIT 20",
        "silver_latest_columns": f"""
SELECT symbol, price, quantity, quote_qty, is_buyer_maker, event_time
FROM (SELECT * FROM ({_SILVER}) ORDER BY event_time DESC, event_id LIMIT 20)
""",
        "silver_count": f"SELECT count(*) AS total_rows FROM ({_SILVER})",
        "gold_input": f"""
SELECT * FROM ({_ALL_RAW}) WHERE event_id IS NOT NULL AND symbol IS NOT NULL AND price IS NOT NULL
   AND quantity IS NOT NULL AND quote_qty IS NOT NULL AND event_time IS NOT NULL
""",
        "ohlc": _ohlc(_T),
        "ohlc_1h": _ohlc(_T, h1),
        "ohlc_history": _ohlc(_L),
        "vwap": _vwap(_T),
        "vwap_1h": _vwap(_T, h1),
        "maker_taker_flow": _flow(_T),
        "maker_taker_flow_history": _flow(_L),
        "whale_alert": _whales(_L, 50000),
        "whale_alert_live": _T_WHALES,
        "merge_ohlc_first_batch": _ohlc(_T),
        "combine_ohlc": _ohlc(_T, h1),
        "combine_flow": _flow(_T, h1),
        "combine_vwap": _vwap(_T, h1),
        "merge_ohlc": f"""
SELECT symbol, candle_time,
       arg_min(open_price, (open_event_time, half)) AS open_price, min(open_event_time) AS open_event_time,
       max(high_price) AS high_price, min(low_price) AS low_price,
       arg_max(close_price, (close_event_time, -half)) AS close_price, max(close_event_time) AS close_event_time,
       sum(total_quantity) AS total_quantity, sum(total_quote_qty) AS total_quote_qty,
       CAST(sum(total_trades) AS BIGINT) AS total_trades
FROM ({_both_halves(_ohlc)}) GROUP BY 1, 2
""",
        "merge_flow": f"""
SELECT symbol, window_start, sum(buy_aggressive_qty) AS buy_aggressive_qty,
       sum(sell_aggressive_qty) AS sell_aggressive_qty, sum(buy_aggressive_quote_qty) AS buy_aggressive_quote_qty,
       sum(sell_aggressive_quote_qty) AS sell_aggressive_quote_qty, sum(net_flow) AS net_flow
FROM ({_both_halves(_flow)}) GROUP BY 1, 2
""",
        "merge_vwap": f"""
SELECT symbol, window_start, total_quantity, total_quote_qty, trade_count, close_price, close_event_time,
       total_quote_qty / total_quantity AS vwap_price, total_quantity / trade_count AS avg_trade_size,
       close_price - total_quote_qty / total_quantity AS close_vs_vwap_diff,
       (close_price - total_quote_qty / total_quantity) / (total_quote_qty / total_quantity) * 100
         AS close_vs_vwap_pct
FROM (SELECT symbol, window_start, sum(total_quantity) AS total_quantity, sum(total_quote_qty) AS total_quote_qty,
             CAST(sum(trade_count) AS BIGINT) AS trade_count,
             arg_max(close_price, (close_event_time, -half)) AS close_price,
             max(close_event_time) AS close_event_time
      FROM ({_both_halves(_vwap)}) GROUP BY 1, 2)
""",
        "merge_upsert_generic": f"""
SELECT symbol, candle_time, max(high_price) AS high_price, min(low_price) AS low_price,
       CASE WHEN min(half) = 1 THEN NULL ELSE arg_max(close_price, (close_event_time, -half)) END AS close_price,
       max(close_event_time) AS close_event_time, CAST(sum(total_trades) AS BIGINT) AS total_trades
FROM ({_both_halves(_ohlc)}) GROUP BY 1, 2
""",
        "merge_whale": f"""
SELECT event_id, symbol, event_time, price, quantity, quote_qty, is_buyer_maker, quote_qty AS trade_value_usdt
FROM ({_unique(f'''
  SELECT * FROM ({_unique_per_step(_DELIVERED)}) WHERE quote_qty > 50000''', 'step, ')})
""",
        "gold_as_of_batch": _ohlc(seen_by_two),
        "gold_replayed_batches": _ohlc(first_seen),
        "gold_compacted": first_seen,
        "gold_late_batch": _ohlc(_unique(_DELIVERED, "delivery DESC, ")),
        "stream_silver": streamed,
        "stream_ohlc": _ohlc(streamed),
        "stream_flow": _flow(streamed),
        "stream_vwap": _vwap(streamed),
        "stream_whale": _whales(streamed, 50000),
        "ohlc_latest": f"SELECT {_OHLC_READ} FROM ({_ohlc(_T)}) ORDER BY candle_time DESC, symbol LIMIT 100",
        "ohlc_latest_symbol": f"""
SELECT {_OHLC_READ} FROM ({_ohlc(_T)}) WHERE symbol = 'PURCHASE' ORDER BY candle_time DESC LIMIT 500
""",
        "ohlc_latest_json": f"""
SELECT '{{"symbol":"' || symbol || '","candle_time":"' || strftime(candle_time, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00"'
       || ',"open_price":' || CAST(open_price AS VARCHAR) || ',"high_price":' || CAST(high_price AS VARCHAR)
       || ',"low_price":' || CAST(low_price AS VARCHAR) || ',"close_price":' || CAST(close_price AS VARCHAR)
       || ',"total_quantity":' || CAST(total_quantity AS VARCHAR)
       || ',"total_quote_qty":' || CAST(total_quote_qty AS VARCHAR)
       || ',"total_trades":' || total_trades || '}}' AS json
FROM (SELECT {_OHLC_READ} FROM ({_ohlc(_T)}) ORDER BY candle_time DESC, symbol LIMIT 100)
""",
        "ohlc_newest_periods": f"""
SELECT {_OHLC_READ} FROM ({_ohlc(_T)}) WHERE symbol = 'PURCHASE' ORDER BY candle_time DESC LIMIT 500
""",
        "whale_newest_periods": f"""
SELECT * FROM ({_T_WHALES}) WHERE trade_value_usdt >= 10000 ORDER BY event_time DESC, event_id LIMIT 50
""",
        "silver_newest_periods": f"SELECT * FROM ({_SILVER}) ORDER BY event_time DESC, event_id LIMIT 20",
        "file_ids_delivered_twice": _SILVER,
        "flow_latest": f"SELECT * FROM ({_flow(_T)}) ORDER BY window_start DESC, symbol LIMIT 100",
        "vwap_latest": f"SELECT * FROM ({_vwap(_T)}) ORDER BY window_start DESC, symbol LIMIT 100",
        "whale_latest": f"""
SELECT * FROM ({_T_WHALES}) WHERE trade_value_usdt >= 10000 ORDER BY event_time DESC, event_id LIMIT 50
""",
        "whale_latest_symbol": f"""
SELECT * FROM ({_T_WHALES}) WHERE trade_value_usdt >= 15000 AND symbol = 'PURCHASE'
ORDER BY event_time DESC, event_id LIMIT 200
""",
        "whale_last_hour": f"""
SELECT count(*) AS whale_count_1h, coalesce({_sum('quote_qty')}, 0) AS whale_total_value_1h
FROM ({_T}) WHERE event_time >= {_NEWEST} - INTERVAL 1 HOUR AND event_time <= {_NEWEST}
""",
        "whale_hours_running": f"""
SELECT CAST(m.hours AS BIGINT) AS hours_before,
       count(t.event_id) AS whale_count_1h, coalesce({_sum('t.quote_qty')}, 0) AS whale_total_value_1h
FROM (SELECT hours, {_NEWEST} - to_hours(hours) - to_seconds(CASE WHEN hours > 0 THEN 30 ELSE 0 END) AS as_of
      FROM (VALUES (0), (1), (26), (1000), (9000), (-240)) AS v(hours)) AS m
LEFT JOIN ({_T}) AS t ON t.event_time >= m.as_of - INTERVAL 1 HOUR AND t.event_time <= m.as_of
GROUP BY m.hours
""",
        "dashboard_summary": _summary(_T),
        "dashboard_summary_symbol": _summary(f"SELECT * FROM ({_T}) WHERE symbol = 'VIEW'"),
        "dashboard_by_symbol": _SUMMARY_BY_SYMBOL,
        "gold_stats": f"""
SELECT 'ohlc' AS name, count(*) AS total_records, 'ohlc_1min' AS "table" FROM ({_ohlc(_T)})
UNION ALL SELECT 'whale', count(*), 'whale_alert' FROM ({_T_WHALES})
UNION ALL SELECT 'flow', count(*), 'maker_taker_flow_1min' FROM ({_flow(_T)})
UNION ALL SELECT 'vwap', count(*), 'vwap_1min' FROM ({_vwap(_T)})
""",
        "sql_registered_tables": f"""
SELECT 'ohlc_1min' AS name, count(*) AS total_rows FROM ({_ohlc(_T)})
UNION ALL SELECT 'whale_alert', count(*) FROM ({_T_WHALES})
UNION ALL SELECT 'maker_taker_flow_1min', count(*) FROM ({_flow(_T)})
UNION ALL SELECT 'vwap_1min', count(*) FROM ({_vwap(_T)})
""",
        "sql_latest_candles": f"""
SELECT symbol, candle_time, close_price FROM ({_ohlc(_T)}) ORDER BY candle_time DESC, symbol LIMIT 20
""",
    }


def _unique_per_step(rows: str) -> str:
    """One row per id within the first delivery, and one within the later two together."""
    return f"""
SELECT * FROM (
  SELECT *, least(delivery, 1) AS step,
         row_number() OVER (PARTITION BY event_id, least(delivery, 1) ORDER BY {_ORDER}) AS place
  FROM ({rows}))
WHERE place = 1
"""
