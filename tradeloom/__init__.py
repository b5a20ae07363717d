"""Trade-tick analytics on Spark: raw trades to clean trades to candles, VWAP, flow and alerts."""
