"""candlewick: market-data models (candles, trades, tickers) as Spark jobs."""

__version__ = "0.1.0"
