"""Typed schemas of the raw layer and of the exchange payloads.

The raw tables carry no surrogate id; their natural keys are listed in
``RAW_KEYS``.  Prices and quantities are ``decimal(18,8)`` (so that a price
times a quantity stays exact at ``decimal(37,16)``), volumes are
``decimal(28,8)``, epochs are Unix milliseconds in ``long``.
"""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(18, 8)
VOLUME = T.DecimalType(28, 8)


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


RAW_KLINES = _struct(
    ("symbol", T.StringType(), False),
    ("open_time", T.LongType(), True),
    ("open_price", PRICE, True),
    ("high_price", PRICE, True),
    ("low_price", PRICE, True),
    ("close_price", PRICE, True),
    ("volume", VOLUME, True),
    ("close_time", T.LongType(), True),
    ("quote_asset_volume", VOLUME, True),
    ("number_of_trades", T.IntegerType(), True),
    ("taker_buy_base_volume", VOLUME, True),
    ("taker_buy_quote_volume", VOLUME, True),
    ("extracted_at", T.TimestampNTZType(), True),
)

RAW_TRADES = _struct(
    ("symbol", T.StringType(), False),
    ("trade_id", T.LongType(), True),
    ("price", PRICE, True),
    ("quantity", PRICE, True),
    ("quote_qty", VOLUME, True),
    ("trade_time", T.LongType(), True),
    ("is_buyer_maker", T.BooleanType(), True),
    ("extracted_at", T.TimestampNTZType(), True),
)

RAW_TICKERS = _struct(
    ("symbol", T.StringType(), False),
    ("price_change", PRICE, True),
    ("price_change_pct", PRICE, True),
    ("weighted_avg_price", PRICE, True),
    ("prev_close_price", PRICE, True),
    ("last_price", PRICE, True),
    ("open_price", PRICE, True),
    ("high_price", PRICE, True),
    ("low_price", PRICE, True),
    ("volume", VOLUME, True),
    ("quote_volume", VOLUME, True),
    ("open_time", T.LongType(), True),
    ("close_time", T.LongType(), True),
    ("count", T.IntegerType(), True),
    ("extracted_at", T.TimestampNTZType(), True),
)

RAW_SCHEMAS = {"klines": RAW_KLINES, "trades": RAW_TRADES, "tickers": RAW_TICKERS}

# Natural (conflict) keys of the raw tables.
RAW_KEYS = {
    "klines": ("symbol", "open_time"),
    "trades": ("symbol", "trade_id"),
    "tickers": ("symbol", "open_time"),
}

# Exchange payload shapes (prices arrive as quoted strings).
# Candles: an array of positional arrays; positions 0-10 are used.
KLINE_POSITIONS = (
    # fixed values: position -> raw column, in payload order
    ("open_time", 0),
    ("open_price", 1),
    ("high_price", 2),
    ("low_price", 3),
    ("close_price", 4),
    ("volume", 5),
    ("close_time", 6),
    ("quote_asset_volume", 7),
    ("number_of_trades", 8),
    ("taker_buy_base_volume", 9),
    ("taker_buy_quote_volume", 10),
)

# Trades: an array of objects (payload field -> raw column).
TRADE_FIELDS = (
    # fixed values: payload field -> raw column
    ("id", "trade_id"),
    ("price", "price"),
    ("qty", "quantity"),
    ("quoteQty", "quote_qty"),
    ("time", "trade_time"),
    ("isBuyerMaker", "is_buyer_maker"),
)

# 24 h ticker: one object per symbol (payload field -> raw column).
TICKER_FIELDS = (
    # fixed values: payload field -> raw column
    ("symbol", "symbol"),
    ("priceChange", "price_change"),
    ("priceChangePercent", "price_change_pct"),
    ("weightedAvgPrice", "weighted_avg_price"),
    ("prevClosePrice", "prev_close_price"),
    ("lastPrice", "last_price"),
    ("openPrice", "open_price"),
    ("highPrice", "high_price"),
    ("lowPrice", "low_price"),
    ("volume", "volume"),
    ("quoteVolume", "quote_volume"),
    ("openTime", "open_time"),
    ("closeTime", "close_time"),
    ("count", "count"),
)

# Symbols tracked by the original job (used by the accepted-values test when
# no other list is given).
TRACKED_SYMBOLS = ("BTCUSDT", "ETHUSDT", "BNBUSDT")
