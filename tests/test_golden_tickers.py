"""Golden check on the one landed sample of the original job: three 24 h
tickers, read from a JSON array file, through staging and the dimension."""

from __future__ import annotations

import datetime as dt
import os

from candlewick.operators import marts, metrics, staging
from candlewick.schemas import RAW_KLINES, RAW_TRADES
from candlewick.sources.landing import read_landing

# fixed values: the landed ticker sample (prices as text, times in ms)
SAMPLE = """[
 {"symbol": "BTCUSDT", "price_change": "2119.02000000", "price_change_pct": "2.916",
  "weighted_avg_price": "74122.35778088", "prev_close_price": "72658.21000000",
  "last_price": "74777.22000000", "open_price": "72658.20000000", "high_price": "76000.00000000",
  "low_price": "72658.20000000", "volume": "32053.13579000", "quote_volume": "2375853999.02562520",
  "open_time": 1773631379001, "close_time": 1773717779001, "count": 5929223,
  "extracted_at": "2026-03-17T03:22:59.560273"},
 {"symbol": "ETHUSDT", "price_change": "143.62000000", "price_change_pct": "6.550",
  "weighted_avg_price": "2298.20747031", "prev_close_price": "2192.69000000",
  "last_price": "2336.31000000", "open_price": "2192.69000000", "high_price": "2386.02000000",
  "low_price": "2192.46000000", "volume": "928913.52470000", "quote_volume": "2134836001.73430300",
  "open_time": 1773631379014, "close_time": 1773717779014, "count": 7920136,
  "extracted_at": "2026-03-17T03:22:59.868976"},
 {"symbol": "BNBUSDT", "price_change": "4.60000000", "price_change_pct": "0.682",
  "weighted_avg_price": "679.47517957", "prev_close_price": "674.85000000",
  "last_price": "679.45000000", "open_price": "674.85000000", "high_price": "687.82000000",
  "low_price": "670.13000000", "volume": "244702.81600000", "quote_volume": "166269489.84320000",
  "open_time": 1773631379105, "close_time": 1773717779105, "count": 1914744,
  "extracted_at": "2026-03-17T03:23:00.237357"}
]"""


def _tickers(spark, scratch):
    path = os.path.join(scratch, "tickers.json")
    with open(path, "w") as f:
        f.write(SAMPLE)
    return read_landing(spark, path, "tickers", multiline=True)


def test_spread_sentiment_and_assets(spark, scratch):
    stg = staging.stg_tickers(_tickers(spark, scratch))
    empty_klines = spark.createDataFrame([], RAW_KLINES)
    dim = marts.dim_symbols(stg, staging.stg_klines(empty_klines), as_of="2026-03-17 04:00:00")
    got = {r.symbol: r for r in dim.collect()}
    assert {s: got[s].price_spread_pct for s in got} == {"BTCUSDT": 4.5993, "ETHUSDT": 8.8275, "BNBUSDT": 2.6213}
    assert {s: got[s].market_sentiment for s in got} == {
        "BTCUSDT": "bullish", "ETHUSDT": "strongly_bullish", "BNBUSDT": "neutral"}
    assert {s: (got[s].base_asset, got[s].quote_asset) for s in got} == {
        "BTCUSDT": ("BTC", "USDT"), "ETHUSDT": ("ETH", "USDT"), "BNBUSDT": ("BNB", "USDT")}
    # a ticker without candles is kept with empty history
    assert all(got[s].total_candles is None for s in got)


def test_period_start_utc(spark, scratch):
    stg = staging.stg_tickers(_tickers(spark, scratch))
    starts = {r.symbol: r.period_start for r in stg.collect()}
    assert starts["BTCUSDT"] == dt.datetime(2026, 3, 16, 3, 22, 59, 1000)
    assert starts["BNBUSDT"] == dt.datetime(2026, 3, 16, 3, 22, 59, 105000)


def test_momentum_rank(spark, scratch):
    stg = staging.stg_tickers(_tickers(spark, scratch))
    trades = spark.createDataFrame(
        [(s, 1, None, None, None, 0, False, None) for s in ("BTCUSDT", "ETHUSDT", "BNBUSDT")], RAW_TRADES
    )
    sv = metrics.symbol_volume(staging.stg_trades(trades), stg)
    assert {r.symbol: r.momentum_rank for r in sv.collect()} == {"ETHUSDT": 1, "BTCUSDT": 2, "BNBUSDT": 3}
