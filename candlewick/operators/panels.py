"""Dashboard read-side queries over the marts (one function per panel).

They read the materialised marts, so filters on ``trade_date`` / ``symbol``
prune partitions and row groups; rankings run over already aggregated rows
(one per symbol, or per symbol and day).
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def data_freshness(raw_klines: DataFrame, raw_trades: DataFrame, raw_tickers: DataFrame) -> DataFrame:
    """Per raw table: row count and newest extraction stamp."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count"), F.max("extracted_at").alias("last_extracted_at"))
        .select(F.lit(name).alias("table_name"), "row_count", "last_extracted_at")
        for name, df in (("raw_klines", raw_klines), ("raw_trades", raw_trades), ("raw_tickers", raw_tickers))
    ]
    return functools.reduce(DataFrame.unionByName, parts)


def rolling_trend(daily: DataFrame) -> DataFrame:
    """Daily average price and its 7-day rolling average per symbol."""
    return daily.select("trade_date", "symbol", "daily_avg_price", "rolling_7d_avg_price")


def daily_volatility(daily: DataFrame) -> DataFrame:
    """Daily volatility % per symbol and the day's most volatile pair."""
    w = Window.partitionBy("trade_date").orderBy(F.col("daily_volatility_pct").desc_nulls_last())
    return daily.select(
        "trade_date",
        "symbol",
        "daily_volatility_pct",
        (F.rank().over(w) == 1).alias("is_most_volatile"),
    )


def volume_by_symbol(symbol_volume: DataFrame) -> DataFrame:
    """Traded value per symbol, highest first (rank 1 = highest)."""
    return symbol_volume.select("symbol", "total_trades", "total_volume_usdt", "volume_dominance_pct", "volume_rank")


def moving_averages(fct_candles: DataFrame, symbol: str) -> DataFrame:
    """Close price with MA 7/14/30 overlay for one symbol."""
    return fct_candles.where(F.col("symbol") == symbol).select(
        "opened_at", "symbol", "close_price", "ma_7", "ma_14", "ma_30", "ma_signal"
    )


def price_history(fct_candles: DataFrame, days: int = 7, as_of=None) -> DataFrame:
    """Close prices of the last ``days`` days up to ``as_of`` (default: the
    newest candle date, as a scalar subquery evaluated once)."""
    if as_of is None:
        newest = fct_candles.select(F.max("trade_date")).scalar()
    else:
        newest = F.lit(as_of).cast("date")
    start = F.date_sub(newest, days - 1)
    return fct_candles.where((F.col("trade_date") >= start) & (F.col("trade_date") <= newest)).select(
        "opened_at", "trade_date", "symbol", "close_price"
    )


def sentiment(dim_symbols: DataFrame) -> DataFrame:
    """Market sentiment table, graded and ordered by 24 h change (largest gain first;
    one row per symbol, so the sort is small)."""
    rows = dim_symbols.select("symbol", "current_price", "price_change_pct", "market_sentiment")
    return rows.orderBy(F.col("price_change_pct").desc_nulls_last(), "symbol")


def daily_moves(daily: DataFrame) -> DataFrame:
    """Daily average price and return; the day's largest absolute move."""
    w = Window.partitionBy("trade_date").orderBy(F.abs("daily_return_pct").desc_nulls_last())
    return daily.select(
        "trade_date",
        "symbol",
        "daily_avg_price",
        "daily_return_pct",
        (F.rank().over(w) == 1).alias("is_largest_move"),
    )


def volume_spikes(fct_candles: DataFrame) -> DataFrame:
    """Candles whose volume is elevated or a spike against the last 7."""
    return fct_candles.where(F.col("volume_signal") != "normal_volume").select(
        "opened_at", "symbol", "volume", "avg_volume_7", "volume_ratio", "volume_signal"
    )


def buy_sell_pressure(symbol_volume: DataFrame) -> DataFrame:
    """Buy versus sell pressure per coin."""
    return symbol_volume.select(
        "symbol", "buy_trades", "sell_trades", "buy_pressure_pct", "buy_volume_usdt", "sell_volume_usdt"
    )
