"""Mergeable partial aggregates per symbol and day.

The trade summary and the candle statistics of the symbol dimension cover all
history, but each is a merge of its days: exact sums, counts, minima and maxima.
A refresh replaces the partials of the days it touches and merges one row per
symbol and day, instead of reading every trade and candle again.

Sums stay exact decimals and averages are divided once, after the merge.  Trades
without a time are the partials of the day NULL; symbols may be NULL too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.numeric import pct, rounded
from candlewick.functions.temporal import trade_date


def _average(total, wide: str, count) -> Column:
    """Exact decimal average of merged sums and counts (NULL without values)."""
    return total.cast(wide) / F.nullif(count, F.lit(0))


def trade_partials(trades: DataFrame) -> DataFrame:
    """Partials of staged trades: one row per symbol and ``trade_date``."""
    value = F.col("trade_value_usdt")
    is_buy, is_sell = (F.col("trade_direction") == side for side in ("buy", "sell"))
    zero = F.lit(0).cast("decimal(37,16)")
    return trades.groupBy("symbol", trade_date("traded_at").alias("trade_date")).agg(
        F.count(F.lit(1)).alias("trades"),
        F.count(value).alias("valued"),
        F.sum(value).alias("value_sum"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.count_if(is_buy).alias("buys"),
        F.count_if(is_sell).alias("sells"),
        F.sum(F.when(is_buy, value).otherwise(zero)).alias("buy_value"),
        F.sum(F.when(is_sell, value).otherwise(zero)).alias("sell_value"),
    )


def merged_trade_summary(partials: DataFrame) -> DataFrame:
    """``metrics.trade_summary`` of the trades behind ``trade_partials``."""
    total = F.sum("value_sum")
    return partials.groupBy("symbol").agg(
        F.sum("trades").alias("total_trades"),
        F.round(total, 2).alias("total_volume_usdt"),
        rounded(_average(total, "decimal(38,16)", F.sum("valued")), 4).alias("avg_trade_value_usdt"),
        F.round(F.min("min_price"), 4).alias("min_trade_price"),
        F.round(F.max("max_price"), 4).alias("max_trade_price"),
        F.sum("buys").alias("buy_trades"),
        F.sum("sells").alias("sell_trades"),
        rounded(pct(F.sum("buys"), F.sum("trades")), 2).alias("buy_pressure_pct"),
        F.sum("buy_value").alias("buy_volume_usdt"),
        F.sum("sell_value").alias("sell_volume_usdt"),
    )


def candle_partials(candles: DataFrame) -> DataFrame:
    """Partials of staged candles: one row per symbol and ``trade_date``."""
    close = F.col("close_price")
    return candles.groupBy("symbol", trade_date("opened_at").alias("trade_date")).agg(
        F.min("opened_at").alias("first_seen"),
        F.max("opened_at").alias("last_seen"),
        F.count(F.lit(1)).alias("candles"),
        F.count(close).alias("closes"),
        F.sum(close).alias("close_sum"),
        F.min(close).alias("low_close"),
        F.max(close).alias("high_close"),
    )


def merged_candle_stats(partials: DataFrame) -> DataFrame:
    """``marts.candle_stats`` of the candles behind ``candle_partials``."""
    return partials.groupBy("symbol").agg(
        F.min("first_seen").alias("first_seen_at"),
        F.max("last_seen").alias("last_seen_at"),
        F.sum("candles").alias("total_candles"),
        F.round(F.min("low_close"), 4).alias("historical_low"),
        F.round(F.max("high_close"), 4).alias("historical_high"),
        rounded(_average(F.sum("close_sum"), "decimal(28,8)", F.sum("closes")), 4).alias("avg_close_price"),
    )
