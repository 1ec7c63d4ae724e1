"""Mart models: candle and trade facts, the symbol dimension, and the daily
market summary in two grains."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions import classify
from candlewick.functions.numeric import pct, ratio, rounded
from candlewick.functions.temporal import base_asset, day_name, quote_asset, trade_date, trade_hour
from candlewick.operators.staging import latest_ticker

RELATIVE_SIZE_ROWS = 10  # fixed value: the current trade and the nine before it
ROLLING_DAYS = 7  # fixed value: rows in the rolling average of the daily mart

FCT_CANDLE_COLUMNS = (
    "kline_id", "symbol", "opened_at", "closed_at", "trade_date", "trade_hour",
    "day_of_week", "open_price", "high_price", "low_price", "close_price", "volume",
    "number_of_trades", "price_range", "candle_direction", "body_pct_of_range",
    "prev_close_price", "pct_return", "move_category", "ma_7", "ma_14", "ma_30",
    "ma_signal", "avg_volume_7", "volume_ratio", "volume_signal", "price_rank",
    "volatility_7",
)


def fct_candles(price_metrics: DataFrame) -> DataFrame:
    """One row per candle with calendar parts and classified signals.

    ``volatility_7`` is carried as the last column: the daily mart needs it.
    """
    return price_metrics.select(
        "kline_id",
        "symbol",
        "opened_at",
        "closed_at",
        trade_date("opened_at").alias("trade_date"),
        trade_hour("opened_at").alias("trade_hour"),
        day_name("opened_at").alias("day_of_week"),
        "open_price",
        "high_price",
        "low_price",
        "close_price",
        "volume",
        "number_of_trades",
        "price_range",
        "candle_direction",
        "body_pct_of_range",
        "prev_close_price",
        "pct_return",
        classify.move_category("pct_return").alias("move_category"),
        "ma_7",
        "ma_14",
        "ma_30",
        classify.ma_signal("ma_7", "ma_14").alias("ma_signal"),
        "avg_volume_7",
        "volume_ratio",
        classify.volume_signal("volume_ratio").alias("volume_signal"),
        "price_rank",
        "volatility_7",
    )


FCT_TRADE_COLUMNS = (
    "trade_key", "symbol", "trade_id", "traded_at", "trade_date", "trade_hour",
    "quantity", "quote_qty", "trade_value_usdt", "trade_direction",
    "trade_size_category", "relative_size", "cumulative_volume_usdt",
)


def trade_fact_columns() -> list:
    """Row-local columns of the trade fact (no window)."""
    return [
        F.col("trade_key"),
        F.col("symbol"),
        F.col("trade_id"),
        F.col("traded_at"),
        trade_date("traded_at").alias("trade_date"),
        trade_hour("traded_at").alias("trade_hour"),
        F.col("quantity"),
        F.col("quote_qty"),
        F.col("trade_value_usdt"),
        F.col("trade_direction"),
        classify.trade_size_category("trade_value_usdt").alias("trade_size_category"),
    ]


def fct_trades(
    stg_trades: DataFrame,
    method: str = "blocked",
    block_rows: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Trades with size class, size relative to the last ten trades of the
    symbol, and the symbol's running traded value.

    Trades are ordered by ``(traded_at, trade_id)``: several trades can share
    a millisecond, and the id makes the row frames deterministic.

    ``method="blocked"`` (default) splits each symbol's history into blocks
    of ``block_rows`` rows (``operators.scaled``), so no task holds a whole
    symbol; ``method="plain"`` runs one window partition per symbol, which is
    simpler and fine while a symbol's history fits one task.  Both give the
    same rows and values.

    The trailing average feeds a double ratio, so it is averaged in double:
    a ``decimal(37,16)`` average would cost ten BigDecimal additions and a
    division per trade.
    """
    if method == "blocked":
        from candlewick.operators import scaled

        kwargs = {k: v for k, v in (("block_rows", block_rows), ("partitions", partitions)) if v is not None}
        return scaled.fct_trades_scaled(stg_trades, **kwargs)
    if method != "plain":
        raise ValueError(f"unknown method {method!r}")
    return stg_trades.select(*trade_fact_columns(), *trade_window_columns())


def trade_window_columns() -> list:
    """``relative_size`` and ``cumulative_volume_usdt`` as one window per
    symbol (the plain form)."""
    w = Window.partitionBy("symbol").orderBy(F.col("traded_at").asc_nulls_last(), F.col("trade_id").asc_nulls_last())
    recent = F.avg(F.col("trade_value_usdt").cast("double")).over(w.rowsBetween(-(RELATIVE_SIZE_ROWS - 1), 0))
    running = F.sum("trade_value_usdt").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return [
        rounded(ratio("trade_value_usdt", recent), 4).alias("relative_size"),
        running.alias("cumulative_volume_usdt"),
    ]


def candle_stats(stg_klines: DataFrame) -> DataFrame:
    """Per-symbol span, count and close prices of all candles."""
    return stg_klines.groupBy("symbol").agg(
        F.min("opened_at").alias("first_seen_at"),
        F.max("opened_at").alias("last_seen_at"),
        F.count(F.lit(1)).alias("total_candles"),
        F.round(F.min("close_price"), 4).alias("historical_low"),
        F.round(F.max("close_price"), 4).alias("historical_high"),
        rounded(F.avg("close_price"), 4).alias("avg_close_price"),
    )


def dim_symbols(
    stg_tickers: DataFrame,
    stg_klines: DataFrame,
    as_of: _dt.datetime | str | None = None,
    all_snapshots: bool = False,
) -> DataFrame:
    """One row per trading pair: current 24 h state, sentiment and candle
    history.  ``as_of`` fixes ``last_updated_at`` (default: the current time).
    """
    return dim_of_stats(stg_tickers, candle_stats(stg_klines), as_of, all_snapshots)


def dim_of_stats(
    stg_tickers: DataFrame,
    stats: DataFrame,
    as_of: _dt.datetime | str | None = None,
    all_snapshots: bool = False,
) -> DataFrame:
    """``dim_symbols`` from candle statistics, computed or merged from partials."""
    tickers = stg_tickers if all_snapshots else latest_ticker(stg_tickers)
    if as_of is None:
        stamp = F.current_timestamp()
    else:
        text = as_of.isoformat(sep=" ") if isinstance(as_of, _dt.datetime) else str(as_of)
        stamp = F.lit(text).cast("timestamp")  # read in the session zone (UTC)
    t = tickers.alias("t")
    return t.join(stats.alias("k"), "symbol", "left").select(
        "symbol",
        base_asset("symbol").alias("base_asset"),
        quote_asset("symbol").alias("quote_asset"),
        F.col("t.last_price").alias("current_price"),
        "t.price_change",
        "t.price_change_pct",
        F.col("t.high_price").alias("daily_high"),
        F.col("t.low_price").alias("daily_low"),
        F.col("t.volume").alias("daily_volume"),
        F.col("t.quote_volume").alias("daily_quote_volume"),
        F.col("t.trade_count").alias("daily_trade_count"),
        "t.price_spread_pct",
        classify.market_sentiment("t.price_change_pct").alias("market_sentiment"),
        "k.first_seen_at",
        "k.last_seen_at",
        "k.total_candles",
        "k.historical_low",
        "k.historical_high",
        "k.avg_close_price",
        rounded(pct(F.col("t.last_price") - F.col("k.historical_high"), "k.historical_high"), 2).alias("pct_from_high"),
        stamp.alias("last_updated_at"),
    )


DAILY_COLUMNS = (
    "trade_date", "symbol", "daily_low", "daily_high", "daily_avg_price", "daily_open",
    "daily_close", "daily_volume", "daily_trades", "total_candles",
    "daily_volatility_pct", "avg_intraday_volatility", "bullish_candles",
    "bearish_candles", "volume_spikes", "elevated_volume_candles",
    "golden_cross_hours", "death_cross_hours", "avg_ma_7", "avg_ma_14", "avg_ma_30",
    "daily_return_pct", "rolling_7d_avg_price", "volume_change_pct",
)


def _daily_aggregates() -> list:
    """Aggregates of one day of candles (shared by both grains)."""
    return [
        F.round(F.min("low_price"), 4).alias("daily_low"),
        F.round(F.max("high_price"), 4).alias("daily_high"),
        rounded(F.avg("close_price"), 4).alias("daily_avg_price"),
        F.round(F.sum("volume"), 4).alias("daily_volume"),
        F.sum("number_of_trades").alias("daily_trades"),
        F.count(F.lit(1)).alias("total_candles"),
        rounded(pct(F.max("high_price") - F.min("low_price"), F.min("low_price")), 4).alias("daily_volatility_pct"),
        rounded(F.avg("volatility_7"), 4).alias("avg_intraday_volatility"),
        F.count_if(F.col("candle_direction") == classify.BULLISH).alias("bullish_candles"),
        F.count_if(F.col("candle_direction") == classify.BEARISH).alias("bearish_candles"),
        F.count_if(F.col("volume_signal") == "high_volume_spike").alias("volume_spikes"),
        F.count_if(F.col("volume_signal") == "elevated_volume").alias("elevated_volume_candles"),
        F.count_if(F.col("ma_signal") == classify.GOLDEN).alias("golden_cross_hours"),
        F.count_if(F.col("ma_signal") == classify.DEATH).alias("death_cross_hours"),
        rounded(F.avg("ma_7"), 4).alias("avg_ma_7"),
        rounded(F.avg("ma_14"), 4).alias("avg_ma_14"),
        rounded(F.avg("ma_30"), 4).alias("avg_ma_30"),
    ]


def _trend_columns(w: Window) -> list:
    prev_volume = F.lag("daily_volume").over(w)
    return [
        rounded(pct(F.col("daily_close") - F.col("daily_open"), "daily_open"), 4).alias("daily_return_pct"),
        rounded(F.avg("daily_avg_price").over(w.rowsBetween(-(ROLLING_DAYS - 1), 0)), 4).alias("rolling_7d_avg_price"),
        rounded(pct(F.col("daily_volume") - prev_volume, prev_volume), 2).alias("volume_change_pct"),
    ]


def daily_aggregates(fct_candles: DataFrame) -> DataFrame:
    """Per (trade_date, symbol) aggregates of the day's candles, without the
    trend columns.  Open and close are the first open and last close of the
    day (``min_by`` / ``max_by`` on ``opened_at``): one aggregation with
    map-side combine."""
    return fct_candles.groupBy("trade_date", "symbol").agg(
        *_daily_aggregates(),
        F.min_by("open_price", "opened_at").alias("daily_open"),
        F.max_by("close_price", "opened_at").alias("daily_close"),
    )


def with_daily_trends(daily: DataFrame) -> DataFrame:
    """Add return, 7-row rolling average and volume change per symbol over
    days (one row per day, so the window partitions are small)."""
    w = Window.partitionBy("symbol").orderBy(F.col("trade_date").asc_nulls_last())
    return daily.select(*DAILY_COLUMNS[:-3], *_trend_columns(w))


def daily_summary(fct_candles: DataFrame, sort: bool = True) -> DataFrame:
    """One row per (trade_date, symbol): the documented daily grain."""
    out = with_daily_trends(daily_aggregates(fct_candles))
    return out.orderBy(F.col("trade_date").desc_nulls_first(), F.col("symbol").asc_nulls_last()) if sort else out


def daily_summary_candle_grain(fct_candles: DataFrame, sort: bool = True) -> DataFrame:
    """The original model as written: grouped by day, symbol *and* candle
    (``opened_at, open_price, close_price``), so every row is one candle.

    ``daily_open`` / ``daily_close`` are first/last values over the day's
    candles; the rolling average and volume change run per symbol over
    candles ordered by ``(trade_date, opened_at)`` (the open time breaks the
    ties the original leaves open).  ``distinct`` runs after the windows.
    """
    grouped = fct_candles.groupBy("trade_date", "symbol", "opened_at", "open_price", "close_price").agg(
        *_daily_aggregates()
    )
    day = Window.partitionBy("trade_date", "symbol").orderBy(F.col("opened_at").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    daily = grouped.select(
        "*",
        F.first("open_price").over(day).alias("daily_open"),
        F.last("close_price").over(day).alias("daily_close"),
    )
    w = Window.partitionBy("symbol").orderBy(F.col("trade_date").asc_nulls_last(), F.col("opened_at").asc_nulls_last())
    out = daily.select(*DAILY_COLUMNS[:-3], *_trend_columns(w)).distinct()
    return out.orderBy(F.col("trade_date").desc_nulls_first(), F.col("symbol").asc_nulls_last()) if sort else out
