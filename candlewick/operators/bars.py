"""Candles and 24 h tickers built from a trade tape (batch).

Both are plain ``groupBy`` aggregations, so Spark combines map-side before the
shuffle: a hot symbol or a hot hour costs one partial row per map task, never
a single task holding the whole group.  Open and close prices are
``min_by`` / ``max_by`` over ``(trade_time, trade_id)`` (packed into one
decimal key, see ``trade_order_key``), a total order, so ties in time are
resolved the same way on every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.numeric import pct, ratio
from candlewick.functions.temporal import ms_to_ts_ntz
from candlewick.schemas import RAW_KLINES, RAW_TICKERS, VOLUME

HOUR_MS = 3_600_000
DAY_MS = 86_400_000


_ID_SPAN = 10**20  # > 2**64: room for every trade id after shifting it to >= 0


def trade_order_key(time_col: str = "trade_time", id_col: str = "trade_id") -> Column:
    """One ``decimal(38,0)`` that sorts like ``(trade_time, trade_id)`` with a
    NULL id last: ``time * 10^20 + (id + 2^63)``.

    A struct key would make ``min_by``/``max_by`` fall back to a sort-based
    aggregate (a struct buffer is not fixed-width); a decimal key keeps the
    bar aggregation hash-based with map-side combine.
    """
    def big(n: int) -> Column:
        return F.lit(str(n)).cast("decimal(38,0)")

    shifted = F.col(id_col).cast("decimal(38,0)") + big(2**63)
    id_part = F.coalesce(shifted, big(_ID_SPAN - 1))
    return F.col(time_col).cast("decimal(38,0)") * big(_ID_SPAN) + id_part


def _bar_aggregates(trades: DataFrame, bucket_ms: int) -> DataFrame:
    order = trade_order_key()
    taker = ~F.coalesce(F.col("is_buyer_maker"), F.lit(False))
    notional = F.col("price") * F.col("quantity")
    zero = F.lit(0).cast(VOLUME)
    open_time = F.col("trade_time") - F.pmod("trade_time", F.lit(bucket_ms))
    return (
        trades.where(F.col("trade_time").isNotNull())
        .groupBy("symbol", open_time.alias("open_time"))
        .agg(
            F.min_by("price", order).alias("open_price"),
            F.max("price").alias("high_price"),
            F.min("price").alias("low_price"),
            F.max_by("price", order).alias("close_price"),
            F.sum("quantity").alias("volume"),
            F.sum(notional).alias("quote_volume"),
            F.count(F.lit(1)).alias("trade_count"),
            F.sum(F.when(taker, F.col("quantity")).otherwise(zero)).alias("taker_base"),
            F.sum(F.when(taker, notional).otherwise(zero)).alias("taker_quote"),
        )
    )


def _typed(cols: dict, schema) -> list:
    return [cols[f.name].cast(f.dataType).alias(f.name) for f in schema.fields]


def candles_from_trades(trades: DataFrame, interval_ms: int = HOUR_MS) -> DataFrame:
    """OHLCV candles of ``interval_ms`` per symbol, in the raw-klines schema.

    ``extracted_at`` is the instant the candle closed, so re-deriving the same
    candle gives the same row.
    """
    c = F.col
    return _bar_aggregates(trades, interval_ms).select(
        _typed(
            {
                "symbol": c("symbol"),
                "open_time": c("open_time"),
                "open_price": c("open_price"),
                "high_price": c("high_price"),
                "low_price": c("low_price"),
                "close_price": c("close_price"),
                "volume": c("volume"),
                "close_time": c("open_time") + F.lit(interval_ms - 1),
                "quote_asset_volume": c("quote_volume"),
                "number_of_trades": c("trade_count"),
                "taker_buy_base_volume": c("taker_base"),
                "taker_buy_quote_volume": c("taker_quote"),
                "extracted_at": ms_to_ts_ntz(c("open_time") + F.lit(interval_ms)),
            },
            RAW_KLINES,
        )
    )


def ticker_rows(bars: DataFrame, window_ms: int, prev_close: Column) -> DataFrame:
    """Raw-tickers rows of the aggregates of windows."""
    c = F.col
    change = c("close_price") - c("open_price")
    return bars.select(
        _typed(
            {
                "symbol": c("symbol"),
                "price_change": change,
                "price_change_pct": F.round(pct(change, "open_price").cast("decimal(38,10)"), 3),
                "weighted_avg_price": F.round(ratio("quote_volume", "volume").cast("decimal(38,10)"), 8),
                "prev_close_price": prev_close,
                "last_price": c("close_price"),
                "open_price": c("open_price"),
                "high_price": c("high_price"),
                "low_price": c("low_price"),
                "volume": c("volume"),
                "quote_volume": c("quote_volume"),
                "open_time": c("open_time"),
                "close_time": c("open_time") + F.lit(window_ms),
                "count": c("trade_count"),
                "extracted_at": ms_to_ts_ntz(c("open_time") + F.lit(window_ms)),
            },
            RAW_TICKERS,
        )
    )


def tickers_from_trades(trades: DataFrame, window_ms: int = DAY_MS) -> DataFrame:
    """One 24 h ticker snapshot per symbol and day, in the raw-tickers schema.

    ``prev_close_price`` is the last price of the symbol's previous snapshot;
    that window runs over the aggregated snapshots (symbols x days rows).
    """
    prev = Window.partitionBy("symbol").orderBy("open_time")
    return ticker_rows(_bar_aggregates(trades, window_ms), window_ms, F.lag("close_price").over(prev))


def with_prev_close(tickers: DataFrame, window_ms: int = DAY_MS) -> DataFrame:
    """Snapshots of sliding windows with ``prev_close_price``: the last price of the
    symbol's newest earlier snapshot that ends where this one begins, or whole windows
    before that (NULL: none)."""
    phase = F.pmod("open_time", F.lit(window_ms))
    prev = Window.partitionBy("symbol", phase).orderBy("open_time")
    return tickers.withColumn("prev_close_price", F.lag("last_price").over(prev))
