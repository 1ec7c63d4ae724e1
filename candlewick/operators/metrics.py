"""Intermediate models: per-candle price metrics and per-symbol trade flow."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.numeric import pct, ratio, rounded
from candlewick.operators.staging import latest_ticker

# fixed values: moving-window lengths in rows (candles)
MA_FAST, MA_MID, MA_SLOW = 7, 14, 30
VOLATILITY_ROWS = 7
VOLUME_ROWS = 7


def _trailing(w: Window, rows: int) -> Window:
    return w.rowsBetween(-(rows - 1), Window.currentRow)


def price_metric_columns(w: Window) -> list:
    """Per-symbol window columns of the price-metrics model over ``w``
    (partitioned by the series and ordered by ``opened_at``)."""
    prev_close = F.lag("close_price").over(w)
    avg_volume = F.avg("volume").over(_trailing(w, VOLUME_ROWS))
    return [
        prev_close.alias("prev_close_price"),
        rounded(pct(F.col("close_price") - prev_close, prev_close), 4).alias("pct_return"),
        rounded(F.avg("close_price").over(_trailing(w, MA_FAST)), 4).alias("ma_7"),
        rounded(F.avg("close_price").over(_trailing(w, MA_MID)), 4).alias("ma_14"),
        rounded(F.avg("close_price").over(_trailing(w, MA_SLOW)), 4).alias("ma_30"),
        rounded(F.stddev_samp("close_price").over(_trailing(w, VOLATILITY_ROWS)), 4).alias("volatility_7"),
        rounded(avg_volume, 4).alias("avg_volume_7"),
        rounded(ratio("volume", avg_volume), 4).alias("volume_ratio"),
    ]


PRICE_METRIC_COLUMNS = (
    "kline_id", "symbol", "opened_at", "closed_at", "open_price", "high_price",
    "low_price", "close_price", "volume", "number_of_trades", "candle_direction",
    "price_range", "prev_close_price", "pct_return", "ma_7", "ma_14", "ma_30",
    "volatility_7", "avg_volume_7", "volume_ratio", "body_pct_of_range", "price_rank",
)


def price_rank() -> "F.Column":
    """Rank of each symbol's close within the same candle open time
    (highest close = 1; a NULL close ranks first)."""
    w = Window.partitionBy("opened_at").orderBy(F.col("close_price").desc_nulls_first())
    return F.rank().over(w).alias("price_rank")


def with_price_rank(df: DataFrame) -> DataFrame:
    """``df`` in the model's column order with ``price_rank`` added."""
    return df.select(*[c for c in PRICE_METRIC_COLUMNS if c != "price_rank"], price_rank())


def price_metrics(stg_klines: DataFrame) -> DataFrame:
    """Returns, moving averages, volatility and volume ratios per candle.

    All per-symbol windows share one partitioning and ordering, so Spark runs
    them in a single Window node after one shuffle; the cross-symbol rank
    adds a second shuffle on ``opened_at``.
    """
    w = Window.partitionBy("symbol").orderBy(F.col("opened_at").asc_nulls_last())
    out = stg_klines.select(
        "kline_id", "symbol", "opened_at", "closed_at", "open_price", "high_price",
        "low_price", "close_price", "volume", "number_of_trades", "candle_direction",
        "price_range",
        *price_metric_columns(w),
        rounded(pct(F.abs(F.col("close_price") - F.col("open_price")), "price_range"), 4).alias("body_pct_of_range"),
    )
    return with_price_rank(out)


def trade_summary(stg_trades: DataFrame) -> DataFrame:
    """Per-symbol trade counts, values and buy/sell split (partial + final
    aggregation: one partial row per symbol per map task)."""
    value = F.col("trade_value_usdt")
    is_buy = F.col("trade_direction") == "buy"
    is_sell = F.col("trade_direction") == "sell"
    zero = F.lit(0).cast("decimal(37,16)")
    return stg_trades.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("total_trades"),
        F.round(F.sum(value), 2).alias("total_volume_usdt"),
        rounded(F.avg(value), 4).alias("avg_trade_value_usdt"),
        F.round(F.min("price"), 4).alias("min_trade_price"),
        F.round(F.max("price"), 4).alias("max_trade_price"),
        F.count_if(is_buy).alias("buy_trades"),
        F.count_if(is_sell).alias("sell_trades"),
        rounded(pct(F.count_if(is_buy), F.count(F.lit(1))), 2).alias("buy_pressure_pct"),
        F.sum(F.when(is_buy, value).otherwise(zero)).alias("buy_volume_usdt"),
        F.sum(F.when(is_sell, value).otherwise(zero)).alias("sell_volume_usdt"),
    )


def symbol_volume(stg_trades: DataFrame, stg_tickers: DataFrame, all_snapshots: bool = False) -> DataFrame:
    """Trade flow per symbol with 24 h ticker context and market ranks.

    By default the newest ticker snapshot per symbol is joined; with
    ``all_snapshots=True`` every snapshot is joined, as the original model
    does, which repeats a symbol once per snapshot.

    The dominance share and both ranks run over the whole aggregated result.
    That is one row per symbol by default; with all snapshots, whose number
    grows with time, they come from counts (``snapshot_ranks``), not from a
    window over all rows.
    """
    return volume_of_summary(trade_summary(stg_trades), stg_tickers, all_snapshots)


def volume_of_summary(ts: DataFrame, stg_tickers: DataFrame, all_snapshots: bool = False) -> DataFrame:
    """``symbol_volume`` from trade summaries, computed or merged from partials."""
    tickers = stg_tickers if all_snapshots else latest_ticker(stg_tickers)
    tk = tickers.select(
        "symbol",
        "last_price",
        "price_change",
        "price_change_pct",
        F.col("high_price").alias("daily_high"),
        F.col("low_price").alias("daily_low"),
        F.col("volume").alias("daily_volume"),
        F.col("quote_volume").alias("daily_quote_volume"),
        F.col("trade_count").alias("daily_trade_count"),
        "price_spread_pct",
    )
    if all_snapshots:
        return snapshot_ranks(ts, tk)
    everything = Window.partitionBy()
    joined = ts.join(tk, "symbol", "left")
    return joined.select(
        "*",
        rounded(pct("total_volume_usdt", F.sum("total_volume_usdt").over(everything)), 2).alias("volume_dominance_pct"),
        F.rank().over(Window.orderBy(F.col("total_volume_usdt").desc_nulls_first())).alias("volume_rank"),
        F.rank().over(Window.orderBy(F.col("price_change_pct").desc_nulls_first())).alias("momentum_rank"),
    )


#: Tell snapshots of one change apart, so that a frequent change spreads over tasks.
SNAPSHOT_TIES = ("symbol", "last_price", "daily_volume", "daily_quote_volume", "daily_trade_count")


def snapshot_ranks(ts: DataFrame, tk: DataFrame) -> DataFrame:
    """Trade summaries with every snapshot of their symbol, and the shares and ranks
    that windows over all these rows would give.

    Total and volume rank follow from the summaries, each weighted by its number
    of snapshots (a window over one row per symbol).  The momentum rank comes from
    places in ranges taken from the data (``scaled.with_rank``), so it does not matter
    how close together the changes lie.  Building the frame writes the joined rows once.
    """
    from candlewick.operators.scaled import with_rank  # scaled builds on this module

    weight = tk.groupBy("symbol").agg(F.count(F.lit(1)).alias("_w"))
    rows = ts.join(weight, "symbol", "left").withColumn("_w", F.coalesce("_w", F.lit(1)))
    down = Window.orderBy(F.col("total_volume_usdt").desc_nulls_first())
    upto = F.sum("_w").over(down.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    peers = F.sum("_w").over(Window.partitionBy("total_volume_usdt"))
    total = F.sum(F.col("total_volume_usdt") * F.col("_w")).over(Window.partitionBy())
    shares = rows.select(
        *ts.columns,
        rounded(pct("total_volume_usdt", total), 2).alias("volume_dominance_pct"),
        (upto - peers + 1).cast("int").alias("volume_rank"),
    )
    joined = shares.join(tk, "symbol", "left")
    ranked = with_rank(joined, "price_change_pct", SNAPSHOT_TIES, "momentum_rank")
    return ranked.select(
        *ts.columns, *[c for c in tk.columns if c != "symbol"], "volume_dominance_pct", "volume_rank", "momentum_rank")
