"""Candles from a trade stream (event-time windows with a watermark).

The streaming twin of ``operators.bars.candles_from_trades``: trades are
grouped by symbol and a tumbling event-time window; a window's candle is
emitted once the watermark (newest trade time minus the allowed lateness)
has passed its end, and trades arriving later than that are dropped by the
watermark: use it for live displays only.  Emitted candles equal the batch
candles of the same trades.

``update_candles`` loses nothing: a batch of trades is appended to the raw
table (first write wins), and the candles of the days that it touches are
computed again from all raw trades of those days; the scan is filtered by their
span of trade times, which skips row groups of other times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.operators.bars import candles_from_trades, ticker_rows, trade_order_key
from candlewick.operators.ingest import append_idempotent, partition_value, read_raw_table, touched
from candlewick.schemas import RAW_KLINES, VOLUME

HOUR_MS = 3_600_000
DAY_MS = 24 * HOUR_MS


def stream_candles(trades: DataFrame, interval: str = "1 hour", lateness: str = "10 minutes") -> DataFrame:
    """Raw-klines rows from a (streaming) raw-trades DataFrame."""
    order = trade_order_key()
    taker = ~F.coalesce(F.col("is_buyer_maker"), F.lit(False))
    notional = F.col("price") * F.col("quantity")
    zero = F.lit(0).cast(VOLUME)
    timed = trades.where(F.col("trade_time").isNotNull()).withColumn("_ts", F.timestamp_millis("trade_time"))
    bars = (
        timed.withWatermark("_ts", lateness)
        .groupBy("symbol", F.window("_ts", interval).alias("w"))
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
    open_ms = F.unix_millis(F.col("w.start"))
    out = bars.select(
        "symbol",
        open_ms.alias("open_time"),
        "open_price",
        "high_price",
        "low_price",
        "close_price",
        F.col("volume").cast(VOLUME).alias("volume"),
        (F.unix_millis(F.col("w.end")) - 1).alias("close_time"),
        F.col("quote_volume").cast(VOLUME).alias("quote_asset_volume"),
        F.col("trade_count").cast("int").alias("number_of_trades"),
        F.col("taker_base").cast(VOLUME).alias("taker_buy_base_volume"),
        F.col("taker_quote").cast(VOLUME).alias("taker_buy_quote_volume"),
        F.col("w.end").cast("timestamp_ntz").alias("extracted_at"),
    )
    return out.select([F.col(f.name).cast(f.dataType) for f in RAW_KLINES.fields])


def stream_tickers(trades: DataFrame, hours: int = 24, lateness: str = "10 minutes") -> DataFrame:
    """Raw-tickers rows of the ``hours`` up to each full hour, from a (streaming or batch)
    raw-trades DataFrame.

    Two aggregations in a row: trades to partials per symbol and hour, then partials to
    windows that slide by an hour, so the copies for overlapping windows are of partials,
    not of trades, and the state is a few hours and ``hours`` windows per symbol.  A
    window is emitted once the watermark has passed its end; later trades are dropped.
    A symbol without a trade in a window has no row for it; trades without a time have
    none either.  ``prev_close_price`` is NULL, as it may lie any time back:
    ``bars.with_prev_close`` fills it in the written snapshots.
    """
    order, notional = trade_order_key(), F.col("price") * F.col("quantity")
    timed = trades.where(F.col("trade_time").isNotNull()).withColumn("_ts", F.timestamp_millis("trade_time"))
    partials = (
        timed.withWatermark("_ts", lateness)
        .groupBy("symbol", F.window("_ts", "1 hour").alias("hour"))
        .agg(
            F.min_by("price", order).alias("open_price"),
            F.min(order).alias("first"),
            F.max("price").alias("high_price"),
            F.min("price").alias("low_price"),
            F.max_by("price", order).alias("close_price"),
            F.max(order).alias("last"),
            F.sum("quantity").alias("volume"),
            F.sum(notional).alias("quote_volume"),
            F.count(F.lit(1)).alias("trade_count"),
        )
    )
    windows = partials.groupBy("symbol", F.window(F.window_time("hour"), f"{hours} hours", "1 hour").alias("w")).agg(
        F.min_by("open_price", "first").alias("open_price"),
        F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"),
        F.max_by("close_price", "last").alias("close_price"),
        F.sum("volume").alias("volume"),
        F.sum("quote_volume").alias("quote_volume"),
        F.sum("trade_count").alias("trade_count"),
    )
    opened = windows.withColumn("open_time", F.unix_millis(F.col("w.start")))
    return ticker_rows(opened, hours * HOUR_MS, F.lit(None))


def candles_path(root: str) -> str:
    return f"{root.rstrip('/')}/trade_candles"


def update_candles(spark: SparkSession, trades: DataFrame, root: str, interval_ms: int = 3_600_000) -> None:
    """Append a batch of raw trades and replace the candles of its days, for use in
    ``foreachBatch``; a late trade corrects its candle, a replayed batch changes
    nothing.  The candle table is partitioned by ``open_date``."""
    if DAY_MS % interval_ms:
        raise ValueError("candles must not reach over the end of a day")
    append_idempotent(spark, trades, root, "trades")
    day = F.to_date(F.timestamp_millis("trade_time"))
    timed = trades.where(F.col("trade_time").isNotNull())
    days = touched(timed.withColumn("open_date", day), "open_date")
    if days is None:
        return
    low, high = timed.agg(F.min("trade_time"), F.max("trade_time")).first()
    span = F.col("trade_time").between(low // DAY_MS * DAY_MS, high // DAY_MS * DAY_MS + DAY_MS - 1)  # reaches the scan
    raw = read_raw_table(spark, root, "trades").where(span).withColumn("open_date", day)
    bars = candles_from_trades(raw.where(days), interval_ms).withColumn("open_date", partition_value("klines"))
    writer = bars.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("open_date").parquet(candles_path(root))


def read_candles(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(candles_path(root)).select(*RAW_KLINES.names)
