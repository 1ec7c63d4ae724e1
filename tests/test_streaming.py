"""Structured Streaming: landing ingest is exactly-once through the
idempotent append; streamed candles equal batch candles once closed."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from candlewick.operators import bars, ingest
from candlewick.plans.models import standin_raw
from candlewick.schemas import RAW_TRADES
from candlewick.sources.landing import write_landing
from candlewick.streaming.bars import read_candles, stream_candles, stream_tickers, update_candles
from candlewick.streaming.ingest import start_landing_ingest

SF_SMALL = "/root/testdata/sf0.001"


def test_landing_stream_ingest_is_idempotent(spark, scratch):
    trades = standin_raw(spark, SF_SMALL).trades
    landing = os.path.join(scratch, "landing")
    first = trades.where(F.col("trade_time") < F.lit(1704844800000))  # before 2024-01-10
    write_landing(first, os.path.join(landing, "run1"))
    write_landing(trades, os.path.join(landing, "run2"))  # re-sends everything
    q = start_landing_ingest(spark, landing + "/*", "trades", scratch, checkpoint=os.path.join(scratch, "ckpt"),
                             multiline=False)
    q.awaitTermination(300)
    table = ingest.read_raw_table(spark, scratch, "trades")
    assert table.count() == trades.count()
    assert table.exceptAll(trades).count() == 0
    # replaying the whole landing folder under a fresh checkpoint inserts nothing
    q2 = start_landing_ingest(spark, landing + "/*", "trades", scratch, checkpoint=os.path.join(scratch, "ckpt2"),
                              multiline=False)
    q2.awaitTermination(300)
    assert ingest.read_raw_table(spark, scratch, "trades").count() == trades.count()


def test_stream_candles_equal_batch_for_closed_windows(spark, scratch):
    trades = standin_raw(spark, SF_SMALL).trades
    src = os.path.join(scratch, "trades")
    trades.write.parquet(src)
    stream = spark.readStream.schema(RAW_TRADES).parquet(src)
    q = (stream_candles(stream).writeStream.format("memory").queryName("candles_stream")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.table("candles_stream")
    newest = trades.agg(F.max("trade_time")).first()[0]
    expected = bars.candles_from_trades(trades).where(F.col("close_time") + 1 + 600_000 <= F.lit(newest))
    assert got.count() > 0
    assert got.exceptAll(expected).count() == 0
    assert expected.exceptAll(got).count() == 0


def test_late_trades_after_the_watermark_are_dropped(spark, scratch):
    from decimal import Decimal
    import datetime as dt

    hour = 3_600_000
    t0 = 1_704_067_200_000  # 2024-01-01 00:00 UTC

    def trade(i, ms, price):
        return ("AUSDT", i, Decimal(price), Decimal("1"), Decimal(price), ms, False, dt.datetime(2024, 1, 1))

    src = os.path.join(scratch, "trades")
    spark.createDataFrame([trade(1, t0 + 60_000, "10"), trade(2, t0 + 3 * hour, "11")], RAW_TRADES) \
        .write.parquet(os.path.join(src, "b1"))
    ckpt = os.path.join(scratch, "ckpt")
    out = os.path.join(scratch, "candles_out")

    def run():
        q = (stream_candles(spark.readStream.schema(RAW_TRADES).parquet(src + "/*")).writeStream
             .format("parquet").option("path", out).option("checkpointLocation", ckpt)
             .outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination(300)

    run()
    # a trade for the first hour arrives three hours late, with newer trades
    spark.createDataFrame([trade(3, t0 + 120_000, "99"), trade(4, t0 + 6 * hour, "12")], RAW_TRADES) \
        .write.parquet(os.path.join(src, "b2"))
    run()
    emitted = spark.read.parquet(out)
    first_hour = emitted.where(F.col("open_time") == t0).collect()
    assert len(first_hour) == 1
    assert all(r.high_price == Decimal("10.00000000") and r.number_of_trades == 1 for r in first_hour)


def test_close_time_follows_the_interval(spark, scratch):
    trades = standin_raw(spark, SF_SMALL).trades
    src = os.path.join(scratch, "trades")
    trades.write.parquet(src)
    stream = spark.readStream.schema(RAW_TRADES).parquet(src)
    q = (stream_candles(stream, interval="5 minutes").writeStream.format("memory").queryName("candles_5m")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert spark.table("candles_5m").selectExpr("max(close_time - open_time) x", "min(close_time - open_time) y").first() == (299_999, 299_999)


def test_a_late_trade_corrects_its_candle(spark, scratch):
    trades = standin_raw(spark, SF_SMALL).trades
    late = F.pmod("trade_id", F.lit(10)) == 3
    update_candles(spark, trades.where(~late), scratch)
    update_candles(spark, trades.where(late), scratch)
    update_candles(spark, trades.where(late), scratch)  # a replayed batch
    got, want = read_candles(spark, scratch), bars.candles_from_trades(trades)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_streamed_tickers_equal_batch_for_closed_windows(spark, scratch):
    """The windows that end with a day are the batch's snapshots."""
    trades = standin_raw(spark, SF_SMALL).trades
    src = os.path.join(scratch, "trades")
    trades.repartitionByRange(6, "trade_time").sortWithinPartitions("trade_time").write.parquet(src)
    stream = spark.readStream.schema(RAW_TRADES).parquet(src)
    q = (stream_tickers(stream).writeStream.format("memory").queryName("tickers_stream")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination(300)
    newest = trades.agg(F.max("trade_time")).first()[0]
    closed = F.col("close_time") + 600_000 <= F.lit(newest)
    got = bars.with_prev_close(spark.table("tickers_stream"))
    sliding = bars.with_prev_close(stream_tickers(trades)).where(closed)
    assert got.exceptAll(sliding).count() == sliding.exceptAll(got).count() == 0
    days = got.where(F.col("open_time") % bars.DAY_MS == 0)
    expected = bars.tickers_from_trades(trades).where(closed)
    assert days.count() > 0
    assert days.exceptAll(expected).count() == expected.exceptAll(days).count() == 0
