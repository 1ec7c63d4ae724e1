"""Price metrics, symbol volume, facts, dimension and daily mart: edge cases
from literal frames plus properties on the test tables."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from candlewick.operators import marts, metrics, staging
from candlewick.plans.models import standin_models, tape_trades
from candlewick.schemas import RAW_KLINES, RAW_TICKERS, RAW_TRADES

SF_SMALL = "/root/testdata/sf0.001"

H = 3_600_000
T0 = dt.datetime(2024, 1, 1)


def _k(symbol, i, o, h, lo, c, vol="1"):
    d = Decimal
    return (symbol, i * H, d(o), d(h), d(lo), d(c), d(vol), i * H + H - 1, d(vol), 1, d(vol), d(vol), T0)


def _fct(spark, rows):
    return marts.fct_candles(metrics.price_metrics(staging.stg_klines(spark.createDataFrame(rows, RAW_KLINES))))


def test_first_candle_defaults(spark):
    r = _fct(spark, [_k("BTCUSDT", 0, "1", "3", "1", "2")]).first()
    assert r.prev_close_price is None and r.pct_return is None and r.move_category == "flat"
    assert r.ma_7 == r.ma_14 == r.ma_30 == 2.0 and r.ma_signal == "neutral"
    assert r.volatility_7 is None and r.volume_ratio == 1.0
    assert r.day_of_week == "Thursday " and r.trade_hour == 0


def test_flat_range_and_zero_volumes(spark):
    rows = [_k("BTCUSDT", i, "1", "1", "1", "1", vol="0") for i in range(7)]
    out = _fct(spark, rows).collect()
    assert all(r.body_pct_of_range is None for r in out)
    assert all(r.volume_ratio is None and r.volume_signal == "normal_volume" for r in out)


def test_equal_close_shares_rank(spark):
    rows = [_k("AUSDT", 0, "1", "2", "1", "2"), _k("BUSDT", 0, "1", "2", "1", "2"), _k("CUSDT", 0, "1", "1", "1", "1")]
    ranks = {r.symbol: r.price_rank for r in _fct(spark, rows).collect()}
    assert ranks == {"AUSDT": 1, "BUSDT": 1, "CUSDT": 3}


def test_moving_average_windows_are_row_frames(spark):
    rows = [_k("BTCUSDT", i, "1", "100", "1", str(i + 1)) for i in range(40)]
    out = {r.opened_at: r for r in _fct(spark, rows).collect()}
    last = out[max(out)]
    assert last.ma_7 == sum(range(34, 41)) / 7
    assert last.ma_30 == sum(range(11, 41)) / 30
    assert last.pct_return == round((40 - 39) / 39 * 100, 4)


def test_symbol_volume_without_ticker_and_null_change_ranks_first(spark):
    trades = spark.createDataFrame(
        [("AUSDT", 1, Decimal("10"), Decimal("1"), Decimal("10"), 0, False, T0),
         ("BUSDT", 2, Decimal("30"), Decimal("1"), Decimal("30"), 0, True, T0)], RAW_TRADES)
    tickers = spark.createDataFrame(
        [("AUSDT", None, Decimal("3"), None, None, Decimal("1"), Decimal("1"), Decimal("1"), Decimal("1"),
          None, None, 0, 1, 1, T0),
         ("CUSDT", None, None, None, None, Decimal("1"), Decimal("1"), Decimal("1"), Decimal("1"),
          None, None, 0, 1, 1, T0)], RAW_TICKERS)
    sv = {r.symbol: r for r in metrics.symbol_volume(staging.stg_trades(trades), staging.stg_tickers(tickers)).collect()}
    assert set(sv) == {"AUSDT", "BUSDT"}
    assert sv["BUSDT"].last_price is None
    assert sv["BUSDT"].momentum_rank == 1 and sv["AUSDT"].momentum_rank == 2
    assert sv["BUSDT"].volume_rank == 1 and sv["AUSDT"].volume_dominance_pct == 25.0
    assert sv["AUSDT"].buy_pressure_pct == 100.0 and sv["BUSDT"].sell_trades == 1


def test_properties_on_test_tables(spark):
    m = standin_models(spark, SF_SMALL)
    n_candles = m.stg_klines.count()
    assert m.price_metrics.count() == n_candles == m.fct_candles.count()
    assert m.fct_trades.count() == m.stg_trades.count()
    dom = m.symbol_volume.agg(F.sum("volume_dominance_pct")).first()[0]
    assert abs(dom - 100.0) < 0.05
    day = m.daily_summary
    assert day.count() == day.select("trade_date", "symbol").distinct().count()
    assert m.daily_summary_candle_grain.count() == n_candles
    last = m.fct_trades.groupBy("symbol").agg(F.max_by("cumulative_volume_usdt", F.struct("traded_at", "trade_id")).alias("c"))
    total = m.stg_trades.groupBy("symbol").agg(F.sum("trade_value_usdt").alias("t"))
    assert last.join(total, "symbol").where(F.col("c") != F.col("t")).count() == 0
    assert m.dim_symbols.count() == m.latest_ticker.count() == m.stg_tickers.select("symbol").distinct().count()


def test_whales_exist_on_the_tape(spark):
    fct = marts.fct_trades(staging.stg_trades(tape_trades(spark, SF_SMALL)))
    classes = {r.trade_size_category for r in fct.select("trade_size_category").distinct().collect()}
    assert "whale" in classes
