"""Column functions: classifiers (incl. NULL -> ELSE), rounding, calendar
parts, symbol parsing, surrogate keys."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from candlewick.functions import classify
from candlewick.functions.numeric import pct, rounded
from candlewick.functions.temporal import base_asset, day_name, quote_asset, surrogate_key, trade_date, trade_hour


def _one(spark, expr, value, dtype):
    return spark.createDataFrame([(value,)], f"x {dtype}").select(expr.alias("r")).first()["r"]


def test_candle_direction_equal_close_is_bullish(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (1.0, 2.0), (None, 1.0)], "c double, o double")
    got = [r.d for r in df.select(classify.candle_direction("c", "o").alias("d")).collect()]
    assert got == ["bullish", "bullish", "bearish", "bearish"]


def test_trade_direction_null_is_buy(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "m boolean")
    assert [r.d for r in df.select(classify.trade_direction("m").alias("d")).collect()] == ["sell", "buy", "buy"]


def test_move_category_thresholds_and_null(spark):
    vals = [3.0, -3.0, 2.9999, 1.0, -0.1, 0.0999, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r.d for r in df.select(classify.move_category("x").alias("d")).collect()]
    assert got == ["high_move", "high_move", "medium_move", "medium_move", "small_move", "flat", "flat"]


def test_volume_signal_exact_thresholds(spark):
    df = spark.createDataFrame([(2.0,), (1.5,), (1.4999,), (None,)], "x double")
    got = [r.d for r in df.select(classify.volume_signal("x").alias("d")).collect()]
    assert got == ["high_volume_spike", "elevated_volume", "normal_volume", "normal_volume"]


def test_trade_size_thresholds(spark):
    vals = [Decimal("100000"), Decimal("10000"), Decimal("1000"), Decimal("999.99"), None]
    df = spark.createDataFrame([(v,) for v in vals], "x decimal(37,16)")
    got = [r.d for r in df.select(classify.trade_size_category("x").alias("d")).collect()]
    assert got == ["whale", "large", "medium", "small", "small"]


def test_market_sentiment_boundaries_and_null(spark):
    vals = [5.0, 5.001, 1.0, -1.0, -5.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r.d for r in df.select(classify.market_sentiment("x").alias("d")).collect()]
    assert got == ["bullish", "strongly_bullish", "neutral", "bearish", "strongly_bearish", "strongly_bearish"]


def test_ma_signal(spark):
    df = spark.createDataFrame([(2.0, 1.0), (1.0, 2.0), (1.0, 1.0), (None, 1.0)], "a double, b double")
    got = [r.d for r in df.select(classify.ma_signal("a", "b").alias("d")).collect()]
    assert got == ["golden_cross", "death_cross", "neutral", "neutral"]


def test_rounding_half_away_from_zero(spark):
    assert _one(spark, rounded(F.col("x"), 4), Decimal("-2.00005"), "decimal(18,8)") == -2.0001
    assert _one(spark, rounded(F.col("x"), 4), Decimal("2.00005"), "decimal(18,8)") == 2.0001
    assert _one(spark, rounded(F.col("x"), 2), 0.125, "double") == 0.13


def test_pct_guards_zero_denominator(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0)], "a double, b double")
    assert [r.p for r in df.select(pct("a", "b").alias("p")).collect()] == [None, 25.0]


def test_day_name_padded_and_last_millisecond(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 59, 59, 999000),)], "t timestamp")
    r = df.select(day_name("t").alias("d"), trade_date("t").alias("td"), trade_hour("t").alias("h")).first()
    assert r.d == "Monday   " and len(r.d) == 9
    assert r.td == dt.date(2024, 1, 1) and r.h == 23


def test_symbol_parts_including_short_symbols(spark):
    df = spark.createDataFrame([("BTCUSDT",), ("USDT",), ("ABC",), ("AB",), ("A",), (None,)], "s string")
    got = [(r.b, r.q) for r in df.select(base_asset("s").alias("b"), quote_asset("s").alias("q")).collect()]
    assert got == [("BTC", "USDT"), ("", "USDT"), ("AB", "ABC"), ("", "AB"), ("", "A"), (None, None)]


def test_surrogate_key_null_propagates(spark):
    df = spark.createDataFrame([("BTCUSDT", 5), ("BTCUSDT", None), (None, 5)], "s string, i long")
    assert [r.k for r in df.select(surrogate_key("s", "i").alias("k")).collect()] == ["BTCUSDT_5", None, None]
