"""Signal classifiers.  First matching branch wins; a NULL input falls to
the final ``otherwise`` branch, as a searched CASE's ELSE does."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: class labels and thresholds of each classifier
BULLISH, BEARISH = "bullish", "bearish"
BUY, SELL = "buy", "sell"
MOVE_THRESHOLDS = ((3, "high_move"), (1, "medium_move"), (0.1, "small_move"))
MOVE_ELSE = "flat"
GOLDEN, DEATH, NEUTRAL_CROSS = "golden_cross", "death_cross", "neutral"
VOLUME_THRESHOLDS = ((2.0, "high_volume_spike"), (1.5, "elevated_volume"))
VOLUME_ELSE = "normal_volume"
SIZE_THRESHOLDS = ((100000, "whale"), (10000, "large"), (1000, "medium"))
SIZE_ELSE = "small"
SENTIMENT_THRESHOLDS = (
    (5, "strongly_bullish"),
    (1, "bullish"),
    (-1, "neutral"),
    (-5, "bearish"),
)
SENTIMENT_ELSE = "strongly_bearish"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _ladder(value: Column, thresholds, otherwise: str, strict: bool) -> Column:
    out = None
    for limit, label in thresholds:
        cond = value > F.lit(limit) if strict else value >= F.lit(limit)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(otherwise)


def candle_direction(close: Column | str, open_: Column | str) -> Column:
    return F.when(_col(close) >= _col(open_), BULLISH).otherwise(BEARISH)


def trade_direction(is_buyer_maker: Column | str) -> Column:
    return F.when(_col(is_buyer_maker) == F.lit(True), SELL).otherwise(BUY)


def move_category(pct_return: Column | str) -> Column:
    return _ladder(F.abs(_col(pct_return)), MOVE_THRESHOLDS, MOVE_ELSE, strict=False)


def ma_signal(ma_fast: Column | str, ma_slow: Column | str) -> Column:
    fast, slow = _col(ma_fast), _col(ma_slow)
    return F.when(fast > slow, GOLDEN).when(fast < slow, DEATH).otherwise(NEUTRAL_CROSS)


def volume_signal(volume_ratio: Column | str) -> Column:
    return _ladder(_col(volume_ratio), VOLUME_THRESHOLDS, VOLUME_ELSE, strict=False)


def trade_size_category(value: Column | str) -> Column:
    return _ladder(_col(value), SIZE_THRESHOLDS, SIZE_ELSE, strict=False)


def market_sentiment(price_change_pct: Column | str) -> Column:
    return _ladder(_col(price_change_pct), SENTIMENT_THRESHOLDS, SENTIMENT_ELSE, strict=True)
