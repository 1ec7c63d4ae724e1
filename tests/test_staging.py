"""Staging: latest-wins dedupe, NULL keys, ticker staging, latest ticker."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from candlewick.operators import staging
from candlewick.schemas import RAW_KLINES, RAW_TRADES

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def _kline(symbol, open_time, close, extracted_at):
    p = Decimal(close)
    v = Decimal("1")
    return (symbol, open_time, p, p, p, p, v, None if open_time is None else open_time + 3599999,
            v, 1, v, v, extracted_at)


def test_newest_extraction_wins_and_null_stamp_is_newest(spark):
    rows = [
        _kline("BTCUSDT", 0, "1", T0),
        _kline("BTCUSDT", 0, "2", T0 + dt.timedelta(hours=1)),
        _kline("ETHUSDT", 0, "3", T0),
        _kline("ETHUSDT", 0, "4", None),
        _kline("ETHUSDT", 0, "5", T0 + dt.timedelta(hours=5)),
    ]
    out = staging.stg_klines(spark.createDataFrame(rows, RAW_KLINES))
    got = {r.kline_id: (r.close_price, r.row_num) for r in out.collect()}
    assert got == {"BTCUSDT_0": (Decimal("2.00000000"), 1), "ETHUSDT_0": (Decimal("4.00000000"), 1)}


def test_null_keys_collapse_to_one_row_across_symbols(spark):
    rows = [_kline("BTCUSDT", None, "1", T0), _kline("ETHUSDT", None, "2", T0), _kline("BTCUSDT", 7, "3", T0)]
    out = staging.stg_klines(spark.createDataFrame(rows, RAW_KLINES)).collect()
    assert len(out) == 2
    assert sum(1 for r in out if r.kline_id is None) == 1


def test_ties_are_broken_deterministically(spark):
    rows = [
        ("BTCUSDT", 1, Decimal("2"), Decimal("1"), Decimal("2"), 10, False, T0),
        ("BTCUSDT", 1, Decimal("1"), Decimal("1"), Decimal("1"), 10, True, T0),
    ]
    for _ in range(2):
        out = staging.stg_trades(spark.createDataFrame(rows, RAW_TRADES).repartition(2)).collect()
        assert [(r.price, r.trade_direction) for r in out] == [(Decimal("1.00000000"), "sell")]


def test_trade_staging_columns(spark):
    rows = [("BTCUSDT", 9, Decimal("2.5"), Decimal("4"), Decimal("10"), 1704067200123, None, T0)]
    r = staging.stg_trades(spark.createDataFrame(rows, RAW_TRADES)).first()
    assert r.trade_key == "BTCUSDT_9"
    assert r.trade_value_usdt == Decimal("10.0000000000000000")
    assert r.trade_direction == "buy"
    assert r.traded_at == dt.datetime(2024, 1, 1, 0, 0, 0, 123000)
    assert list(staging.stg_trades(spark.createDataFrame(rows, RAW_TRADES)).columns)[-1] == "row_num"


def test_trades_are_shuffled_as_raw_columns(spark):
    df = staging.stg_trades(spark.createDataFrame([("AUSDT", 1, Decimal("2"), Decimal("3"), None, 1000, True, T0)], RAW_TRADES))
    plan = df._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning") :]
    assert not any(c in below for c in ("trade_key", "trade_value_usdt", "trade_direction", "traded_at"))
    r = df.first()
    assert (r.trade_key, r.trade_value_usdt, r.trade_direction) == ("AUSDT_1", Decimal(6), "sell")
