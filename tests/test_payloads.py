"""Payload normalisers: positions, renames, empty/failed payloads, bad values."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from candlewick.sources import payloads

T0 = dt.datetime(2026, 3, 17, 3, 0, 0)


def test_klines_positions_and_extra_positions_ignored(spark):
    payload = ('[[1773630000000,"1.5","2.5","1.0","2.0","10.0",1773633599999,"20.0",7,"4.0","8.0","0"],'
               '[1773633600000,"2.0","2.0","2.0","2.0","0.0",1773637199999,"0.0",0,"0.0","0.0","0"]]')
    df = spark.createDataFrame([("BTCUSDT", payload, T0), ("ETHUSDT", "[]", T0), ("BNBUSDT", None, T0)],
                               "symbol string, payload string, extracted_at timestamp_ntz")
    out = payloads.normalize_klines(df).orderBy("open_time").collect()
    assert len(out) == 2
    r = out[0]
    assert (r.symbol, r.open_time, r.open_price, r.close_time, r.number_of_trades) == (
        "BTCUSDT", 1773630000000, Decimal("1.50000000"), 1773633599999, 7)
    assert r.taker_buy_quote_volume == Decimal("8.00000000") and r.extracted_at == T0


def test_trades_renamed(spark):
    payload = '[{"id": 42, "price": "3.5", "qty": "2", "quoteQty": "7", "time": 1773630000001, "isBuyerMaker": true}]'
    df = spark.createDataFrame([("ETHUSDT", payload, T0)], "symbol string, payload string, extracted_at timestamp_ntz")
    r = payloads.normalize_trades(df).first()
    assert (r.trade_id, r.price, r.quantity, r.quote_qty, r.trade_time, r.is_buyer_maker) == (
        42, Decimal("3.50000000"), Decimal("2.00000000"), Decimal("7.00000000"), 1773630000001, True)


def test_tickers_symbol_from_payload_and_failed_skipped(spark):
    ok = ('{"symbol":"BNBUSDT","priceChange":"4.6","priceChangePercent":"0.682","weightedAvgPrice":"679.4",'
          '"prevClosePrice":"674.85","lastPrice":"679.45","openPrice":"674.85","highPrice":"687.82",'
          '"lowPrice":"670.13","volume":"1","quoteVolume":"2","openTime":1,"closeTime":2,"count":3}')
    df = spark.createDataFrame([(ok, T0), (None, T0), ("not json", T0)], "payload string, extracted_at timestamp_ntz")
    with pytest.raises(Exception, match="not the expected JSON"):
        payloads.normalize_tickers(df).collect()
    out = payloads.normalize_tickers(df, on_bad="quarantine").collect()
    assert [r.reason for r in payloads.quarantined(df, "tickers").collect()] == ["payload: not the expected JSON"]
    assert [(r["symbol"], r["price_change_pct"], r["count"]) for r in out] == [("BNBUSDT", Decimal("0.68200000"), 3)]


def test_bad_price_fails_instead_of_null(spark):
    payload = '[{"id": 1, "price": "abc", "qty": "2", "quoteQty": "7", "time": 1, "isBuyerMaker": false}]'
    df = spark.createDataFrame([("ETHUSDT", payload, T0)], "symbol string, payload string, extracted_at timestamp_ntz")
    with pytest.raises(Exception):
        payloads.normalize_trades(df).collect()


TRADE = '{"id": %s, "price": "%s", "qty": "%s", "quoteQty": "7", "time": 1, "isBuyerMaker": false}'


@pytest.mark.parametrize(
    ("payload", "reason"),
    [
        ("[" + TRADE % (1, "1", "2") + "," + TRADE % (2, "1", "2")[:20], "payload: not the expected JSON"),
        ("[" + TRADE % ('"x4"', "1", "2") + "]", "trade_id: not bigint"),
        ("[" + TRADE % ("null", "1", "2") + "]", "trade_id: missing"),
        ("[" + TRADE % (1, "0.0000012345", "2") + "]", "price: not decimal(18,8)"),
        ("[" + TRADE % (1, "1", "12000000000") + "]", "quantity: not decimal(18,8)"),
        ("[" + TRADE % (1, "abc", "2") + "]", "price: not decimal(18,8)"),
        ('{"code": -1121, "msg": "Invalid symbol."}', "trade_id: missing"),
        ('"down for maintenance"', "payload: not the expected JSON"),
    ],
)
def test_bad_records_fail_or_go_to_quarantine(spark, payload, reason):
    good = "[" + TRADE % (9, "1.50", "2.00000000000") + "]"
    df = spark.createDataFrame([("A", payload, T0), ("A", good, T0)], "symbol string, payload string, extracted_at timestamp_ntz")
    with pytest.raises(Exception, match="bad record"):
        payloads.normalize_trades(df).count()
    kept = payloads.normalize_trades(df, on_bad="quarantine").collect()
    assert [(r.trade_id, r.price) for r in kept] == [(9, Decimal("1.50000000"))]
    bad = payloads.quarantined(df, "trades").collect()
    assert [(r.symbol, r.reason, r.payload) for r in bad] == [("A", reason, payload)]


def test_short_candle_goes_to_quarantine(spark):
    payload = '[[1773630000000,"1.5"],[]]'
    df = spark.createDataFrame([("A", payload, T0)], "symbol string, payload string, extracted_at timestamp_ntz")
    assert [r.open_time for r in payloads.normalize_klines(df, on_bad="quarantine").collect()] == [1773630000000]
    assert [r.reason for r in payloads.quarantined(df, "klines").collect()] == ["open_time: missing"]
