"""Idempotent appends (first write wins), landing round trip, pruning."""

from __future__ import annotations

import datetime as dt
import json
import os
from decimal import Decimal

import pytest

from candlewick.operators import ingest
from candlewick.plans.models import standin_raw
from candlewick.schemas import RAW_KLINES, RAW_TRADES
from candlewick.sources.landing import read_landing, write_landing

SF_SMALL = "/root/testdata/sf0.001"

T0 = dt.datetime(2024, 1, 1)


def _t(symbol, tid, price, ts=T0):
    p = Decimal(price)
    return (symbol, tid, p, Decimal("1"), p, 0 if tid is None else tid, False, ts)


def test_load_twice_equals_load_once(spark, scratch):
    trades = standin_raw(spark, SF_SMALL).trades
    ingest.append_idempotent(spark, trades, scratch, "trades")
    once = ingest.read_raw_table(spark, scratch, "trades")
    n = once.count()
    ingest.append_idempotent(spark, trades, scratch, "trades")
    twice = ingest.read_raw_table(spark, scratch, "trades")
    assert twice.count() == n == trades.count()
    assert twice.exceptAll(trades).count() == 0


def test_first_wins_in_batch_and_across_loads(spark, scratch):
    b1 = spark.createDataFrame([_t("BTCUSDT", 1, "1", T0), _t("BTCUSDT", 1, "2", T0 + dt.timedelta(1))], RAW_TRADES)
    ingest.append_idempotent(spark, b1, scratch, "trades", order=["extracted_at"])
    b2 = spark.createDataFrame([_t("BTCUSDT", 1, "3"), _t("BTCUSDT", 2, "4")], RAW_TRADES)
    ingest.append_idempotent(spark, b2, scratch, "trades", order=["extracted_at"])
    got = sorted((r.trade_id, r.price) for r in ingest.read_raw_table(spark, scratch, "trades").collect())
    assert got == [(1, Decimal("1.00000000")), (2, Decimal("4.00000000"))]


def test_null_keys_always_insert(spark, scratch):
    b = spark.createDataFrame([_t("BTCUSDT", None, "1"), _t("BTCUSDT", None, "2")], RAW_TRADES)
    ingest.append_idempotent(spark, b, scratch, "trades")
    ingest.append_idempotent(spark, b, scratch, "trades")
    assert ingest.read_raw_table(spark, scratch, "trades").count() == 4


def test_null_symbol_rejected(spark, scratch):
    b = spark.createDataFrame([_t(None, 1, "1")], "symbol string, trade_id long, price decimal(18,8), quantity decimal(18,8), quote_qty decimal(28,8), trade_time long, is_buyer_maker boolean, extracted_at timestamp_ntz")
    with pytest.raises(Exception):
        ingest.append_idempotent(spark, b, scratch, "trades")


@pytest.mark.parametrize("limit", [1000, 1])
def test_conflict_check_reads_only_touched_partitions(spark, scratch, monkeypatch, limit):
    monkeypatch.setattr(ingest, "MAX_TOUCHED", limit)
    raw = standin_raw(spark, SF_SMALL).klines
    ingest.append_idempotent(spark, raw, scratch, "klines")
    landed = os.path.join(scratch, "landed")
    write_landing(raw.where("open_time >= 1704153600000 and open_time < 1704326400000"), landed)  # two days
    batch = read_landing(spark, landed, "klines").withColumn("open_date", ingest.partition_value("klines"))
    table = ingest.read_raw_table(spark, scratch, "klines", with_partition=True)
    days = table.select("open_date").distinct().count()
    read = table.where(ingest.touched(batch, "open_date"))
    read.collect()
    scan = read._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert days > 20
    assert scan.metrics().apply("numPartitions").value() == 2
    assert ingest.new_rows(batch, table, ("symbol", "open_time"), ["_mtime"], "open_date").count() == 0


def test_batch_is_read_once(spark, scratch):
    raw = standin_raw(spark, SF_SMALL).klines
    landed, seen = os.path.join(scratch, "landed"), spark.sparkContext.accumulator(0)
    write_landing(raw, landed)

    def count(rows):
        for part in rows:
            seen.add(len(part))
            yield part

    batch = read_landing(spark, landed, "klines").drop("_mtime", "_file", "_block", "_pos")
    ingest.append_idempotent(spark, batch.mapInPandas(count, batch.schema), scratch, "klines")
    assert seen.value == raw.count() == ingest.read_raw_table(spark, scratch, "klines").count()


def test_arrival_order_is_by_file_time(spark, scratch):
    landed = os.path.join(scratch, "landed")
    os.makedirs(landed)
    for name, price, when in (("run_9.json", "1", 1_700_000_000), ("run_10.json", "2", 1_700_003_600)):
        path = os.path.join(landed, name)
        with open(path, "w") as f:
            json.dump([{"symbol": "A", "trade_id": 1, "price": price, "quantity": "1", "quote_qty": "1", "trade_time": 1,
                        "is_buyer_maker": False, "extracted_at": "2024-01-01T00:00:00"}], f, indent=2)
        os.utime(path, (when, when))
    ingest.append_idempotent(spark, read_landing(spark, landed, "trades", multiline=True), scratch, "trades")
    assert [r.price for r in ingest.read_raw_table(spark, scratch, "trades").collect()] == [Decimal(1)]


def test_landing_round_trip_keeps_arrival_order(spark, scratch):
    raw = standin_raw(spark, SF_SMALL).klines
    path = os.path.join(scratch, "landing")
    write_landing(raw, path)
    back = read_landing(spark, path, "klines")
    assert {"_mtime", "_file", "_block", "_pos"} <= set(back.columns)
    assert back.drop("_mtime", "_file", "_block", "_pos").exceptAll(raw).count() == 0
    assert raw.exceptAll(back.drop("_mtime", "_file", "_block", "_pos")).count() == 0


def test_empty_batch_is_a_no_op(spark, scratch):
    ingest.append_idempotent(spark, spark.createDataFrame([], RAW_KLINES), scratch, "klines")
    assert ingest.read_raw_table(spark, scratch, "klines").count() == 0


def test_bad_decimal_in_landing_fails_not_null(spark, scratch):
    path = os.path.join(scratch, "bad.json")
    with open(path, "w") as f:
        f.write('{"symbol": "BTCUSDT", "trade_id": 1, "price": "12x.5", "quantity": "1", "quote_qty": "1",'
                ' "trade_time": 1, "is_buyer_maker": false, "extracted_at": "2024-01-01T00:00:00"}\n')
    with pytest.raises(Exception):
        read_landing(spark, path, "trades").collect()
