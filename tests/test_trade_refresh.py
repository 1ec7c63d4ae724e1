"""Refresh of the trade tables and of the symbol tables merged from partials equals a
full build, also after late trades, trades without a time and trades without an id."""

from __future__ import annotations

import datetime as dt
import os
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from candlewick.operators import ingest, marts, metrics, partials, scaled, staging
from candlewick.plans import incremental, materialize
from candlewick.plans.models import standin_raw
from candlewick.schemas import RAW_TRADES

SF_SMALL = "/root/testdata/sf0.001"


def _same(a, b):
    return a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def _ms(*day) -> int:
    return int(dt.datetime(*day, tzinfo=dt.timezone.utc).timestamp() * 1000)


def _equal(spark, root, paths):
    """Every written trade table against a full computation on the raw table."""
    stg = staging.stg_trades(ingest.read_raw_table(spark, root, "trades"))
    fact = marts.fct_trades(stg, method="plain")
    for name, want in (("stg_trades", stg), ("fct_trades", fact), ("trade_tails", scaled.trade_tails(fact)),
                       ("trade_partials", partials.trade_partials(stg))):
        assert _same(spark.read.parquet(paths[name]).select(*want.columns), want), name
    merged = partials.merged_trade_summary(spark.read.parquet(paths["trade_partials"]))
    assert _same(merged, metrics.trade_summary(stg))


def _trade(trade_id, time, symbol="AUSDT", price="2.5", stamp=1):
    d = Decimal(price) if price else None
    values = {"symbol": symbol, "trade_id": trade_id, "price": d, "quantity": Decimal("3.00000001"), "quote_qty": d,
              "trade_time": time, "is_buyer_maker": bool((trade_id or 0) % 2), "extracted_at": dt.datetime(2024, 2, 1, 0, 0, stamp)}
    return tuple(values[c] for c in RAW_TRADES.names)


def test_refresh_of_trades_equals_full_build(spark, scratch):
    raw = standin_raw(spark, SF_SMALL).trades
    root, out = os.path.join(scratch, "raw"), os.path.join(scratch, "out")
    late = F.col("trade_id") % 97 == 5
    ingest.append_idempotent(spark, raw.where((F.col("trade_time") < _ms(2024, 1, 20, 13)) & ~late), root, "trades")
    paths = materialize.build_trades(spark, ingest.read_raw_table(spark, root, "trades"), out)
    _equal(spark, root, paths)

    ingest.append_idempotent(spark, raw.where(~late), root, "trades")
    incremental.refresh_trades(spark, root, paths, dt.datetime(2024, 1, 20, 13))
    _equal(spark, root, paths)

    ingest.append_idempotent(spark, raw, root, "trades")  # late ones, of every day
    first = raw.where(late).select(F.to_date(F.timestamp_millis(F.min("trade_time"))).cast("string")).first()[0]
    incremental.refresh_trades(spark, root, paths, f"{first} 00:00:00")
    incremental.refresh_trades(spark, root, paths, f"{first} 00:00:00")  # a replay changes nothing
    _equal(spark, root, paths)


def test_odd_trades(spark, scratch):
    """Ties, fewer than nine trades over many days, a symbol silent for long, trades
    without a time, a value or an id, and tables that start empty."""
    root, out = os.path.join(scratch, "raw"), os.path.join(scratch, "out")

    def load(rows):
        ingest.append_idempotent(spark, spark.createDataFrame(rows, RAW_TRADES), root, "trades")

    load([])
    paths = materialize.build_trades(spark, ingest.read_raw_table(spark, root, "trades"), out)
    days = [_trade(i, _ms(2024, 1, 1 + i // 2, 5), price=None if i % 5 == 0 else "1.25") for i in range(30)]
    load([*days, _trade(1, _ms(2024, 1, 1), "OLDUSDT"), _trade(77, None)])
    incremental.refresh_trades(spark, root, paths, "2024-01-01 00:00:00")
    _equal(spark, root, paths)

    load([_trade(2, _ms(2024, 1, 16, 5), "OLDUSDT"), _trade(3, _ms(2024, 1, 16, 5), "OLDUSDT"), _trade(78, None, "NEWUSDT"),
          *[_trade(100 + i, _ms(2024, 1, 16, 5)) for i in range(12)]])
    incremental.refresh_trades(spark, root, paths, "2024-01-16 00:00:00")
    _equal(spark, root, paths)

    load([_trade(None, _ms(2024, 1, 4), stamp=2), _trade(None, _ms(2024, 1, 17), stamp=3)])
    incremental.refresh_trades(spark, root, paths, "2024-01-17 00:00:00")
    load([_trade(None, _ms(2024, 1, 5), stamp=4)])  # replaces the one of the 17th
    incremental.refresh_trades(spark, root, paths, "2024-01-17 00:00:00")
    _equal(spark, root, paths)


@pytest.mark.parametrize("block_rows", [9, 50_000])
def test_facts_from_tails_in_small_blocks(spark, scratch, block_rows):
    stg = staging.stg_trades(standin_raw(spark, SF_SMALL).trades)
    fact = marts.fct_trades(stg, method="plain")
    got = scaled.fct_trades_from(stg.where("traded_at >= timestamp'2024-01-15'"), scaled.trade_tails(fact), "2024-01-15", block_rows, 5)
    assert _same(got, fact.where("trade_date >= date'2024-01-15'"))


def test_tails_hold_nine_trades_per_symbol_and_day(spark):
    stg = staging.stg_trades(standin_raw(spark, SF_SMALL).trades)
    tails = scaled.trade_tails(marts.fct_trades(stg, method="plain"))
    assert tails.groupBy("symbol", "trade_date").count().agg(F.max("count")).first()[0] <= scaled.TAIL_ROWS


def test_raw_trades_are_read_by_time(spark, scratch):
    raw = standin_raw(spark, SF_SMALL).trades
    ingest.append_idempotent(spark, raw, scratch, "trades")
    table = ingest.read_raw_table(spark, scratch, "trades", with_partition=True)
    moment = F.unix_millis(F.lit("2024-01-20").cast("timestamp"))
    plan = table.where((F.col("trade_time") >= moment) | F.col("trade_time").isNull())._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(trade_time,1705708800000)" in plan


def test_new_listing_does_not_send_the_walk_back(spark, scratch):
    raw = standin_raw(spark, SF_SMALL).klines
    old = raw.where(F.col("symbol") != "VIEWUSDT").unionByName(
        raw.where((F.col("symbol") == "VIEWUSDT") & (F.col("open_time") >= _ms(2024, 1, 27))))
    stg = staging.stg_klines(old)
    path = os.path.join(scratch, "fct")
    materialize.write_table(marts.fct_candles(metrics.price_metrics(stg)), path, ("trade_date",))
    first = partials.candle_partials(stg).groupBy("symbol").agg(F.min("trade_date").alias("first_day"))
    symbols = old.select("symbol").distinct()
    tail = incremental.earlier_rows(spark, path, "opened_at", "2024-01-28", 29, symbols, first)
    want = incremental.earlier_rows(spark, path, "opened_at", "2024-01-28", 29, symbols)
    assert _same(tail, want)

    def reached(df) -> str:
        return min(re.findall(r">= cast\((2024-01-\d\d) as date", df._jdf.queryExecution().analyzed().toString()))

    assert reached(want) == "2024-01-01" < reached(tail)
