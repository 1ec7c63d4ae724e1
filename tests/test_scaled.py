"""Blocked windows with a halo give exactly the plain windows' results."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from candlewick.operators import marts, metrics, scaled, staging
from candlewick.plans.models import standin_models, tape_trades
from candlewick.schemas import RAW_TRADES

SF_SMALL = "/root/testdata/sf0.001"


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() == b.count()


def test_trade_fact_blocks_equal_plain(spark):
    stg = standin_models(spark, SF_SMALL).stg_trades
    plain = marts.fct_trades(stg, method="plain")
    for block_rows, partitions in ((9, 3), (37, 16), (1000, 1)):
        assert _same(plain, scaled.fct_trades_scaled(stg, block_rows=block_rows, partitions=partitions))


def test_trade_fact_blocks_equal_plain_on_tied_tape(spark):
    stg = staging.stg_trades(tape_trades(spark, SF_SMALL))
    assert _same(marts.fct_trades(stg, method="plain"), scaled.fct_trades_scaled(stg, block_rows=50))


def test_price_metrics_blocks_equal_plain(spark):
    stg = standin_models(spark, SF_SMALL).stg_klines
    plain = metrics.price_metrics(stg)
    for block_rows in (29, 64):
        assert _same(plain, scaled.price_metrics_scaled(stg, block_rows=block_rows, partitions=5))


def test_positions_are_exact_under_a_hot_symbol(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("HOTUSDT", i, Decimal(i % 7 + 1), Decimal("1"), None, 1000, False, t0) for i in range(300)]
    rows += [("COLDUSDT", i, Decimal("2"), Decimal("1"), None, 1000 + i, True, t0) for i in range(5)]
    df = spark.createDataFrame(rows, RAW_TRADES)
    pos = scaled.positioned(df, ["symbol"], ["trade_time", "trade_id"], partitions=8)
    got = {(r.symbol, r.trade_id): r._pos for r in pos.collect()}
    assert got == {**{("HOTUSDT", i): i for i in range(300)}, **{("COLDUSDT", i): i for i in range(5)}}


def test_nulls_sort_last_and_null_values_skip(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("AUSDT", i, None if i % 4 == 0 else Decimal(i), Decimal("1"), None, i * 1000 if i != 5 else None, False, t0)
            for i in range(1, 30)]
    stg = staging.stg_trades(spark.createDataFrame(rows, RAW_TRADES))
    assert _same(marts.fct_trades(stg, method="plain"), scaled.fct_trades_scaled(stg, block_rows=10, partitions=4))


def test_scratch_tables_are_released(spark):
    from candlewick.session import _SCOPES, release_scratch

    stg = standin_models(spark, SF_SMALL).stg_trades
    scaled.fct_trades_scaled(stg, block_rows=100).count()
    assert _SCOPES[0]
    assert release_scratch(spark) >= 1 and not _SCOPES[0]


def test_a_scope_releases_its_own_scratch_only(spark):
    from candlewick.session import _SCOPES, scratch_scope

    stg = standin_models(spark, SF_SMALL).stg_trades
    outer = scaled.fct_trades_scaled(stg, block_rows=100)
    with scratch_scope(spark) as own:
        inner = scaled.fct_trades_scaled(stg, block_rows=200)
        assert own and inner.count() == outer.count()
    assert not any(os.path.exists(p.removeprefix("file://")) for p in own)
    assert outer.count() == stg.count()
    with pytest.raises(ZeroDivisionError), scratch_scope(spark) as own:
        scaled.fct_trades_scaled(stg, block_rows=200)
        raise ZeroDivisionError
    assert own and not any(os.path.exists(p.removeprefix("file://")) for p in own)
    assert len(_SCOPES) == 1


def test_rows_without_symbol_take_the_plain_window(spark):
    t0 = dt.datetime(2024, 1, 1)
    schema = ("symbol string, trade_id long, price decimal(18,8), quantity decimal(18,8), quote_qty decimal(28,8), "
              "trade_time long, is_buyer_maker boolean, extracted_at timestamp_ntz")
    rows = [(None if i % 3 == 0 else "AUSDT", i, Decimal(i), Decimal("1"), None, i * 1000, False, t0) for i in range(40)]
    stg = staging.stg_trades(spark.createDataFrame(rows, schema))
    assert _same(marts.fct_trades(stg, method="plain"), scaled.fct_trades_scaled(stg, block_rows=10, partitions=3))


def test_ranks_carry_over_range_boundaries(spark):
    """Nine tenths of the values lie within one per cent, a third of all rows share one."""
    near = F.when(F.col("id") % 3 == 0, F.lit(0.25)).when(F.col("id") % 10 == 1, F.col("id") - 500).when(F.col("id") % 50 == 2, F.lit(None))
    df = spark.range(2000).select("id", near.otherwise((F.col("id") % 97) / 100).cast("decimal(18,8)").alias("change"))
    order = Window.orderBy(F.col("change").desc_nulls_first())
    want = df.withColumn("place", F.rank().over(order))
    for partitions in (1, 5, 16):
        assert _same(scaled.with_rank(df, "change", ["id"], "place", partitions), want)
    assert _same(scaled.with_rank(df.repartition(7), "change", ["id"], "place"), want)
    assert scaled.with_rank(df.limit(0), "change", ["id"], "place").count() == 0
    repeated = df.unionByName(df)  # copies that nothing tells apart
    assert _same(scaled.with_rank(repeated, "change", ["id"], "place", 9), repeated.withColumn("place", F.rank().over(order)))


def test_no_range_holds_a_hot_value(spark):
    df = spark.range(4000).select("id", F.when(F.col("id") % 3 > 0, F.lit(1)).otherwise(F.col("id")).alias("change"))
    tagged = scaled.range_tagged(df, [F.col("change").desc_nulls_first(), F.col("id").asc_nulls_last()], 16)
    sizes = [r[0] for r in tagged.groupBy("_pid").count().select("count").collect()]
    assert len(sizes) >= 12 and max(sizes) < 2.5 * 4000 / 16  # boundaries are sampled


def test_snapshot_ranks_equal_plain_windows(spark):
    m = standin_models(spark, SF_SMALL)
    got = metrics.symbol_volume(m.stg_trades, m.stg_tickers, all_snapshots=True)
    want = got.drop("momentum_rank").withColumn("momentum_rank", F.rank().over(Window.orderBy(F.col("price_change_pct").desc_nulls_first())))
    assert _same(got, want.select(*got.columns))


def test_tagged_trades_are_narrow_and_not_shuffled_for_their_places(spark):
    stg = staging.stg_trades(tape_trades(spark, SF_SMALL))
    found = scaled.fct_trades_scaled(stg, block_rows=100)
    base = ["trade_id", "traded_at", "quantity", "quote_qty", "trade_value_usdt", "trade_direction", "_keyed", "_key", "_series"]
    tables = [spark.read.parquet(f) for f in {p.rsplit("/", 1)[0] for p in found.inputFiles()}]
    assert [*base, "_pid", "_local"] in [t.columns for t in tables]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_series" in plan and "hashpartitioning(_pid" not in plan


def test_other_trade_keys_pass(spark):
    stg = staging.stg_trades(tape_trades(spark, SF_SMALL)).limit(200)
    other = stg.withColumn("trade_key", F.when(F.col("trade_id") % 3 == 0, "other").when(F.col("trade_id") % 3 == 1, F.col("trade_key")))
    other = scaled.written_table(other.withColumn("symbol", F.when(F.col("trade_id") % 5 > 0, F.col("symbol"))), "other")
    assert _same(marts.fct_trades(other, method="plain"), scaled.fct_trades_scaled(other, block_rows=20))
