"""Layered build: written tables equal the lazy models; marts are
partitioned by trade_date; views are registered for SQL."""

from __future__ import annotations

import datetime as dt
import json
import os

from candlewick.plans import materialize
from candlewick.plans.models import standin_models

SF_SMALL = "/root/testdata/sf0.001"


def test_build_writes_every_layer(spark, scratch):
    m = standin_models(spark, SF_SMALL)
    paths = materialize.build(spark, m.raw, os.path.join(scratch, "marts"))
    assert set(paths) >= {"stg_klines", "fct_candles", "fct_trades", "dim_symbols", "daily_summary"}
    assert any(d.startswith("trade_date=") for d in os.listdir(paths["fct_candles"]))
    for name in ("stg_klines", "stg_trades", "stg_tickers", "symbol_volume", "fct_candles", "fct_trades",
                 "daily_summary", "daily_summary_candle_grain"):
        model = getattr(m, name)
        written = spark.read.parquet(paths[name]).select(*model.columns)
        assert written.exceptAll(model).count() == model.exceptAll(written).count() == 0, name


def test_dimension_holds_the_time_of_the_run(spark, scratch):
    raw = standin_models(spark, SF_SMALL).raw
    before = dt.datetime.now()
    dim = spark.read.parquet(materialize.build(spark, raw, os.path.join(scratch, "marts"))["dim_symbols"])
    stamps = dim.selectExpr("last_updated_at >= timestamp'%s' as late" % before.astimezone(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")).collect()
    assert stamps and all(r.late for r in stamps)


def test_views_answer_sql(spark):
    m = standin_models(spark, SF_SMALL)
    materialize.register_views(m)
    n = spark.sql("select count(*) from fct_candles where volume_signal <> 'normal_volume'").first()[0]
    assert n == m.fct_candles.where("volume_signal <> 'normal_volume'").count()


def test_command_line_build_refresh_check(spark, scratch, capsys):
    from candlewick.__main__ import main
    from candlewick.operators import ingest

    raw = standin_models(spark, SF_SMALL).raw
    root, out = os.path.join(scratch, "raw"), os.path.join(scratch, "out")
    for name in ("klines", "trades", "tickers"):
        ingest.append_idempotent(spark, getattr(raw, name), root, name)
    assert main(["build", root, out]) == 0
    assert main(["refresh", root, out, "2024-01-25 00:00:00"]) == 0
    assert spark.read.parquet(os.path.join(out, "fct_trades")).count() == raw.trades.count()
    symbols = ["CLICKUSDT", "ERRORUSDT", "PURCHASEUSDT", "SIGNUPUSDT", "VIEWUSDT"]
    assert main(["check", out, *symbols]) == 1  # snapshots repeat symbols in stg_tickers
    assert "FAIL stg_tickers.symbol unique: 5" in capsys.readouterr().out


def test_command_line_loads_indented_arrays(spark, scratch):
    """Files as an extraction run leaves them: one indented array, stamps as ISO text."""
    from candlewick.__main__ import main
    from candlewick.operators import ingest

    raw = standin_models(spark, SF_SMALL).raw
    root, out = os.path.join(scratch, "raw"), os.path.join(scratch, "out")
    for name in ("klines", "trades", "tickers"):
        rows, landing = getattr(raw, name), os.path.join(scratch, "landing", name)
        os.makedirs(landing)
        records = [{k: v.isoformat() if isinstance(v, dt.datetime) else str(v) if hasattr(v, "as_tuple") else v
                    for k, v in r.asDict().items()} for r in rows.collect()]
        with open(os.path.join(landing, f"{name}.json"), "w") as f:
            json.dump(records, f, indent=2)
        assert main(["ingest", landing, name, root]) == 0
        os.rename(os.path.join(landing, f"{name}.json"), os.path.join(landing, "again.json"))
        assert main(["ingest", landing, name, root]) == 0  # a second run inserts nothing
        table = ingest.read_raw_table(spark, root, name)
        assert table.exceptAll(rows).count() == rows.exceptAll(table).count() == 0, name
    assert main(["build", root, out]) == 0
    assert spark.read.parquet(os.path.join(out, "daily_summary")).count() > 0


def test_tables_are_made_once_and_large_dates_are_split(spark, scratch):
    made = spark.sparkContext.accumulator(0)

    def seen(parts):
        for part in parts:
            made.add(len(part))
            yield part

    rows = spark.range(0, 20_000, 1, 8).selectExpr("if(id % 50 = 0, date'2024-01-02', date'2024-01-01') as trade_date", "id")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    try:
        materialize.write_table(rows.mapInPandas(seen, rows.schema), f"{scratch}/t", ("trade_date",), ("id",))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert made.value == 20_000
    assert sorted(r.id for r in spark.read.parquet(f"{scratch}/t").collect()) == list(range(20_000))
    assert len(os.listdir(f"{scratch}/t/trade_date=2024-01-01")) > 4
