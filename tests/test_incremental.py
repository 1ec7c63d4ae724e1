"""Incremental refresh of the candle fact and the daily mart equals a full
refresh over all candles."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from candlewick.operators import ingest, marts, metrics, staging
from candlewick.plans import incremental, materialize
from candlewick.plans.models import standin_raw

SF_SMALL = "/root/testdata/sf0.001"
SINCE = dt.datetime(2024, 1, 20, 13, 0, 0)


def _same(a, b):
    return a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_refresh_equals_full_build(spark, scratch):
    raw = standin_raw(spark, SF_SMALL).klines
    root, out, whole = (os.path.join(scratch, x) for x in ("raw", "out", "whole"))
    moment = F.lit(int(SINCE.replace(tzinfo=dt.timezone.utc).timestamp() * 1000))
    ingest.append_idempotent(spark, raw.where(F.col("open_time") < moment), root, "klines")
    paths = {name: os.path.join(out, name) for name in ("fct_candles", "daily_summary")}

    def written(stg, at):
        first = marts.fct_candles(metrics.price_metrics(stg))
        for name, df in (("fct_candles", first), ("daily_summary", marts.daily_summary(first, sort=False))):
            materialize.write_table(df, os.path.join(at, name), ("trade_date",), materialize.CLUSTER_BY[name])

    def equal(stg):
        written(stg, whole)
        for name, path in paths.items():
            want = spark.read.parquet(os.path.join(whole, name))
            assert _same(spark.read.parquet(path).select(*want.columns), want), name

    written(staging.stg_klines(ingest.read_raw_table(spark, root, "klines")), out)
    ingest.append_idempotent(spark, raw, root, "klines")
    incremental.refresh(spark, root, paths, SINCE)
    equal(staging.stg_klines(raw))

    # a day whose candles are gone loses its partition
    import shutil

    shutil.rmtree(os.path.join(root, "raw_klines", "open_date=2024-01-25"))
    incremental.refresh(spark, root, paths, "2024-01-25 00:00:00")
    assert "2024-01-25" not in incremental.partition_days(spark, paths["daily_summary"])
    equal(staging.stg_klines(ingest.read_raw_table(spark, root, "klines")))


def test_refresh_reads_only_the_partitions_it_needs(spark, scratch):
    raw = standin_raw(spark, SF_SMALL).klines
    ingest.append_idempotent(spark, raw, scratch, "klines")
    new = ingest.read_raw_table(spark, scratch, "klines", with_partition=True).where("open_date >= date'2024-01-28'")
    new.collect()
    days = new.select("open_date").distinct().count()
    assert new._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics().apply("numPartitions").value() == days < 6
    path = os.path.join(scratch, "fct")
    materialize.write_table(marts.fct_candles(metrics.price_metrics(staging.stg_klines(raw))), path, ("trade_date",))
    tail = incremental.earlier_rows(spark, path, "opened_at", "2024-01-28", 29, raw.select("symbol").distinct())
    assert tail.groupBy("symbol").count().where("count <> 29").count() == 0
    assert tail.agg(F.min("trade_date")).first()[0] >= dt.date(2024, 1, 20)
