"""New tables take the place of old ones together; failed and lost runs leave whole tables."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from candlewick.plans import materialize, publish
from candlewick.plans.models import standin_raw

SF_SMALL = "/root/testdata/sf0.001"
TABLES = ("first", "second", "third")


def _write(spark, folder, n):
    for name in TABLES:
        spark.range(n).write.parquet(f"{folder}/{name}")


def _counts(spark, out):
    return [spark.read.parquet(f"{out}/{name}").count() for name in TABLES]


def test_tables_are_replaced_together(spark, scratch):
    with publish.published(spark, scratch) as aside:
        _write(spark, aside, 3)
    with publish.published(spark, scratch) as aside:
        _write(spark, aside, 5)
        assert _counts(spark, scratch) == [3] * 3
    assert _counts(spark, scratch) == [5] * 3
    assert set(os.listdir(scratch)) == set(TABLES)


def test_a_failed_write_leaves_the_old_tables(spark, scratch):
    with publish.published(spark, scratch) as aside:
        _write(spark, aside, 3)
    bad = spark.range(9).select(F.when(F.col("id") == 7, F.raise_error(F.lit("lost"))).otherwise("id").alias("id"))
    with pytest.raises(Exception, match="lost"), publish.published(spark, scratch) as aside:
        spark.range(5).write.parquet(f"{aside}/first")
        bad.write.parquet(f"{aside}/second")
    assert _counts(spark, scratch) == [3] * 3
    assert set(os.listdir(scratch)) == set(TABLES)


def test_a_lost_driver_leaves_whole_tables(spark, scratch):
    """Every place where a run can end: before the marker, and between any two renames."""
    with publish.published(spark, scratch) as aside:
        _write(spark, aside, 3)
    _write(spark, f"{scratch}/_new-lost", 4)  # no marker
    publish.recover(spark, scratch)
    assert _counts(spark, scratch) == [3] * 3 and set(os.listdir(scratch)) == set(TABLES)

    for n, renames in enumerate(range(7), start=10):
        folder = f"{scratch}/_new-lost"
        _write(spark, folder, n)
        open(f"{folder}/_DONE", "w").close()
        os.makedirs(f"{folder}/_old")
        moves = [m for t in TABLES for m in ((f"{scratch}/{t}", f"{folder}/_old/{t}"), (f"{folder}/{t}", f"{scratch}/{t}"))]
        for source, target in moves[:renames]:
            os.rename(source, target)
        publish.recover(spark, scratch)
        assert _counts(spark, scratch) == [n] * 3, renames
        assert set(os.listdir(scratch)) == set(TABLES)


def test_a_refused_rename_puts_the_old_table_back(spark, scratch, monkeypatch):
    with publish.published(spark, scratch) as aside:
        _write(spark, aside, 3)
    rename = publish._rename

    def refuse(spark, source, target):
        if source.endswith("/second") and "_new-" in source and "_old" not in source:
            raise OSError("refused")
        rename(spark, source, target)

    monkeypatch.setattr(publish, "_rename", refuse)
    with pytest.raises(OSError, match="refused"), publish.published(spark, scratch) as aside:
        _write(spark, aside, 5)
    assert _counts(spark, scratch) == [5, 3, 3]
    monkeypatch.undo()
    publish.recover(spark, scratch)  # the marker is there: the set goes in whole
    assert _counts(spark, scratch) == [5] * 3


def test_a_failed_build_leaves_the_old_tables(spark, scratch):
    klines = standin_raw(spark, SF_SMALL).klines
    paths = materialize.build_candles(spark, klines.limit(50), scratch)
    before = {n: sorted(map(str, spark.read.parquet(p).collect())) for n, p in paths.items()}
    newest = klines.agg(F.max("open_time")).first()[0]
    closed = F.when(F.col("open_time") == newest, F.raise_error(F.lit("lost")).cast("decimal(18,8)")).otherwise(F.col("close_price"))
    with pytest.raises(Exception, match="lost"):
        materialize.build_candles(spark, klines.withColumn("close_price", closed), scratch)
    assert {n: sorted(map(str, spark.read.parquet(p).collect())) for n, p in paths.items()} == before
