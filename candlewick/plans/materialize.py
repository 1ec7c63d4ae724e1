"""Materialisation of the model layers.

* Staging and intermediate models are views in the original job; here they
  can be registered as temporary views (``register_views``) for SQL users.
* ``build`` writes the layers in order: the staging tables are written once
  and read back, so the two consumers of staged candles (price metrics and
  the symbol dimension) do not recompute them, and a lost executor only
  re-runs tasks of the current layer (lineage is cut at each written table).
  Tables with a time are partitioned by ``trade_date``, so that dashboard
  filters on dates prune files and a refresh replaces whole days; the symbol
  tables are merged from partials per symbol and day.
  The tables are written aside and moved into place together (``plans.publish``),
  so a build that fails or is running leaves the old ones whole.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.temporal import trade_date
from candlewick.operators import marts, metrics, partials, scaled, staging
from candlewick.plans.models import Models, Raw
from candlewick.plans.publish import published
from candlewick.session import scratch_scope

MART_PARTITIONS = {
    "stg_klines": ("trade_date",),
    "stg_trades": ("trade_date",),
    "price_metrics": ("trade_date",),
    "fct_candles": ("trade_date",),
    "fct_trades": ("trade_date",),
    "daily_summary": ("trade_date",),
    "daily_summary_candle_grain": ("trade_date",),
    "trade_tails": ("trade_date",),
    "trade_partials": ("trade_date",),
    "candle_partials": ("trade_date",),
    "dim_symbols": (),
}
CLUSTER_BY = {
    "stg_klines": ("symbol", "opened_at"),
    "stg_trades": ("symbol", "traded_at", "trade_id"),
    "price_metrics": ("symbol", "opened_at"),
    "fct_candles": ("symbol", "opened_at"),
    "fct_trades": ("symbol", "traded_at", "trade_id"),
    "daily_summary": ("symbol",),
    "daily_summary_candle_grain": ("symbol",),
    "trade_tails": ("symbol", "traded_at", "trade_id"),
    "trade_partials": ("symbol",),
    "candle_partials": ("symbol",),
}


SHARED = ("trade_partials", "candle_partials")  # tables that others read


# Models without a day of their own are written with the day of this column.
DAY_OF = {"stg_klines": "opened_at", "stg_trades": "traded_at", "price_metrics": "opened_at"}


def dated(table: str, df: DataFrame) -> DataFrame:
    """``df`` with the partition column of its written table."""
    return df.withColumn("trade_date", trade_date(DAY_OF[table])) if table in DAY_OF else df


def register_views(models: Models) -> list[str]:
    """Register every model as a temporary view named after it."""
    names = ["stg_klines", "stg_trades", "stg_tickers", "latest_ticker", "price_metrics", "symbol_volume",
             "fct_candles", "fct_trades", "dim_symbols", "daily_summary", "daily_summary_candle_grain"]
    for name in names:
        getattr(models, name).createOrReplaceTempView(name)
    return names


def write_table(df: DataFrame, path: str, partition_by=(), cluster_by=()) -> None:
    """Full refresh of one table.

    With partition columns, the rows of a date come together in one shuffle and
    are sorted by ``cluster_by`` within it, so each date is in few files.  The
    shuffle is a rebalance: adaptive execution splits a date that holds a large
    share of the rows over tasks and merges small ones.  Unlike a range shuffle
    it takes no sample, for which all that makes ``df`` would be computed twice.
    """
    writer = df
    if partition_by:
        dates = [F.col(c) for c in partition_by]
        writer = df.hint("rebalance", *dates).sortWithinPartitions(*partition_by, *cluster_by)
    w = writer.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


class _Writer:
    """Writes the tables of ``out_dir`` into the folder ``aside`` and reads them back;
    leaves those in ``skip``.  ``paths`` tells where they are once published."""

    def __init__(self, spark: SparkSession, out_dir: str, aside: str, skip: Collection[str] = ()):
        self.spark, self.out, self.aside, self.skip, self.paths = spark, out_dir.rstrip("/"), aside, skip, {}

    def put(self, name: str, make: Callable[[], DataFrame]) -> DataFrame | None:
        if name in self.skip:
            return self.spark.read.parquet(f"{self.out}/{name}") if name in SHARED else None
        df, path = dated(name, make()), f"{self.aside}/{name}"
        write_table(df, path, MART_PARTITIONS.get(name, ()), CLUSTER_BY.get(name, ()))
        self.paths[name] = f"{self.out}/{name}"
        return self.spark.read.schema(df.schema).parquet(path)  # a table without rows has no files to tell

    def candles(self, raw_klines: DataFrame) -> DataFrame | None:
        stg = self.put("stg_klines", lambda: staging.stg_klines(raw_klines))
        pm = self.put("price_metrics", lambda: metrics.price_metrics(stg))
        fct = self.put("fct_candles", lambda: marts.fct_candles(pm))
        self.put("daily_summary", lambda: marts.daily_summary(fct, sort=False))
        self.put("daily_summary_candle_grain", lambda: marts.daily_summary_candle_grain(fct, sort=False))
        return self.put("candle_partials", lambda: partials.candle_partials(stg))

    def trades(self, raw_trades: DataFrame) -> DataFrame | None:
        stg = self.put("stg_trades", lambda: staging.stg_trades(raw_trades))
        fct = self.put("fct_trades", lambda: marts.fct_trades(stg))
        self.put("trade_tails", lambda: scaled.trade_tails(fct))
        return self.put("trade_partials", lambda: partials.trade_partials(stg))


def build_candles(spark: SparkSession, raw_klines: DataFrame, out_dir: str) -> dict[str, str]:
    """The tables made of candles alone."""
    with scratch_scope(spark), published(spark, out_dir) as aside:
        writer = _Writer(spark, out_dir, aside)
        writer.candles(raw_klines)
    return writer.paths


def build_trades(spark: SparkSession, raw_trades: DataFrame, out_dir: str) -> dict[str, str]:
    """The tables made of trades alone."""
    with scratch_scope(spark), published(spark, out_dir) as aside:  # scratch: tables of the blocked windows
        writer = _Writer(spark, out_dir, aside)
        writer.trades(raw_trades)
    return writer.paths


def build(spark: SparkSession, raw: Raw, out_dir: str, as_of: _dt.datetime | None = None,
          skip: Collection[str] = ()) -> dict[str, str]:
    """Write staging, intermediate and mart tables under ``out_dir``; ``as_of`` is
    the dimension's stamp (default: the time of the run).
    Tables named in ``skip`` are left as they are; those in ``SHARED`` must then be
    there, as others read them."""
    with scratch_scope(spark), published(spark, out_dir) as aside:
        writer = _Writer(spark, out_dir, aside, skip)
        tickers = writer.put("stg_tickers", lambda: staging.stg_tickers(raw.tickers))
        of_candles, of_trades = writer.candles(raw.klines), writer.trades(raw.trades)
        writer.put("symbol_volume", lambda: metrics.volume_of_summary(partials.merged_trade_summary(of_trades), tickers))
        writer.put("dim_symbols", lambda: marts.dim_of_stats(tickers, partials.merged_candle_stats(of_candles), as_of=as_of))
    return writer.paths
