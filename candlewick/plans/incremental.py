"""Incremental refresh of the tables that grow with time.

A full refresh recomputes every candle of every symbol each run.  Only the
rows at or after ``since`` can change when new candles arrive, and their
windows reach back a bounded number of rows:

* candle metrics look back 29 candles (MA 30) per symbol, and the price
  rank only compares candles of the same hour;
* the daily mart looks back 6 days (rolling 7) plus one (volume change);
* the trade fact looks back nine trades and one running total per symbol, which
  the table of ``trade_tails`` keeps for every day;
* the symbol tables merge partial aggregates per symbol and day
  (``operators.partials``).

So the refresh reads the raw candles of the ``open_date`` partitions from
``since``'s day on (exact: the de-duplication key holds the open time), and
the earlier rows from the written tables, walking back over their
``trade_date`` partitions until every symbol concerned has enough rows or the
table begins.  It recomputes, overwrites the ``trade_date`` partitions from
that day on and removes those that no longer have a row.  The result equals a
full refresh; ``tests/test_incremental.py`` checks that.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.operators import marts, metrics, partials, scaled, staging
from candlewick.operators.ingest import read_raw_table
from candlewick.operators.scaled import written_table
from candlewick.plans import materialize
from candlewick.plans.materialize import CLUSTER_BY, MART_PARTITIONS
from candlewick.session import scratch_scope

CANDLE_LOOKBACK = metrics.MA_SLOW - 1  # rows before the first new candle
DAY_LOOKBACK = marts.ROLLING_DAYS  # days before the first new day (6 + 1 for lag)


def _since(value) -> F.Column:
    """Start of the UTC day of ``value``: partitions are whole days, so a
    refresh always rewrites whole days."""
    text = value.isoformat(sep=" ") if isinstance(value, _dt.datetime) else str(value)
    return F.date_trunc("day", F.lit(text).cast("timestamp"))


def _tail_before(df: DataFrame, time_col: str, start: F.Column, rows: int) -> DataFrame:
    """The newest ``rows`` rows of each symbol strictly before ``start``."""
    w = Window.partitionBy("symbol").orderBy(F.col(time_col).desc_nulls_last())
    earlier = df.where(F.col(time_col) < start)
    return earlier.select("*", F.row_number().over(w).alias("_rn")).where(F.col("_rn") <= rows).drop("_rn")


def candles_since(stg_klines: DataFrame, since) -> DataFrame:
    """``fct_candles`` rows whose candle opened at or after ``since``."""
    start = _since(since)
    context = stg_klines.where(F.col("opened_at") >= start).unionByName(
        _tail_before(stg_klines, "opened_at", start, CANDLE_LOOKBACK)
    )
    fresh = marts.fct_candles(metrics.price_metrics(context))
    return fresh.where(F.col("opened_at") >= start)


def daily_since(fct_candles: DataFrame, daily_table: DataFrame, since) -> DataFrame:
    """Day-grain ``daily_summary`` rows for days on or after ``since``'s date.

    Those days are re-aggregated from the candle fact; the trend windows get
    the newest ``DAY_LOOKBACK`` earlier days of each symbol from the daily
    table already written.
    """
    start_day = F.to_date(_since(since))
    fresh = marts.daily_aggregates(fct_candles.where(F.col("trade_date") >= start_day))
    prior = _tail_before(daily_table, "trade_date", start_day, DAY_LOOKBACK).select(*fresh.columns)
    return marts.with_daily_trends(fresh.unionByName(prior)).where(F.col("trade_date") >= start_day)


def overwrite_partitions(df: DataFrame, path: str, table: str) -> None:
    """Replace only the ``trade_date`` partitions present in ``df``."""
    keys = [*MART_PARTITIONS[table], *CLUSTER_BY.get(table, ())]
    writer = df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*MART_PARTITIONS[table]).parquet(path)


def partition_days(spark: SparkSession, path: str) -> list[str]:
    """The ``trade_date`` partitions of a written table, from its folder names."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().getName() for s in place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)]
    return sorted(n.removeprefix("trade_date=") for n in names if re.fullmatch(r"trade_date=\d{4}-\d\d-\d\d", n))


def drop_days(spark: SparkSession, path: str, days: list[str]) -> None:
    jvm = spark._jvm
    for day in days:
        place = jvm.org.apache.hadoop.fs.Path(f"{path}/trade_date={day}")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def earlier_rows(spark: SparkSession, path: str, time_col: str, start_day: str, rows: int, symbols: DataFrame,
                 first_days: DataFrame | None = None) -> DataFrame:
    """The newest ``rows`` rows of each of ``symbols`` before a day, read from the
    fewest partitions of a written table that a walk back by doubling needs.

    ``first_days`` (``symbol``, ``first_day``) tells where the rows of a symbol begin, so
    that a new listing with fewer rows does not send the walk to the start of the table.
    """
    table = spark.read.parquet(path)
    days = [d for d in partition_days(spark, path) if d < start_day]
    take = 2
    while True:
        since = days[-take] if take < len(days) else (days[0] if days else start_day)
        part = table.where((F.col("trade_date") >= F.lit(since).cast("date")) & (F.col("trade_date") < F.lit(start_day).cast("date")))
        part = part.join(symbols, "symbol", "left_semi")
        enough = part.groupBy("symbol").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= rows)
        wanted = symbols
        if first_days is not None:
            wanted = symbols.join(first_days.where(F.col("first_day") < F.lit(since).cast("date")), "symbol", "left_semi")
        if take >= len(days) or wanted.join(enough, "symbol", "left_anti").isEmpty():
            w = Window.partitionBy("symbol").orderBy(F.col(time_col).desc_nulls_last())
            return part.select("*", F.row_number().over(w).alias("_rn")).where(F.col("_rn") <= rows).drop("_rn")
        take *= 2


def raw_since(spark: SparkSession, root: str, start_day: str) -> DataFrame:
    """Staged candles of the raw partitions from a day on."""
    raw = read_raw_table(spark, root, "klines", with_partition=True)
    return staging.stg_klines(raw.where(F.col("open_date") >= F.lit(start_day).cast("date")).drop("open_date"))


def start_day(spark: SparkSession, since) -> str:
    return spark.range(1).select(F.to_date(_since(since)).cast("string")).first()[0]


def replace_from(spark: SparkSession, table: str, rows: DataFrame, path: str, start: str) -> None:
    """Replace the days of a written table from ``start`` on, and the rows without a day
    where ``rows`` has some.  ``rows`` is read twice: pass a written copy."""
    fresh = {str(r[0]) for r in rows.select("trade_date").distinct().collect()}  # one per day
    overwrite_partitions(rows, path, table)
    drop_days(spark, path, [d for d in partition_days(spark, path) if d >= start and d not in fresh])


# What ``refresh`` and ``refresh_trades`` replace by days; the other tables are small, one
# row per symbol or ticker snapshot.
CANDLE_TABLES = ("stg_klines", "price_metrics", "fct_candles", "candle_partials", "daily_summary", "daily_summary_candle_grain")
TRADE_TABLES = ("stg_trades", "fct_trades", "trade_tails", "trade_partials")


def refresh(spark: SparkSession, root: str, paths: dict[str, str], since) -> None:
    """Refresh the candle fact, and those of ``CANDLE_TABLES`` that ``paths`` names, from
    ``since``'s day on, from the raw tables under ``root``."""
    start = start_day(spark, since)
    day = F.lit(start).cast("date")

    def replace(table: str, rows: DataFrame) -> None:
        if table in paths:
            replace_from(spark, table, written_table(materialize.dated(table, rows), table), paths[table], start)

    with scratch_scope(spark):
        new = written_table(raw_since(spark, root, start), "new_candles")
        symbols = new.select("symbol").distinct()
        first_days = None
        if "candle_partials" in paths:
            known = spark.read.parquet(paths["candle_partials"])
            first_days = written_table(known.groupBy("symbol").agg(F.min("trade_date").alias("first_day")), "first_days")
        tail = written_table(
            earlier_rows(spark, paths["fct_candles"], "opened_at", start, CANDLE_LOOKBACK, symbols, first_days), "earlier_candles")
        used = [c for c in new.columns if c in tail.columns]
        context = new.select(*used).unionByName(tail.select(*used))
        measured = written_table(metrics.price_metrics(context).where(F.to_date("opened_at") >= day), "measured")
        replace("stg_klines", new)
        replace("price_metrics", measured)
        replace("fct_candles", marts.fct_candles(measured))
        replace("candle_partials", partials.candle_partials(new))

        fct = spark.read.parquet(paths["fct_candles"]).where(F.col("trade_date") >= day)
        if "daily_summary" in paths:
            days = marts.daily_aggregates(fct)
            prior = earlier_rows(spark, paths["daily_summary"], "trade_date", start, DAY_LOOKBACK, symbols, first_days).select(*days.columns)
            replace("daily_summary", marts.with_daily_trends(days.unionByName(prior)).where(F.col("trade_date") >= day))
        if "daily_summary_candle_grain" in paths:  # its windows reach back fewer candles than the metrics'
            grain = marts.daily_summary_candle_grain(fct.unionByName(tail.select(*fct.columns)), sort=False)
            replace("daily_summary_candle_grain", grain.where(F.col("trade_date") >= day))


def refresh_trades(spark: SparkSession, root: str, paths: dict[str, str], since) -> None:
    """Refresh those of ``TRADE_TABLES`` that ``paths`` names (the tails always) from
    ``since``'s day on; pass the day of the earliest trade that came, also a late one.

    The raw trades from that day on are read by their time, which the scan compares
    with the statistics of files and row groups.  Frames and running totals start
    from the tails of the days before: nine trades per symbol and day, whatever the
    length of the history.  Trades without a time come last and are always taken.
    Trades without an id share one key over all days, and any may be the newest: the
    refresh then starts at the day of the first one.
    """
    start = start_day(spark, since)
    raw = read_raw_table(spark, root, "trades", with_partition=True)
    keyless = raw.where(F.col("id_block").isNull())
    first = keyless.select(F.min(F.to_date(F.timestamp_millis("trade_time"))).cast("string")).first()[0]
    start = min(start, first or start)
    moment = F.unix_millis(F.lit(start).cast("timestamp"))

    with scratch_scope(spark):
        taken = raw.where((F.col("trade_time") >= moment) | F.col("trade_time").isNull()).drop("id_block")
        new = written_table(materialize.dated("stg_trades", staging.stg_trades(taken)), "new_trades")
        shape = scaled.trade_tails(marts.fct_trades(new, method="plain")).schema  # nothing runs for it
        tails = spark.read.schema(shape).parquet(paths["trade_tails"])
        facts = written_table(scaled.fct_trades_from(new, tails, start), "fct_trades")
        for table, rows in (("stg_trades", new), ("fct_trades", facts), ("trade_partials", partials.trade_partials(new)),
                            ("trade_tails", scaled.trade_tails(facts))):
            if table in paths:
                replace_from(spark, table, written_table(rows, table), paths[table], start)
