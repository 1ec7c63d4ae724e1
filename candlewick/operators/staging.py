"""Staging models: typed, keyed and de-duplicated raw records.

De-duplication keeps, per surrogate key, the row with the newest
``extracted_at`` (a NULL stamp counts as newest, as a descending sort puts
NULLs first in the original store).  Remaining ties are broken on every other
column so that the result is deterministic.  Rows whose key is NULL share one
group and collapse to a single row, like a window partition on NULL does.

``row_number() ... = 1`` lets Catalyst plan a partial top-1 per key before
the shuffle (``WindowGroupLimit``), so a hot key is reduced map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions import classify
from candlewick.functions.numeric import pct, rounded
from candlewick.functions.temporal import ms_to_ts, surrogate_key


def _tiebreak(cols: Sequence[str | Column]) -> list[Column]:
    return [(F.col(c) if isinstance(c, str) else c).asc_nulls_last() for c in cols]


def dedupe_latest(
    df: DataFrame,
    key: str | Column | Sequence[str],
    newest: str = "extracted_at",
    tiebreak: Sequence[str | Column] = (),
    keep_row_num: bool = True,
    parts: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the newest row per ``key`` (``row_num`` = 1 is kept as a column).

    ``parts`` optionally names the columns a concatenated surrogate ``key``
    was built from (numeric part first).  The window is then partitioned by
    those parts instead of the string, each set to NULL wherever the
    surrogate is NULL, which groups rows identically but lets the sort use
    the numeric part as its prefix (the partition expressions are evaluated
    in place, no helper columns).  The surrogate may then be an expression.
    """
    keys = [key] if isinstance(key, str | Column) else list(key)
    if parts:
        surrogate = F.col(keys[0]) if isinstance(keys[0], str) else keys[0]
        partition = [F.when(surrogate.isNotNull(), F.col(p)) for p in parts]
    else:
        partition = [F.col(k) for k in keys]
    w = Window.partitionBy(*partition).orderBy(F.col(newest).desc_nulls_first(), *_tiebreak(tiebreak))
    out = df.select("*", F.row_number().over(w).alias("row_num")).where(F.col("row_num") == 1)
    return out if keep_row_num else out.drop("row_num")


KLINE_TIEBREAK = (
    "symbol", "opened_at", "closed_at", "open_price", "high_price", "low_price",
    "close_price", "volume", "quote_asset_volume", "number_of_trades",
    "taker_buy_base_volume", "taker_buy_quote_volume",
)


def stg_klines(raw_klines: DataFrame) -> DataFrame:
    cleaned = raw_klines.select(
        surrogate_key("symbol", "open_time").alias("kline_id"),
        "symbol",
        ms_to_ts("open_time").alias("opened_at"),
        ms_to_ts("close_time").alias("closed_at"),
        "open_price",
        "high_price",
        "low_price",
        "close_price",
        "volume",
        "quote_asset_volume",
        F.col("number_of_trades").cast("int").alias("number_of_trades"),
        "taker_buy_base_volume",
        "taker_buy_quote_volume",
        (F.col("high_price") - F.col("low_price")).alias("price_range"),
        classify.candle_direction("close_price", "open_price").alias("candle_direction"),
        F.col("extracted_at").cast("timestamp_ntz").alias("extracted_at"),
    )
    return dedupe_latest(cleaned, "kline_id", tiebreak=KLINE_TIEBREAK, parts=("opened_at", "symbol"))


def stg_trades(raw_trades: DataFrame) -> DataFrame:
    """Typed trades, the newest record of each key.  The raw columns are de-duplicated
    and what follows from them is added after, so the shuffle holds narrow rows."""
    key, direction = surrogate_key("symbol", "trade_id"), classify.trade_direction("is_buyer_maker")
    raw = raw_trades.select(
        "symbol", "trade_id", "trade_time", "price", "quantity", "quote_qty", "is_buyer_maker",
        F.col("extracted_at").cast("timestamp_ntz").alias("extracted_at"),
    )
    tiebreak = ("symbol", "trade_id", "trade_time", "price", "quantity", "quote_qty", direction)
    return dedupe_latest(raw, key, tiebreak=tiebreak, parts=("trade_id", "symbol")).select(
        key.alias("trade_key"),
        "symbol",
        "trade_id",
        ms_to_ts("trade_time").alias("traded_at"),
        "price",
        "quantity",
        "quote_qty",
        (F.col("price") * F.col("quantity")).alias("trade_value_usdt"),
        direction.alias("trade_direction"),
        "extracted_at",
        "row_num",
    )


def stg_tickers(raw_tickers: DataFrame) -> DataFrame:
    """Typed ticker snapshots; not de-duplicated (one row per snapshot)."""
    return raw_tickers.select(
        "symbol",
        "price_change",
        "price_change_pct",
        "weighted_avg_price",
        "prev_close_price",
        "last_price",
        "open_price",
        "high_price",
        "low_price",
        "volume",
        "quote_volume",
        F.col("count").alias("trade_count"),
        ms_to_ts("open_time").alias("period_start"),
        ms_to_ts("close_time").alias("period_end"),
        rounded(pct(F.col("high_price") - F.col("low_price"), "open_price"), 4).alias("price_spread_pct"),
        F.col("extracted_at").cast("timestamp_ntz").alias("extracted_at"),
    )


def latest_ticker(tickers: DataFrame) -> DataFrame:
    """The newest snapshot per symbol (newest ``extracted_at``, then newest
    ``period_start``), so that joins on ``symbol`` do not fan out."""
    w = Window.partitionBy("symbol").orderBy(
        F.col("extracted_at").desc_nulls_first(), F.col("period_start").desc_nulls_first()
    )
    return tickers.select("*", F.row_number().over(w).alias("_rn")).where("_rn = 1").drop("_rn")


def newest_per_symbol(df: DataFrame, n: int, time_col: str, tiebreak: str | None = None) -> DataFrame:
    """The newest ``n`` rows of each symbol (what one API request returns).

    ``row_number() <= n`` is planned as a per-key top-n before the shuffle
    (``WindowGroupLimit``), so each map task forwards at most ``n`` rows
    per symbol, however large the history.
    """
    order = [F.col(time_col).desc_nulls_last()]
    if tiebreak:
        order.append(F.col(tiebreak).desc_nulls_last())
    w = Window.partitionBy("symbol").orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def restrict_symbols(df: DataFrame, symbols) -> DataFrame:
    """Keep the tracked symbols only (pushed down to the scan as an IN filter)."""
    return df.where(F.col("symbol").isin(list(symbols)))
