"""The model graph as plain function composition.

    raw trades -> raw klines (1 h candles) -> stg_klines -> price_metrics
        -> fct_candles -> daily_summary / daily_summary_candle_grain
    raw trades -> raw tickers (24 h) -> stg_tickers -> latest_ticker
    raw trades -> stg_trades -> fct_trades
    stg_trades + stg_tickers -> symbol_volume
    stg_tickers + stg_klines -> dim_symbols

Every function returns a lazy DataFrame; nothing runs until an action or a
write.  ``Models`` memoises each node so that one plan reuses the same
subtree (Spark then reuses the exchange), and ``materialize`` writes the
marts once.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from candlewick.operators import bars, marts, metrics, staging
from candlewick.sources.standins import trades_from_events, trades_from_lineitem
from candlewick.sources.tables import read_table

# Fixed stamp used for dim_symbols.last_updated_at in reproducible runs.
DEFAULT_AS_OF = _dt.datetime(2024, 2, 1, 0, 0, 0)


class Raw:
    """The three raw tables; each is built on first access only."""

    def __init__(self, klines=None, trades=None, tickers=None, *, derive_from_trades: bool = False):
        self._klines, self._trades, self._tickers = klines, trades, tickers
        self._derive = derive_from_trades

    @property
    def trades(self) -> DataFrame:
        return self._trades

    @property
    def klines(self) -> DataFrame:
        if self._klines is None and self._derive:
            self._klines = bars.candles_from_trades(self._trades)
        return self._klines

    @property
    def tickers(self) -> DataFrame:
        if self._tickers is None and self._derive:
            self._tickers = bars.tickers_from_trades(self._trades)
        return self._tickers


def standin_raw(spark: SparkSession, sf_dir: str) -> Raw:
    """Raw market tables derived from the driver's ``events`` table."""
    trades = trades_from_events(read_table(spark, sf_dir, "events"))
    return Raw(trades=trades, derive_from_trades=True)


def tape_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The larger raw trade tape derived from ``lineitem`` (duplicate keys)."""
    return trades_from_lineitem(read_table(spark, sf_dir, "lineitem"))


@dataclass
class Models:
    raw: Raw
    as_of: _dt.datetime | None = None  # None: the time of the run
    _memo: dict = field(default_factory=dict)

    def _get(self, name, build):
        if name not in self._memo:
            self._memo[name] = build()
        return self._memo[name]

    @property
    def stg_klines(self) -> DataFrame:
        return self._get("stg_klines", lambda: staging.stg_klines(self.raw.klines))

    @property
    def stg_trades(self) -> DataFrame:
        return self._get("stg_trades", lambda: staging.stg_trades(self.raw.trades))

    @property
    def stg_tickers(self) -> DataFrame:
        return self._get("stg_tickers", lambda: staging.stg_tickers(self.raw.tickers))

    @property
    def latest_ticker(self) -> DataFrame:
        return self._get("latest_ticker", lambda: staging.latest_ticker(self.stg_tickers))

    @property
    def price_metrics(self) -> DataFrame:
        return self._get("price_metrics", lambda: metrics.price_metrics(self.stg_klines))

    @property
    def symbol_volume(self) -> DataFrame:
        return self._get("symbol_volume", lambda: metrics.symbol_volume(self.stg_trades, self.stg_tickers))

    @property
    def fct_candles(self) -> DataFrame:
        return self._get("fct_candles", lambda: marts.fct_candles(self.price_metrics))

    @property
    def fct_trades(self) -> DataFrame:
        return self._get("fct_trades", lambda: marts.fct_trades(self.stg_trades))

    @property
    def dim_symbols(self) -> DataFrame:
        return self._get(
            "dim_symbols", lambda: marts.dim_symbols(self.stg_tickers, self.stg_klines, as_of=self.as_of)
        )

    @property
    def daily_summary(self) -> DataFrame:
        return self._get("daily_summary", lambda: marts.daily_summary(self.fct_candles))

    @property
    def daily_summary_candle_grain(self) -> DataFrame:
        return self._get(
            "daily_summary_candle_grain", lambda: marts.daily_summary_candle_grain(self.fct_candles)
        )


def standin_models(spark: SparkSession, sf_dir: str, as_of=DEFAULT_AS_OF) -> Models:
    return Models(standin_raw(spark, sf_dir), as_of=as_of)
