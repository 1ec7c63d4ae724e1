"""Column-level data-quality tests (unique, not_null, accepted_values).

Counting follows the usual schema-test conventions:

* ``not_null``: rows whose value is NULL;
* ``unique``: distinct non-NULL values that occur more than once;
* ``accepted_values``: distinct non-NULL values outside the list.

The ``not_null`` tests of a model are one aggregate without a shuffle of rows;
a ``unique`` column is counted by its typed value, an ``accepted_values`` column
only where the value is outside the list (both partially aggregated first, so a
hot value costs one row per map task).  So a model is scanned once per such
column, reading that column only, and once for all nulls.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESULT_COLUMNS = ("model", "column_name", "test", "failures")


@dataclass(frozen=True)
class Rule:
    test: str  # "unique" | "not_null" | "accepted_values"
    column: str
    values: tuple[str, ...] = ()


def unique(c: str) -> Rule:
    return Rule("unique", c)


def not_null(c: str) -> Rule:
    return Rule("not_null", c)


def accepted_values(c: str, values: Sequence[str]) -> Rule:
    return Rule("accepted_values", c, tuple(values))


def check(df: DataFrame, model: str, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: (model, column_name, test, failures)."""

    def row(rule: Rule, failures) -> list:
        return [F.lit(model), F.lit(rule.column), F.lit(rule.test), failures.cast("long")]

    parts = []
    nulls = [r for r in rules if r.test == "not_null"]
    if nulls:
        counts = df.agg(*(F.count_if(F.col(r.column).isNull()).alias(f"f{i}") for i, r in enumerate(nulls)))
        entries = [F.struct(*row(r, F.col(f"f{i}"))) for i, r in enumerate(nulls)]
        parts.append(counts.select(F.inline(F.array(*entries))))
    for r in rules:
        value = F.col(r.column)
        if r.test == "unique":
            often = df.where(value.isNotNull()).groupBy(r.column).agg(F.count(F.lit(1)).alias("n"))
            parts.append(often.agg(F.count_if(F.col("n") > 1).alias("f")).select(*row(r, F.col("f"))))
        elif r.test == "accepted_values":
            other = df.where(value.isNotNull() & ~value.cast("string").isin(*r.values)).select(r.column).distinct()
            parts.append(other.agg(F.count(F.lit(1)).alias("f")).select(*row(r, F.col("f"))))
    return functools.reduce(DataFrame.union, parts).toDF(*RESULT_COLUMNS)


def declared_suite(models: dict[str, DataFrame], symbols: Sequence[str]) -> DataFrame:
    """The 28 declared tests over the staging, intermediate and mart models.

    ``symbols`` is the accepted list for the staged candle symbols.
    """
    suite = {
        "stg_klines": [unique("kline_id"), not_null("kline_id"), not_null("symbol"),
                       accepted_values("symbol", symbols), not_null("close_price")],
        "stg_trades": [unique("trade_key"), not_null("trade_key"), not_null("symbol"), not_null("price")],
        "stg_tickers": [unique("symbol"), not_null("symbol")],
        "price_metrics": [unique("kline_id"), not_null("kline_id"), not_null("symbol")],
        "symbol_volume": [unique("symbol"), not_null("symbol")],
        "fct_candles": [unique("kline_id"), not_null("kline_id"), not_null("symbol"),
                        not_null("close_price"), not_null("trade_date")],
        "fct_trades": [unique("trade_key"), not_null("trade_key"), not_null("symbol")],
        "dim_symbols": [unique("symbol"), not_null("symbol")],
        "daily_summary": [not_null("symbol"), not_null("trade_date")],
    }
    return functools.reduce(
        DataFrame.unionByName, [check(models[name], name, rules) for name, rules in suite.items()]
    )
